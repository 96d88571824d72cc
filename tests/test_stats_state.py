"""K3, G1-G3, G5 from mergeable state: loads, replays, a deletion and compaction equal the full refresh."""

import os
import random

from pyspark.sql import functions as F

from opinio.operators import stats as G
from opinio.operators import stats_state as ST


def test_loads_and_a_deletion_equal_the_full_refresh(spark, tmpdir_fresh):
    r = random.Random(4)
    arts = [(i, r.choice(["china", "usa", None]), r.choice(["text", "image", "video"]), r.choice(["a", "b", None]), f"2024-0{r.randint(1, 3)}-10") for i in range(200)]
    rows = [(i, s, str(round(r.uniform(-1, 1), 2))) for i in range(200) for s in r.sample(["positive", "neutral", "negative"], r.choice([0, 1, 1, 2]))]
    corpus = spark.createDataFrame(arts, "id long, source string, type string, media_name string, d string").withColumn("publish_date", F.to_date("d")).cache()
    sent = spark.createDataFrame(rows, "corpus_id long, sentiment string, s string").withColumn("sentiment_score", F.col("s").cast("decimal(3,2)")).cache()
    path = os.path.join(tmpdir_fresh, "state")
    for load in range(3):
        part = lambda df, key, k=load: df.where(F.col(key) % 3 == k)
        assert ST.add_load(part(corpus, "id"), part(sent, "corpus_id"), path, f"l{load}")
    assert not ST.add_load(corpus.where("id % 3 = 1"), sent.where("corpus_id % 3 = 1"), path, "l1")
    gone = corpus.where("id % 7 = 2 OR source = 'usa' AND type = 'video'").select("id")
    assert ST.subtract(corpus, sent, gone, path, "gone")
    left, kept = corpus.join(gone, "id", "left_anti"), sent.join(gone.select(F.col("id").alias("corpus_id")), "corpus_id", "left_anti")
    packed = os.path.join(tmpdir_fresh, "packed")
    assert ST.compacted(spark, path, packed)
    for at in (path, packed):
        cells = ST.state(spark, at)
        same = lambda a, b: sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))
        assert same(ST.source_statistics(cells, "2024-12-31"), G.source_statistics(left, kept, "2024-12-31"))
        assert same(ST.corpus_statistics(cells), G.corpus_statistics(left))
        assert same(ST.sentiment_statistics(cells), G.sentiment_statistics(left, kept))
        assert same(ST.media_activity(cells), G.media_activity(left))
