"""Streaming equals batch on the driver's pages and documents."""

import os

from pyspark.sql import functions as F

from conftest import SMALL
from pyspark.sql import types as T

from opinio.operators import pages as P
from opinio.sinks import merge as MG
from opinio.streaming import pages as SP


def test_stream_new_pages_equals_batch(spark, tmpdir_fresh):
    landing = os.path.join(tmpdir_fresh, "landing")
    src = spark.read.parquet(f"{SMALL}/pages.parquet")
    # land the same pages twice (two files): the stream must process each URL once
    src.write.parquet(os.path.join(landing, "a"))
    src.write.parquet(os.path.join(landing, "b"))
    stream = SP.read_landing(spark, os.path.join(landing, "*"), max_files_per_trigger=1)
    SP.run_available(SP.stream_new_pages(stream), os.path.join(tmpdir_fresh, "ck1"), "append", "paras_out")
    got = spark.table("paras_out").select("page_id", "pos", "paragraph")
    exp = P.page_paragraphs(src.select("page_id", "url", "html"))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_stream_source_counts_equals_batch(spark, tmpdir_fresh):
    landing = os.path.join(tmpdir_fresh, "docs")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.where(F.col("doc_id") % 2 == 0).write.parquet(os.path.join(landing, "p0"))
    docs.where(F.col("doc_id") % 2 == 1).write.parquet(os.path.join(landing, "p1"))
    stream = SP.read_landing(spark, os.path.join(landing, "*"), SP.DOCUMENTS_SCHEMA, max_files_per_trigger=1)
    SP.run_available(SP.stream_source_counts(stream), os.path.join(tmpdir_fresh, "ck2"), "complete", "counts_out")
    got = {r["source"]: r["count"] for r in spark.table("counts_out").collect()}
    exp = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    assert got == exp


PARAGRAPHS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("paragraph", T.StringType())])


def stored(spark, path):
    return sorted(tuple(r) for r in MG.read_stored(spark, path, PARAGRAPHS).collect())


def test_restart_and_replay_store_every_paragraph_once(spark, tmpdir_fresh):
    landing, path, checkpoint = (os.path.join(tmpdir_fresh, n) for n in ("landing", "paragraphs", "ck"))
    src = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").cache()

    def run():
        stream = SP.read_landing(spark, os.path.join(landing, "*"), max_files_per_trigger=1)
        SP.store_available(SP.stream_new_pages(stream), checkpoint, path, ["page_id", "pos"], "pages", parts=4)

    want = lambda rows: sorted(tuple(r) for r in P.page_paragraphs(rows).collect())
    src.where("page_id < 20").coalesce(1).write.parquet(os.path.join(landing, "a"))
    run()
    assert stored(spark, path) == want(src.where("page_id < 20"))
    src.where("page_id < 35").coalesce(1).write.parquet(os.path.join(landing, "b"))     # URLs seen and new ones
    run()                                                                                # restarted from its checkpoint
    assert stored(spark, path) == want(src.where("page_id < 35"))
    done, loads = sorted(os.listdir(os.path.join(checkpoint, "commits")), key=lambda n: (n.startswith("."), n)), MG.loads(spark, path).count()
    last = max(int(n) for n in done if n.isdigit())
    for name in (str(last), f".{last}.crc"):                                             # written, but not committed
        if os.path.exists(os.path.join(checkpoint, "commits", name)):
            os.remove(os.path.join(checkpoint, "commits", name))
    run()
    assert stored(spark, path) == want(src.where("page_id < 35")) and MG.loads(spark, path).count() == loads


def test_late_rows_repeats_and_stored_urls(spark, tmpdir_fresh):
    landing, path = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "out")
    schema = T.StructType([*SP.PAGES_SCHEMA.fields, T.StructField("seen_at", T.TimestampType())])
    page = "<article><p>%d</p></article>"

    def land(name, rows):
        df = spark.createDataFrame([(i, f"u{u}", page % i) for i, u, _ in rows], SP.PAGES_SCHEMA)
        times = spark.createDataFrame([(i, t) for i, _, t in rows], "page_id long, t string")
        df.join(times, "page_id").select("page_id", "url", "html", F.col("t").cast("timestamp").alias("seen_at")).coalesce(1).write.parquet(os.path.join(landing, name))

    land("a", [(1, 1, "2024-01-01 10:00:00"), (2, 2, "2024-01-01 12:00:00"), (9, 9, "2024-01-01 12:00:00")])
    ready = spark.createDataFrame([("u9",)], "url string")

    def run():
        stream = SP.read_landing(spark, os.path.join(landing, "*"), schema, 1, "seen_at")
        SP.store_available(SP.stream_new_pages(stream, "1 hour", ready, "seen_at"), os.path.join(tmpdir_fresh, "ck"), path, ["page_id", "pos"], "late", parts=2)

    run()
    assert [r[0] for r in stored(spark, path)] == [1, 2]                     # u9 is stored already
    # the watermark is 11:00 now: 9:00 is late, 11:30 repeats u2, 12:30 is new
    land("b", [(3, 3, "2024-01-01 09:00:00"), (4, 2, "2024-01-01 11:30:00"), (5, 5, "2024-01-01 12:30:00")])
    run()
    assert [r[0] for r in stored(spark, path)] == [1, 2, 5]
