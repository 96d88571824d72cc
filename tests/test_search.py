"""Phrase and n-gram search: brute force, many phrases, plans."""

import random

from pyspark.sql import functions as F

from conftest import SMALL
from opinio.operators import ingest as I
from opinio.operators import search as SR
from opinio.operators.matching import contained_pairs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs_of(spark, texts):
    return spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(texts)], "doc_id long, url string, text string").withColumn("title", F.lit("t"))


def test_contained_pairs_equal_brute_force(spark):
    r = random.Random(3)
    bits = ["a", "b", "ab", "Ba", " ", "  ", "\n", "é", "the", "x1", ""]
    make = lambda most: "".join(r.choice(bits) for _ in range(r.randint(0, most)))
    xs, ys = [make(7) for _ in range(150)], [make(16) for _ in range(120)]
    x = spark.createDataFrame(list(enumerate(xs)), "x_id long, x_str string")
    y = spark.createDataFrame(list(enumerate(ys)), "y_id long, y_str string")
    pairs = [(p["x_id"], p["y_id"]) for p in contained_pairs(x, y).collect()]
    assert sorted(pairs) == [(i, j) for i, a in enumerate(xs) for j, b in enumerate(ys) if a in b]
    proper = [(p["x_id"], p["y_id"]) for p in contained_pairs(x, y, proper=True).collect()]
    assert sorted(proper) == [(i, j) for i, a in enumerate(xs) for j, b in enumerate(ys) if a in b and a != b]


def test_phrases_of_every_kind(spark):
    texts = ["The cat sat on the mat", "cats and THE\ndog", "", None, "on the  mat", "a"]
    phrases = ["the", "cat s", "the mat", "sat on the m", "", " ", "The\nDog", "zebra", "t on the ma", "İ"]
    got = {(h["phrase"], h["doc_id"]) for h in I.phrase_search(docs_of(spark, texts), I.phrases_df(spark, phrases)).collect()}
    assert got == {(p, i) for p in phrases for i, t in enumerate(texts) if t is not None and p.lower() in t.lower()}


def test_a_hundred_thousand_phrases_without_a_nested_loop(spark):
    docs = (spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.concat(F.lit("u"), "doc_id").alias("url"), "text")
            .withColumn("title", F.lit("t")))
    texts = {d["doc_id"]: d["text"].lower() for d in docs.collect() if d["text"]}
    ids = sorted(texts)
    r = random.Random(4)
    phrases = []
    for k in range(100_000):
        t = texts[r.choice(ids)]
        at = r.randrange(len(t))
        phrases.append((k, t[at:at + r.randint(9, 30)] + ("" if r.random() < 0.5 else "q" * 3)))
    p = spark.createDataFrame(phrases, I.PHRASE_SCHEMA)
    hits = I.phrase_hits(docs, p)
    assert "NestedLoop" not in plan_of(hits) and "Cartesian" not in plan_of(hits)
    asked = set(r.sample(range(100_000), 400))
    got = {(h["phrase_seq"], h["doc_id"]) for h in hits.collect() if h["phrase_seq"] in asked}
    assert got == {(k, i) for k in asked for i, t in texts.items() if phrases[k][1] in t}


def test_ngram_search_joins_on_bigrams(spark):
    texts, phrases = ["Abc ab", "bc a b", "x y", "", None, "ab ab ab"], ["ab bc", "xy", "a", "Abc"]
    found = SR.ngram_search(docs_of(spark, texts).withColumn("title", F.lit("")), I.phrases_df(spark, phrases))
    assert "NestedLoop" not in plan_of(found)
    grams = [{p.lower()[i:i + 2] for i in range(len(p) - 1)} for p in phrases]
    grams = [{g for g in s if len(g) == 2 and not any(c.isspace() for c in g)} for s in grams]
    want = {(k, i, sum(g in (t or "").lower() for g in s), len(s)) for k, s in enumerate(grams) for i, t in enumerate(texts)}
    assert {tuple(f) for f in found.collect()} == {w for w in want if w[2]}
