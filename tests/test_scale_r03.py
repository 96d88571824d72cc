"""Steps that must stay cheap on large tables: what they read, join and write, and the same rows as before."""

import glob
import os
import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SMALL
from opinio.catalog import QUERIES
from opinio.functions import text as T
from opinio.operators import ingest as I
from opinio.operators import matching as M
from opinio.sinks import merge as MG


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------- F8, F13 ------------------------------------------

def test_both_white_space_classes_are_the_same(spark):
    chars = spark.createDataFrame([(chr(c),) for c in [*range(0xD800), *range(0xE000, 0x11000)]], "c string")
    assert chars.where(F.col("c").rlike("^" + T.WS + "\\z") != F.col("c").rlike("^" + T.WS_JAVA + "\\z")).count() == 0
    assert chars.where(F.col("c").rlike(T.WS_JAVA)).count() == len(T.WS_CHARS)


def test_words_are_counted_without_matching_each(spark):
    texts = ["", " ", "a", " a  b\n", "　x y\x1cz ", "é\xa0ü", None, "one two three"]
    got = [r["n"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.word_count_ws(F.col("t")).alias("n")).collect()]
    assert got == [None if t is None else len(t.split()) for t in texts]
    assert "regexp_extract_all" not in plan_of(QUERIES["min_words_filter"](spark, SMALL))


def test_tokens_are_made_once(spark):
    for name in ("tokenize", "word_count", "singularize"):
        assert plan_of(QUERIES[name](spark, SMALL)).count("split(") == 1, name


def test_tokens_of_odd_words(spark):
    texts = ["", "1 22 a bb 3c c3 ٣٣ é1 éé {{ z~z", None, "-- 12-3 !!", "A1 1B x"]
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id long, body string")
    punct = str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    want = {(i, p, w) for i, t in enumerate(texts) for p, w in enumerate(
        w for w in (t or "").lower().translate(punct).split() if len(w) > 1 and not re.fullmatch(r"\d+", w))}
    from opinio.operators import wordfreq as WF
    assert {tuple(r) for r in WF.exploded_tokens(rows).collect()} == want


# --------------------------------- F7, F9, F11, F12 --------------------------------------

def test_short_phrase_lists_give_the_same_hits_as_long_ones(spark, monkeypatch):
    r = random.Random(5)
    bits = ["a", "b", "ab", "Ba", " ", "  ", "\n", "é", "the", "x1", ""]
    make = lambda most: "".join(r.choice(bits) for _ in range(r.randint(0, most)))
    texts = [make(30) for _ in range(60)] + ["The  cat", None, "the cat"]
    phrases = [*dict.fromkeys([make(5) for _ in range(40)] + ["", " ", "the cat", "cat"])][:50]
    docs = spark.createDataFrame([(i // 2 if i % 7 else i, t) for i, t in enumerate(texts)] + [(999, "ab ab"), (999, "ab ab")], "doc_id long, text string")
    p = spark.createDataFrame(list(enumerate(phrases)), I.PHRASE_SCHEMA)
    few = I.phrase_hits(docs.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id = 999")), p)
    got = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(I, "DIRECT_PHRASES", 0)
    assert got == sorted(map(tuple, I.phrase_hits(docs.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id = 999")), p).collect()))


def test_short_phrase_lists_do_not_take_texts_apart(spark):
    for name in ("search_union", "dedupe_url_first", "new_urls_only", "nested_report"):
        assert "split(" not in plan_of(QUERIES[name](spark, SMALL)), name


def test_report_total_reads_the_written_hits(spark):
    assert "substring_index" not in plan_of(QUERIES["nested_report"](spark, SMALL))


# ---------------------------------------- F10 -------------------------------------------

def test_append_copies_no_stored_row(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    kind = "k string, n int, m string"
    load = lambda rows, name: MG.merge_into(spark.createDataFrame(rows, kind), path, ["k"], name, update=False, parts=4)
    files = lambda: set(glob.glob(os.path.join(path, "_part=*", "*.parquet")))
    first = [(f"k{i}", i, "a") for i in range(40)] + [(None, 1, "z"), (None, 2, "b"), ("k0", 0, "b")]
    load(first, "a")
    before = files()
    load(first, "again")
    assert files() == before
    load([("k1", 9, "x"), ("new", 1, None), ("new", 1, "c"), (None, 5, "q")], "b")
    assert before < files() and len(files() - before) == 1                  # one part gets one file
    want = {("new", 1, "c"), (None, 2, "b"), ("k0", 0, "b")} | {(f"k{i}", i, "a") for i in range(1, 40)}
    got = [tuple(r) for r in MG.read_stored(spark, path, spark.createDataFrame([], kind).schema).collect()]
    assert len(got) == len(want) and set(got) == want


# ----------------------------------- F1, F3 to F6 ----------------------------------------

def _norm(t):
    return re.sub(r"[^\w\s]", "", t.lower())


def _similar(a, r):
    a, r = _norm(a), _norm(r)
    return a in r or r in a or len(set(a.split()) & set(r.split())) >= 3


def _titles(seed, n, vocab, most=9):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, most))) + rnd.choice(["", "", "!", " "]) for _ in range(n)]


VOCAB = [f"{c}{k}" for k in range(60) for c in ("w", "x", "ü", "ab", "q-")] + ["the"] * 60 + ["of"] * 40 + ["and"] * 30 + ["a"] * 10


def _frames(spark, a, r):
    return (spark.createDataFrame(list(enumerate(a)), "a_id long, a_title string"),
            spark.createDataFrame([(i, t, Decimal("0.1")) for i, t in enumerate(r)], "seq long, title string, score decimal(4,3)"))


def test_contained_titles_equal_brute_force(spark):
    r = random.Random(6)
    bits = ["a", "b", "ab", "ba", " ", " ", "  ", "\n", "é", "the", "x1", ""]
    make = lambda most: "".join(r.choice(bits) for _ in range(r.randint(0, most)))
    ys = [make(24) for _ in range(150)] + ["a b ab the x1 é the b", "", None]
    xs = [make(9) for _ in range(150)] + [y[r.randrange(len(y) + 1):] for y in ys if y] + [None]
    x, y = spark.createDataFrame(list(enumerate(xs)), "x_id long, x_str string"), spark.createDataFrame(list(enumerate(ys)), "y_id long, y_str string")
    for proper in (False, True):
        got = sorted((p["x_id"], p["y_id"]) for p in M.contained_titles(x, y, proper=proper).collect())
        assert got == [(i, j) for i, a in enumerate(xs) for j, b in enumerate(ys) if a is not None and b is not None and a in b and not (proper and a == b)]


def test_fuzzy_pairs_with_hot_words_bits_and_grids(spark, monkeypatch):
    a, r = _titles(1, 110, VOCAB), [*dict.fromkeys(_titles(2, 90, VOCAB))]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(r) if _similar(x, y)}
    for few, pairs in ((100_000, 20_000_000), (0, 20_000_000), (0, 50)):                # broadcast; shuffled; dealt over grids
        monkeypatch.setattr(M, "BROADCAST_KEYS", few)
        monkeypatch.setattr(M, "TASK_PAIRS", pairs)
        got = [tuple(p) for p in M.match_fuzzy(*_frames(spark, a, r)).select("a_id", "r_seq").collect()]
        assert len(got) == len(set(got)) and set(got) == want, (few, pairs)


def test_first_matches_over_many_ranges(spark, monkeypatch):
    a, r = _titles(3, 80, VOCAB, 6) + ["zz nowhere"] * 3, [*dict.fromkeys(_titles(4, 80, VOCAB, 6))]
    monkeypatch.setattr(M.first_fuzzy, "__defaults__", (4, 3))
    got = {b["a_id"]: (b["r_seq"], b["how"]) for b in M.match_best(*_frames(spark, a, r)).collect()}
    want = {i: (r.index(x), "exact") if x in r else (min(j for j, y in enumerate(r) if _similar(x, y)), "fuzzy")
            for i, x in enumerate(a) if x in r or any(_similar(x, y) for y in r)}
    assert got == want


def test_candidates_are_verified_where_they_meet(spark):
    a, r = _frames(spark, _titles(7, 50, VOCAB), [*dict.fromkeys(_titles(8, 50, VOCAB))])
    plan = plan_of(M.match_containment(a, r).groupBy().count())
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert any("instr" in x for x in joins) and not any("[x_id" in x or "[y_id" in x for x in joins)
