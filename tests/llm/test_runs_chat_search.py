"""Periodic runs, chat formatting and ranked search: brute force, round trips, DuckDB, edge rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from harness import compare, duck
from opinio.llm import chat_format, ranked_search, runs
from opinio.llm.queries import LLM_ORACLE, LLM_QUERIES

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------ runs ----------------------------------------------

def brute_runs(w, least, times):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(least, times * q) and not any(
                    all(w[x] == w[x + p] for x in range(start, end - p)) for p in range(1, q)):
                out.append((start, end - start, q))
            i = j + 1
    return sorted(out)


def test_runs_of_all_small_strings_equal_brute_force():
    r = random.Random(5)
    for _ in range(1500):
        w = [r.randint(1, r.choice([1, 2, 3])) for _ in range(r.randint(0, 40))]
        if len(w) > 3 and r.random() < 0.5:
            w = (w[:r.randint(0, 5)] + w[:r.randint(1, 6)] * r.randint(2, 8) + w[-3:])[:60]
        numbers = {}
        w = [numbers.setdefault(x, len(numbers) + 1) for x in w]
        least, times = r.choice([(2, 2), (6, 2), (4, 3), (1, 3)])
        assert sorted(runs.runs_of(w, least, times)) == brute_runs(w, least, times)


def random_words(r, most):
    w = []
    while len(w) < r.randint(10, most):
        if r.random() < 0.4:
            w += [r.choice("abcdefg") for _ in range(r.randint(1, 14))] * r.randint(2, 9)
        else:
            w += [str(r.randint(0, r.choice([3, 500]))) for _ in range(r.randint(1, 30))]
    return w


def test_find_equals_brute_force():
    r = random.Random(6)
    for _ in range(300):
        w = [x.encode() for x in random_words(r, 300)]
        assert runs.find(w) == sorted(brute_runs(w, 24, 3), key=lambda t: (t[0], t[2]))


def test_lowest_common_ancestors_give_the_longest_common_extension():
    r = random.Random(7)
    w = [r.randint(1, 2) for _ in range(120)]
    lce = runs.Extension(runs.SuffixTree(w))
    for _ in range(500):
        a, b = r.sample(range(len(w)), 2)
        n = 0
        while max(a, b) + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        assert lce(np.array([a]), np.array([b]))[0] == n


def stand_in(doc_id, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_digest(doc_id, text):
    w = stand_in(doc_id, text)
    found = sorted(brute_runs(w, 24, 3), key=lambda t: (t[0], t[2]))
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda t: (-t[1] / t[2], t[0], t[2]), default=(None, None, None))
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op11_equals_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    short = {i: t for i, t in docs if len((t or "").split()) <= 900}
    got = {r["doc_id"]: tuple(r) for r in LLM_QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert set(got) == {i for i, _ in docs} and len(short) > 100
    for i, t in short.items():
        assert got[i] == brute_digest(i, t)
    assert any(v[1] for v in got.values())


def test_runs_edge_rows(spark):
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (4, "a"), (None, " ".join([line] * 3)), (6, "w x " * 24), (7, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, words string, period int")
    got = sorted(((r["doc_id"], r["period"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.find_runs(docs).collect()), key=str)
    assert got == sorted([(1, 3, [], ""), (2, 3, [], ""), (3, 3, [], ""), (4, 3, [], "a"), (4, 3, [], "a"), (None, 3, [(0, 36, 12)], line),
                          (6, 3, [(0, 24, 1)], "w x"), (7, 3, [(0, 30_000, 1)], "word")], key=str)
    assert runs.find_runs(docs.where("false")).count() == 0


# ------------------------------------ chat ----------------------------------------------

def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, segments string, _turns int")


def test_chat_round_trip_of_hostile_texts(spark):
    r = random.Random(8)
    bits = [*chat_format.DEFAULT.controls, "␛", "␛0", "␛1", "<", "|", "[", "\\", "$0", "é", "\n", "a", "<|im_", "start|>", "</", "s>"]
    convs = {}
    for c in range(60):
        convs[c] = [(r.choice(["user", "assistant", "system", "tool<|im_sep|>\n"]), "".join(r.choice(bits) for _ in range(r.randint(0, 9))))
                    for _ in range(r.randint(1, 12))]
    rows = [(c, i, role, text) for c, ts in convs.items() for i, (role, text) in enumerate(ts)]
    r.shuffle(rows)
    made = chat_format.format_conversations(turns_of(spark, rows))
    got = made.select("conv_id", "formatted", "segments", chat_format.parse(F.col("formatted")).alias("turns"),
                      chat_format.learnt_text(F.col("segments")).alias("learnt")).collect()
    assert {g["conv_id"]: [tuple(t) for t in g["turns"]] for g in got} == convs
    for g in got:
        assert g["formatted"] == "".join(s["text"] for s in g["segments"])
        assert g["learnt"] == "".join(t for role, t in convs[g["conv_id"]] if role == "assistant")
        heads = sum(i == 0 or convs[g["conv_id"]][i - 1][0] != role for i, (role, _) in enumerate(convs[g["conv_id"]]))
        assert g["formatted"].count("<|im_start|>") == g["formatted"].count("<|im_end|>") == heads   # merged, and nothing else opens a turn
        inside = [s["text"] for s in g["segments"] if s["label"]]
        assert not any(c in t for t in inside for c in chat_format.DEFAULT.controls)


def test_chat_edge_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, "user", None), (1, None, None, "first"), (None, 0, "user", "x"), (3, 0, "assistant", "é" * 50_000)]
    made = chat_format.format_conversations(turns_of(spark, rows))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in made.select("conv_id", chat_format.parse(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("", "first"), ("user", ""), ("user", ""), ("assistant", "b")], None: [("user", "x")], 3: [("assistant", "é" * 50_000)]}
    assert chat_format.format_conversations(turns_of(spark, rows).where("false")).count() == 0


def test_chat_has_no_python_and_one_shuffle(spark):
    plan = LLM_QUERIES["op12_chat_formatting"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Window|Join", plan)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


# ----------------------------------- search ---------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_rank(docs, items, k):
    held = [(i, w) for i, t in docs if (w := terms_of(t))]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, w in held:
            m = 50 + (50 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                    for t in ts if t in w)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_docs,front,cells,block_bytes", [(16_384, 192, 1 << 22, 8 << 20), (7, 2, 1 << 22, 60), (40, 3, 50, 300)])
def test_search_equals_brute_force(spark, monkeypatch, shard_docs, front, cells, block_bytes):
    for name, value in [("SHARD_DOCS", shard_docs), ("FRONT", front), ("CELLS", cells), ("BLOCK_BYTES", block_bytes)]:
        monkeypatch.setattr(ranked_search, name, value)
    r = random.Random(9)
    vocabulary = [f"t{int(r.paretovariate(0.5)) % 60}" for _ in range(300)] + ["É", "Ab", "x1"]
    text = lambda most: " ".join(r.choice(vocabulary) for _ in range(r.randint(0, most)))
    docs = [(r.randint(0, 400), text(30)) for _ in range(160)] + [(900, None), (901, ""), (None, "t1 t2 t3"), (None, "t1 t2 t3"), (902, "t1, t1; t1-T1")]
    docs += [(500 + i, "t1 t2 t4 t9 t11") for i in range(30)]                         # ties around the k-th place
    items = [(i, text(9)) for i in range(25)] + [(90, "nowhere at"), (91, None), (92, ""), (93, "t1 t2"), (93, "t5"), (94, "t1 t2"), (95, "t2 t1 t1")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, shard int").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, terms int")
    index = ranked_search.materialise(ranked_search.build_index(d), "test-index")
    got = ranked_search.rank(index, b, k=12).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((tuple(g) for g in got), key=str) == brute_rank(docs, items, 12)


def test_search_of_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.rank(ranked_search.build_index(d), b).count() == 0
    assert ranked_search.rank(ranked_search.build_index(full), b.where("false")).count() == 0


def test_range_maxima(spark):
    r = random.Random(10)
    docs = spark.createDataFrame([(i, " ".join(r.choice("abc") for _ in range(r.randint(1, 20)))) for i in range(90)], "doc_id long, text string").coalesce(1)
    import pyarrow as pa
    row = ranked_search.build_index(docs).toArrow().to_batches()[0]
    p = ranked_search.Postings({n: row.column(n)[0] for n in row.schema.names}, pa.array([b"c", b"zz", b"a"], pa.binary()), 90, 900)
    assert p.start[1] == p.start[2] > 0                                              # nothing holds zz
    for _ in range(300):
        t = r.choice([0, 2])
        lo, hi = sorted(r.sample(range(int(p.start[t]), int(p.start[t + 1]) + 1), 2))
        assert p.impact[p.best(np.array([lo]), np.array([hi]))[0]] == p.impact[lo:hi].max()


@pytest.mark.parametrize("name", ["op12_chat_formatting", "op13_ranked_search"])
def test_query_equals_oracle(spark, name):
    problems, n, _ = compare(spark, duck(SMALL), name, LLM_QUERIES[name], LLM_ORACLE[name], SMALL)
    assert not problems and n
