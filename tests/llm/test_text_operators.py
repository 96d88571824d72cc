"""Decontamination, quality, toxicity, secrets, licences, token counts: brute force, edge rows, held-out accuracy."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import decontaminate, licenses, quality, secrets, token_counts, toxicity
from opinio.llm.queries import LLM_QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (4, "one"), (None, "a null id"), (6, "é" * 50), (7, "word " * 30_000)]


def edge_docs(spark, rows=EDGE):
    """Documents with nulls, an empty, a very long and repeated rows, and clashing column names."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, label string, _key int, n_words int")


def lower_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items, window=10):
    w, hit, found = lower_words(text), set(), set()
    for item, t in items:
        b = lower_words(t)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == b[i:i + n]:
                    hit.update(range(p, p + n))
                    found.add(item)
    return len(w), len(hit), sorted(map(str, found))


def random_texts(seed, n, vocabulary, most):
    r = random.Random(seed)
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)  # one block, and many
    docs = list(enumerate(random_texts(1, 60, "a b C d, e".split(), 80))) + [(100, None), (101, ""), (101, "a b C")]
    items = list(enumerate(random_texts(2, 12, "a b c d e".split(), 14))) + [(50, "a"), (51, None), (52, "zz zz"), (9, "a b c")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_matches(d, b).select(
        "doc_id", "n_words", "items", F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("hit")).collect()
    have = sorted((r["doc_id"], r["n_words"], r["hit"], r["items"]) for r in got)
    assert have == sorted((i, *brute_hits(t, items)) for i, t in docs)
    kept = {(r["doc_id"], r["text"]) for r in decontaminate.decontaminate(d, b).collect()}
    assert kept == {(i, t) for i, t in docs if not brute_hits(t, items)[1]}


def test_longest_verbatim_match_and_its_place(spark):
    text = "x y " + " ".join(f"w{k}" for k in range(30)) + " z"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "q " + " ".join(f"w{k}" for k in range(5, 25)) + " r")], "item_id long, text string")
    m = decontaminate.find_matches(d, b).first()["matches"]
    assert [(x["item"], x["item_start"], x["start"], x["words"]) for x in m] == [("7", 1, 7, 20)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_matches(none, items).count() == 0
    assert [r["n_words"] for r in decontaminate.find_matches(edge_docs(spark).limit(1), items).collect()] == [0]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counted = quality.count_table(none, "doc_id", "text")
    assert quality.score(counted, quality.fit(counted, labels)).count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert secrets.find_secrets(none).count() == 0 and licenses.scan(none).count() == 0


def test_quality_edge_rows_and_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = LLM_QUERIES["op6_quality_classifier"](spark, MEDIUM).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.97 and len(held) > 50
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = quality.fit(quality.count_table(docs, "doc_id", "text"), labels)
    edge = edge_docs(spark)
    scores = [r["score"] for r in quality.score(quality.count_table(edge, "doc_id", "text"), model).collect()]
    assert len(scores) == len(EDGE) and all(0 <= s <= 1 for s in scores)
    assert quality.keep_good(edge, model).columns == edge.columns


def test_quality_without_labels_of_a_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    counted = quality.count_table(docs, "doc_id", "text")
    one = spark.createDataFrame([(2, 1), (2, None), (1, 7)], "doc_id long, quality int")
    model = quality.fit(counted, one)
    assert [r["score"] for r in quality.score(counted, model).collect()] == [model.share] * 2


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    vectors = [(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()), None) for _ in range(700)]
    vectors = [(t, rng.integers(1, 4, len(t)).tolist()) for t, _ in vectors]
    index = toxicity.Index(rng.uniform(1, 4, 40), vectors, rng.integers(0, 2, 700).tolist(), {0: 0.5, 1: 1.0}, list(range(700)))
    dense = np.zeros((index.size, 40))
    for n, (t, w) in enumerate(index.vectors):
        dense[n, t] = w
    for t, c in vectors[:80]:
        ids, w = index.unit(t, c)
        q = np.zeros(40)
        q[ids] = w
        cos = np.round(dense @ q, 12)
        best = np.lexsort((np.arange(index.size), -cos))[:25]
        got, _ = index.nearest(ids, w, 25)
        assert got.tolist() == best.tolist()


def test_toxicity_edge_rows_and_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = LLM_QUERIES["op2_toxicity"](spark, MEDIUM).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    held = got[got.held_out]
    toxic = held[held.toxic == 1]
    assert (held.predicted == held.toxic).mean() > 0.9 and toxic.score.mean() > 0.4 > held[held.toxic == 0].score.mean()
    docs = edge_docs(spark)
    rows = toxicity.toxicity(docs, spark.createDataFrame([(4, 1), (4, 0), (None, 1), (1, 0), (9, 3)], "doc_id long, toxic int")).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)


def brute_spans(text):
    out = []
    for kind, pattern, group, least in secrets.BASE:
        flags = re.I | re.A if kind == "assign" else 0
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_secrets_equal_the_rules(spark):
    r = random.Random(3)
    parts = ["password", "API_KEY", "token", " = ", ":", '"', "'", "AKIA", "ABCDEF0123456789ABCD", "deadbeef", "0123456789abcdef", " ", "é", "x", "\n", "ſecret"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(800)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for r in secrets.scan(docs).collect()}
    assert got == {i: brute_spans(t or "") for i, t in enumerate(texts)}


def test_inferred_grammar_finds_bare_credentials_and_spares_words(spark):
    r = random.Random(5)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(18)) for _ in range(210)]
    rows = [(i, f"some words here password={h} and more page{i * 7}.example.com at chapter{i}section.html") for i, h in enumerate(hexes[:200])]
    rows += [(300, f"it is {hexes[205]} there"), (301, "visit page77.example.com or call number55abcdefgh now"), (302, None)]
    got = {x["doc_id"]: [(s["kind"], s["value"]) for s in x["spans"]] for x in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[300] == [("format", hexes[205])] and got[301] == [] and got[302] == []
    assert all(got[i] == [("assign", hexes[i])] for i in range(200))
    docs = edge_docs(spark)
    clean = secrets.redact(docs.withColumn("n_chars", F.lit(0).cast("long")), secrets.infer(secrets.scan(docs)))
    assert clean.count() == len(EDGE) and clean.where("text IS NULL").count() == 1


def test_automaton_merges_a_loop():
    a = secrets.Automaton(["ab" * n for n in range(1, 8) for _ in range(20)])
    assert a.log_likelihood("ab" * 20) > a.log_likelihood("ba" * 20)


def test_secret_query_columns(spark):
    got = LLM_QUERIES["op1_secret_scan"](spark, SMALL)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in got.collect():
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_spans(texts[r["doc_id"]] or ""))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


def test_licences():
    rules = licenses.SentenceRules()
    mit = "\n".join(t + "." for n, t in licenses.SENTENCES if n in ("mit-title", "mit-grant", "mit-keep", "as-is"))
    wrapped = re.sub(r"((?:\S+ ){9}\S+) ", r"\1\n", mit)
    name = lambda text: [x[0] for x in rules.licences(rules.sentences(text))]
    assert name(mit) == ["MIT"] and name(wrapped) == ["MIT"]
    assert name("Foo.\nReleased under the MIT license!\nLicensed under CC BY-NC 4.0.") == ["MIT", "CC-BY-NC-4.0"]
    assert name("We released under the MIT License") == [] and name("") == [] and name(None) == []
    part = mit.split("\n")[1]
    assert name(part) == [] and [s[0] for s in rules.sentences(part)] == ["mit-grant"]
    text = "é: Licensed under the Apache License, Version 2.0."
    (licence, start, end), = rules.licences(rules.sentences(text))
    assert licence == "Apache-2.0" and text[start:end] == "Licensed under the Apache License, Version 2.0"


def test_licence_query_equals_a_line_search(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    marks = ["Licensed under CC BY-NC", "is licensed under the GNU General Public License, version", "Licensed under the Apache License, Version", "Released under the MIT License."]
    for r in LLM_QUERIES["op3_license_scan"](spark, MEDIUM).collect():
        assert (r["n_licences"] > 0) == any(m in docs[r["doc_id"]] for m in marks), r["doc_id"]
    assert licenses.scan(edge_docs(spark)).count() == len(EDGE)


def test_segment_trees_equal_whole_encoding():
    import public_tokenizers as P

    counter, r = token_counts.PieceCounter(P.path("byte_bpe_50k.json"), P.PATTERN), random.Random(3)
    letters = "ab  \n\n'sldmrevt 1!é\t-,"
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 300)))
        tree = token_counts.SegmentTree(text, counter, segment=r.choice([1, 2, 4, 32]))
        for _ in range(4):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.choice([0, 1, 3, 20]))
            new = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 9])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text
            assert tree.tokens == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_an_edit_reads_little_again():
    import public_tokenizers as P

    counter = token_counts.PieceCounter(P.path("byte_bpe_50k.json"), P.PATTERN)
    tree = token_counts.SegmentTree("some words and more " * 5000, counter)
    before = tree.encoded
    tree.edit(50_000, 50_010, "xyz")
    assert tree.encoded - before < 200


def test_token_counts_of_the_table(spark):
    import public_tokenizers as P
    import regex

    got = {r["doc_id"]: r for r in LLM_QUERIES["op8_token_counts"](spark, SMALL).collect()}
    counter = token_counts.PieceCounter(P.path("byte_bpe_50k.json"), P.PATTERN)
    count = lambda t: len(counter.tokenizer.encode(t, add_special_tokens=False).ids)
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        assert got[r["doc_id"]]["n_tokens"] == count(r["text"])
        assert got[r["doc_id"]]["tokens_after"] == count(regex.sub(token_counts.PERSONAL, "[MASKED]", r["text"]))


def test_ordinary_pairs_cover_all_candidates(spark):
    r = random.Random(8)
    values = [f"page{k}.example.com/{r.randint(0, 10**9)}" for k in range(5000)] + ["z1" * 150]
    scanned = secrets.scan(spark.createDataFrame(list(enumerate(values)), "doc_id long, text string"))
    model = secrets.infer(scanned).ordinary
    assert model.n == sum(len(v) + 1 for v in values) and model.pair["z", "1"] >= 150


def test_parts_of_a_run_outside_the_base_spans_are_candidates():
    hexes, rest = "0123456789abcdef01234567", "_Zq8Xw2Lk9Pm4Rt"
    text = f"see {rest[1:]}-{hexes}{rest} now"
    got = secrets.candidates(text, secrets.base_spans(text))
    assert got == [(4, 19, rest[1:] + "-"), (43, 58, rest)] and all(text[a:b] == v for a, b, v in got)
