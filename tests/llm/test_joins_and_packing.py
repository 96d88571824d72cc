"""Near-duplicates, embeddings, packing, extraction, the pipeline: brute force and edge rows."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinio.llm import caps, components, decontaminate, html_wrapper, ngram_join, packing
from opinio.llm.queries import LLM_ORACLE, LLM_QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_components(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(200, 260)] + [(r.randint(300, 360), r.randint(300, 360)) for _ in range(40)]
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute_components({n for p in links for n in p}, links)
    assert got == {n: c for n, c in want.items() if n in got}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def mutated(seed, bases, each, words=60):
    r = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{r.randint(0, 400)}" for _ in range(words)]
        for _ in range(each):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = f"x{r.randint(0, 400)}"
            rows.append(" ".join(copy))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_ngram_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join.verify, "__defaults__", (block,))  # whole clusters, and clusters dealt into blocks
    texts = mutated(7, 6, 14) + ["a b c", "A, b! c", "", None, "   ", "one", "one"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0])]
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, _row int, component string")
    got = ngram_join.near_duplicates(ngram_join.hold(docs)).collect()
    numbers = ngram_join._Numbers()
    sets = [set(ngram_join.ngrams(ngram_join.words((t or "").encode()), 5, numbers).tolist()) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = brute_components(range(len(rows)), links)
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[label[k]].append(rows[k][0])
    want = sorted((str(rows[k][0]), str(min((i for i in groups[label[k]] if i is not None), default=None)), degree[k]) for k in range(len(rows)))
    assert sorted((str(r["_id"]), str(r["class_id"]), r["n_links"]) for r in got) == want
    kept = ngram_join.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_for(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(LLM_ORACLE[name])
    cols = sorted(want.columns)
    got = LLM_QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == cols
    assert sorted(map(str, got.select(cols).toPandas().values.tolist())) == sorted(map(str, want.df()[cols].values.tolist()))


@pytest.mark.parametrize("block", [512, 5])
def test_caps_find_the_near_vectors(spark, block):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 32))
    rows = [(int(k), (centre[k % 12] + rng.normal(size=32) * rng.choice([0.05, 0.2, 0.5])).tolist()) for k in range(240)]
    rows += [(900, rows[0][1]), (901, rows[0][1]), (902, None), (903, []), (904, [0.0] * 32), (905, [None] + rows[0][1][1:]),
             (906, [float("nan")] * 32), (907, [1.0, 2.0]), (908, [2.0, 4.0]), (909, [1e300] * 32), (910, [1e-300] * 32)]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, _row long")
    got = {r["vec_id"]: r for r in caps.near_vectors(df, block=block).collect()}
    unit = {i: caps.unit_vector(v) for i, v in rows}
    links = {(a, b) for a in unit for b in unit if a < b and unit[a] is not None and unit[b] is not None
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9}
    degree = defaultdict(int)
    for p in links:
        for x in p:
            degree[x] += 1
    total = sum(degree.values())
    assert len(got) == len(rows) and all(got[i]["n_links"] <= degree[i] for i in unit)  # none below the threshold
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * total > 0
    label = brute_components(unit, links)
    assert np.mean([got[i]["component_id"] == label[i] for i in unit]) > 0.95
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert got[907]["n_links"] == 1 and got[902]["n_links"] == got[904]["n_links"] == got[906]["n_links"] == 0


def test_list_decoding_finds_every_filter():
    code = caps.Caps(16, 50)
    for x in np.random.default_rng(1).normal(size=(20, 16)):
        x /= np.linalg.norm(x)
        first, second = code.halves(x)
        assert code.decode(x).tolist() == np.flatnonzero((first[:, None] + second[None, :]).ravel() >= code.alpha).tolist()


def test_tasks_draw_the_same_code():
    import pickle

    code = caps.Caps(16, 50)
    again = pickle.loads(pickle.dumps(code))
    x = caps.unit_vector([float(k) - 7 for k in range(16)])
    assert again.decode(x).tolist() == code.decode(x).tolist() and len(pickle.dumps(code)) < 300


def test_embedding_recall_on_the_table(spark):
    e = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.array(e.embedding.tolist(), dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = (x @ x.T >= 0.9).sum(1) - 1
    got = LLM_QUERIES["op10_embedding_near_dedup"](spark, MEDIUM).orderBy("vec_id").toPandas().n_links.values
    assert (got <= true).all() and got.sum() >= 0.9 * true.sum()


def test_first_fit_decreasing_and_filling():
    r = random.Random(9)
    for sizes in ([], [4096], [2100] * 9, [r.randint(1, 4096) for _ in range(300)], [1] * 5000, [4096, 1, 4095]):
        made = packing.pack_group(list(enumerate(sizes)), 4096)
        got = defaultdict(list)
        for b in made:
            assert 0 < sum(n for _, _, n in b) <= 4096
            for row, start, n in b:
                got[row].append((start, n))
        for row, n in enumerate(sizes):
            at = 0
            for start, size in sorted(got[row]):
                assert start == at
                at += size
            assert at == n
        assert len(made) == -(-sum(sizes) // 4096)


def test_room_is_first_fit():
    r = random.Random(1)
    tree, free = packing.Room(50, 10), [10] * 64
    for n in sorted((r.randint(1, 10) for _ in range(50)), reverse=True):
        want = next(k for k, f in enumerate(free) if f >= n)
        free[want] -= n
        assert tree.take(n) == want


def test_packing_round_trip(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    rows += [(1000, None), (1001, ""), (1002, "Ünïcode 漢字 ½ <|endoftext|> İ"), (1003, "x" * 100_000), (1004, "same"), (1004, "same")]
    docs = spark.createDataFrame([(i, s, 1, "q") for i, s in rows], "doc_id long, text string, n int, ids string")
    got = packing.pack(docs, P.path("word_bpe_49k.json")).toPandas()
    want = defaultdict(list)
    for i, s in rows:
        want[i].append(np.array([*t.encode(s or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    for i, copies in want.items():
        pieces = got[got.doc_id == i]
        assert pieces.length.sum() == sum(map(len, copies)) and set(pieces.doc_tokens) == {len(c) for c in copies}
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(copies[0][p.start:p.start + p.length].tobytes())
    q = got.sort_values(["sequence_id", "offset"])
    assert (q.groupby("sequence_id").length.cumsum() - q.length == q["offset"]).all()
    sizes = q.groupby("sequence_id").length.sum()
    assert sizes.max() <= 4096 and (sizes < 4096).sum() <= 1
    assert packing.pack(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


PAGE = """<html><head><title>x</title><script>var a="</p><p>no"</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=1>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><main><article><header><h1>Big &amp; Title</h1>
<span>By me</span></header><p>First <b>bold</b> text&nbsp;here<br>next line.<p>Second para.<aside class="sidebar">side</aside>
<ul><li>one<li>two</ul><div class='ad'>Buy</div><p>Last</p><form><p>subscribe</p></form><section class="comments"><p>nice</p></section>
</article></main><footer>&copy; x</footer></body>"""


def test_article_without_its_surroundings():
    assert html_wrapper.main_text(PAGE, {}, []) == "Big & Title\nFirst bold text here next line.\nSecond para.\none\ntwo\nLast"


def test_marks_of_regions():
    page = """<body class="has-sidebar"><div class="layout with-sidebar"><article class="post sidebar-left"><div class="article-header"><h1>T</h1>by me</div>
    <p>One &lt;two&gt; &#233;.</p><ol class="commentlist"><li>c</li></ol><article class="comment"><p>r</p></article><p>commentary</p></article></div></body>"""
    assert html_wrapper.main_text(page, {}, []) == "T\nOne <two> é.\ncommentary"


def test_wrapper_of_a_host_without_article():
    page = '<body><div id="top-menu">m</div><div class="content"><div class=story><h2>T</h2>%s</div></div><div class="sidebar">z</div></body>'
    pages = [page % "".join(f"<p>Paragraph {k} is long enough.</p>" for k in range(n)) for n in (1, 3, 2)]
    wrapper, main, regions = html_wrapper.infer(pages)
    assert any(t[0] == "+" for t in wrapper)  # the paragraphs are a repeated group
    assert html_wrapper.main_text(page % "<p>New</p>", main, regions) == "T\nNew"


def test_alignment_makes_optional_and_repeated_groups():
    a, b, c = ("a", "t"), ("b", "t"), ("c", "t")
    assert html_wrapper.align([a, b, c], [a, c]) == [a, ("?", b), c]
    assert html_wrapper.fold([a, b, b, b, c]) == [a, ("+", b), c]


def test_extraction_edge_rows(spark):
    rows = [(1, "http://h/1", PAGE), (1, "http://h/1", PAGE), (2, None, None), (None, "http://h/2", ""), (3, "x", "<p>un<p>closed"), (4, "http://h/3", "<article>" + "<p>w</p>" * 20000)]
    got = html_wrapper.extract(spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")).collect()
    assert len(got) == len(rows)
    text = {(r["page_id"], r["url"]): r["text"] for r in got}
    assert text[2, None] == text[None, "http://h/2"] == "" and text[3, "x"] == "un\nclosed" and text[4, "http://h/3"].count("w") == 20000
    assert html_wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 100_000).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    docs = docs.unionByName(extra)
    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, state, SMALL)
        assert after.columns == docs.columns
        if name == "near_duplicates":
            assert after.where("text IS NOT NULL").count() == after.where("text IS NOT NULL").select("text").distinct().count()
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            found = decontaminate.find_matches(state, bench)
            assert after.count() == found.where(F.size("ranges") == 0).count()
        if name == "secrets":
            assert after.count() == state.count() and after.where(F.col("text").rlike("token = \"[0-9a-f]{40}")).count() == 0
        state = after
    kept = {r["doc_id"] for r in state.select("doc_id").collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, state, SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == kept
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_text_stays_after_letters_that_grow_in_lower_case():
    page = "<article>" + "\u0130" * 20 + "<script>x</script> kept words <b>y</b><SCRIPT>z</Script><p>end</p></article>"
    assert html_wrapper.main_text(page, {}, []) == "\u0130" * 20 + " kept words y\nend"


def test_links_without_a_shared_band_are_counted():
    text = " ".join(f"w{k}" for k in range(60))
    unit = [{"_row": k, "_text": t.encode(), "_own": 0, "_first": 0, "_second": 0, "_copies": c, "_bands": [k]} for k, (t, c) in enumerate(
        [(text, 1), (text + " x", 2), (text + " y", 3)])]
    got = ngram_join.verify_unit(unit, 5, ngram_join._Numbers(), (4, 5))
    assert [(row, links) for row, links, _ in got] == [(0, 5), (1, 4), (2, 3)]


def test_packed_sequences_hold_the_ids(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "x y " * 5000)], "doc_id long, text string")
    got = packing.pack(docs, P.path("word_bpe_49k.json")).toPandas()
    for i, s in [(1, "some words"), (2, ""), (3, "x y " * 5000)]:
        pieces = got[got.doc_id == i].sort_values("start").ids
        assert np.concatenate(list(pieces)).tolist() == [*t.encode(s, add_special_tokens=False).ids, 2]
    made = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id").ids.apply(lambda x: sum(map(len, x)))
    assert made.max() == 4096 and (made < 4096).sum() <= 1
    assert "ids" not in LLM_QUERIES["op7_sequence_packing"](spark, SMALL).columns


def test_pages_of_two_templates_on_a_host_keep_their_texts(spark):
    text = lambda k: f"Paragraph {k} of some length that varies from page to page."
    kinds = ["<body><article><p>%s</p></article></body>", "<body><main><p>%s</p></main></body>",
             "<body><div><div><p>%s</p><p>%s</p></div></div><div>Imprint</div></body>", "<body><section><p>%s</p></section></body>"]
    rows = []
    for host, some in (("named", (0, 1)), ("bare", (2, 2, 2, 2, 3))):
        for k in range(30):
            kind = kinds[some[k % len(some)]]
            rows.append((len(rows), f"http://{host}/{k}", kind % tuple(text(f"{k}{x}") for x in "ab"[:kind.count("%s")])))
    got = html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        k = r["url"].split("/")[-1]
        assert r["text"].split("\n") == [text(f"{k}{x}") for x in "ab"[:rows[r["page_id"]][2].count("<p>")]]


def test_slots_decide_over_word_lists():
    page = ('<body><form id="search"><div class="sidebar-wrapper"><div><p>%s</p><p>%s</p><p>Share this story with all your friends</p>'
            '<div class="ad">%s</div></div></div></form><div>About us</div></body>')
    word = lambda k: f"The words of page {k}, " * 8
    wrapper, main, regions, spine, constant = html_wrapper.learn([page % (word(k), word(k + 50), k) for k in range(6)])
    texts = {t for _, t, _, _ in html_wrapper.leaves(wrapper)}
    assert html_wrapper.SLOT in texts and "About us" in texts
    got = html_wrapper.main_text(page % ("Another", "text", "Buy"), main, regions, spine, constant)
    assert got == "Another\ntext"


@pytest.mark.parametrize("n", [3, 4, 12, 40])
def test_article_text_does_not_depend_on_the_pages_of_a_template(spark, n):
    page = "<body><nav>menu</nav><article><p>Part of our series.</p><p>%s</p><p>Same last line.</p></article></body>"
    rows = [(k, f"http://h/{k}", page % f"Words of page {k}.") for k in range(n)]
    got = html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"Part of our series.\nWords of page {k}.\nSame last line." for k in range(n)}


def test_template_texts_are_those_of_all_pages_not_of_the_sample(spark):
    page = "<body><div class=x><div><p>%s</p><p>%s</p><p>Share this with friends</p></div></div></body>"
    text = lambda k: f"The words of page number {k} go on and on. " * 4
    rows = [(k, f"http://h/{k}", page % (text(k), "Seen on most pages" if k else "Not on this one")) for k in range(60)]
    got = html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        k = r["page_id"]
        assert r["text"].split("\n") == [text(k).strip(), "Seen on most pages" if k else "Not on this one"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_any_tokenizer_file(name):
    import public_tokenizers
    words = packing.WordTokenizer(public_tokenizers.path(name))
    texts = ["", "Plain words, it's 2024!", "  two  spaces\tTAB\n\nline", "Ünï é ß", "naïve <|endoftext|> x", "日本 text", "a'S don'T ''ll"]
    texts += [t or "" for t in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet'").df()["text"]]
    assert words.by_word == (name == "word_bpe_49k.json")
    for t in texts:
        assert words.encode(t).tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids


def test_one_row_of_a_class_is_kept(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(5, text), (3, text), (3, text), (9, "other words stand here now"), (None, text), (7, None), (8, "")], "doc_id long, text string")
    kept = ngram_join.deduplicate(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"]) == [(3, text), (9, "other words stand here now")]
    assert sorted(r["doc_id"] for r in kept if not r["text"]) == [7, 8]
