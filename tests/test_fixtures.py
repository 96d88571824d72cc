"""Inline cases for semantics the driver data cannot reach (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from opinio.functions import html as H
from opinio.functions import numbers as N
from opinio.functions import sentiment as SF
from opinio.functions import text as T
from opinio.functions import urls as U
from opinio.operators import keywords as K
from opinio.operators import matching as M
from opinio.operators import quality as QA
from opinio.operators import stats as G
from opinio.operators import wordfreq as WF


def one(spark, value, expr, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["r"] for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


B, IMG, VID = T.BODY_MARKER, T.IMAGE_LIST_MARKER, T.VIDEO_LIST_MARKER


def test_f1_body_with_images_and_videos(spark):
    art = f"{T.TITLE_MARKER}t\n{T.URL_MARKER}u\n\n{B}\n p1\n\np2 \n\n{IMG}\n1. a.jpg - cap\n"
    assert one(spark, art, T.body_strict) == "p1\n\np2"
    art2 = f"{T.TITLE_MARKER}t\n{T.URL_MARKER}u\n\n{B}\nbody\n\n{VID}\n1. v.mp4\n"
    assert one(spark, art2, T.body_strict) == f"body\n\n{VID}\n1. v.mp4"
    art3 = f"x\ny\n\n{B}\n body text\n"
    assert one(spark, art3, T.body_strict) == "body text"


def test_f2_fallback_markers(spark):
    m1, m2, _ = T.END_MARKERS
    text = f"l1\nl2\nstart {m2} middle {m1} end"
    assert one(spark, text, T.body_fallback) == f"start {m2} middle"
    assert one(spark, f"l1\nl2\n{m1} rest", T.body_fallback) == f"{m1} rest"   # pos 0 is not cut
    assert one(spark, "only\ntwo", T.body_fallback) == ""


def test_f3_f4_loose_body(spark):
    assert col_values(spark, ["no marker here", f"{B} body {IMG} x"], T.has_body_marker) == [False, True]
    assert one(spark, f"{B} body {IMG} x", T.body_loose) == "body"


def test_f6_min_words(spark):
    nine = " ".join(["w"] * 9)
    ten = " ".join(["w"] * 10)
    assert col_values(spark, [nine, ten, "　".join(["w"] * 10)], T.word_count_ws) == [9, 10, 10]


def test_f8_publish_date(spark):
    pad = "x" * 600
    vals = ["on 2023-01-02 ok", "2023-1-2", "2024-02-30", "01/02/2023", "1 May 2023", pad + " 2023-01-02"]
    got = col_values(spark, vals, T.publish_date)
    d = dt.date
    assert got == [d(2023, 1, 2), d(2023, 1, 2), d(2024, 1, 1), d(2024, 1, 1), d(2024, 1, 1), d(2024, 1, 1)]


def test_w1_tokenize(spark):
    toks = one(spark, "Don't U.S. 123 a 3d “quoted”", T.tokens)
    assert toks == ["dont", "us", "3d", "“quoted”"]


def test_w2_w3_stopwords_then_plural(spark):
    docs = spark.createDataFrame([(1, "years year bus gas")], "doc_id long, body string")
    got = {r["word"]: r["count"] for r in WF.word_count(docs).collect()}
    assert got == {"year": 1, "bus": 1, "gas": 1}


def test_v3_v4_labels(spark):
    vals = [0.05, -0.05, 0.1, -0.1, 0.0499]
    assert col_values(spark, vals, SF.label_scored, "v double") == ["positive", "negative", "positive", "negative", "neutral"]
    assert col_values(spark, vals, SF.label_loaded, "v double") == ["neutral"] * 5


def test_f11_rates(spark):
    df = spark.createDataFrame([(Decimal("0.250"),), (Decimal("-0.250"),), (Decimal("0.000"),)], "s decimal(4,3)")
    rows = df.select(*SF.rates(F.col("s"))).collect()
    as_t = [tuple(float(x) for x in r) for r in rows]
    assert as_t == [(25, 25, 0, 75), (25, 0, 25, 75), (0, 0, 0, 100)]
    for r in rows:
        assert r["positive_rate"] + r["negative_rate"] + r["neutral_rate"] == 100


def test_m5_last_value_first_position(spark):
    rep = spark.createDataFrame([(1, "A", Decimal("0.100")), (2, "B", Decimal("0.200")), (3, "A", Decimal("0.300"))],
                                "seq long, title string, score decimal(4,3)")
    r = {x["title"]: (x["score"], x["seq"]) for x in M.dedupe_last(rep).collect()}
    assert r["A"] == (Decimal("0.300"), 1)


def _fuzzy(spark, a_titles, r_titles):
    arts = spark.createDataFrame(list(enumerate(a_titles)), "a_id long, a_title string")
    rep = spark.createDataFrame([(i, t, Decimal("0.1")) for i, t in enumerate(r_titles)],
                                "seq long, title string, score decimal(4,3)")
    return arts, rep


def test_m2_similarity_rules(spark):
    arts, rep = _fuzzy(spark, ["", "alpha beta", "alpha beta gamma delta", "ome"],
                       ["alpha beta zeta", "delta gamma beta alpha x", "homework"])
    pairs = {(r["a_id"], r["r_seq"]) for r in M.match_fuzzy(arts, rep).collect()}
    assert {(0, 0), (0, 1), (0, 2)} <= pairs            # empty title matches everything
    assert (1, 0) in pairs                               # containment "alpha beta" ⊂ "alpha beta zeta"
    assert (2, 1) in pairs                               # 3+ common words
    assert (2, 0) not in pairs                           # only 2 common words, no containment
    assert (3, 2) in pairs                               # substring inside a word


def test_m3_exact_beats_earlier_fuzzy(spark):
    a_titles = ["one two three four"]
    r_titles = ["x", "one two three four five", "y", "z", "w", "one two three four"]
    arts, rep = _fuzzy(spark, a_titles, r_titles)
    best = M.match_best(arts, rep).collect()
    assert [(b["r_seq"], b["how"]) for b in best] == [(5, "exact")]


def test_prefix_filtered_join_equals_brute_force(spark):
    import random
    import re
    rnd = random.Random(7)
    vocab = ["a", "bb", "ccc", "the", "of", "x1", "yy", "zeta", "mu", "nu"]
    A = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 7))) for _ in range(60)]
    R = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 7))) for _ in range(50)]
    arts, rep = _fuzzy(spark, A, R)
    got = {(r["a_id"], r["r_seq"]) for r in M.match_fuzzy(arts, rep).collect()}

    def norm(t):
        return re.sub(r"[^\w\s]", "", t.lower())
    exp = {(i, j) for i, a in enumerate(A) for j, r in enumerate(R)
           if norm(a) in norm(r) or norm(r) in norm(a) or len(set(norm(a).split()) & set(norm(r).split())) >= 3}
    assert got == exp


def test_w8_w9_heat_and_weight(spark):
    df = spark.createDataFrame([("1.2345%", 40), ("x", 40)], "f string, c int")
    r = df.select(N.heat_score(F.col("f"), F.col("c")).alias("h"), N.keyword_weight(F.col("f"), F.col("c")).alias("w")).collect()
    assert (r[0]["h"], r[0]["w"]) == (Decimal("1.23"), Decimal("0.01"))
    assert (r[1]["h"], r[1]["w"]) == (Decimal("40.00"), Decimal("0.04"))


def test_k5_upsert_keeps_create_time(spark):
    cols = "keyword string, source string, stat_date date, count int, heat_score decimal(5,2), create_time timestamp_ntz, update_time timestamp_ntz"
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    d = dt.date(2024, 1, 1)
    old = spark.createDataFrame([("k", "all", d, 1, Decimal("1.00"), t0, t0), ("o", "all", d, 5, Decimal("5.00"), t0, t0)], cols)
    new = spark.createDataFrame([("k", "all", d, 9, Decimal("9.00"), t1, t1), ("n", "all", d, 2, Decimal("2.00"), t1, t1)], cols)
    r = {x["keyword"]: x for x in K.upsert_hot_keywords(old, new).collect()}
    assert (r["k"]["count"], r["k"]["heat_score"], r["k"]["create_time"], r["k"]["update_time"]) == (9, Decimal("9.00"), t0, t1)
    assert r["o"]["count"] == 5 and r["n"]["create_time"] == t1


def test_k6_rejects(spark):
    sheet = spark.createDataFrame([("a", "abc", "1%"), ("b", "3", "1234.5%"), ("", "1", "1%"), ("c", "2", "0.5%")],
                                  "keyword string, count string, freq string")
    reasons = {r["keyword"]: r["reason"] for r in K.rejects(sheet).collect()}
    assert reasons == {"a": "count not an integer", "b": "heat not a DECIMAL(5,2)", "": "blank keyword"}
    assert [r["keyword"] for r in K.accepted(sheet).collect()] == ["c"]


def test_g1_left_join_multiplicity(spark):
    corpus = spark.createDataFrame([(1, "en", "text"), (2, "en", "text")], "id long, source string, type string")
    sent = spark.createDataFrame([(2, "positive", Decimal("0.50")), (2, "negative", Decimal("-0.50"))],
                                 "corpus_id long, sentiment string, sentiment_score decimal(3,2)")
    r = G.source_statistics(corpus, sent, "2024-01-01").first()
    assert r["total_count"] == 3 and r["positive_count"] == 1 and r["negative_count"] == 1


def test_c1_absolutize(spark):
    got = col_values(spark, ["//h/x", "/x", "https://h/x"], lambda c: U.absolutize(c, "https://base.example"))
    assert got == ["https://h/x", "https://base.example/x", "https://h/x"]


def test_c3_title_cascade(spark):
    pages = ['<html><h2 class="x">  Second level </h2></html>',
             '<html><meta property="og:title" content="From OG"></html>',
             '<html><meta property="og:url" content="https://h/news/some-long-story/"></html>',
             '<html><h1>BBC News</h1><h2>Real</h2></html>']
    assert col_values(spark, pages, H.page_title) == ["Second level", "From OG", "some long story", "Real"]


def test_c6_paragraphs_unclosed_and_script(spark):
    html = '<script>var t="</p>";</script><article><h1>T</h1><p><b>One &amp; a<br><p>Two</p><p> </p></article>'
    got = one(spark, html, lambda c: H.paragraphs(H.body_container(H.clean_html(c))))
    assert got == ["One & a", "Two"]


def test_c8_images(spark):
    cont = ('<figure><img src="/a.jpg" width="99"><img src="/b.jpg" width="100"><figcaption>Cap B</figcaption></figure>'
            '<img src="/c.jpg" width="auto"><img src="/d.jpg"><img width="300">')
    got = one(spark, cont, lambda c: H.images(c, T.NO_CAPTION))
    assert [(g["src"], g["caption"]) for g in got] == [("/b.jpg", "Cap B"), ("/c.jpg", T.NO_CAPTION), ("/d.jpg", T.NO_CAPTION)]


def test_c9_videos(spark):
    cont = ('<video src="/v1.mp4"></video><iframe src="https://x/player/1"></iframe><iframe src="https://x/ad"></iframe>'
            '<div data-e2e="media-player"><video src="/v2.webm"></video></div><video></video>')
    got = one(spark, cont, H.videos)
    # all <video> first, then player iframes, then each media-player box's first child (repeats kept)
    assert [g["src"] for g in got] == ["/v1.mp4", "/v2.webm", "https://x/player/1", "/v2.webm"]


def test_c10_extensions(spark):
    got = col_values(spark, ["image/jpeg", "image/webp", "text/html"], lambda c: U.media_extension(c, "image"))
    assert got == [".jpg", ".webp", ".jpg"]
    assert one(spark, "video/webm", lambda c: U.media_extension(c, "video")) == ".webm"


def test_c11_filenames(spark):
    import hashlib
    df = spark.createDataFrame([("u1", "a/b:c?"), ("u2", "x" * 120), ("u3", "/*?"), ("u4", None)], "u string, t string")
    got = [r["f"] for r in df.select(U.article_filename(F.col("u"), F.col("t")).alias("f")).collect()]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == ["abc.txt", "x" * 100 + ".txt", md5("u3") + ".txt", md5("u4") + ".txt"]


def test_n3_first_phrase_wins(spark):
    from opinio.operators import ingest as I
    hits = spark.createDataFrame([(1, 10, "u", "late"), (0, 20, "u", "early")], "phrase_seq int, doc_id long, url string, title string")
    r = I.dedupe_url_first(hits).first()
    assert (r["phrase_seq"], r["title"]) == (0, "early")


def test_d1_violations(spark):
    corpus = spark.createDataFrame([(1, "uk", None), (2, "en", "x" * 501), (2, "en", "ok")], "id long, source string, title string")
    parts = QA.union_all([QA.in_domain(corpus, "corpus", "source", ("en",), "id"),
                          QA.not_null(corpus, "corpus", "title", "id"),
                          QA.max_length(corpus, "corpus", "title", 500, "id"),
                          QA.unique(corpus, "corpus", ["id"])])
    rules = sorted((r["rule"], r["key"]) for r in parts.collect())
    assert rules == [("source in domain", "1"), ("title length <= 500", "2"), ("title not null", "1"), ("unique(id)", "2")]
    child = spark.createDataFrame([(7,)], "corpus_id long")
    assert QA.foreign_key(child, "s", "corpus_id", corpus, "id", "corpus").count() == 1


def test_m13_cascade(spark):
    kids = spark.createDataFrame([(1, 1), (2, 2)], "id long, corpus_id long")
    deleted = spark.createDataFrame([(1,)], "id long")
    assert [r["corpus_id"] for r in QA.cascade_delete(kids, deleted).collect()] == [2]


def test_percent_text_rounding(spark):
    df = spark.createDataFrame([(176115, 10000000), (1, 3), (2, 3)], "c long, t long")
    got = [r["p"] for r in df.select(N.percent_text(F.col("c"), F.col("t")).alias("p")).collect()]
    assert got == ["1.7612%", "33.3333%", "66.6667%"]


def test_v2_context_rules(spark):
    from opinio.operators import sentiment as V
    from opinio.sources.lexicon import lexicon_from_pairs
    lex = lexicon_from_pairs(spark, (("good", "2.0"),))
    docs = spark.createDataFrame([(1, "this is GOOD stuff"), (2, "not good at all"), (3, "very good"),
                                  (4, "good but good"), (5, "good!!"), (6, "GOOD")], "doc_id long, body string")
    got = {r["doc_id"]: float(r["valence_sum"]) for r in V.lexicon_scores_context(docs, lex).collect()}
    assert got[1] == 2.733                      # caps emphasis (text mixes caps and other words)
    assert got[2] == -1.48                      # negation within three words
    assert got[3] == 2.293                      # booster one word back
    assert got[4] == 4.0                        # 0.5 before "but", 1.5 after
    assert abs(got[5] - 2.584) < 1e-9           # two exclamation marks
    assert got[6] == 2.0                        # all words in caps: no caps differential


def test_c2_search_result_blocks(spark):
    from opinio.operators import pages as P
    html = ('<div class="ssrcss-1v7bxtk-StyledContainer x"><a href="/news/a">A</a><h3> First </h3></div>'
            '<div class="ssrcss-1v7bxtk-StyledContainer"><span>no link here</span></div>'
            '<div class="ssrcss-1v7bxtk-StyledContainer"><a href="//cdn.example/b">B</a><span class="promo-heading__title">Span T</span></div>'
            '<div class="ssrcss-1v7bxtk-StyledContainer"><a href="https://h/c">C</a></div>'
            '<div class="PromoContent"><a href="/ignored">later cascade step</a></div>')
    pages = spark.createDataFrame([(1, "https://search.example/q", html)], "page_id long, url string, html string")
    got = [(r["url"], r["title"]) for r in P.search_page_hits(pages, "https://www.site.example").orderBy("pos").collect()]
    assert got == [("https://www.site.example/news/a", "First"), ("https://cdn.example/b", "Span T"),
                   ("https://h/c", "No Title")]
