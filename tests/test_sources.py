"""File sources: article folder (S1/S2), report file (S3), search results (S5/S6), sheet."""

import json
import os

from opinio.functions import text as T
from opinio.operators import keywords as K
from opinio.sources import articles as A
from opinio.sources import reports as R


def test_scan_articles_folder(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "articles")
    os.makedirs(d)
    body = f"{T.TITLE_MARKER}Hello\n{T.URL_MARKER}https://x\n\n{T.BODY_MARKER}\npara\n"
    with open(os.path.join(d, "Hello world.txt"), "w", encoding="utf-8") as f:
        f.write(body + "  \n")
    with open(os.path.join(d, "skip.md"), "w") as f:
        f.write("not an article")
    with open(os.path.join(d, "bad.txt"), "wb") as f:
        f.write(b"ok \xff\xfe bytes")
    rows = {r["title"]: r for r in A.scan_articles(spark, d, tolerant=True).collect()}
    assert set(rows) == {"Hello world", "bad"}
    assert rows["Hello world"]["content"] == body.strip()
    assert rows["Hello world"]["type"] == "text"
    assert "�" not in rows["bad"]["content"]


def test_read_report_file(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "report.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("头\n\n正向报道列表 (共2篇):\n1. First title (得分: 0.512)\n2.  Spaced  (得分: -0.100)\nnoise line\n")
    got = R.parse_ranked_report(R.read_report_file(spark, p)).orderBy("seq").collect()
    assert [(g["title"], str(g["score"])) for g in got] == [("First title", "0.512"), ("Spaced", "-0.100")]


def test_search_results_and_first_existing(spark, tmpdir_fresh):
    nested = os.path.join(tmpdir_fresh, "report.json")
    with open(nested, "w") as f:
        json.dump({"total_articles": 2, "articles": [{"url": "u1", "title": "t1"}, {"url": "u2", "title": "t2"}]}, f,
                  indent=2)
    assert R.first_existing(spark, [os.path.join(tmpdir_fresh, "missing.json"), nested]) == nested
    hits = R.read_search_results(spark, nested).orderBy("seq").collect()
    assert [(h["seq"], h["url"]) for h in hits] == [(0, "u1"), (1, "u2")]
    rep = R.nested_report(R.read_search_results(spark, nested)).collect()
    assert {r["total_articles"] for r in rep} == {2}


def hits_of(spark, folder, name, text):
    p = os.path.join(folder, name)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return [(r["seq"], r["url"], r["title"], r["reject"]) for r in R.read_search_hits(spark, p).orderBy("seq", "url").collect()]


def test_search_hits_forms(spark, tmpdir_fresh):
    hits = [{"url": f"u{i}", "title": t} for i, t in enumerate(
        ["plain", "a } b", 'q "}, {" q', "x}, {\\\"url\\\": 1}", "[list] ]}", "", "ü \n line", "{}"])]
    hits.insert(3, {"extra": {"k": {"n": 1}}, "url": "n", "title": "nested", "tags": ["a"]})
    want = [(i, h["url"], h["title"], None) for i, h in enumerate(hits)]
    forms = {"array": json.dumps(hits), "indented": json.dumps(hits, indent=2, ensure_ascii=False),
             "report": json.dumps({"total_articles": 9, "articles": hits}), "report2": json.dumps({"m": {"x": 1}, "articles": hits, "total": 9}, indent=4),
             "lines": "\n".join(json.dumps(h) for h in hits), "lines_end": "".join(json.dumps(h) + "\n" for h in hits), "crlf": json.dumps(hits, indent=1).replace("\n", "\r\n")}
    for name, text in forms.items():
        assert hits_of(spark, tmpdir_fresh, name, text) == want, name
    for name, text in {"e1": "", "e2": "[]", "e3": '{"total_articles": 0, "articles": []}', "e4": '{"articles": [], "total_articles": 0}\n'}.items():
        assert hits_of(spark, tmpdir_fresh, name, text) == [], name


def test_search_hits_broken_elements(spark, tmpdir_fresh):
    good = [json.dumps({"url": f"u{i}", "title": f"t{i}"}) for i in range(4)]
    for sep in (", ", ",\n  "):
        for k, bad in enumerate(['{"url": "x", "title": "cut', '{"url": "x", "title": }', '{"url": "x" "title": "y"}', '{"title": "no url"}', "{}"]):
            got = hits_of(spark, tmpdir_fresh, f"b{k}{len(sep)}", "[" + sep.join([good[0], good[1], bad, *good[2:]]) + "]")
            assert [g[:3] for g in got if g[3] is None] == [(0, "u0", "t0"), (1, "u1", "t1"), (3, "u2", "t2"), (4, "u3", "t3")], bad
            assert [(g[0], g[3]) for g in got if g[3] is not None] == [(2, bad)]
    got = hits_of(spark, tmpdir_fresh, "junk", "[null, " + ", 42, ".join(good[:2]) + ', "text"]')
    assert sorted((g[0], g[3]) for g in got if g[3]) == [(-1, "null"), (0, "42"), (1, '"text"')] and len(got) == 5
    got = hits_of(spark, tmpdir_fresh, "end", "[" + ", ".join(good)[:-4])
    assert [g[1] for g in got] == ["u0", "u1", "u2", None] and got[3][3].startswith('{"url": "u3"')


def test_search_hits_in_splits(spark, tmpdir_fresh):
    """Splits cut hits anywhere; numbers and hits are those of the whole file, plain in the plan."""
    hits = [{"url": f"u{i}", "title": "}{"[i % 2] * (i % 5) + f" title {i}"} for i in range(3000)]
    p = os.path.join(tmpdir_fresh, "big.json")
    with open(p, "w") as f:
        json.dump({"total_articles": len(hits), "articles": hits}, f)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        got = R.read_search_hits(spark, p).orderBy("seq").collect()
        assert spark.read.option("lineSep", "}").text(p).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(g["seq"], g["url"], g["title"]) for g in got] == [(i, h["url"], h["title"]) for i, h in enumerate(hits)]


def test_read_sheet_csv(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "sheet.csv")
    with open(p, "w") as f:
        f.write("词语,出现次数,频率\nspace,40,1.2345%\nnan,3,1%\n")
    t = K.typed_sheet(K.read_sheet(spark, p)).collect()
    assert [(r["keyword"], r["count"], str(r["heat_score"]), str(r["weight"])) for r in t] == [("space", 40, "1.23", "0.01")]


def test_sinks_roundtrip(spark, tmpdir_fresh):
    from pyspark.sql import functions as F
    from opinio.sinks import tables as SK
    lines = spark.createDataFrame([(1, 2, "b"), (0, 1, "h"), (1, 1, "a"), (2, 1, "c")], "section int, rank long, line string")
    out = os.path.join(tmpdir_fresh, "report")
    SK.write_report_text(lines.repartition(3), out)
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    text = "".join(open(os.path.join(out, p), encoding="utf-8").read() for p in parts)
    assert text == "h\na\nb\nc\n"
    stats = spark.createDataFrame([("2024-01-01", "en", 1), ("2024-01-02", "en", 2)], "stat_date string, source string, n int")
    sp = os.path.join(tmpdir_fresh, "stats")
    SK.refresh_statistics(stats, sp, keep_history=True)
    SK.refresh_statistics(stats.where(F.col("stat_date") == "2024-01-02").withColumn("n", F.lit(9)), sp, keep_history=True)
    got = {(r["stat_date"].isoformat() if hasattr(r["stat_date"], "isoformat") else r["stat_date"], r["n"])
           for r in spark.read.parquet(sp).collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 9)}
    arts = spark.createDataFrame([("/x/a.txt", "a", "2023-05-06 body", "text")], "file_path string, title string, content string, type string")
    c = SK.to_corpus(arts, "uk", "BBC").first()
    assert c["source"] == "uk" and str(c["publish_date"]) == "2023-05-06" and isinstance(c["id"], int)
