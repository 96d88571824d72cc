"""The wrapper decides what is read: its own parts where it has them, nothing without it."""

from opinio.llm import html_wrapper as H

PAGE = "<body><nav><a href=/x>Menu</a></nav><article><h1>Title %d</h1><p>Text %d.</p></article><footer>About</footer></body>"
ROWS = [(k, f"http://h{k % 2}/x{k}", PAGE % (k, k)) for k in range(12)] + [(None, "http://null/x", PAGE % (50, 50)), (3, "http://h1/x3", PAGE % (3, 3)), (70, None, "")]
KIND = "page_id long, url string, html string"


def texts(spark):
    return sorted(map(str, ((r["page_id"], r["text"]) for r in H.extract(spark.createDataFrame(ROWS, KIND)).collect())))


def test_pages_are_read_by_the_wrapper(spark, monkeypatch):
    want = sorted(str((k, f"Title {n}\nText {n}." if page else "")) for k, _, page in ROWS for n in [50 if k is None else k])
    assert texts(spark) == want
    found = H.wrappers
    monkeypatch.setattr(H, "wrappers", lambda *a, **k: found(*a, **k).where("false"))
    assert {t.split(", ", 1)[1] for t in texts(spark)} == {"'')"}


def test_parts_of_the_wrapper_are_the_text():
    pages = [PAGE % (k, k) for k in range(5)]
    _, main, regions, spine, constant, named = H.learn_template(pages)
    heading = next(path for path in main if path[-1][0] == "h1")
    assert main[heading] and named == {"article"}
    assert H.main_text(PAGE % (9, 9), main, regions, spine, constant, named) == "Title 9\nText 9."
    assert H.main_text(PAGE % (9, 9), {**main, heading: False}, regions, spine, constant, named) == "Text 9."
