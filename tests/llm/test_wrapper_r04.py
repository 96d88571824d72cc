"""All pages of a template infer its wrapper, in whatever order and parts they come."""

import json
import random
from functools import reduce

from opinio.llm import html_wrapper as H

PAGE = "<body><div class=top><b>Site</b></div><div class=text><p>Text %d.</p>%s</div></body>"
KIND = "page_id long, url string, html string"


def test_every_page_is_in_the_wrapper(spark):
    heading = lambda k: f"<h{k % 6 + 1}>H {k}</h{k % 6 + 1}>" if k > 55 else ""
    rows = [(k, f"http://one/x{k}", PAGE % (k, heading(k))) for k in range(60)]
    found = H.wrappers(spark.createDataFrame(rows, KIND).repartition(7), "page_id", "url", "html").collect()
    assert len(found) == 1
    kept = {path[-1][0] for path in json.loads(found[0]["slots"])[0]}
    assert kept >= {"p"} | {f"h{k % 6 + 1}" for k in range(56, 60)}


def test_states_join_in_any_order():
    r = random.Random(3)
    pages = [PAGE % (k % 9, "".join(r.choice(["<p>x</p>", "<ul><li>a</li><li>b</li></ul>", "<h2>T</h2>", "same"]) for _ in range(r.randint(0, 4)))) for k in range(40)]
    state = lambda some: reduce(H.joined, [H.state_of(p, H.blocks(p)) for p in some])
    want = H.template_of(state(pages))
    for _ in range(3):
        r.shuffle(pages)
        at = r.randrange(1, 39)
        assert H.template_of(H.joined(state(pages[at:]), state(pages[:at]))) == want


def test_template_text_is_that_of_all_pages(spark):
    rows = [(k, f"http://one/x{k}", f"<body><div><p>Story number {k} with words {k * 7}</p><p>Read more</p></div></body>") for k in range(30)]
    one = (99, "http://one/x99", "<body><div><p>Story number 99 without the line</p></div></body>")
    texts = lambda rows: {t["page_id"]: t["text"] for t in H.extract(spark.createDataFrame(rows, KIND)).collect()}
    assert texts(rows)[3] == "Story number 3 with words 21"
    assert texts([*rows, one])[3] == "Story number 3 with words 21\nRead more"
