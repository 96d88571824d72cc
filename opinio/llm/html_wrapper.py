"""HTML extraction: wrappers from union-free regular expressions over same-host pages.

1. Every page is read for its layout: the set of containers with text outside menus and their
   like. Pages of a host with the same layout are a template. All pages of a template infer its
   wrapper: each task gathers what its pages say (``state_of``) and the states are put together (``joined``),
   in any order, so neither pages nor their texts are gathered anywhere.
2. A page is a stream of texts, each on its path of open elements (name and marks of
   class, id and role); scripts, styles, comments and their like never become text. Repeats in
   a stream fold into groups, pages of the same folded stream are one entry, the wrapper and the next
   entry are aligned, and what only one of them has becomes an optional group; repeats are folded
   again. Texts that agree in all pages are template text (``AGREE`` different pages at least), others
   make a slot.
3. The slots choose: the elements that hold nearly all varying text are never taken for menus,
   whatever their marks say, and the innermost element with most of it is the main region.
   Text is left out inside the region if its own element, below those of the slots, is a menu,
   header, footer, sidebar, notice, advert, form or comment, and in an inferred region also if
   every page of the template repeats it. Where a page has an article (or main) element, that is its region and whole text.
4. Every page is read whole with its template's wrapper: the parts of the wrapper that are main text
   give the page's text; a part that the wrapper lacks is judged by its region. Without
   a wrapper nothing is read. Block elements end a block, inline elements don't. A page that has
   other article or main elements than its template is read by those, one that has nothing in the
   region of its template gets the densest of its own.

Defined results: null or empty html gives an empty text; an unclosed paragraph ends where the
next block begins; unclosed elements end with their parent; a null url is a host of its own;
repeated rows each get their own result and count as often when texts are weighed; a page with no article text gives an empty text.
"""

from __future__ import annotations

import hashlib
import html
import pickle
import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import map_batches, materialise, slices, table

#: Tokens above which a stream is folded by ancestors.
LONGEST = 4000
#: Templates, and different streams of theirs, that a task holds before it hands on their states; groups that join states.
HELD_TEMPLATES, HELD_STREAMS, GROUPS = 2000, 20_000, 16
#: Different pages that must agree before a text is the template's; shares of the varying text
#: that the main region and the elements above doubt hold.
AGREE, REGION, SPINE = 4, 0.6, 0.9
#: Wrappers, and bytes of them, that may be broadcast.
TEMPLATES, HELD = 200_000, 64 << 20

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>", re.S)
_MARKS = re.compile(r"""\b(class|id|role|aria-label|hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "title", "canvas", "math", "select", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that hold no main text, and words of class, id or role that say the same.
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"}
CHROME_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
                "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "aside", "footer", "header", "masthead", "topbar", "comment", "comments",
                "reply", "replies", "respond", "discussion", "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
                "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "related", "recommended", "recommendations", "share", "sharing",
                "social", "widget", "toolbar", "pagination", "pager", "search", "complementary", "contentinfo", "form", "paywall", "hidden", "toc"}
#: Elements that are never main text, however much text varies in them.
NEVER = {"nav", "footer", "aside", "menu", "dialog", "button", "head"}
#: Elements of the text itself; what encloses them is layout.
FLOW = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "blockquote", "pre", "figure", "figcaption", "header", "hr", "form"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


#: Beginnings of words that say the same ("commentlist"); words before them that deny it ("no-sidebar").
CHROME_STEMS = ("comment", "advert", "sidebar", "cookie", "newsletter", "sponsor")
LAYOUT = {"no", "with", "has", "without"}
#: An article element is only left out for marks that make it another kind of article.
OTHER_ARTICLES = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo", "related", "recommended", "hidden"}


def _marks(name: str, attributes: str) -> tuple[str, ...]:
    words = set()
    for key, a, b, c in _MARKS.findall(attributes):
        value, key = (a or b or c).lower(), key.lower()
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value):
            words.add("hidden")
        elif key not in ("style", "hidden"):
            for token in value.split():
                parts = [w for w in re.split(r"[^a-z]+", token) if w]
                if parts and parts[0] not in LAYOUT:
                    words |= {w for w in parts if w in CHROME_WORDS or w.startswith(CHROME_STEMS) and w != "commentary"}
    if name == "article":
        words &= OTHER_ARTICLES
    return () if name in ("html", "body", "main") else tuple(sorted(words))


@lru_cache(None)
def _raw_end(name: str) -> re.Pattern:
    """The end tag of a raw element. It is sought in the page itself: lower case may be longer."""
    return re.compile(f"</{name}", re.I | re.A)


def stream(page: str) -> list[tuple[str, str, tuple[str, ...]]]:
    """(kind, name or text, marks): kind is open, close or text. Raw elements are left out."""
    out, at = [], 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not text.isspace():
            out.append(("text", text, ()))
        elif text:
            out.append(("text", " ", ()))
        if not m:
            return out
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            out.append(("close", name, ()))
        elif name in RAW and not m[3].rstrip().endswith("/"):
            end = _raw_end(name).search(page, at)
            if end:
                close = page.find(">", end.start())
                at = close + 1 if close >= 0 else len(page)
            elif name != "title":
                at = len(page)
        else:
            out.append(("open", name, _marks(name, m[3]) if m[3] else ()))


def blocks(page: str) -> list[tuple[tuple, str, bool]]:
    """(path, text, is a heading) of every block; a path lists (name, marks) of open elements."""
    out: list[tuple[tuple, str, bool]] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []

    def end_block() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((tuple(path), text, any(n in HEADINGS for n, _ in path)))
            held.clear()
    for kind, what, marks in stream(page):
        if kind == "text":
            held.append(what)
        elif what == "br":
            held.append(" ")
        elif what in INLINE and not marks:
            continue
        elif kind == "open":
            end_block()
            if what in VOID:
                continue
            if what not in INLINE:
                while path and (path[-1][0] == "p" or path[-1][0] in INLINE):
                    path.pop()
            gone = CLOSES.get(what, ())
            while path and path[-1][0] in gone:
                path.pop()
            path.append((what, marks))
        else:
            end_block()
            if any(n == what for n, _ in path):
                while path.pop()[0] != what:
                    pass
    end_block()
    return out


def is_chrome(path: tuple, heading: bool, spine: tuple = ()) -> bool:
    """A region without main text on the path. A header inside the article keeps its headings;
    the elements of ``spine`` are not doubted."""
    inside, sure = False, len(spine) if path[:len(spine)] == spine else 0
    for k, (name, marks) in enumerate(path):
        if k >= sure and (name in CHROME or (marks or name == "header") and not (inside and heading and set(marks) <= {"header"})):
            return True
        inside = inside or name in ("article", "main")
    return False


def layout(found: list[tuple[tuple, str, bool]]) -> int:
    """A number of the page's template: its containers with text outside menus and their like."""
    seen = set()
    for path, _, heading in found:
        if not is_chrome(path, heading):
            end = next((k for k, (n, _) in enumerate(path) if n in FLOW or n in INLINE), len(path))
            inner = next((k + 1 for k, (n, _) in enumerate(path) if n in ("article", "main")), end)
            seen.add(path[:min(end, inner)])
    return int.from_bytes(hashlib.blake2b(repr(sorted(seen)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


#: The text of a slot, in tokens (path, text).
SLOT = "\0"


def key(t: tuple):
    """What tokens must share to be the same part of a wrapper: their paths, not their texts."""
    if t[0] in ("+", "?"):
        return key(t[1]) if t[0] == "+" and len(t) == 2 else (t[0], *map(key, t[1:]))
    return t[0]


def merge(a: tuple, b: tuple) -> tuple:
    """One token for two with the same key; different texts make a slot."""
    if a[0] == "+" or b[0] == "+":
        return ("+", *map(merge, a[1:] if a[0] == "+" else (a,), b[1:] if b[0] == "+" else (b,)))
    if a[0] == "?":
        return ("?", *map(merge, a[1:], b[1:]))
    return a if a[1] == b[1] else (a[0], SLOT)


def fold(tokens: list) -> list:
    """Immediate repeats become one repeated group, shortest units first."""
    for size in (1, 2, 3, 4, 5, 6, 8):
        keys = [key(t) for t in tokens]
        out, last, i = [], None, 0  # last: keys of the unit of the group at the end
        while i < len(tokens):
            unit, same, n = tokens[i:i + size], keys[i:i + size], 1
            while len(same) == size and keys[i + n * size:i + (n + 1) * size] == same:
                unit = list(map(merge, unit, tokens[i + n * size:i + (n + 1) * size]))
                n += 1
            if n > 1:
                out.append(unit[0] if size == 1 and unit[0][0] == "+" else ("+", *unit))
                last = same
                i += n * size
            elif last is not None and last == same:
                out[-1] = ("+", *map(merge, out[-1][1:], unit)) if size > 1 else merge(out[-1], unit[0])
                i += size
            else:
                out.append(tokens[i])
                last = None
                i += 1
        tokens = out
    return tokens


def leaves(tokens: list, optional: bool = False, repeated: bool = False):
    """(path, text, in an optional group, in a repeated group) of a wrapper's texts."""
    for t in tokens:
        if t[0] in ("+", "?"):
            yield from leaves(list(t[1:]), optional or t[0] == "?", repeated or t[0] == "+")
        else:
            yield (*t, optional, repeated)


def signs(found: list[tuple[tuple, str, bool]]) -> list:
    """The folded stream of a page. Where irregular repeats leave it long, neighbours below one
    ancestor become a repeated group of optional parts, deepest ancestors first."""
    tokens = fold([(path, text) for path, text, _ in found])
    depth = max((len(path) for path, _, _ in found), default=0)
    while len(tokens) > LONGEST and depth > 0:
        depth -= 1
        tokens = []
        for _, run in groupby(found, key=lambda f: f[0][:depth]):
            parts: dict[tuple, tuple] = {}
            for path, text, _ in run:
                parts[path] = merge(parts[path], (path, text)) if path in parts else (path, text)
            tokens.append(("+", *(("?", t) for t in parts.values())) if len(parts) > 1 else next(iter(parts.values())))
        tokens = fold(tokens)
    return tokens


def align(wrapper: list, page: list) -> list:
    """The union-free expression of both: what only one has becomes optional, what one has
    once and the other repeatedly becomes repeated, texts that differ become slots."""
    plain = [t[1:] if t[0] == "?" else (t,) for t in wrapper]
    flat = [u for units in plain for u in units]
    optional = [t[0] == "?" for t, units in zip(wrapper, plain) for _ in units]
    out: list = []
    for op, a, b, c, d in SequenceMatcher(None, [key(t) for t in flat], [key(t) for t in page], autojunk=False).get_opcodes():
        if op == "equal":
            for k in range(a, b):
                both = merge(flat[k], page[c + k - a])
                out.append(("?", both) if optional[k] else both)
        else:
            out += [("?", *flat[a:b])] if b > a else []
            out += [("?", *page[c:d])] if d > c else []
    return fold(out)


def names_of(found: list[tuple[tuple, str, bool]], spine: tuple = ()) -> set[str]:
    """Which of article and main a page has outside menus and their like."""
    return {n for path, _, heading in found if not is_chrome(path, heading, spine) for n, _ in path} & {"article", "main"}


def densest(weight: Counter, total: int, repeated: set[tuple] = frozenset()) -> tuple:
    """The innermost element that still holds most of the text; never a paragraph, nor a
    repeated text's own element where it isn't all."""
    return max((p for p, n in weight.items() if n >= REGION * total and p[-1][0] != "p" and p not in repeated), key=len, default=())


def weigh(found, spine: tuple = ()) -> tuple[Counter, int]:
    """Characters below each element, and in all; without menus and their like."""
    weights = Counter()
    for path, text, _ in found:
        weights[path] += len(text)
    return weigh_paths(weights, spine)


def weigh_paths(weights: Counter, spine: tuple = (), all_of: bool = False) -> tuple[Counter, int]:
    """As ``weigh``, of the characters on each path; with menus and their like if ``all_of``."""
    weight, total = Counter(), 0
    for path, n in weights.items():
        if n > 0 and (all_of or not is_chrome(path, is_heading(path), spine)):
            total += n
            for depth in range(1, len(path) + 1):
                weight[path[:depth]] += n
    return weight, total


def is_heading(path: tuple) -> bool:
    return any(n in HEADINGS for n, _ in path)


def state_of(page: str, found: list[tuple[tuple, str, bool]]) -> tuple[dict, Counter, Counter, list[bytes]]:
    """What one page says of its template: its folded stream, its texts and how often each comes, the characters on each
    path, and a number of the page itself."""
    tokens, weights = signs(found), Counter()
    for path, text, _ in found:
        weights[path] += len(text)
    number = lambda text: hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return {number(repr([key(t) for t in tokens])): tokens}, Counter(f[:2] for f in found), weights, [number(page)]


def joined(a: tuple, b: tuple) -> tuple:
    """Two states of a template as one, whatever their order: streams of the same parts are one, only texts of both remain,
    characters add up, and of the pages ``AGREE`` are known."""
    streams, texts, weights, pages = a
    for number, tokens in b[0].items():
        streams[number] = list(map(merge, streams[number], tokens)) if number in streams else tokens
    weights.update(b[2])
    common = Counter({t: n + b[1][t] for t, n in texts.items() if t in b[1]})
    return streams, common, weights, sorted({*pages, *b[3]})[:AGREE]


def learn(pages: list[str]) -> tuple[list, dict[tuple, bool], list[tuple], tuple, set[tuple[tuple, str]]]:
    """The wrapper of a template's pages, which of its paths are main text and its main region
    (where there is no article or main element), the elements above doubt, the template's texts."""
    return learn_template(pages)[:5]


def learn_template(pages: list[str]) -> tuple[list, dict[tuple, bool], list[tuple], tuple, set[tuple[tuple, str]], set[str]]:
    """What ``learn`` finds, and which of article and main the pages have."""
    states = [state_of(page, blocks(page)) for page in dict.fromkeys(pages)]
    return template_of(reduce(joined, states)) if states else ([], {}, [()], (), set(), set())


def template_of(state: tuple) -> tuple[list, dict[tuple, bool], list[tuple], tuple, set[tuple[tuple, str]], set[str]]:
    """What ``learn_template`` finds, from the joined state of a template's pages."""
    streams, texts, weights, pages = state
    wrapper: list = []
    for k, number in enumerate(sorted(streams)):
        wrapper = align(wrapper, streams[number]) if k else streams[number]
    parts = list(leaves(wrapper))
    constant = set(texts) if len(pages) >= AGREE else set()
    repeated = {path for path, _, _, again in parts if again}
    every = [(path, "", is_heading(path)) for path in weights]
    while True:
        varying = Counter(weights)
        for path, text in constant:
            varying[path] -= texts[path, text] * len(text)
        weight, total = weigh_paths(varying, all_of=True)
        spine = max((p for p, n in weight.items() if n >= SPINE * total and not {n for n, _ in p} & NEVER), key=len, default=())
        named = names_of(every, spine)
        regions = [] if named else [densest(*weigh_paths(varying, spine), repeated)]
        inside = {path: n for path, n in weights.items() if is_main(path, named, regions, spine)}
        agreed = sum(texts[c] * len(c[1]) for c in constant if c[0] in inside)
        if not constant or 2 * agreed <= sum(inside.values()):
            break
        constant = set()  # mostly agreeing pages are copies of a text: nothing tells the template from it
    main = {path: is_main(path, named, regions, spine) for path, *_ in parts}
    # an article or main element is all text of its page; only in an inferred region can the template repeat some
    return wrapper, main, regions, spine, set() if named else {c for c in constant if c[0] in inside}, named


def infer(pages: list[str]) -> tuple[list, dict[tuple, bool], list[tuple]]:
    """The wrapper of a template's pages, which of its paths are main text, and its main region."""
    return learn(pages)[:3]


def is_main(path: tuple, named: set[str], regions: list[tuple], spine: tuple = ()) -> bool:
    """Whether a path holds main text; ``named``: those of article and main that the page has."""
    names = {n for n, _ in path}
    if is_chrome(path, bool(names & HEADINGS), spine):
        return False
    if named:
        return ("article" if "article" in named else "main") in names
    return not regions or any(path[:len(r)] == r for r in regions)


def main_text(page: str | None, main: dict[tuple, bool], regions: list[tuple], spine: tuple = (), constant: set = frozenset(),
              elements: set[str] = frozenset()) -> str:
    """The main text of a whole page by its template's wrapper, which holds for pages with the same of
    article and main (``elements``) as the template."""
    if not page:
        return ""
    found = blocks(page)
    named = names_of(found, spine)
    known = main if named == elements else {}
    if not named and not any(is_main(path, named, regions, spine) for path, _, _ in found if regions):
        known, regions = {}, [densest(*weigh(found, spine))]
    return "\n".join(text for path, text, _ in found if (named or (path, text) not in constant)
                     and (known[path] if path in known else is_main(path, named, regions, spine)))


def host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def with_layout(rows: DataFrame, *kept: str) -> DataFrame:
    """Columns ``kept`` of pages with ``_host`` and ``_html``, and their template ``_layout``."""
    def of(b):
        return {**{c: b.column(c) for c in kept}, "_layout": [layout(blocks(page)) if page else 0 for page in b.column("_html").to_pylist()]}
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(rows.select(*dict.fromkeys([*kept, "_html"])), of, kinds + ", _layout long")


def states(rows: DataFrame) -> DataFrame:
    """``_host``, ``_layout`` and the pickled ``state`` of the templates of ``rows`` (``_host``, ``_html``): of each some,
    one from each task or more."""
    kind = StructType([StructField("_host", StringType()), StructField("_layout", LongType()), StructField("state", BinaryType())])
    arrow = to_arrow_schema(kind)

    def run(batches):
        held: dict[tuple, tuple] = {}

        def handed():
            columns = [[k[0] for k in held], [k[1] for k in held], [pickle.dumps(s) for s in held.values()]]
            held.clear()
            return pa.RecordBatch.from_pydict(dict(zip(kind.names, columns)), schema=arrow)
        fresh = 0
        for part in slices(batches):
            for at, page in zip(part.column("_host").to_pylist(), part.column("_html").to_pylist()):
                if page:
                    found = blocks(page)
                    template, state = (at, layout(found)), state_of(page, found)
                    known = held.get(template)
                    before = len(known[0]) if known else 0
                    held[template] = joined(known, state) if known else state
                    fresh += len(held[template][0]) - before
            if len(held) > HELD_TEMPLATES or fresh > HELD_STREAMS:
                fresh = 0
                yield handed()
        yield handed()
    return rows.select("_host", "_html").mapInArrow(run, kind)


def wrappers(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``_host`` and ``_layout`` of each template, its wrapper as text, and as JSON what ``learn`` found, from all its pages."""
    rows = pages.select(host(url_col).alias("_host"), F.col(html_col).cast("string").alias("_html"))

    def together(pdf) -> tuple:
        return reduce(joined, map(pickle.loads, pdf["state"]))

    def of_group(pdf):
        import pandas as pd
        return pd.DataFrame({"_host": [pdf["_host"].iloc[0]], "_layout": [pdf["_layout"].iloc[0]], "state": [pickle.dumps(together(pdf))]})

    def of_template(pdf):
        import json

        import pandas as pd
        wrapper, main, regions, spine, constant, named = template_of(together(pdf))
        kept = sorted(path for path, is_text in main.items() if is_text)
        return pd.DataFrame({"_host": [pdf["_host"].iloc[0]], "_layout": [pdf["_layout"].iloc[0]], "wrapper": [repr(wrapper)],
                             "slots": [json.dumps([kept, regions, spine, sorted(named), sorted(constant)])]})
    some = states(rows).withColumn("_group", F.spark_partition_id() % GROUPS)
    some = some.groupBy("_host", "_layout", "_group").applyInPandas(of_group, "_host string, _layout long, state binary")
    return some.groupBy("_host", "_layout").applyInPandas(of_template, "_host string, _layout long, wrapper string, slots string")


def unpacked(slots: str) -> tuple[dict[tuple, bool], list[tuple], tuple, set[tuple[tuple, str]], set[str]]:
    """What ``learn_template`` found, from its JSON: main, regions, spine, template texts, elements."""
    import json

    path = lambda p: tuple((n, tuple(m)) for n, m in p)
    kept, regions, spine, named, constant = json.loads(slots)
    return {path(p): True for p in kept}, [path(p) for p in regions], path(spine), {(path(p), t) for p, t in constant}, set(named)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col``, ``url_col``, ``text``."""
    learned = materialise(wrappers(pages, id_col, url_col, html_col), "wrappers").select("_host", "_layout", "slots")
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("_html"), host(url_col).alias("_host"))
    n, held = learned.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("slots")), F.lit(0))).first()
    learned = F.broadcast(learned) if n <= TEMPLATES and held <= HELD else learned
    joined = with_layout(rows, id_col, url_col, "_html", "_host").join(learned, ["_host", "_layout"], "left").drop("_host", "_layout")
    known: dict[str, tuple] = {}

    def of(b):
        texts = []
        for page, learnt in zip(b.column("_html").to_pylist(), b.column("slots").to_pylist()):
            if learnt is None:
                texts.append("")
                continue
            if learnt not in known:
                if len(known) > 5000:
                    known.clear()
                known[learnt] = unpacked(learnt)
            texts.append(main_text(page, *known[learnt]))
        return {id_col: b.column(id_col), url_col: b.column(url_col), "text": texts}
    kinds = pages.schema
    return map_batches(joined, of, f"`{id_col}` {kinds[id_col].dataType.simpleString()}, `{url_col}` {kinds[url_col].dataType.simpleString()}, text string")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
