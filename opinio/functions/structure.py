"""The element structure of a page, as one native array, and what is looked up on it.

``segments`` cuts a page before every tag. ``nodes`` gives one entry per segment: the element that its
tag opens ('' for a closing tag or text), the segment of its parent, the first segment behind it,
the nearest figure around an image and whether a div with a content class is around it. So element ``i``
is the segments ``[i, end)``, an ancestor's interval holds its descendants', and container, parent,
figure and children are interval look-ups.

The array comes from one fold over the tags with the stack of open elements. A closing tag closes
everything above the element it names and is ignored if there is none; some elements end where
another one begins (a paragraph before a block, an item before the next item); void and
self-closed elements hold nothing; what is never closed runs to the end of what it lies in. The
fold works in chunks of ``CHUNK`` tags, so that a long page costs little more per tag than a short one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 64

# ------------------------------------ fixed values -------------------------------------

VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Elements before which an open paragraph ends.
BLOCKS = ("address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main",
          "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul")
#: Elements that end where one of their kind begins, inside the same list or table.
SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
LISTS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "option": ("select",)}
#: No element ends because of a tag inside one of these.
BARRIERS = ("table", "td", "th", "caption", "button", "object", "template")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def segments(clean: Column) -> Column:
    """The page cut before every tag (``clean``: without scripts, styles and comments)."""
    return F.split(clean, "(?=</?[a-zA-Z])")


def own_tag(segment: Column) -> Column:
    return F.regexp_extract(segment, "^(<[^>]*>)", 1)


def _ends(name: Column) -> Column:
    """The elements that an opening tag ends; null if none."""
    out = F.when(name.isin(*BLOCKS), _strings(["p"]))
    for key, kinds in SIBLINGS.items():
        out = out.when(name == key, _strings([*kinds, "p"] if key == "li" else kinds))
    return out


def _barriers(name: Column) -> Column:
    """The elements beyond which an opening tag ends nothing."""
    out = F.when(name.isin("tr", "td", "th"), _strings(["table"]))
    for key, lists in LISTS.items():
        out = out.when(name == key, _strings([*lists, *BARRIERS]))
    return out.otherwise(_strings(BARRIERS))


def tags_of(segs: Column, hint: str = "^$") -> Column:
    """Per segment: place, element name, kind (1 opens, 0 holds nothing, -1 closes), what it ends and
    within what, whether it is a div whose tag matches ``hint``."""
    def tag(seg: Column, i: Column) -> Column:
        name = F.lower(F.regexp_extract(seg, "^</?([a-zA-Z][^\\s/>]*)", 1))
        closing = seg.startswith("</")
        kind = (F.when(name == "", 0).when(closing, -1)
                .when(name.isin(*VOID) | seg.rlike("^<[^>]*/>"), 0).otherwise(1))
        return F.struct((i + 1).alias("at"), name.alias("name"), kind.alias("kind"),
                        F.when(~closing, _ends(name)).alias("ends"), _barriers(name).alias("within"),
                        F.when((name == "div") & ~closing, seg.rlike(hint)).otherwise(False).alias("hint"))
    return F.transform(segs, tag)


def _place(names: Column, kinds: Column) -> Column:
    """The place of the first of ``kinds`` in ``names``, 0 if there is none."""
    return F.array_position(F.transform(names, lambda n: F.array_contains(kinds, n)), True).cast("int")


def _kept(acc: Column, t: Column) -> Column:
    """How many of the open elements stay open at a tag."""
    names, size = acc["names"], F.size(acc["names"])
    named = F.array_position(F.reverse(names), t["name"]).cast("int")
    barrier = F.when(_place(F.reverse(names), t["within"]) > 0, size - _place(F.reverse(names), t["within"]) + 1).otherwise(0)
    ended = _place(F.slice(names, barrier + 1, size), t["ends"])
    return (F.when(t["kind"] == -1, F.when(named > 0, size - named).otherwise(size))
            .when(t["ends"].isNull(), size).when(ended > 0, barrier + ended - 1).otherwise(size))


def _after(acc: Column, t: Column, k: Column) -> Column:
    """The state after a tag that leaves ``k`` elements open."""
    names, at = F.slice(acc["names"], F.lit(1), k), F.slice(acc["at"], F.lit(1), k)
    opens, hint = t["kind"] == 1, F.when(acc["hint"] > k, 0).otherwise(acc["hint"])
    figure = F.get(acc["at"], k - F.array_position(F.reverse(names), "figure").cast("int"))
    node = F.struct(
        F.coalesce(F.get(acc["at"], k - 1), F.lit(0)).alias("parent"),
        F.when((t["name"] == "img") & F.array_contains(names, "figure"), figure).otherwise(0).alias("figure"),
        (hint > 0).alias("hinted"), F.slice(acc["at"], k + 1, F.size(acc["at"]) - k).alias("closes"))
    return _state(F.when(opens, F.concat(names, F.array(t["name"]))).otherwise(names),
                  F.when(opens, F.concat(at, F.array(t["at"]))).otherwise(at),
                  F.when(opens & t["hint"] & (hint == 0), k + 1).otherwise(hint), F.concat(acc["out"], F.array(node)))


def _state(names: Column, at: Column, hint: Column, out: Column) -> Column:
    return F.struct(names.alias("names"), at.alias("at"), hint.alias("hint"), out.alias("out"))


_NODE = "struct<parent:int,figure:int,hinted:boolean,closes:array<int>>"


def fold_of(tags: Column) -> Column:
    """The fold over the tags: ``struct(at, out)`` with the elements never closed and, in chunks, what
    each tag found around it and closed."""
    none = F.array().cast(f"array<{_NODE}>")
    chunks = F.transform(F.sequence(F.lit(0), ((F.size(tags) - 1) / CHUNK).cast("int")), lambda c: F.slice(tags, c * CHUNK + 1, F.lit(CHUNK)))
    start = _state(_strings([]), F.array().cast("array<int>"), F.lit(0), F.array().cast(f"array<array<{_NODE}>>"))
    return F.aggregate(chunks, start, lambda acc, part: F.aggregate(
        part, _state(acc["names"], acc["at"], acc["hint"], none),
        lambda one, t: let(_kept(one, t), lambda k: _after(one, t, k)),
        lambda r: _state(r["names"], r["at"], r["hint"], F.concat(acc["out"], F.array(r["out"])))))


def ends_of(tags: Column, fold: Column) -> Column:
    """``struct(outs, ends)``: what the fold found and the first segment behind the element, per tag."""
    outs = F.flatten(fold["out"])
    pair = lambda at, end: F.struct(at.cast("int").alias("at"), end.cast("int").alias("end"))
    ends = F.array_sort(F.concat(
        F.flatten(F.transform(outs, lambda o, j: F.transform(o["closes"], lambda e: pair(e, j + 1)))),
        F.transform(fold["at"], lambda e: pair(e, F.size(tags) + 1)),
        F.transform(F.filter(tags, lambda t: t["kind"] != 1), lambda t: pair(t["at"], t["at"]))))
    return F.struct(outs.alias("outs"), ends["end"].alias("ends"))


def tree_of(tags: Column, found: Column) -> Column:
    """Per segment ``struct(name, parent, end, figure, hinted)``; places count from 1, 0 is the page."""
    return F.transform(tags, lambda t, i: F.struct(
        F.when(t["kind"] >= 0, t["name"]).otherwise("").alias("name"),
        F.get(found["outs"], i)["parent"].alias("parent"), F.get(found["ends"], i).alias("end"),
        F.get(found["outs"], i)["figure"].alias("figure"), F.get(found["outs"], i)["hinted"].alias("hinted")))


def nodes(segs: Column, hint: str = "^$") -> Column:
    """The structure as one expression; ``with_structure`` adds the same in steps."""
    return let(tags_of(segs, hint), lambda tags: let(fold_of(tags), lambda fold: let(
        ends_of(tags, fold), lambda found: tree_of(tags, found))))


def fenced(df: DataFrame, *computed: str) -> DataFrame:
    """``df`` with its ``computed`` columns behind a one-row generator. The optimizer would otherwise
    move filters on them, and filters that it infers, below the steps that make them, and repeat
    those steps inside each; it also works on a stream, where no table can be written."""
    kept = [c for c in df.columns if c not in computed]
    one = df.select(*kept, F.explode(F.array(F.struct(*computed))).alias("_computed"))
    return one.select(*kept, *[F.col(f"_computed.{c}").alias(c) for c in computed])


def with_structure(pages: DataFrame, clean_col: str, hint: str = "^$") -> DataFrame:
    """``pages`` with the columns ``segs`` and ``tree`` of the page in ``clean_col``."""
    c = F.col
    made = (pages.withColumn("segs", segments(c(clean_col))).withColumn("tags", tags_of(c("segs"), hint))
            .withColumn("fold", fold_of(c("tags"))).withColumn("found", ends_of(c("tags"), c("fold")))
            .withColumn("tree", tree_of(c("tags"), c("found"))).drop("tags", "fold", "found"))
    return fenced(made, "segs", "tree")


# ----------------------------------- look-ups ------------------------------------------

def inner_html(segs: Column, at: Column, end: Column) -> Column:
    """The HTML of the segments [at, end): an element with its own tag, without its closing tag."""
    return F.array_join(F.slice(segs, at, F.greatest(end - at, F.lit(0))), "")


def places(tree: Column, *names: str) -> Column:
    """The places of the elements of these names, in document order."""
    return F.filter(F.transform(tree, lambda n, i: F.when(n["name"].isin(*names), i + 1)), lambda i: i.isNotNull())


def between(at: Column, after: Column, end: Column) -> Column:
    return F.filter(at, lambda i: (i > after) & (i < end))


def node(tree: Column, at: Column) -> Column:
    return F.get(tree, at - 1)
