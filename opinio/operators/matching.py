"""Title matching: M1 (exact), M5 (dedupe, last value wins), M2 (fuzzy similarity),
M3 (exact first, else first fuzzy hit in report order), M4 (containment only), D4.

M2 is ``a ⊆ b  or  b ⊆ a  or  |words(a) ∩ words(b)| ≥ 3`` on normalised titles. As a
join condition that is a nested loop over articles × report titles; here it is equi joins
whose candidates are verified exactly (no pair is lost, none is invented):

* overlap ≥ t — every title's words become numbers, those that only one side has are left out, and the rest
  is ordered by global rarity. The ``HOT`` most frequent words are bits of a few numbers: titles that share t of
  them are met mask by mask, on a grid of tasks, and decided by counting bits. All others share a rarer word:
  two titles that share ≥ t words share one among the first ``n - t + 1`` of each. Equi-join on the rarer ones of
  these words with position filtering: a pair is kept where the join word is its rarest common one, so it comes up
  once and needs no duplicate removal, and the words behind that position must share t - 1 more.
* containment — every word of a string but the first and the last is a whole word of the string
  that contains it, in the same order. A title with such inner words probes with the first run
  of 1, 2 or 4 of them, one of two words with the characters around its white space; one word is sought
  inside the other side's distinct words by a substring of at most q characters. The probe brings its title and the
  answer the piece of text around the run that a probe can reach, so that candidates are verified where they meet;
  a bitmap of the probes' keys leaves out the answers that nobody asks for before any of them is shuffled. Where overlap
  decides too, a contained title with t inner words is left to it. Whole texts are too long for
  this: ``contained_pairs`` probes with the rarest inner word and verifies afterwards.

M3 needs only the first hit of each article, so it works through the report in ranges of its order,
the first one small and each next one larger: titles that found a match leave, and the
pairs of a range are reduced to the first per title before anything else reads them.

Nothing is collected per group and nothing is capped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, WS_JAVA
from ..plans.scratch import materialise

Q = 8                 # longest substring that probes for a string of one or two words
MIN_COMMON = 3        # fixed value: "at least three common words"
FIRST_RANGE, GROWTH = 512, 8   # report entries of the first range of M3; each next is larger by this factor
BITS, MASKS = 62, 4   # the most frequent words as bits: so many a number, and so many numbers
HOT = BITS * MASKS
RUNS = (4, 2, 1)      # inner words that probe for a title: the longest of these that it has
BROADCAST_KEYS, BROADCAST_BYTES = 100_000, 16 << 20   # probes, and bytes of them, that may be broadcast
TASK_PAIRS, GRID = 1_000_000_000, 64  # pairs of masks that a cell of the grid may get; most rows and columns of it
SLOTS, SPARSE = 1 << 20, 16          # numbers of the bitmap of probes, at most; bits for each probe
NORM_DROP = "[^\\p{L}\\p{N}_" + WS[1:-1] + "]"


def norm_title(c: Column) -> Column:
    """Lower-case and drop every character that is neither a word character nor whitespace."""
    return F.regexp_replace(F.lower(c), NORM_DROP, "")


def title_words(norm: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(norm, WS_JAVA + "+"), ""))


# ----------------------------------- M5 / M1 -------------------------------------------

def dedupe_last(report: DataFrame) -> DataFrame:
    """M5: one row per title; ``score`` of the last occurrence, position of the first."""
    return report.groupBy("title").agg(F.max_by("score", "seq").alias("score"),
                                       F.min("seq").alias("seq"))


def match_exact(articles: DataFrame, report_dedup: DataFrame) -> DataFrame:
    """M1: left equi-join on the title (``report_dedup`` has one row per title)."""
    r = report_dedup.select(F.col("title").alias("a_title"), F.col("seq").alias("r_seq"), "score")
    return articles.select("a_id", "a_title").join(r, "a_title", "left")


# ------------------------------------ M2 -----------------------------------------------

def word_numbers(a: DataFrame, r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides ``(id, norm)`` as tables ``(id, norm, rare, m0..)``: the words that both sides know, by one
    order for both, rarest first. ``rare``: the numbers of those that are not among the ``HOT`` most frequent, which are
    the bits of the masks. Rows of words carry the number of their title, never its text."""
    spark = a.sparkSession
    sides = (a.select(F.lit(0).alias("side"), F.col("a_id").alias("id"), F.col("a_norm").alias("norm"))
             .unionByName(r.select(F.lit(1).alias("side"), F.col("r_id").alias("id"), F.col("r_norm").alias("norm"))))
    sides = materialise(sides, "titles", "id")
    kinds = sides.groupBy("norm").agg(F.sum(1 - F.col("side")).alias("na"), F.sum("side").alias("nr"))
    kinds = materialise(_numbered(kinds.where("norm IS NOT NULL"), "norm"), "title-kinds")
    words = kinds.select("kind", "na", "nr", F.explode_outer(title_words(F.col("norm"))).alias("w")).where("w IS NOT NULL")
    known = (words.groupBy("w").agg(F.sum("na").alias("fa"), F.sum("nr").alias("fr")).where("fa > 0 AND fr > 0")
             .select("w", (F.col("fa") * F.col("fr")).alias("f"), F.monotonically_increasing_id().alias("n")))
    known = materialise(known, "title-words")           # the numbers are fixed from here on
    hot = known.orderBy(F.col("f").desc(), F.col("n").desc()).limit(HOT).collect()
    ranks = spark.createDataFrame([(h["n"], k) for k, h in enumerate(hot)], "n long, h int")
    bit = lambda j: F.bit_or(F.when(F.floor(F.col("h") / BITS) == j, F.expr(f"shiftleft(1L, h % {BITS})")))
    numbers = (words.select("kind", "w").join(known, "w").join(F.broadcast(ranks), "n", "left").groupBy("kind")      # at most HOT rows
               .agg(F.sort_array(F.collect_list(F.when(F.col("h").isNull(), F.struct("f", "n"))))["n"].alias("rare"),
                    *[bit(j).alias(f"m{j}") for j in range(MASKS)]))
    numbers = kinds.select("kind", "norm").join(numbers, "kind", "left").drop("kind")
    full = materialise(sides.join(numbers, "norm", "left").select(
        "side", "id", "norm", F.coalesce("rare", F.array().cast("array<bigint>")).alias("rare"),
        *[F.coalesce(f"m{j}", F.lit(0).cast("long")).alias(f"m{j}") for j in range(MASKS)]), "title-numbers", "id")
    one = lambda side, name: full.where(F.col("side") == side).select(
        F.col("id").alias(f"{name}_id"), F.col("norm").alias(f"{name}_norm"), "rare", *[f"m{j}" for j in range(MASKS)])
    return one(0, "a"), one(1, "r")


def _numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` dealt out by a column, with a number ``kind`` for each; to be written at once."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, by).withColumn("kind", F.monotonically_increasing_id())


def _few(rows: DataFrame, held: Column) -> bool:
    """Whether a table may be broadcast, by its rows and their bytes."""
    n, size = rows.limit(BROADCAST_KEYS + 1).select(held.alias("held")).agg(F.count(F.lit(1)), F.coalesce(F.sum("held"), F.lit(0))).first()
    return n <= BROADCAST_KEYS and size <= BROADCAST_BYTES


def _hinted(x: DataFrame, y: DataFrame, x_held: Column, y_held: Column) -> tuple[DataFrame, DataFrame]:
    """The two sides of a join: one of them hinted for broadcast if it is small, else for a merge. Rows that are made
    from a small file may be many, and Spark judges them by the file."""
    if _few(x, x_held):
        return F.broadcast(x), y
    return (x, F.broadcast(y)) if _few(y, y_held) else (x.hint("merge"), y)


def _bits(one: str, other: str) -> Column:
    """How many hot words two sets of masks share."""
    both = [F.bit_count(F.col(f"{one}{j}").bitwiseAND(F.col(f"{other}{j}"))) for j in range(MASKS)]
    return sum(both[1:], both[0])


def hot_pairs(a: DataFrame, r: DataFrame, t: int) -> DataFrame:
    """Pairs ``(a_id, r_id)`` that share at least ``t`` hot words. Each pair of titles that have as many is one
    count of bits; a cell of the grid holds a part of either side."""
    def able(side: DataFrame, id_col: str, as_: str) -> DataFrame:
        return side.where(_bits("m", "m") >= t).select(id_col, *[F.col(f"m{j}").alias(f"{as_}{j}") for j in range(MASKS)])
    x, y = able(a, "a_id", "m"), able(r, "r_id", "n")
    enough, width = _bits("m", "n") >= t, F.lit(8 * (MASKS + 1))
    small = next((k for k, side in enumerate((y, x)) if _few(side, width)), None)
    if small is not None:
        return x.join(F.broadcast(y), enough) if small == 0 else y.join(F.broadcast(x), enough)
    g = max(1, min(GRID, math.ceil(math.sqrt(x.count() * y.count() / TASK_PAIRS))))
    all_cells = F.explode(F.sequence(F.lit(0), F.lit(g - 1)))
    place = lambda id_col: F.pmod(F.xxhash64(id_col), F.lit(g)).cast("int")
    x = x.withColumn("row", place("a_id")).withColumn("column", all_cells)
    y = y.withColumn("column", place("r_id")).withColumn("row", all_cells)
    return x.join(y.hint("shuffle_hash"), ["row", "column"]).where(enough)


def overlap_pairs(a: DataFrame, r: DataFrame, t: int = MIN_COMMON) -> DataFrame:
    """Pairs ``(a_id, r_id)`` whose word numbers share at least ``t`` (exact, each pair once).

    ``a``, ``r``: of ``word_numbers``.
    """
    hots = _bits("m", "m")
    masks = [f"m{j}" for j in range(MASKS)]

    def prefix(side: DataFrame, id_col: str) -> DataFrame:
        first = F.slice("rare", F.lit(1), F.greatest(F.size("rare") + hots - (t - 1), F.lit(0)))
        return side.where((F.size("rare") > 0) & (F.size("rare") + hots >= t)).select(id_col, "rare", *masks, F.posexplode_outer(first).alias("at", "w"))
    asks = prefix(a, "a_id").select("a_id", "w", F.slice("rare", F.lit(1), F.col("at")).alias("before"),
                                    F.slice("rare", F.col("at") + 2, F.size("rare")).alias("behind"), *masks)
    answers = prefix(r, "r_id").select("r_id", "w", "rare", *[F.col(m).alias(f"n{j}") for j, m in enumerate(masks)])
    width = 8 * (MASKS + 2)
    answers, asks = _hinted(answers, asks, F.size("rare") * 8 + width, (F.size("before") + F.size("behind")) * 8 + width)
    shared = _bits("m", "n")
    enough = (shared + F.size("behind") >= t - 1) & ((shared == t - 1) | (shared + F.size(F.array_intersect("behind", "rare")) >= t - 1))
    rarer = (asks.join(answers, "w").where((shared < t) & enough & ~F.arrays_overlap("before", "rare"))
             .select("a_id", "r_id"))
    return rarer.unionByName(hot_pairs(a, r, t).select("a_id", "r_id"))


def string_tokens(c: Column) -> Column:
    return F.split(c, WS_JAVA + "+")


def inner_words(c: Column) -> Column:
    """The words of a string but the first and the last token: whole words wherever it is contained."""
    tokens = string_tokens(c)
    return F.array_distinct(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0))))


def _substrings(c: Column, k: int) -> Column:
    """All substrings of ``k`` characters of a word."""
    return F.when(F.length(c) >= k, F.transform(F.sequence(F.lit(1), F.length(c) - (k - 1)), lambda i: F.substring(c, i, k))) \
        .otherwise(F.array().cast("array<string>"))


def _gap_keys(c: Column, sizes: list[tuple[int, int]]) -> Column:
    """For every white space of a string and every (a, b): the ``a`` characters of the word before it
    and the ``b`` of the word behind it."""
    def keys(tokens: Column, a: int, b: int) -> Column:
        word = lambda i: F.element_at(tokens, i)
        return F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.when(
            (F.length(word(i)) >= a) & (F.length(word(i + 1)) >= b), F.concat(F.right(word(i), F.lit(a)), F.lit(" "), F.left(word(i + 1), F.lit(b)))))
    every = F.transform(F.array(string_tokens(c)), lambda t: F.when(F.size(t) > 1, F.array_distinct(F.array_compact(
        F.flatten(F.array(*[keys(t, a, b) for a, b in sizes]))))).otherwise(F.array().cast("array<string>")))
    return every[0]


def contained_pairs(x: DataFrame, y: DataFrame, q: int = Q, proper: bool = False, beside_overlap: int | None = None) -> DataFrame:
    """Pairs ``(x_id, y_id)`` with ``x_str`` a substring of ``y_str`` (exact, each pair once).

    ``x``: (x_id, x_str); ``y``: (y_id, y_str), both written tables (they are read several times).
    ``proper``: without equal strings; ``beside_overlap``: without pairs that share as many words.
    """
    n_tokens = F.size(string_tokens(F.col("x_str")))
    inner = x.select("x_id", "x_str", inner_words(F.col("x_str")).alias("inner"), n_tokens.alias("tokens"))
    words = y.select("y_id", F.length("y_str").alias("size"), F.explode(F.array_distinct(string_tokens(F.col("y_str")))).alias("w"))
    # strings with inner words: the rarest of them (one that y lacks rules the string out)
    asked = inner.where(F.size("inner") > 0)
    seen = words.groupBy("w").agg(F.count(F.lit(1)).alias("f"))
    probe = (asked.select("x_id", F.explode("inner").alias("w"), F.size("inner").alias("of")).join(seen, "w")
             .groupBy("x_id", "of").agg(F.min_by("w", F.struct("f", "w")).alias("w"), F.count(F.lit(1)).alias("have"))
             .where("have = of").select("x_id", "w"))
    found = probe.join(words, "w").select("x_id", "y_id")
    # one white space: the characters around it
    two = inner.where((F.col("tokens") == 2) & (F.size("inner") == 0)).select("x_id", string_tokens(F.col("x_str")).alias("t"))
    near = lambda i: F.least(F.length(F.get("t", F.lit(i))), F.lit(q // 2 - 1))
    two = two.select("x_id", near(0).alias("a"), near(1).alias("b"), "t")
    # what probes there are: at most (q / 2)^2 pairs of sizes, q lengths, and whether one is empty
    asks = (two.select(F.struct("a", "b").alias("gap"), F.lit(None).cast("int").alias("length"))
            .unionByName(inner.where("tokens = 1").select(F.lit(None).cast("struct<a:int,b:int>").alias("gap"), F.least(F.length("x_str"), F.lit(q)).alias("length")))
            .agg(F.collect_set("gap").alias("gaps"), F.collect_set("length").alias("lengths")).first())
    sizes = sorted((g["a"], g["b"]) for g in asks["gaps"])
    lengths = sorted(n for n in asks["lengths"] if n)
    two = two.select("x_id", F.concat(F.right(F.get("t", F.lit(0)), F.col("a")), F.lit(" "), F.left(F.get("t", F.lit(1)), F.col("b"))).alias("g"))
    if sizes:
        gaps = y.select("y_id", F.explode(_gap_keys(F.col("y_str"), sizes)).alias("g"))
        found = found.unionByName(two.select("x_id", "g").join(gaps, "g").select("x_id", "y_id"))
    checked = found.join(x, "x_id").join(y, "y_id").where(F.instr(F.col("y_str"), F.col("x_str")) > 0)
    if proper:
        checked = checked.where(F.col("x_str") != F.col("y_str"))
    if beside_overlap is not None:
        common = F.array_intersect(title_words(F.col("x_str")), title_words(F.col("y_str")))
        checked = checked.where(F.size(common) < beside_overlap)
    checked = checked.select("x_id", "y_id")
    # one word: inside a word of y, found among y's distinct words
    one = inner.where("tokens = 1 AND x_str <> ''").select("x_id", "x_str", F.substring("x_str", 1, q).alias("g"))
    if lengths:
        grams = (words.select("w").distinct().select("w", F.explode(F.array_distinct(F.flatten(F.array(
            *[_substrings(F.col("w"), n) for n in lengths])))).alias("g")))
        holds = one.join(grams, "g").where(F.instr(F.col("w"), F.col("x_str")) > 0).select("x_id", F.length("x_str").alias("x_size"), "w")
        pairs = holds.join(words, "w")
        pairs = pairs.where(F.col("x_size") < F.col("size")) if proper else pairs
        checked = checked.unionByName(pairs.select("x_id", "y_id").distinct())
    # the empty string is in every other (the key is empty in every row, and no literal)
    empty = inner.where("x_str = ''").select("x_id", F.substring("x_str", 1, 0).alias("g"))
    if 0 in asks["lengths"]:
        every = y.where(F.col("y_str") != "") if proper else y
        checked = checked.unionByName(empty.join(every.select("y_id", F.substring("y_str", 1, 0).alias("g")), "g").select("x_id", "y_id"))
    return checked


def _title_keys(c: Column, runs: dict[int, int], sizes: list[tuple[int, int]]) -> Column:
    """What a title may be asked by, as (k, at, take): numbers of its runs of so many words between others, and of the
    characters around its white space, and the pieces of text (first, how many) that a title with this probe can lie in."""
    def entry(k: Column, at: Column, take: int) -> Column:
        return F.struct(k.alias("k"), at.cast("int").alias("at"), F.lit(take).alias("take"))

    def run(t: Column, n: int, take: int) -> Column:
        return F.when(F.size(t) >= n + 2, F.transform(F.sequence(F.lit(2), F.greatest(F.size(t) - n, F.lit(2))), lambda i: entry(
            F.xxhash64(F.array_join(F.slice(t, i, F.lit(n)), " ")), i - 1, take))).otherwise(none)

    def gap(t: Column, a: int, b: int) -> Column:
        word = lambda i: F.element_at(t, i)
        return F.when(F.size(t) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))), lambda i: F.when(
            (F.length(word(i)) >= a) & (F.length(word(i + 1)) >= b), entry(
                F.xxhash64(F.concat(F.right(word(i), F.lit(a)), F.lit(" "), F.left(word(i + 1), F.lit(b)))), i, 2)))).otherwise(none)
    none = F.array().cast("array<struct<k:bigint,at:int,take:int>>")
    return F.transform(F.array(string_tokens(c)), lambda t: F.array_compact(F.flatten(F.array(
        none, *[run(t, n, take) for n, take in runs.items()], *[gap(t, a, b) for a, b in sizes]))))[0]


def _asked(answers: DataFrame, probes: DataFrame) -> DataFrame:
    """The answers whose key may be that of a probe, by a bitmap of the probes' keys: of a bounded size, it may keep too many."""
    n = 1 << max(6, math.ceil(math.log2(max(1, probes.count()) * SPARSE / 64)))
    slot = F.pmod(F.shiftrightunsigned("k", 6), F.lit(min(SLOTS, n))).alias("slot")
    bit = F.expr("shiftleft(1L, cast(k & 63 as int))")
    bitmap = probes.select(slot, bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits"))       # at most SLOTS rows
    return answers.withColumn("slot", slot).join(F.broadcast(bitmap), "slot").where(F.col("bits").bitwiseAND(bit) != 0)


def contained_titles(x: DataFrame, y: DataFrame, proper: bool = False, beside_overlap: int | None = None) -> DataFrame:
    """As ``contained_pairs``, for two sides of short strings with an id of its own for each: probes come along with
    their strings and answers with the piece of theirs around the key, and they are verified in the join, so
    candidates are never written or shuffled. ``once``: whether the string is one word."""
    q = Q
    longest = y.agg(F.max(F.length("y_str"))).first()[0]        # what is longer than all of y is in none
    x = x.where(F.length("x_str") <= F.lit(-1 if longest is None else longest)).select("x_id", "x_str", string_tokens(F.col("x_str")).alias("t"))
    inner = F.size("t") - 2
    run = F.when(inner >= RUNS[0], RUNS[0]).when(inner >= RUNS[1], RUNS[1]).when(inner >= RUNS[2], RUNS[2])
    near = lambda i: F.least(F.length(F.get("t", F.lit(i))), F.lit(q // 2 - 1))
    two, one = F.size("t") == 2, F.size("t") == 1
    x = x.select("x_id", "x_str", "t", run.alias("run"), F.when(two, F.struct(near(0).alias("a"), near(1).alias("b"))).alias("gap"),
                 F.when(one, F.least(F.length("x_str"), F.lit(q))).alias("length"))
    # what probes there are: at most three lengths of runs and the words of their longest titles, (q / 2)^2 pairs of sizes,
    # q lengths, and whether one is empty
    asks = x.agg(*[F.max(F.when(F.col("run") == n, F.size("t"))).alias(f"run{n}") for n in RUNS],
                 *[F.collect_set(c).alias(c) for c in ("gap", "length")]).first()
    runs, sizes = {n: asks[f"run{n}"] for n in RUNS if asks[f"run{n}"]}, sorted((g["a"], g["b"]) for g in asks["gap"])
    lengths = sorted(n for n in asks["length"] if n)
    gap = F.concat(F.right(F.get("t", F.lit(0)), F.col("gap.a")), F.lit(" "), F.left(F.get("t", F.lit(1)), F.col("gap.b")))
    key = F.when(F.col("run").isNotNull(), F.xxhash64(F.array_join(F.slice("t", F.lit(2), F.coalesce("run", F.lit(1))), " "))).when(two, F.xxhash64(gap))
    probes = x.where("run IS NOT NULL OR gap IS NOT NULL").select("x_id", "x_str", key.alias("k"))
    # a piece is a word and the white space behind it; the text is cut before its keys make many rows of it
    answers = y.select("y_id", "y_str", F.length("y_str").alias("size"), F.split("y_str", "(?<=" + WS_JAVA + ")(?!" + WS_JAVA + ")").alias("pieces"))
    answers = answers.select("y_id", "size", "pieces", F.explode_outer(_title_keys(F.col("y_str"), runs, sizes)).alias("key")).where("key IS NOT NULL")
    answers = answers.select("y_id", "size", "pieces", F.col("key.k").alias("k"), F.col("key.at").alias("at"), F.col("key.take").alias("take"))
    piece = F.array_join(F.slice("pieces", F.col("at"), F.col("take")), "")
    if _few(probes, F.octet_length("x_str") + 16):
        checked = F.broadcast(probes).join(answers, "k").where(F.instr(piece, F.col("x_str")) > 0)
    else:
        answers = _asked(answers, probes).select("y_id", "size", "k", piece.alias("piece"))
        checked = probes.hint("merge").join(answers, "k").where(F.instr(F.col("piece"), F.col("x_str")) > 0)
    if proper:
        checked = checked.where(F.length("x_str") < F.col("size"))
    pair = ["x_id", "y_id", F.lit(False).alias("once")]
    checked = checked.select("x_id", "y_id").distinct()            # a title may be in another twice
    if beside_overlap is not None:
        checked = (checked.join(x.select("x_id", title_words(F.col("x_str")).alias("x_words")), "x_id")
                   .join(y.select("y_id", title_words(F.col("y_str")).alias("y_words")), "y_id")
                   .where(F.size(F.array_intersect("x_words", "y_words")) < beside_overlap).select("x_id", "y_id"))
    checked = checked.select(*pair)
    # one word: inside a word of y, found among y's distinct words
    if lengths:
        words = y.select("y_id", F.length("y_str").alias("size"), F.explode(F.array_distinct(string_tokens(F.col("y_str")))).alias("w"))
        ask = x.where("length > 0").select("x_id", "x_str", F.substring("x_str", 1, q).alias("g"))
        grams = (words.select("w").distinct().select("w", F.explode(F.array_distinct(F.flatten(F.array(
            *[_substrings(F.col("w"), n) for n in lengths])))).alias("g")))
        holds = ask.join(grams, "g").where(F.instr(F.col("w"), F.col("x_str")) > 0).select("x_id", F.length("x_str").alias("x_size"), "w")
        pairs = holds.join(words, "w")
        pairs = pairs.where(F.col("x_size") < F.col("size")) if proper else pairs
        checked = checked.unionByName(pairs.select("x_id", "y_id").distinct().withColumn("once", F.lit(True)))
    # the empty string is in every other (the key is empty in every row, and no literal)
    if 0 in asks["length"]:
        empty = x.where("length = 0").select("x_id", F.substring("x_str", 1, 0).alias("g"))
        every = y.where(F.col("y_str") != "") if proper else y
        checked = checked.unionByName(empty.join(every.select("y_id", F.substring("y_str", 1, 0).alias("g")), "g").select(*pair))
    return checked


def _named(side: DataFrame, name: str, as_: str) -> DataFrame:
    return side.select(F.col(f"{name}_id").alias(f"{as_}_id"), F.col(f"{name}_norm").alias(f"{as_}_str"))


def containment_either(a: DataFrame, r: DataFrame, beside_overlap: int | None = None) -> DataFrame:
    """Pairs with ``a ⊆ r`` or ``r ⊆ a`` (on the prepared strings), each once; every title has an id of its own.
    ``once``: 1 or 2 where one word is in the other title, by which side it is; else 0.

    ``beside_overlap``: only the pairs that share fewer words than that; a contained string with as
    many inner words shares them.
    """
    def few(x: DataFrame) -> DataFrame:
        return x if beside_overlap is None else x.where(F.size(inner_words(F.col("x_str"))) < beside_overlap)
    forth = contained_titles(few(_named(a, "a", "x")), _named(r, "r", "y"), beside_overlap=beside_overlap)
    back = contained_titles(few(_named(r, "r", "x")), _named(a, "a", "y"), proper=True, beside_overlap=beside_overlap)
    once = lambda k: F.when(F.col("once"), k).otherwise(0).alias("once")
    return (forth.select(F.col("x_id").alias("a_id"), F.col("y_id").alias("r_id"), once(1))
            .unionByName(back.select(F.col("y_id").alias("a_id"), F.col("x_id").alias("r_id"), once(2))))


def containment_rows(a: DataFrame, r: DataFrame, beside_overlap: int | None = None) -> DataFrame:
    """As ``containment_either``, for sides whose titles and ids may repeat: each pair of rows once, and
    where one word is in the other title, each pair of ids."""
    def kinds(side: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        known = side.where(F.col(f"{name}_norm").isNotNull())
        of = materialise(_numbered(known.select(f"{name}_norm").distinct(), f"{name}_norm").withColumnRenamed("kind", f"{name}_kind"), "title-kinds")
        return (of.select(F.col(f"{name}_kind").alias(f"{name}_id"), f"{name}_norm"),
                known.select(f"{name}_id", f"{name}_norm").join(of, f"{name}_norm").select(f"{name}_kind", f"{name}_id"))
    (a_kinds, a_rows), (r_kinds, r_rows) = kinds(a, "a"), kinds(r, "r")
    pairs = containment_either(a_kinds, r_kinds, beside_overlap).select(F.col("a_id").alias("a_kind"), F.col("r_id").alias("r_kind"), "once")
    rows = pairs.join(r_rows, "r_kind").join(a_rows, "a_kind").groupBy("a_id", "r_id", "once").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("a_id", "r_id", F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("once") > 0, F.lit(1).cast("long")).otherwise(F.col("n"))))).select("a_id", "r_id")


def _sides(articles: DataFrame, report_dedup: DataFrame, norm) -> tuple[DataFrame, DataFrame]:
    a = articles.select("a_id", norm(F.col("a_title")).alias("a_norm"))
    r = report_dedup.select(F.col("seq").alias("r_id"), norm(F.col("title")).alias("r_norm"))
    return a, r


def similar_pairs(a: DataFrame, r: DataFrame) -> DataFrame:
    """M2 on the tables of ``word_numbers``, each title once: each similar pair ``(a_id, r_id)`` once."""
    return overlap_pairs(a, r).unionByName(containment_either(a, r, beside_overlap=MIN_COMMON).select("a_id", "r_id"))


def match_fuzzy(articles: DataFrame, report_dedup: DataFrame) -> DataFrame:
    """M2: every (article, report title) pair that is similar; ``r_seq`` identifies the title."""
    a, r = word_numbers(*_sides(articles, report_dedup, norm_title))
    pairs = overlap_pairs(a, r).unionByName(containment_rows(a, r, beside_overlap=MIN_COMMON))
    return pairs.select("a_id", F.col("r_id").alias("r_seq"))


def match_containment(articles: DataFrame, report_dedup: DataFrame) -> DataFrame:
    """M4: case-insensitive containment either way, no punctuation removal."""
    a, r = _sides(articles, report_dedup, F.lower)
    return containment_rows(materialise(a, "titles", "a_id"), materialise(r, "titles", "r_id")).select("a_id", F.col("r_id").alias("r_seq"))


# ------------------------------------ M3 / D4 ------------------------------------------

def _ranges(r: DataFrame, first: int, growth: int) -> list[tuple[int | None, int | None]]:
    """Ranges (after, up to) of the report order: about ``first`` entries, then ever larger
    ones. The bounds are approximate percentiles; any bounds give the same matches."""
    n = r.count()
    sizes, shares = first, []
    while sizes < n:
        shares.append(sizes / n)
        sizes *= growth
    if not shares:
        return [(None, None)]
    bounds = r.agg(F.percentile_approx("r_id", shares, 10_000)).first()[0]
    return list(zip([None, *bounds], [*bounds, None]))


def first_fuzzy(a: DataFrame, r: DataFrame, first: int = FIRST_RANGE, growth: int = GROWTH) -> DataFrame:
    """M3's fallback: ``(a_id, r_seq)`` of the first similar title in report order, for the titles
    that have one."""
    found = None
    for after, upto in _ranges(r, first, growth):
        part = r
        part = part if after is None else part.where(F.col("r_id") > after)
        part = part if upto is None else part.where(F.col("r_id") <= upto)
        hits = materialise(similar_pairs(a, part).groupBy("a_id").agg(F.min("r_id").alias("r_seq")), "first-matches")
        found = hits if found is None else found.unionByName(hits)
        if upto is not None:
            a = materialise(a.join(hits, "a_id", "left_anti"), "unmatched-titles", "a_id")
            if a.isEmpty():
                break
    return found


def fuzzy_matches(rest: DataFrame, report_dedup: DataFrame) -> DataFrame:
    """``(a_id, r_seq)`` of the first similar title of the articles that have one. Articles whose
    prepared titles are equal are matched once, and so are such entries of the report."""
    a, r = _sides(rest, report_dedup, norm_title)
    a = materialise(a.where("a_norm IS NOT NULL"), "titles", "a_id")
    kinds = materialise(a.select("a_norm").distinct().select("a_norm", F.monotonically_increasing_id().alias("kind")), "title-kinds")
    first = first_fuzzy(*word_numbers(kinds.select(F.col("kind").alias("a_id"), "a_norm"), r.groupBy("r_norm").agg(F.min("r_id").alias("r_id"))))
    of_kinds = first.select(F.col("a_id").alias("kind"), "r_seq").join(kinds, "kind").select("a_norm", "r_seq")
    return a.join(of_kinds, "a_norm").groupBy("a_id").agg(F.min("r_seq").alias("r_seq"))


def match_best(articles: DataFrame, report_dedup: DataFrame) -> DataFrame:
    """M3: the exact match if there is one, else the fuzzy hit that comes first in the report.

    Articles with an exact match leave before the fuzzy candidates are made.
    """
    exact = (articles.select("a_id", "a_title")
             .join(report_dedup.select(F.col("title").alias("a_title"), F.col("seq").alias("r_seq")), "a_title")
             .select("a_id", "r_seq", F.lit("exact").alias("how")))
    rest = articles.join(exact.select("a_id"), "a_id", "left_anti")
    fuzzy = fuzzy_matches(rest, report_dedup)
    best = exact.unionByName(fuzzy.withColumn("how", F.lit("fuzzy")))
    return best.join(report_dedup.select(F.col("seq").alias("r_seq"), F.col("title").alias("r_title"), "score"),
                     "r_seq").select("r_seq", "a_id", "how", "r_title", "score")


def unmatched(articles: DataFrame, best: DataFrame) -> DataFrame:
    """Articles that got no sentiment match."""
    return articles.select("a_id", "a_title").join(best.select("a_id"), "a_id", "left_anti")


def sentiment_from_matches(best: DataFrame) -> DataFrame:
    """K2 as the loader does it: each matched article gets a sentiment row from its report
    entry — V4 label and F11 rates on the score read back from the report."""
    from ..functions import sentiment as SF
    s = F.col("score")
    return best.select(F.col("a_id").alias("corpus_id"), SF.label_loaded(s).alias("sentiment"),
                       s.cast("decimal(3,2)").alias("sentiment_score"), *SF.rates(s), "how")
