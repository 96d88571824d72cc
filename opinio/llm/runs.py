"""Periodic runs of words: suffix-tree LCE and Lyndon roots.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping that
period; reported are those of at least ``max(LEAST, 3 q)`` words. Per document, in its task:

1. ``stretches`` keeps what can hold such a run: every ``GRAM`` = 9 words inside it occur again q words
   earlier or later within it (q >= 8: 9 <= q + 1, and the run has 3 q words; q < 8: it has 24),
   so a run lies in a stretch of consecutive positions whose 9 words recur in the stretch. Hashes
   are compared, so equal words are never missed. This bound is exact for every document and only
   spares trees over text in which nothing recurs.
2. ``SuffixTree`` builds Ukkonen's tree of a stretch and of its reversal. One walk of the tree gives the
   Euler tour at its leaves with the shallowest node between neighbours; a sparse table of these
   depths answers the lowest common ancestor of two suffixes, and so their longest common
   extension, in constant time.
3. The walk orders the suffixes; in that order and in the order of the reversed alphabet, the next
   smaller suffix of a position ends the longest Lyndon word that starts there. Each such root
   is extended by both trees in both directions; every run has such a root in one of the orders.

Memory of a task grows with the longest stretch of one document (about 1 KB a word); nothing is
shuffled.

Defined results: null and empty texts have no words and no run; words are split at ASCII white space
only and compared as they are; repeated rows and ids are worked off row by row; an empty table
gives an empty result; other columns are carried by ``find_runs`` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from .common import slices, table

#: Shortest run; words whose recurrence a run implies.
LEAST, GRAM = 24, 9
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _recurring(codes: np.ndarray) -> np.ndarray:
    """Which positions lie in ``GRAM`` consecutive codes that occur twice."""
    grams = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams = grams * _FACTOR + codes[k:len(codes) - GRAM + 1 + k]
    _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
    covered = np.zeros(len(codes) + 1, np.int64)
    twice = np.flatnonzero(times[which] > 1)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + GRAM, -1)
    return np.cumsum(covered[:-1]) > 0


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """The stretches [start, end) that can hold a run, by 64-bit codes of the words."""
    out, todo = [], [(0, len(codes))]
    while todo:
        start, end = todo.pop()
        if end - start < LEAST:
            continue
        inside = np.concatenate([[False], _recurring(codes[start:end]), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        parts = [(start + int(a), start + int(b)) for a, b in zip(edges[::2], edges[1::2])]
        if parts == [(start, end)]:
            out.append((start, end))
        else:
            todo.extend(parts)
    return sorted(out)


class SuffixTree:
    """Ukkonen's suffix tree of word numbers (from 1; an end number 0 is added)."""

    def __init__(self, numbers: list[int]):
        self.text = [*numbers, 0]
        self._build()

    def _build(self) -> None:
        text, n = self.text, len(self.text)
        # an inner node has children; a leaf ends with the text
        first, last, link, children = [0], [0], [0], [{}]
        node, edge, length, pending = 0, 0, 0, 0
        for i, word in enumerate(text):
            pending += 1
            waiting = 0
            while pending:
                if not length:
                    edge = i
                below = children[node]
                child = below.get(text[edge])
                if child is None:
                    below[text[edge]] = len(first)
                    first.append(i), last.append(n), link.append(0), children.append(None)
                    if waiting:
                        link[waiting] = node
                    waiting = node
                else:
                    start = first[child]
                    size = (last[child] if children[child] is not None else i + 1) - start
                    if length >= size:
                        edge, length, node = edge + size, length - size, child
                        continue
                    if text[start + length] == word:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(first)
                    first.append(start), last.append(start + length), link.append(0)
                    children.append({word: split + 1, text[start + length]: child})
                    first.append(i), last.append(n), link.append(0), children.append(None)
                    below[text[edge]] = split
                    first[child] = start + length
                    if waiting:
                        link[waiting] = split
                    waiting = split
                pending -= 1
                if not node and length:
                    length -= 1
                    edge = i - pending + 1
                else:
                    node = link[node]
        self.first, self.last, self.children = first, last, children

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The Euler tour at the leaves: the suffixes in order, and the depth of the shallowest
        node between each and the one before. ``reverse``: by the reversed alphabet, the end
        still first."""
        first, last, children, n = self.first, self.last, self.children, len(self.text)
        suffixes, depths = [], []
        shallowest, stack = 0, [(0, 0)]
        while stack:
            node, depth = stack.pop()          # the depth of the inner node it hangs from
            if depth < shallowest:
                shallowest = depth
            below = children[node]
            if below is None:
                suffixes.append(first[node] - depth)
                depths.append(shallowest)
                shallowest = n
                continue
            depth += last[node] - first[node]
            if reverse:                        # what is pushed last comes first
                down = sorted(below)
                if not down[0]:
                    down.append(down.pop(0))
            else:
                down = sorted(below, reverse=True)
            for word in down:
                stack.append((below[word], depth))
        return np.array(suffixes), np.array(depths)


class Extension:
    """Longest common extension of two suffixes: lowest common ancestors in constant time."""

    def __init__(self, tree: SuffixTree):
        self.order, depths = tree.tour()
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))
        self.tables = [depths.astype(np.int32)]
        while (half := 1 << (len(self.tables) - 1)) * 2 <= len(depths):
            low = self.tables[-1]
            self.tables.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The words that the suffixes ``a`` and ``b`` (elementwise different) share at their start."""
        x, y = self.rank[a], self.rank[b]
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        out, level = np.zeros(len(a), np.int64), np.frexp(hi - lo)[1] - 1
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.tables[k][lo[here]], self.tables[k][hi[here] - (1 << int(k))])
        return out


def _next_smaller(order: np.ndarray) -> np.ndarray:
    """For every suffix the next one to its right that is smaller, by the suffixes in order."""
    n = len(order)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    after, ranks, stack = [n] * n, rank.tolist(), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            after[stack.pop()] = i
        stack.append(i)
    return np.array(after[:-1], np.int64)


def runs_of(numbers: list[int], least: int = LEAST, times: int = 3) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least ``max(least, times * period)`` words; ``times`` >= 2."""
    n = len(numbers)
    if n < least:
        return []
    tree = SuffixTree(numbers)
    forward, backward = Extension(tree), Extension(SuffixTree(numbers[::-1]))
    found = []
    for order in (forward.order, tree.tour(reverse=True)[0]):
        end = _next_smaller(order)              # the Lyndon root [i, end[i])
        i = np.arange(n)
        near = (end - i) * times <= n
        i, end = i[near], end[near]
        right = np.where(end < n, forward(i, np.minimum(end, n)), 0)
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = backward(n - i[inner], n - end[inner])
        period = end - i
        length = end + right - i + left
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([i - left, length, period], axis=1)[long])
    return [tuple(r) for r in np.unique(np.concatenate(found), axis=0).tolist()]


def find(words: list[bytes]) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a document's words, by start, then period."""
    out = []
    if len(words) >= LEAST:
        codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        for start, end in stretches(codes):
            numbers: dict[bytes, int] = {}
            part = [numbers.setdefault(w, len(numbers) + 1) for w in words[start:end]]
            out += [(start + s, length, period) for s, length, period in runs_of(part)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first ``period`` words."""
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    if not runs:
        return words
    return [w for w, d in zip(words, np.cumsum(dropped).tolist()) if not d]


def _text(column: pa.Array) -> pa.Array:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.binary())


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``runs`` (by start, then period) and ``collapsed``."""
    kept = [c for c in docs.columns if c != text_col]
    out = StructType([docs.schema[c] for c in kept] + _parse_datatype_string(
        "runs array<struct<start:long,length:long,period:long>>, collapsed string").fields)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            runs, collapsed = [], []
            for text in _text(part.column(text_col)).to_pylist():
                words = text.split() if text else []
                found = find(words)
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                collapsed.append(b" ".join(collapse(words, found)))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c).cast(arrow.field(c).type) for c in kept], pa.array(runs, arrow.field("runs").type),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], schema=arrow)

    return docs.mapInArrow(run, out)


def _stand_in(doc_id: Column, text: Column) -> Column:
    """The contract's input: one text in ten made periodic from word ``a`` on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    let = lambda value, then: F.transform(F.array(value), then)[0]
    words = F.filter(F.split(text, "[ \\t-\\r]+", -1), lambda w: w != "")

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int")))), " ")

    changed = let(words, lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(text))
    return F.when(h % 10 == 0, changed).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs.withColumn("text", _stand_in(F.col("doc_id"), F.col("text"))))
    # the greatest exact length / period: fractions of whole numbers are compared crosswise
    greatest = F.aggregate(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", greatest.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
