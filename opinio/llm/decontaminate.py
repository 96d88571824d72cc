"""Benchmark decontamination with suffix arrays over the training words.

Tasks read documents in shards of a few MB. A shard's words become numbers (0: a word that
no benchmark item has, also put between documents, so no match crosses either) and a suffix
array orders the shard's word positions by the ``window`` words that follow them. Every test
suffix, cut to the window, is found by two binary searches; its range in the array lists all
places where it occurs. Matches of neighbouring suffixes on one diagonal join to the longest
verbatim match. Positions whose first two words are no word pair of any item cannot start a
match and are left out of the array; nothing else is.

The benchmark is read in blocks of a bounded size, so a task holds one block whatever its
size. Defined results: null or empty texts have no words, no matches and stay; an item
without words has no window; an item with fewer words than the window is one window; a null
item id contaminates but is not listed; repeated rows each get their own result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialise, slices, utf8, words

WINDOW = 10
#: Bytes of document text in a shard, and of benchmark text in a block.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20

SCHEMA = ("n_words long, ranges array<struct<start:long,end:long>>, items array<string>, "
          "matches array<struct<item:string,item_start:long,start:long,words:long>>")


class TestSuffixes:
    """The windows of a block of benchmark items, as sorted keys to search a suffix array with."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], int] = {}
        self.owners: list[list[tuple[str | None, int]]] = []
        pairs: set[tuple[int, int]] = set()
        single: set[int] = set()
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            size = min(window, len(ids))
            if size == 1:
                single.add(ids[0])
            pairs.update(zip(ids, ids[1:]))
            for i in range(len(ids) - size + 1 if size else 0):
                k = found.setdefault(tuple(ids[i:i + size]), len(found))
                if k == len(self.owners):
                    self.owners.append([])
                self.owners[k].append((item, i))
        self.base = len(self.number) + 1
        self.kind = np.dtype(">u2" if self.base < 0xFFFF else ">u4")
        self.sizes = np.array([len(k) for k in found], dtype=np.int64)
        low = np.zeros((len(found), window), dtype=self.kind)
        high = np.full((len(found), window), np.iinfo(self.kind).max, dtype=self.kind)
        for row, k in enumerate(found):
            low[row, :len(k)] = high[row, :len(k)] = k
        self.low, self.high = self.as_keys(low), self.as_keys(high)
        self.pairs = np.array(sorted(a * self.base + b for a, b in pairs) or [-1], dtype=np.int64)
        self.single = np.array(sorted(single), dtype=np.int64)

    def as_keys(self, rows: np.ndarray) -> np.ndarray:
        """Rows of word numbers as byte strings that sort in the same order."""
        return np.ascontiguousarray(rows).view(f"S{self.window * self.kind.itemsize}").ravel()

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """The positions where a match can begin."""
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        key = ids[at] * self.base + ids[at + 1]
        k = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        at = at[self.pairs[k] == key]
        return np.union1d(at, np.flatnonzero(np.isin(ids, self.single))) if len(self.single) else at

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in a shard that ends with ``window`` zeros."""
        at = self.starts(ids)
        if not len(at) or not len(self.low):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = self.as_keys(ids[at[:, None] + np.arange(self.window)].astype(self.kind))
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        which = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return which, at[place]

    def search(self, texts: list[bytes | None]) -> list[tuple[int, list, list, list]]:
        """For each text: words, hit ranges, items, longest matches."""
        get, numbers, ends = self.number.get, [], []
        for text in texts:
            numbers.extend(get(w, 0) for w in words(text))
            ends.append(len(numbers))
            numbers.append(0)
        ids = np.array(numbers + [0] * self.window, dtype=np.int64)
        which, at = self.occurrences(ids)
        ends = np.array(ends, dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        out = [(int(e - b), [], [], []) for b, e in zip(begins, ends)]
        doc = np.searchsorted(ends, at, "right")
        order = np.argsort(doc, kind="stable")
        cuts = np.flatnonzero(np.diff(doc[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            k = int(doc[group[0]])
            local = at[group] - begins[k]
            out[k] = (out[k][0], *self._of_document(out[k][0], which[group], local))
        return out

    def _of_document(self, n: int, which: np.ndarray, at: np.ndarray) -> tuple[list, list, list]:
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.sizes[which], -1)
        hit = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8)
        step = np.diff(hit)
        ranges = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]
        lines: dict[tuple, set[tuple[int, int]]] = defaultdict(set)
        for k, p in zip(which.tolist(), at.tolist()):
            for item, i in self.owners[k]:
                lines[item, p - i].add((i, int(self.sizes[k])))
        matches = []
        for (item, shift), found in lines.items():
            run = sorted(found)
            begin, last = run[0][0], run[0]
            for nxt in [*run[1:], (None, 0)]:
                if nxt[0] is None or nxt[0] != last[0] + 1:
                    matches.append({"item": item, "item_start": begin, "start": begin + shift, "words": last[0] + last[1] - begin})
                    begin = nxt[0]
                last = nxt
        items = sorted({item for item, _ in lines if item is not None})
        return ranges, items, sorted(matches, key=lambda m: (m["start"], m["item"] or "", m["item_start"]))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The benchmark's items, a bounded block at a time."""
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), utf8(text_col).alias("text"))
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in b.where(part == k).collect()]


def _shards(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows with their texts, in shards of about SHARD_BYTES."""
    held, size = [], 0
    for part in slices(batches, 256):
        held.append(part)
        size += part.column(text_col).nbytes
        if size >= SHARD_BYTES:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield whole, whole.column(text_col).to_pylist()
            held, size = [], 0
    if held and (whole := pa.Table.from_batches(held).combine_chunks().to_batches()):
        yield whole[0], whole[0].column(text_col).to_pylist()


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: ``id_col``, words, hit word ranges, item ids, longest verbatim matches."""
    d = docs.select(F.col(id_col), utf8(text_col).alias("_text"))
    kind = _parse_datatype_string(f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {SCHEMA}")
    arrow = to_arrow_schema(kind)
    blocks = list(_block_frames(d, benchmark, id_col, item_col, item_text_col, window, kind, arrow))
    if len(blocks) == 1:
        return blocks[0].drop("_row")
    every = blocks[0]
    for more in blocks[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("_row").agg(
        F.first(id_col).alias(id_col), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("ranges")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
    gap = F.aggregate(
        F.array_sort("ranges"), F.array().cast("array<struct<start:long,end:long>>"),
        lambda acc, r: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= r["start"]),
                              F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(r))))
    return merged.withColumn("ranges", gap).drop("_row")


def _block_frames(d, benchmark, id_col, item_col, item_text_col, window, kind, arrow) -> Iterator[DataFrame]:
    loaded = [TestSuffixes(items, window) for items in _blocks(benchmark, item_col, item_text_col)]
    many = len(loaded) > 1
    if many:  # rows of all passes must meet again
        d = materialise(d.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    out = _parse_datatype_string("_row long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind))
    out_arrow = to_arrow_schema(out)
    for suffixes in loaded:
        def run(batches, suffixes=suffixes):
            for rows, texts in _shards(batches, "_text"):
                found = suffixes.search(texts)
                yield pa.RecordBatch.from_pydict({
                    "_row": rows.column("_row") if many else [0] * rows.num_rows, id_col: rows.column(id_col),
                    "n_words": [f[0] for f in found], "ranges": [f[1] for f in found],
                    "items": [f[2] for f in found], "matches": [f[3] for f in found]}, schema=out_arrow)
        yield d.mapInArrow(run, out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents (all their columns) in which no window of the benchmark occurs."""
    for items in _blocks(benchmark, item_col, item_text_col):
        suffixes = TestSuffixes(items, window)

        def run(batches, suffixes=suffixes):
            for rows, texts in _shards(batches, text_col):
                found = suffixes.search([t.encode("utf-8", "surrogatepass") if t is not None else None for t in texts])
                kept = rows.filter(pa.array([not f[1] for f in found], pa.bool_()))
                if kept.num_rows:
                    yield kept
        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


#: Words by the contract's pattern; windows of each length that an item has; every word of a
#: document inside an occurrence of a window counts once.
OP4_ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS g FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM d, lens WHERE len(w) >= n),
occ AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(hits.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(hits.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
