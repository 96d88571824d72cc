"""Ranked lexical search: best-first intervals of documents under range-maximum bounds.

1. Tasks cut their documents into shards of bounded size, number a shard's documents by
   ascending id and write one row per shard: its terms, their posting lists (document number,
   occurrences) and the documents' ids and lengths. This index holds every term of every text.
2. Document frequencies, the number of documents and of terms are sums over the shards. Items with
   the same terms are one query; queries are worked off in blocks of bounded size, one after the
   other, and only the block at hand passes through the driver.
3. In a shard, the impacts of every posting list that a query uses get a sparse table of the
   positions of range maxima. A query starts with the interval of all documents of the shard, bounded
   by the sum of its terms' weighted range maxima. The intervals of the highest bounds are split
   at the document of their greatest single impact: that document is scored exactly, the two
   remaining intervals get their own bounds and stay only if they can still enter the top k (an
   interval whose bound equals the k-th score stays while its first document id is smaller).
   Top lists are carried from shard to shard within a task, then ranked per query by Spark.

Scores are whole numbers: weight * (10^9 tf div (1000 tf + 20 m)), see ``impacts``.

Defined results: null and empty texts hold no term, are not counted and are never found; each row
is a document, also repeated ones, which tie and are listed next to each other; a null id comes
last among equal scores; rows of one item id are one item with the terms of all of them; an item
without terms, or whose terms occur nowhere, has no rows; empty tables give an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import map_batches, materialise, slices, small, table, utf8, words

K = 50
#: Most documents and words of a shard (one longer text is a shard of its own).
SHARD_DOCS, SHARD_WORDS = 16_384, 2_000_000
#: Most bytes of query terms in a block; intervals split at a time; cells (terms by documents) of
#: a search's posting counts: the documents of a shard are searched in ranges of that size.
BLOCK_BYTES, FRONT, CELLS = 8 << 20, 192, 1 << 22
#: A null id in comparisons: after every other.
NO_ID = np.iinfo(np.int64).max

INDEX = ("n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<binary>, "
         "held array<int>, docs binary, occurrences binary")


class _Shard:
    """Documents gathered until their postings are written."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)
        self.docs, self.words = [], 0

    def add(self, doc_id: int | None, text: list[bytes]) -> None:
        self.docs.append((doc_id, np.fromiter(map(self.numbers.__getitem__, text), np.int32, len(text))))
        self.words += len(text)

    def full(self) -> bool:
        return len(self.docs) >= SHARD_DOCS or self.words >= SHARD_WORDS

    def row(self) -> dict[str, list]:
        docs = sorted(self.docs, key=lambda d: (d[0] is None, d[0] or 0))
        sizes = np.array([len(d[1]) for d in docs], np.int64)
        keys = np.concatenate([d[1] for d in docs]).astype(np.int64) * len(docs) + np.repeat(np.arange(len(docs)), sizes)
        postings, occurrences = np.unique(keys, return_counts=True)
        held = np.bincount(postings // len(docs), minlength=len(self.numbers))
        return {"n_docs": [len(docs)], "n_terms": [int(sizes.sum())],
                "ids": [[d[0] for d in docs]], "lengths": [sizes], "terms": [list(self.numbers)], "held": [held.astype(np.int32)],
                "docs": [(postings % len(docs)).astype(np.int32).tobytes()], "occurrences": [occurrences.astype(np.int32).tobytes()]}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard of documents; postings lie in the order of ``terms``, ``held`` for each."""
    kind = _parse_datatype_string(INDEX)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                held = words(text.as_py())
                if held:
                    shard.add(doc_id, held)
                    if shard.full():
                        yield pa.RecordBatch.from_pydict(shard.row(), schema=arrow)
                        shard = _Shard()
        if shard.docs:
            yield pa.RecordBatch.from_pydict(shard.row(), schema=arrow)

    return docs.select(F.col(id_col).cast("long").alias("_id"), utf8(text_col).alias("_text")).mapInArrow(run, kind)


def query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(_item, term)``: the distinct terms of each item."""
    split = map_batches(items.select(F.col(item_col).alias("_item"), utf8(text_col).alias("_text")),
                        lambda b: {"_item": b.column(0), "terms": [list(set(words(t))) for t in b.column(1).to_pylist()]},
                        f"_item {items.schema[item_col].dataType.simpleString()}, terms array<binary>")
    return split.select("_item", F.explode("terms").alias("term")).distinct()


def weigh(index: DataFrame, terms: DataFrame) -> tuple[DataFrame, int, int]:
    """(queries with ``terms`` and ``weights``, number of documents, number of their terms)."""
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    wanted = small(terms.select(F.col("term").alias("terms")).distinct(), "terms")
    held = (index.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).select("t.terms", F.col("t.held").cast("long").alias("n"))
            .join(wanted, "terms", "left_semi")
            .groupBy("terms").agg(F.sum("n").alias("df")))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    found = terms.join(held.select(F.col("terms").alias("term"), weight.alias("weight")), "term")
    queries = found.groupBy("_item").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    return queries, n_docs, n_terms


def impacts(occurrences: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) with m = 100 - 50 + (50 n N) div L of the posting's document."""
    m = 50 + (50 * lengths * n_docs) // n_terms
    tf = occurrences.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Postings:
    """The posting lists of some terms in a shard with their range-maximum tables."""

    def __init__(self, row: dict, wanted: pa.Array, n_docs: int, n_terms: int):
        self.ids = row["ids"].values.fill_null(NO_ID).to_numpy()
        self.size = len(self.ids)
        lengths = row["lengths"].values.to_numpy()
        ends = np.cumsum(row["held"].values.to_numpy(), dtype=np.int64)
        at = pc.index_in(wanted, value_set=row["terms"].values)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.where(known, np.concatenate([[0], ends])[place], 0)
        held = np.where(known, ends[place] - first, 0)
        self.start = np.concatenate([[0], np.cumsum(held)])       # list t: [start[t], start[t + 1])
        pick = np.repeat(first - self.start[:-1], held) + np.arange(self.start[-1])
        self.docs = np.frombuffer(row["docs"].as_py(), np.int32)[pick]
        self.keys = np.repeat(np.arange(len(held)), held) * self.size + self.docs
        self.impact = impacts(np.frombuffer(row["occurrences"].as_py(), np.int32)[pick], lengths[self.docs], n_docs, n_terms)
        # tables[k][i]: the position of the greatest impact in [i, i + 2^k), within one list
        self.tables = [np.arange(len(pick), dtype=np.int32)]
        for k in range(1, int(held.max(initial=1)).bit_length()):
            left, half = self.tables[-1], 1 << (k - 1)
            right = np.concatenate([left[half:], left[len(left) - min(half, len(left)):]])[:len(left)]
            self.tables.append(np.where(self.impact[right] > self.impact[left], right, left))
        self.flat = np.concatenate(self.tables) if len(pick) else np.zeros(0, np.int32)

    def best(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Positions of the greatest impacts of the ranges [lo, hi), which are not empty."""
        k = np.frexp(hi - lo)[1].astype(np.int64) - 1
        base = k * len(self.docs)
        a, b = self.flat[base + lo], self.flat[base + hi - (1 << k)]
        return np.where(self.impact[b] > self.impact[a], b, a)


class Top:
    """The best ``k`` (score, id) so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]

    def admits(self, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a document of at most this score and at least this id can enter."""
        if len(self.score) < self.k:
            return bound > 0
        last, last_id = self.score[-1], self.ids[-1]
        return (bound > last) | ((bound == last) & (least_id < last_id) & (bound > 0))


def search(p: Postings, lists: np.ndarray, weights: np.ndarray, top: Top) -> None:
    """Best-first search of one query (its lists in ``p`` and their weights) over a shard."""
    some = p.start[lists + 1] > p.start[lists]
    lists, weights = lists[some], weights[some]
    if len(lists):
        step = max(1, CELLS // len(lists))
        for first in range(0, p.size, step):
            _search_range(p, lists, weights, top, first, min(step, p.size - first))


def _search_range(p: Postings, lists: np.ndarray, weights: np.ndarray, top: Top, first: int, n: int) -> None:
    """``search`` over the documents [first, first + n)."""
    begin = np.searchsorted(p.keys, lists * p.size + first)
    held = np.searchsorted(p.keys, lists * p.size + first + n) - begin
    at = np.repeat(begin - np.concatenate([[0], np.cumsum(held)[:-1]]), held) + np.arange(held.sum())
    ids = p.ids[first:first + n]
    # before[t, d]: the position in ``p`` of the first posting of list t at document first + d or later
    before = np.zeros((len(lists), n + 1), np.int32)
    before[np.repeat(np.arange(len(lists)), held), p.docs[at] - first + 1] = 1
    before = np.cumsum(before, axis=1, dtype=np.int32) + begin[:, None].astype(np.int32)

    def bounded(lo: np.ndarray, hi: np.ndarray):
        """(bound, split document) of the intervals [lo, hi) of documents."""
        a, b = before[:, lo], before[:, hi]
        full = b > a
        at = np.zeros(a.shape, np.int64)
        at[full] = p.best(a[full], b[full])
        value = np.where(full, p.impact[at] * weights[:, None], 0)
        return value.sum(axis=0), p.docs[at[np.argmax(value, axis=0), np.arange(len(lo))]] - first

    lo, hi = np.zeros(1, np.int64), np.full(1, n, np.int64)
    bound, split = bounded(lo, hi)
    while True:
        stay = top.admits(bound, ids[lo])
        lo, hi, bound, split = lo[stay], hi[stay], bound[stay], split[stay]
        if not len(lo):
            return
        if len(lo) > FRONT:
            order = np.argpartition(-bound, FRONT)
            now, later = order[:FRONT], order[FRONT:]
        else:
            now, later = np.arange(len(lo)), np.zeros(0, np.int64)
        d = split[now].astype(np.int64)
        at = before[:, d]
        score = (np.where(before[:, d + 1] > at, p.impact[np.minimum(at, len(p.impact) - 1)], 0) * weights[:, None]).sum(axis=0)
        found = score > 0
        top.add(score[found], ids[d[found]])
        new_lo, new_hi = np.concatenate([lo[now], d + 1]), np.concatenate([d, hi[now]])
        open_ = new_hi > new_lo
        new_lo, new_hi = new_lo[open_], new_hi[open_]
        if len(new_lo):
            new_bound, new_split = bounded(new_lo, new_hi)
            stay = top.admits(new_bound, ids[new_lo])
            new_lo, new_hi, new_bound, new_split = new_lo[stay], new_hi[stay], new_bound[stay], new_split[stay]
        else:
            new_bound, new_split = np.zeros(0, np.int64), np.zeros(0, np.int32)
        lo, hi = np.concatenate([lo[later], new_lo]), np.concatenate([hi[later], new_hi])
        bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


def search_block(index: DataFrame, block: list[tuple[int, list]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``(_query, doc_id, score)``: the best of each query (number, (term, weight) pairs) per task."""
    numbers: dict[bytes, int] = {}
    queries = [(q, np.array([numbers.setdefault(bytes(t), len(numbers)) for t, _ in terms], np.int64),
                np.array([w for _, w in terms], np.int64)) for q, terms in block]
    wanted = pa.array(list(numbers), pa.binary())
    kind = _parse_datatype_string("_query long, doc_id long, score long")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in queries]
        for part in slices(batches, 1):
            p = Postings({n: part.column(n)[0] for n in part.schema.names}, wanted, n_docs, n_terms)
            for (_, lists, weights), top in zip(queries, tops):
                search(p, lists, weights, top)
        for (q, _, _), top in zip(queries, tops):
            if len(top.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(top.score), q, np.int64)), pa.array(top.ids, mask=top.ids == NO_ID), pa.array(top.score)], schema=arrow)

    return index.select("ids", "lengths", "terms", "held", "docs", "occurrences").mapInArrow(run, kind)


def rank(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``(item_col, rank, doc_id, score)``: the ``k`` best documents of the index for each item."""
    spark = index.sparkSession
    found, n_docs, n_terms = weigh(index, query_terms(items, item_col, text_col))
    found = materialise(found.select("_item", "terms", F.xxhash64("terms").alias("_key")), "search-items")
    distinct = found.groupBy("_key", "terms").agg(F.min(F.lit(0)).alias("_")).drop("_")
    size = distinct.agg(F.coalesce(F.sum(F.expr("aggregate(terms, 0L, (a, t) -> a + octet_length(t.term) + 16)")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    distinct = materialise(distinct.withColumn("_block", F.pmod(F.xxhash64(F.lit(7), "terms"), F.lit(blocks))), "search-queries")
    best = None
    for b in range(blocks):
        # the block at hand only: its queries are numbered here, by their place
        block = [(i, [(t["term"], t["weight"]) for t in r["terms"]], r["_key"]) for i, r in enumerate(
            distinct.where(F.col("_block") == b).select("_key", "terms").collect())]
        if not block:
            continue
        hits = search_block(index, [(i, terms) for i, terms, _ in block], n_docs, n_terms, k)
        order = Window.partitionBy("_query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = distinct.where(F.col("_block") == b)
        keys = spark.createDataFrame([(i, key) for i, _, key in block], "_query long, _key long")
        hits = hits.join(keys, "_query").join(names.select("_key", "terms"), "_key").drop("_query")
        hits = materialise(hits, "search-block") if blocks > 1 else hits
        best = hits if best is None else best.unionByName(hits)
    if best is None:
        return spark.createDataFrame([], f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, rank int, doc_id long, score long")
    return (found.join(best, ["_key", "terms"])
            .select(F.col("_item").alias(item_col), "rank", "doc_id", "score"))


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    index = materialise(build_index(table(spark, sf_dir, "documents")), "search-index")
    return rank(index, table(spark, sf_dir, "benchmark")).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: Every document scored for every item.
OP13_ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
x AS (SELECT r, doc_id, term, len(any_value(w)) AS n, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM b) GROUP BY r, doc_id, term),
f AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(big_n) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS weight FROM x, s GROUP BY term),
p AS (SELECT b.item_id, x.r, x.doc_id, CAST(sum(f.weight * ((1000000000 * x.tf) // (1000 * x.tf + 20 * (50 + (50 * x.n * s.big_n) // s.big_l)))) AS BIGINT) AS score
      FROM b JOIN x USING (term) JOIN f USING (term), s GROUP BY b.item_id, x.r, x.doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
