"""Embedding near-duplicates by spherical-cap filters of a structured random product code.

1. Vectors are scaled to length 1 in double precision; equal vectors form one entry with a
   count. A random rotation splits a vector into ``PARTS`` blocks, each with a code of random
   unit words; a filter is one word per block, and a vector is in the filter's cap when its
   inner product with it reaches ``alpha``. List decoding enumerates exactly those filters:
   sums of two blocks are sorted, and for each sum of the first half the second half's prefix
   that still reaches alpha is read off.
2. The number of words per block grows with the number of entries, so a filter keeps a few
   entries on average; alpha is the largest that reaches the target recall at the threshold,
   measured on simulated pairs of exactly that cosine with the same code.
3. Entries join on filters. Filters with one entry go; a filter with many entries is dealt into
   blocks of ``BLOCK`` and every pair of blocks is a unit of work. A pair whose
   double-precision cosine reaches the threshold counts in the least filter that both share
   (linked vectors are decoded again for that). A unit returns counts and a spanning forest of
   its links, never the pairs.
4. Components of the links are found on Spark.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing and are their own component; vectors of different lengths don't link; repeated
rows are copies of each other; the component id is the least vec_id reachable (null ids count
as largest). Recall on pairs at the threshold is ``RECALL`` by construction and rises with the
cosine; tests compare with brute force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, table
from .components import Forest, components

THRESHOLD, RECALL = 0.9, 0.96
#: Blocks of the code (two keep the filters close to independent) and filters per entry.
PARTS, FILTERS, SEED = 2, 128, 20240611
#: Entries of a filter in a block; simulated pairs.
BLOCK, PAIRS = 512, 600


class Caps:
    """Filters for vectors of one dimension."""

    def __init__(self, dim: int, entries: int, threshold: float = THRESHOLD, recall: float = RECALL):
        words = max(8, int(np.ceil((float(FILTERS) * max(entries, 1)) ** (1 / min(PARTS, dim)))))
        rng = self._draw(dim, words)
        a = rng.normal(size=(PAIRS, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=(PAIRS, dim))
        b -= (a * b).sum(1, keepdims=True) * a
        norm = np.linalg.norm(b, axis=1, keepdims=True)
        b = threshold * a + np.sqrt(1 - threshold ** 2) * np.divide(b, norm, out=np.zeros_like(b), where=norm > 0)
        self.alpha = self._fit(a, b, recall)

    def _draw(self, dim: int, words: int) -> np.random.Generator:
        """The rotation and the code; they depend on the seed, the dimension and the words only."""
        self.dim, self.words, self.parts = dim, words, min(PARTS, dim)
        rng = np.random.default_rng(SEED + dim)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), self.parts)
        self.code = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in (rng.normal(size=(words, len(k))) for k in self.cuts)]
        return rng

    def __getstate__(self) -> tuple[int, int, float]:
        return self.dim, self.words, self.alpha  # the code grows with the data: tasks draw it again

    def __setstate__(self, state: tuple[int, int, float]) -> None:
        self._draw(*state[:2])
        self.alpha = state[2]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of one vector with all words of each half of the code."""
        x = self.turn @ x
        part = [c @ x[k] / np.sqrt(self.parts) for c, k in zip(self.code, self.cuts)]
        half = (len(part) + 1) // 2

        def combine(vs):
            out = np.zeros(1)
            for v in vs:
                out = (out[:, None] + v[None, :]).ravel()
            return out
        return combine(part[:half]), combine(part[half:])

    def _fit(self, a: np.ndarray, b: np.ndarray, recall: float) -> float:
        """Largest alpha at which the share ``recall`` of the pairs has a common filter."""
        best = []
        for x, y in zip(a, b):
            x1, x2 = self.halves(x)
            y1, y2 = self.halves(y)
            # the best common filter of a pair: the largest min(<x,c>, <y,c>), over good first halves
            top = np.argsort(-(x1 + y1))[:200]
            end = np.argsort(-(x2 + y2))[:200]
            best.append(np.minimum(x1[top][:, None] + x2[end][None, :], y1[top][:, None] + y2[end][None, :]).max())
        return float(np.quantile(best, 1 - recall))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The numbers of all filters whose cap holds ``x``, sorted."""
        first, second = self.halves(x)
        order = np.argsort(-second)
        at = np.flatnonzero(first + second[order[0]] >= self.alpha)
        reach = np.searchsorted(-second[order], first[at] - self.alpha, "right")
        which = np.repeat(at, reach)
        rank = np.arange(len(which)) - np.repeat(np.cumsum(reach) - reach, reach)
        return np.sort(which.astype(np.int64) * len(second) + order[rank])


def unit_vector(values: list | None) -> np.ndarray | None:
    """The vector at length 1; None if it cannot link."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x /= np.abs(x).max()  # against overflow and underflow of the squares
    return x / np.sqrt((x * x).sum())


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, as ``unit_vector`` scales them."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def verify_unit(x: np.ndarray, rows: np.ndarray, copies: np.ndarray, own: np.ndarray, split: bool,
                mine: int, caps: Caps, threshold: float) -> list[tuple[int, int, int]]:
    """(entry, linked copies found here, a node it reaches through links found here)."""
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    if split:  # pairs inside one block belong to the block's own unit
        linked &= own[:, None] != own[None, :]
    some = np.flatnonzero(linked.any(1))
    if not len(some):
        return []
    linked, rows, copies = linked[np.ix_(some, some)], rows[some], copies[some]
    # a pair counts in its least common filter: drop pairs that share a smaller one
    smaller = [f[f < mine] for f in map(caps.decode, x[some])]
    names, number = np.unique(np.concatenate(smaller), return_inverse=True)
    member = np.zeros((len(some), max(1, len(names))), dtype=np.float32)
    member[np.repeat(np.arange(len(some)), [len(f) for f in smaller]), number] = 1
    linked &= member @ member.T == 0
    counts, forest = linked @ copies, Forest()
    for i in np.flatnonzero(counts):
        for j in np.flatnonzero(linked[i, :i]):
            forest.join(int(rows[i]), int(rows[j]))
    return [(int(rows[i]), int(counts[i]), forest.root(int(rows[i]))) for i in np.flatnonzero(counts)]


def verify_units(units: pa.Table, caps: dict[int, Caps], threshold: float) -> list[tuple[int, int, int]]:
    """All whole units of a sorted table. Small units are first tested together for any link."""
    found: list[tuple[int, int, int]] = []
    col = {c: units.column(c).to_numpy() for c in ("_dim", "_filter", "_first", "_second", "_row", "_own", "_copies")}
    flat = units.column("_vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(col["_dim"])])
    for d in np.unique(col["_dim"]):
        at = np.flatnonzero(col["_dim"] == d)
        x = unit_rows(flat[starts[at[0]]:starts[at[-1] + 1]].reshape(len(at), d))
        k = {c: v[at] for c, v in col.items()}
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(k["_filter"]) != 0) | (np.diff(k["_first"]) != 0) | (np.diff(k["_second"]) != 0)
        unit = np.cumsum(new) - 1
        size = np.bincount(unit)
        promising = size > 8
        for shift in range(1, 8):
            i = np.flatnonzero(unit[:-shift] == unit[shift:])
            i = i[size[unit[i]] <= 8]
            near = np.einsum("ij,ij->i", x[i], x[i + shift]) >= threshold - 1e-9
            promising[unit[i[near]]] = True
        begin = np.flatnonzero(new)
        for u in np.flatnonzero(promising):
            w = slice(begin[u], begin[u] + size[u])
            found += verify_unit(x[w], k["_row"][w], k["_copies"][w], k["_own"][w], k["_first"][w.start] != k["_second"][w.start],
                                 int(k["_filter"][w.start]), caps[int(d)], threshold)
    return found


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    held = materialise(vectors.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"),
                                      F.col(vector_col).alias("_vector")), "vectors")
    fine = (F.col("_vector").isNotNull() & (F.size("_vector") > 0)
            & F.forall("_vector", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
            & F.exists("_vector", lambda v: v != 0))
    # adding 0.0 makes -0.0 and 0.0 one value
    digest = F.md5(F.concat_ws(",", F.transform("_vector", lambda v: (v.cast("double") + F.lit(0.0)).cast("string"))).cast("binary"))
    keyed = held.withColumn("_key", F.when(F.coalesce(fine, F.lit(False)), digest))
    entries = materialise(keyed.where("_key IS NOT NULL").groupBy("_key").agg(
        F.min("_row").alias("_row"), F.min("_id").alias("_least"), F.count("*").alias("_copies"),
        F.min_by("_vector", "_row").alias("_vector")), "entries")
    counts = {r["d"]: r["n"] for r in entries.groupBy(F.size("_vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    caps = {d: Caps(d, n, threshold, recall) for d, n in counts.items()}

    def of(b):
        xs = [unit_vector(v) for v in b.column("_vector").to_pylist()]
        return {"_row": b.column("_row"), "_dim": [len(x) for x in xs], "_filters": [caps[len(x)].decode(x).tolist() for x in xs]}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = entries.select("_row", "_vector").repartition(parts, "_row")
    placed = materialise(map_batches(spread, of, "_row long, _dim int, _filters array<long>")
                         .select("_row", "_dim", F.explode("_filters").alias("_filter")), "filters")
    sizes = (placed.groupBy("_dim", "_filter").agg(F.count("*").alias("n")).where("n > 1")
             .select("_dim", "_filter", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("_blocks")))
    units = (placed.join(sizes, ["_dim", "_filter"])
             .withColumn("_own", F.pmod(F.xxhash64("_row"), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .withColumn("_first", F.least("_own", "_other")).withColumn("_second", F.greatest("_own", "_other"))
             .drop("_blocks", "_other")
             .join(entries.select("_row", "_copies", "_vector"), "_row"))
    key = ["_dim", "_filter", "_first", "_second"]
    arrow = pa.schema([("entry", pa.int64()), ("links", pa.int64()), ("near", pa.int64())])

    def run(batches):
        held = None  # the rows of the last unit so far, which may go on in the next batch
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            last = {c: t.column(c)[-1].as_py() for c in key}
            same = np.ones(t.num_rows, dtype=bool)
            for c in key:
                same &= t.column(c).to_numpy() == last[c]
            cut = int(np.argmax(same))
            held = t.slice(cut)
            if cut and (found := verify_units(t.slice(0, cut), caps, threshold)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=arrow)
        if held is not None and (found := verify_units(held, caps, threshold)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=arrow)
    verified = materialise(units.repartition(parts, *key).sortWithinPartitions(*key)
                           .mapInArrow(run, "entry long, links long, near long"), "verified")
    classes = components(verified.where("entry <> near").select(F.col("entry").alias("a"), F.col("near").alias("b")))
    links = verified.groupBy("entry").agg(F.sum("links").alias("_links"))
    known = (entries.select("_key", "_row", "_least", "_copies").join(links, F.col("_row") == F.col("entry"), "left")
             .join(classes, F.col("_row") == F.col("node"), "left").withColumn("component", F.coalesce("component", "_row")))
    heads = known.groupBy("component").agg(F.min("_least").alias("_head"))
    known = known.join(heads, "component").select("_key", "_head", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_links"))
    out = keyed.select("_id", "_key").join(known, "_key", "left")
    head = F.when(F.col("_key").isNull(), F.col("_id")).otherwise(F.col("_head"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                      head.alias("component_id"), F.col("_id").eqNullSafe(head).alias("kept"))


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: Exact links in double precision; components by repeated spreading of the least id.
OP10_ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id WHERE r.c < l.b),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, m.component_id, m.vec_id = m.component_id AS kept FROM m LEFT JOIN k USING (vec_id)
"""
