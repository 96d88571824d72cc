"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

1. One pass gives every text its set of hashed word n-grams, a digest of that set and the
   hashes of its bands. Texts with the same set form one entry with a count, so exact copies
   cost one row from here on. Bands and rows are the cheapest pair that reaches the target
   recall at the similarity threshold.
2. Entries are shuffled on band hashes; every band bucket with at least two entries links its
   members to its least one, and connected components of these links are the candidate
   clusters. Any pair that shares a band is inside one cluster.
3. The n-gram sets of clustered entries meet by cluster. A cluster is dealt at random into
   blocks of ``BLOCK`` entries and every pair of blocks is a unit of work, so no task holds
   more than two blocks. All pairs of a unit are verified by exact set sizes (products of 0/1
   incidence matrices, a bounded number of columns at a time), whether or not they share a band:
   every pair of a cluster meets in exactly one unit. A unit returns
   counts per entry and a spanning forest of its links, never the pairs.
4. Components of the verified links are the classes.

A cluster whose entries all differ still takes the verification of all its pairs: the number
of links of each document, which the result states, is that large.

Defined results: null and empty texts (no words) have no n-grams, link with nothing and are
each a class of their own; a text with fewer words than n is one n-gram; repeated rows are
copies of each other; the class id is the least document id of the class (null if all are).
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, table, words
from .components import Forest, components

N, SIMILARITY, RECALL = 5, (4, 5), 0.9995
#: Entries in a block of a cluster; columns of an incidence matrix at a time.
BLOCK, COLUMNS = 512, 4096
SEED = 20240607


def bands_for(similarity: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach ``recall`` within ``most`` hashes."""
    best = None
    for rows in range(1, 17):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach this recall")
    return best


class _Numbers(dict):
    """64-bit numbers of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        n = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(found: list[bytes], n: int, numbers: dict) -> np.ndarray:
    """The set of n-grams of a word list as sorted 64-bit hashes."""
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(numbers.__getitem__, found), np.uint64, len(found))
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = _mix(h + w[k:len(w) - size + 1 + k])
    return np.unique(h)


def band_hashes(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature."""
    least = None
    for at in range(0, len(grams), 2048):
        part = ((grams[None, at:at + 2048] * factors[:, :1] + factors[:, 1:]) >> np.uint64(24)).min(1)
        least = part if least is None else np.minimum(least, part)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    sig = least.reshape(bands, rows)
    for k in range(rows):
        h = _mix(h + sig[:, k])
    return h


def _factors(bands: int, rows: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    f = rng.integers(0, 2 ** 63, size=(bands * rows, 2), dtype=np.uint64)
    f[:, 0] |= np.uint64(1)
    return f


def hold(docs: DataFrame) -> DataFrame:
    """The documents as ``_doc`` (a struct of all columns) with a number ``_row`` each, written once."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_doc")), "documents")


def sketch(held: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """``_row``, ``_id``, ``_key`` (digest of the n-gram set; null: no words) and ``_bands``."""
    factors = _factors(bands, rows)
    numbers = _Numbers()

    def of(b):
        keys, hashes = [], []
        for t in b.column("_text").to_pylist():
            grams = ngrams(words(t), n, numbers)
            keys.append(hashlib.md5(grams.tobytes()).digest() if len(grams) else None)
            hashes.append(band_hashes(grams, bands, rows, factors).view(np.int64).tolist() if len(grams) else None)
        return {"_row": b.column("_row"), "_id": b.column("_id"), "_key": keys, "_bands": hashes}
    d = held.select("_row", F.col("_doc")[id_col].cast("long").alias("_id"), F.col("_doc")[text_col].cast("string").cast("binary").alias("_text"))
    return materialise(map_batches(d, of, "_row long, _id long, _key binary, _bands array<long>"), "sketch")


def clusters(entries: DataFrame) -> DataFrame:
    """``node`` (an entry) and ``component``: entries that band buckets connect."""
    placed = entries.select("_row", F.explode("_bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("_row").alias("least"), F.max("_row").alias("most")).where("least < most").drop("most")
    return components(placed.join(shared, "bucket").select(F.col("_row").alias("a"), F.col("least").alias("b")))


def overlaps(sets: list[np.ndarray], columns: int = COLUMNS) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    size = np.zeros((len(sets), len(sets)), dtype=np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[gram] > 1
    number = np.cumsum(often > 1) - 1
    owner, gram = owner[shared], number[gram[shared]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    for at in range(0, int(gram[-1]) + 1 if len(gram) else 0, columns):
        lo, hi = np.searchsorted(gram, [at, at + columns])
        m = np.zeros((len(sets), columns), dtype=np.float32)
        m[owner[lo:hi], gram[lo:hi] - at] = 1
        size += m @ m.T
    return size


def verify_unit(unit: list[dict], n: int, numbers: dict, similarity: tuple[int, int]) -> list[tuple[int, int, int]]:
    """(entry, links of it found here, a node it is linked to through links found here)."""
    once = list({e["_row"]: e for e in unit}.values())
    sets = [ngrams(words(e["_text"]), n, numbers) for e in once]
    rows = np.array([e["_row"] for e in once])
    block = np.array([e["_own"] for e in once])
    copies = np.array([e["_copies"] for e in once])
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    same = overlaps(sets).astype(np.float64)
    top, bottom = similarity
    linked = same * (top + bottom) >= top * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    first, second = unit[0]["_first"], unit[0]["_second"]
    if first != second:  # pairs inside one block belong to the block's own unit
        linked &= block[:, None] != block[None, :]
    forest = Forest()
    counts = np.zeros(len(once), dtype=np.int64)
    for i in np.flatnonzero(linked.any(1)):
        near = np.flatnonzero(linked[i])
        counts[i] = copies[near].sum()
        for j in near[near < i]:
            forest.join(int(rows[i]), int(rows[j]))
    return [(int(rows[i]), int(counts[i]), forest.root(int(rows[i]))) for i in np.flatnonzero(counts)]


def verify(texts: DataFrame, entries: DataFrame, clustered: DataFrame, n: int, similarity: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """``entry``, ``links`` (of other entries' documents) and ``near`` rows of all units; texts: ``_row``, ``_text``."""
    sizes = clustered.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    member = (clustered.join(sizes, "component")
              .join(entries.select(F.col("_row").alias("node"), "_copies"), "node")
              .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    units = (member.join(texts.withColumnRenamed("_row", "node"), "node")
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("_own", "_other").alias("_first"), F.greatest("_own", "_other").alias("_second"),
                     F.col("node").alias("_row"), "_own", "_copies", "_text"))
    key = ["component", "_first", "_second"]
    numbers = _Numbers()
    arrow = pa.schema([("entry", pa.int64()), ("links", pa.int64()), ("near", pa.int64())])

    def run(batches):
        rows = (r for b in batches for at in range(0, b.num_rows, 256) for r in b.slice(at, 256).to_pylist())
        held: list[tuple[int, int, int]] = []
        for _, unit in groupby(rows, key=lambda r: tuple(r[k] for k in key)):
            unit = list(unit)
            if len(unit) > 1:
                held += verify_unit(unit, n, numbers, similarity)
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], schema=arrow)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(run, "entry long, links long, near long")


def near_duplicates(held: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                    similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Of held documents: ``_row``, ``_id``, ``n_links``, ``class_id``, ``kept`` (one row of each class)."""
    bands, rows = bands_for(similarity[0] / similarity[1], recall)
    sketched = sketch(held, id_col, text_col, n, bands, rows)
    texts = held.select("_row", F.col("_doc")[text_col].cast("string").cast("binary").alias("_text"))
    entries = materialise(
        sketched.where("_key IS NOT NULL").groupBy("_key").agg(
            F.min("_row").alias("_row"), F.min("_id").alias("_least"), F.count("*").alias("_copies"),
            F.min_by("_bands", "_row").alias("_bands")), "entries")
    found = materialise(verify(texts, entries, clusters(entries), n, similarity), "verified")
    classes = components(found.select(F.col("entry").alias("a"), F.col("near").alias("b")))
    links = found.groupBy("entry").agg(F.sum("links").alias("_links"))
    known = (entries.select("_key", "_row", "_least", "_copies")
             .join(links, F.col("_row") == F.col("entry"), "left").drop("entry")
             .join(classes, F.col("_row") == F.col("node"), "left").drop("node")
             .withColumn("component", F.coalesce("component", "_row")))
    heads = known.groupBy("component").agg(F.min("_least").alias("class_id"), F.min_by("_row", F.struct(F.col("_least").isNull(), "_least", "_row")).alias("_head"))
    known = known.join(heads, "component").select(
        "_key", "class_id", "_head", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"))
    out = sketched.select("_row", "_id", "_key").join(known, "_key", "left")
    # the kept row of a class is met on its own number, not on the class: a class may hold most rows
    first = (out.where("_key IS NOT NULL AND _id <=> class_id").groupBy("_head").agg(F.min("_row").alias("_row"))
             .select("_row", F.lit(True).alias("_keep")))
    return out.join(first, "_row", "left").select(
        "_row", "_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_key").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("_key").isNull() | F.col("_keep").isNotNull()).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """All columns of one document of each class (the least id), and of every text without words."""
    held = hold(docs)
    found = near_duplicates(held, id_col, text_col, n, similarity, recall)
    return held.join(found.where("kept").select("_row"), "_row", "left_semi").select("_doc.*")


def op5_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(hold(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select(F.col("_id").alias("doc_id"), "class_id", "n_links")


#: Exact sets and all links by shared n-grams; classes by repeated spreading of the least id.
OP5_ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS s FROM d WHERE len(w) > 0),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 9 >= 4 * (a.n + b.n)),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b),
m AS (SELECT doc_id, min(c) AS class_id FROM r GROUP BY doc_id),
l AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
SELECT m.doc_id, m.class_id, CAST(coalesce(l.n_links, 0) AS BIGINT) AS n_links FROM m LEFT JOIN l USING (doc_id)
"""
