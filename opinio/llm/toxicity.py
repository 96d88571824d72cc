"""Toxicity by nearest labelled examples: exact TF-IDF cosine on a block-max inverted index.

1. A bounded sample of labelled training documents (``EXAMPLES`` per class, the lowest hashes)
   gives the vocabulary: words and word beginnings that mark toxic examples (largest G-squared
   among those with at least ``LEAST`` toxic examples), ``TERMS`` of them.
2. One pass over all whole texts counts these terms per document (a narrow table); document
   frequencies come from all documents.
3. The examples' TF-IDF vectors, at length 1, form the index: per term a posting list in example
   order, cut into blocks of ``BLOCK`` examples with the largest weight of each. For a query the
   sum of query weight times block maximum bounds every cosine in the block; blocks are scored
   in falling order of bounds until none can beat the k-th best found, so the k nearest are exact.
4. Neighbours vote with weights that fall with their distance and that undo the sampling rates
   of the classes; a prior vote at the rate of documents without any term keeps few or far
   neighbours modest. Votes are mapped to probabilities by isotonic (pool-adjacent) calibration on
   the training examples themselves, each without its own vote.

Defined results: null and empty texts, and texts without any term, score the share of toxic
examples among those; a document with both labels counts as toxic; labels other than 0 and 1
don't train; without examples every score is 0; ties among neighbours go to the lower example
number; repeated rows each get their own result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, remainder, table

EXAMPLES = {1: 3000, 0: 6000}
TERMS, LEAST, PREFIXES = 512, 5, (4, 5, 6)
#: Least G-squared and least ratio of rates for a term.
EVIDENCE, RATIO = 25.0, 3.0
NEIGHBOURS, BLOCK = 25, 64
#: Words a task remembers.
REMEMBERED = 500_000

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letter_words(text: str | None) -> list[bytes]:
    """Lower-case runs of letters."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def terms_of(word: bytes) -> list[bytes]:
    """A word and its beginnings (marked by a hyphen)."""
    return [word, *(word[:n] + b"-" for n in PREFIXES if len(word) > n)]


def examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out: tuple[int, int]) -> tuple[DataFrame, dict[int, float]]:
    """The sampled training documents with ``_y``, and the sampling rate of each class."""
    marks = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .where(F.col("_y").isin(0, 1) & (remainder("_id", held_out[0]) != held_out[1])).groupBy("_id").agg(F.max("_y").alias("_y")))
    totals = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    chosen = None
    for y, most in EXAMPLES.items():
        part = marks.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rates = {y: min(1.0, EXAMPLES[y] / n) for y, n in totals.items()}
    chosen = materialise(chosen, "examples")  # at most sum(EXAMPLES) ids: a fixed bound
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
    return materialise(rows, "example-texts"), rates


def vocabulary(sampled: DataFrame, n_terms: int = TERMS) -> list[bytes]:
    """The terms that mark toxic examples best."""
    import pyarrow as pa

    sizes = {r["_y"]: r["count"] for r in sampled.groupBy("_y").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1:
        return []

    def run(batches):
        seen = {0: Counter(), 1: Counter()}
        def flush():
            terms = list({*seen[0], *seen[1]})
            out = pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.binary()), "toxic": pa.array([seen[1][t] for t in terms], pa.int64()),
                                              "clean": pa.array([seen[0][t] for t in terms], pa.int64())})
            seen[0].clear(), seen[1].clear()
            return out
        for b in batches:
            for y, text in zip(b.column("_y").to_pylist(), b.column("_text").to_pylist()):
                seen[y].update({t for w in set(letter_words(text)) for t in terms_of(w)})
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield flush()
        yield flush()
    counted = (sampled.select("_y", "_text").mapInArrow(run, "term binary, toxic long, clean long")
               .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(F.col("a") >= LEAST))
    a, b = F.col("a"), F.col("b")
    total = F.lit(float(n1 + n0))
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    both, rest = a + b, total - a - b
    score = 2 * (part(a, both * n1 / total) + part(b, both * n0 / total) + part(n1 - a, rest * n1 / total) + part(n0 - b, rest * n0 / total))
    best = (counted.withColumn("score", score).where((F.col("score") >= EVIDENCE) & ((a + 0.5) / n1 >= RATIO * (b + 0.5) / max(n0, 1)))
            .orderBy(F.desc("score"), "term").limit(n_terms).collect())
    return [bytes(r["term"]) for r in best]


def count_terms(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str, *more: str) -> DataFrame:
    """``id_col`` and the terms (numbers) of each document with their counts."""
    number = {t: k for k, t in enumerate(terms)}

    class Known(dict):
        def __missing__(self, word):
            if len(self) >= REMEMBERED:
                self.clear()
            hit = self[word] = tuple(number[t] for t in terms_of(word) if t in number)
            return hit
    known = Known()

    def of(b):
        ks, ns = [], []
        for text in b.column("_text").to_pylist():
            c = Counter(k for hit in map(known.__getitem__, letter_words(text)) if hit for k in hit)
            found = sorted(c.items())
            ks.append([k for k, _ in found])
            ns.append([n for _, n in found])
        return {**{c: b.column(c) for c in (id_col, *more)}, "terms": ks, "counts": ns}
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in (id_col, *more))
    return materialise(map_batches(docs.select(id_col, *more, F.col(text_col).cast("string").alias("_text")), of,
                                   kinds + "terms array<int>, counts array<int>"), "terms")


class Index:
    """Block-max inverted index of labelled examples and the vote over the nearest."""

    def __init__(self, idf: np.ndarray, vectors: list[tuple[list[int], list[int]]], labels: list[int], rates: dict[int, float], ids: list):
        self.idf = idf
        weight = np.array([1.0 / rates[y] for y in labels])
        y = np.array(labels, dtype=float)
        bare = np.array([not t for t, _ in vectors], dtype=bool)
        self.bare = float((weight * y)[bare].sum() / weight[bare].sum()) if bare.any() else 0.0
        full = sorted((k for k in range(len(vectors)) if not bare[k]), key=lambda k: (vectors[k][0], k))  # like with like
        self.y, self.weight, self.ids = y[full], weight[full], [ids[k] for k in full]
        self.size, self.blocks = len(full), -(-len(full) // BLOCK)
        post: list[list[tuple[int, float]]] = [[] for _ in idf]
        self.vectors = []
        for n, k in enumerate(full):
            terms, w = self.unit(*vectors[k])
            self.vectors.append((terms, w))
            for t, x in zip(terms, w):
                post[t].append((n, x))
        self.post_id = [np.array([n for n, _ in p], dtype=np.int64) for p in post]
        self.post_w = [np.array([x for _, x in p]) for p in post]
        edges = np.arange(self.blocks + 1) * BLOCK
        self.cut = np.array([np.searchsorted(p, edges) for p in self.post_id]).reshape(len(idf), self.blocks + 1)
        self.most = np.zeros((len(idf), self.blocks))
        for t, (p, w) in enumerate(zip(self.post_id, self.post_w)):
            np.maximum.at(self.most[t], p // BLOCK, w)
        self.steps: tuple[np.ndarray, np.ndarray] | None = None
        if self.size:
            self._calibrate()

    def unit(self, terms: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(terms, dtype=np.int64)
        w = (1 + np.log(np.array(counts, dtype=float))) * self.idf[t]
        return t, w / np.sqrt((w * w).sum())

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosines: numbers and cosines, exact, ties by number."""
        bound = w @ self.most[t]
        order = np.argsort(-bound, kind="stable")
        ids, cos, at, step = np.empty(0, np.int64), np.empty(0), 0, max(1, -(-k // BLOCK) + 1)
        while at < self.blocks and (len(ids) < k or bound[order[at]] >= cos[-1] - 1e-12):
            chosen = order[at:at + step]
            at, step = at + step, step * 2
            slot = np.full(self.blocks, -1)
            slot[chosen] = np.arange(len(chosen))
            dot = np.zeros(len(chosen) * BLOCK)
            for term, x in zip(t, w):
                for b in chosen[self.cut[term, chosen] < self.cut[term, chosen + 1]]:
                    a, e = self.cut[term, b], self.cut[term, b + 1]
                    dot[slot[b] * BLOCK + self.post_id[term][a:e] - b * BLOCK] += x * self.post_w[term][a:e]
            number = (chosen[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            ids, cos = np.concatenate([ids, number[number < self.size]]), np.concatenate([cos, dot[number < self.size]])
            best = np.lexsort((ids, -np.round(cos, 12)))[:k]
            ids, cos = ids[best], cos[best]
        return ids, cos

    def vote(self, ids: np.ndarray, cos: np.ndarray) -> float:
        pull = self.weight[ids] / (0.05 + np.clip(1 - cos, 0, None)) * (cos > 0)
        return float((pull @ self.y[ids] + 2.0 * self.bare) / (pull.sum() + 2.0))

    def _calibrate(self) -> None:
        """Pool adjacent violators over the examples' own votes (each without itself)."""
        votes = np.empty(self.size)
        for n, (t, w) in enumerate(self.vectors):
            ids, cos = self.nearest(t, w, NEIGHBOURS + 1)
            other = ids != n
            votes[n] = self.vote(ids[other][:NEIGHBOURS], cos[other][:NEIGHBOURS])
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # weight, toxic weight, largest vote
        for n in order:
            pools.append([self.weight[n], self.weight[n] * self.y[n], votes[n]])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                w, a, v = pools.pop()
                pools[-1] = [pools[-1][0] + w, pools[-1][1] + a, v]
        edge = np.array([p[2] for p in pools])
        rate = np.array([(p[1] + self.bare) / (p[0] + 1.0) for p in pools])
        self.steps = edge, np.maximum.accumulate(rate)

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, list]:
        """The calibrated score and the nearest examples (id, cosine, label)."""
        if not terms or not self.size:
            return self.bare, []
        ids, cos = self.nearest(*self.unit(terms, counts), NEIGHBOURS)
        vote = self.vote(ids, cos)
        edge, rate = self.steps
        # between calibrated steps the vote itself keeps an order
        value = 0.98 * float(np.interp(vote, edge, rate)) + 0.02 * vote
        return min(1.0, value), [(self.ids[i], round(float(c), 6), int(self.y[i])) for i, c in zip(ids[:3], cos[:3])]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """One row per document: ``id_col``, ``score``, ``evidence`` (nearest examples)."""
    sampled, rates = examples(docs, labels, id_col, text_col, label_col, held_out)
    terms = vocabulary(sampled)
    counted = count_terms(docs, terms, id_col, text_col)
    n = counted.count()
    seen = {r["t"]: r["count"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # at most TERMS rows
    idf = np.array([math.log((1 + n) / (1 + seen.get(k, 0))) + 1 for k in range(len(terms))])
    rows = count_terms(sampled, terms, "_id", "_text", "_y").orderBy("_id").collect()  # at most the sample
    index = Index(idf, [(r["terms"], r["counts"]) for r in rows], [r["_y"] for r in rows], rates, [r["_id"] for r in rows])
    known: dict[tuple, tuple] = {}

    def of(b):
        scores, evidence = [], []
        for t, c in zip(b.column("terms").to_pylist(), b.column("counts").to_pylist()):
            key = (tuple(t), tuple(c))
            if key not in known:
                if len(known) > 100_000:
                    known.clear()
                known[key] = index.score(t, c)
            scores.append(known[key][0])
            evidence.append([{"example": str(i), "cosine": x, "label": y} for i, x, y in known[key][1]])
        return {id_col: b.column(id_col), "score": scores, "evidence": evidence}
    return map_batches(counted, of, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, "
                                    "evidence array<struct<example:string,cosine:double,label:int>>")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
