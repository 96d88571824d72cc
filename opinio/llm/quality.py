"""Quality classifier: regularised quadratic discriminant over document statistics.

1. One pass over all texts counts, per document, characters of several kinds, words, repeats
   and lines; the counts are a narrow table.
2. Counts become rates, smoothed towards the rates of good training documents so that short
   texts say little, and are variance-stabilised (arcsine of the square root).
3. Per class, Spark sums the training rows' features and their products; the covariance
   shrinks towards the pooled one and that towards its diagonal. The driver only sees these
   sums. The two Cholesky factors are computed once and travel with the tasks.
4. The score is the logistic of the log-density difference plus the log prior ratio.

Defined results: null and empty texts have zero counts and get the score of the smoothed
rates; unlabelled documents and labels other than 0 and 1 don't train; a document with two
labels trains on the higher; with a class missing from the training rows every score is the
share of the class that is there (0.5 without any).
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_batches, map_batches, materialise, remainder, table, utf8

#: Shrinkage of a class covariance towards the pooled one, and of the pooled towards its diagonal.
SHRINK_CLASS, SHRINK_POOLED = 0.2, 0.1
#: Least standard deviation of a feature, and units (characters, words, lines) of smoothing.
FLOOR_SD, SMOOTH = 0.02, {"chars": 60.0, "words": 12.0, "lines": 3.0}
#: Log-density differences are divided by the number of features that share the evidence.
TEMPERATURE = 4.0

#: Counted per document, with the count it is a share of.
COUNTS = {"upper": "chars", "digit": "chars", "space": "chars", "stop": "chars", "comma": "chars", "bang": "chars",
          "pipe": "chars", "symbol": "chars", "high": "chars", "control": "chars", "repeated": "words",
          "common": "words", "ended": "words", "copied_lines": "lines"}
BASES = ("chars", "words", "lines")
NAMES = [*BASES, *COUNTS]

_CLASS = np.full(256, 7)  # the rest of ASCII: symbols
_CLASS[[*range(65, 91)]] = 0
_CLASS[[*range(48, 58)]] = 1
_CLASS[[9, 10, 13, 32]] = 2
_CLASS[[ord(c) for c in ".?"]] = 3
_CLASS[[ord(c) for c in ",;:'\"()-"]] = 4
_CLASS[ord("!")] = 5
_CLASS[ord("|")] = 6
_CLASS[128:] = 8
_CLASS[[*range(0, 9), 11, 12, *range(14, 32), 127]] = 9
_CLASS[[*range(97, 123)]] = 10
_ONE_HOT = np.eye(11)[_CLASS]


def statistics(data: bytes | None) -> list[float]:
    """The counts of one text, in the order of NAMES."""
    if not data:
        return [0.0] * len(NAMES)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _ONE_HOT
    found = data.split()
    often = Counter(found)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(1 for w in often if not (w[-1:].isalnum() or w[-1] >= 128) for _ in range(often[w]))
    return [float(len(data)), float(len(found)), float(len(lines)), *kinds[:10].tolist(),
            float(sum(map(eq, found, found[1:]))), float(max(often.values(), default=0)), float(ended),
            float(len(lines) - len(set(lines)))]


@dataclasses.dataclass
class Model:
    rates: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors
    offsets: list[float]  # log prior - log determinant / 2
    share: float

    def features(self, counts: np.ndarray) -> np.ndarray:
        return features(counts, self.rates)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(counts), self.share)
        x = self.features(counts)
        dens = [o - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, o in zip(self.means, self.factors, self.offsets)]
        return 1.0 / (1.0 + np.exp(-np.clip((dens[1] - dens[0]) / TEMPERATURE, -500, 500)))


def features(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Smoothed, variance-stabilised rates."""
    cols = []
    for k, base in enumerate(COUNTS.values()):
        n, m = counts[:, BASES.index(base)], SMOOTH[base]
        got = counts[:, 3 + k]
        cols.append(np.arcsin(np.sqrt(np.clip((got + m * rates[k]) / (n + m), 0, 1))))
    return np.column_stack(cols)


def count_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, counts array<double>"
    return map_batches(docs.select(F.col(id_col), utf8(text_col).alias("_text")),
                       lambda b: {id_col: b.column(id_col), "counts": [statistics(t) for t in b.column("_text").to_pylist()]}, schema)


def fit(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        held_out: tuple[int, int] = (3, 1)) -> Model:
    """Fit on all rows with a label whose remainder isn't the held-out one."""
    marks = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .where(F.col("_y").isin(0, 1) & (remainder("_id", held_out[0]) != held_out[1]))
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    train = counted.join(marks, counted[id_col] == marks["_id"]).select("counts", "_y")
    d = len(COUNTS)
    names = list(COUNTS)
    base = {n: i for i, n in enumerate(BASES)}
    good = train.where("_y = 1").agg(*[F.avg(
        F.col("counts")[3 + k] / F.greatest(F.col("counts")[base[COUNTS[n]]], F.lit(1.0))).alias(n) for k, n in enumerate(names)]).first()
    rates = np.array([good[n] if good[n] is not None else 0.0 for n in names])
    per_class = _moments(train, rates, d)
    total = sum(n for n, _, _ in per_class.values())
    share = per_class[1][0] / total if 1 in per_class else 0.0 if total else 0.5
    if len(per_class) < 2 or min(n for n, _, _ in per_class.values()) < 2:
        return Model(rates, [], [], [], share)
    means, covs = {}, {}
    for c, (n, s, ss) in per_class.items():
        means[c] = s / n
        covs[c] = ss / n - np.outer(means[c], means[c])
    pooled = sum(per_class[c][0] * covs[c] for c in covs) / total
    pooled = (1 - SHRINK_POOLED) * pooled + SHRINK_POOLED * np.diag(np.diag(pooled)) + FLOOR_SD ** 2 * np.eye(d)
    factors, offsets = [], []
    for c in (0, 1):
        chol = np.linalg.cholesky((1 - SHRINK_CLASS) * covs[c] + SHRINK_CLASS * pooled + FLOOR_SD ** 2 * np.eye(d))
        factors.append(np.linalg.inv(chol))
        offsets.append(float(np.log(per_class[c][0] / total) - np.log(np.diag(chol)).sum()))
    return Model(rates, [means[0], means[1]], factors, offsets, share)


def _moments(train: DataFrame, rates: np.ndarray, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sum of features, sum of products. Each task sends one row per class."""
    def run(batches):
        import pyarrow as pa
        sums = {}
        for b in batches:
            x = features(np.array(b.column("counts").to_pylist(), dtype=float).reshape(b.num_rows, -1), rates) if b.num_rows else np.empty((0, d))
            y = np.array(b.column("_y").to_pylist())
            for c in (0, 1):
                part = x[y == c] if len(y) else x
                n, s, ss = sums.get(c, (0, np.zeros(d), np.zeros((d, d))))
                sums[c] = (n + len(part), s + part.sum(0), ss + part.T @ part)
        yield pa.RecordBatch.from_pydict({
            "_y": pa.array([c for c in sums], pa.int32()), "n": pa.array([float(v[0]) for v in sums.values()], pa.float64()),
            "s": pa.array([v[1].tolist() for v in sums.values()], pa.list_(pa.float64())),
            "ss": pa.array([v[2].ravel().tolist() for v in sums.values()], pa.list_(pa.float64()))})
    parts = train.mapInArrow(run, "_y int, n double, s array<double>, ss array<double>")
    rows = (parts.groupBy("_y").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(d)]).alias("s"),
        F.array(*[F.sum(F.col("ss")[i]) for i in range(d * d)]).alias("ss")).where("n > 0").collect())
    return {r["_y"]: (r["n"], np.array(r["s"]), np.array(r["ss"]).reshape(d, d)) for r in rows}


def score(counted: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and the score of each counted document."""
    def of(b):
        counts = np.array(b.column("counts").to_pylist(), dtype=float).reshape(b.num_rows, len(NAMES))
        return {id_col: b.column(id_col), "score": model.score(counts).tolist()}
    return map_batches(counted, of, f"`{id_col}` {counted.schema[id_col].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents (all columns) that score at least ``threshold``."""
    def keep(b):
        texts = [t.encode("utf-8", "surrogatepass") if t is not None else None for t in b.column(text_col).to_pylist()]
        counts = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(NAMES))
        return (model.score(counts) >= threshold).tolist()
    return filter_batches(docs, keep)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    counted = materialise(count_table(table(spark, sf_dir, "documents"), "doc_id", "text"), "quality")
    model = fit(counted, table(spark, sf_dir, "labels"))
    return score(counted, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
