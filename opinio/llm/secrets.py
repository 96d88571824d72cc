"""Secret scan: base rules plus credentials that an inferred grammar recognises.

1. One pass over all whole texts finds the base spans and the candidates: what lies outside the
   spans of every run of credential characters, if at least ``MIN_CANDIDATE`` long with a digit
   and a letter.
2. The base spans are the labelled credentials. Per kind, a prefix tree over a bounded sample
   of their values (``SAMPLE`` distinct values, the lowest hashes) is folded into a
   probabilistic automaton: states whose next-character frequencies agree within Hoeffding
   bounds, recursively, are merged (red and blue states in breadth-first order).
3. Character pairs are counted over all candidates of the table, which gives the model of
   ordinary ones. Every candidate gets its best log-likelihood ratio, automaton against that
   model; those above the threshold become spans of kind ``format``.

Defined results: null and empty texts have no spans; without labelled credentials of a kind
there is no automaton for it; repeated rows each get their own result; offsets are code points.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_batches, map_batches, materialise, table  # noqa: F401

#: The base rules (kind, pattern, group that is measured, its least length).
BASE = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
KINDS = ["assign", "access", "hex", "format"]

#: Distinct labelled values of a kind that train, and the longest value that does.
SAMPLE, LONGEST = 400, 200
#: Labelled values that a kind needs for an automaton; significance of the merge test.
LEAST, ALPHA = 10, 0.01
MIN_CANDIDATE = 12
#: Least log-likelihood ratio in all, and per character.
THRESHOLD, PER_CHARACTER = 12.0, 0.7
#: Size of the credential alphabet, for smoothing.
LETTERS = 68

_ASSIGN = re.compile(BASE[0][1], re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(BASE[1][1])
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs that are long enough
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_CANDIDATE)
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
_HEX_MARK = bytes(120 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))
_DIGIT_MARK = bytes(57 if 48 <= b <= 57 else 32 for b in range(256))

SPAN = "struct<kind:string,start:long,end:long,value:string>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Matches of the base rules, leftmost non-overlapping per kind, by start then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"x" * 24 in text.encode("utf-8", "surrogatepass").translate(_HEX_MARK):
        out += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """The parts of runs of credential characters outside the spans, with a digit and a letter."""
    if b"9" not in text.encode("utf-8", "surrogatepass").translate(_DIGIT_MARK):
        return []
    out = []
    for m in _CANDIDATE.finditer(text):
        at = m.start()
        for a, b in [*sorted((a, b) for _, a, b, _ in spans if a < m.end() and m.start() < b), (m.end(), m.end())]:
            part = text[at:max(at, a)]
            if len(part) >= MIN_CANDIDATE and _DIGIT.search(part) and _LETTER.search(part):
                out.append((at, at + len(part), part))
            at = max(at, b)
    return out


class Automaton:
    """A probabilistic automaton inferred from strings by merging prefix-tree states."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]  # "" counts the ends
        for s in sorted(strings):
            at = 0
            for c in s:
                self.count[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(defaultdict(int))
                at = self.next[at][c]
            self.count[at][""] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _differ(self, a: int, b: int) -> bool:
        na, nb = sum(self.count[a].values()), sum(self.count[b].values())
        if not na or not nb:
            return False
        most = self.bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
        return any(abs(self.count[a].get(c, 0) / na - self.count[b].get(c, 0) / nb) > most
                   for c in {*self.count[a], *self.count[b]})

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(a, b):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a] if c in self.next[b] and self.next[a][c] != self.next[b][c]]
            if len(todo) > 10_000:
                return False
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for c, n in self.count[b].items():
                self.count[a][c] += n
            for c, to in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], to))
                else:
                    self.next[a][c] = to

    def _merge_all(self) -> None:
        red = [0]
        while True:
            blue = next(((r, c, to) for r in red for c, to in sorted(self.next[r].items()) if to not in red), None)
            if blue is None:
                return
            parent, c, state = blue
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)

    def log_likelihood(self, s: str) -> float:
        at, total = 0, 0.0
        for c in [*s, ""]:
            n = sum(self.count[at].values())
            total += math.log((self.count[at].get(c, 0) + 0.2 / LETTERS) / (n + 0.2))
            if c:
                at = self.next[at].get(c, at)
        return total


class Pairs:
    """Character-pair model of ordinary candidates, smoothed by the single characters."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.pair, self.one, self.n = counts, defaultdict(int), 0
        for (a, _), n in counts.items():
            self.one[a] += n
            self.n += n

    def log_likelihood(self, s: str) -> float:
        total = 0.0
        for a, b in zip(" " + s, s + " "):
            single = (self.one.get(b, 0) + 1) / (self.n + LETTERS)
            total += math.log((self.pair.get((a, b), 0) + 20 * single) / (self.one.get(a, 0) + 20))
        return total


class Formats:
    """The automata of all kinds against the model of ordinary candidates."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: dict[tuple[str, str], int]):
        self.automata = {k: Automaton(v) for k, v in sorted(labelled.items()) if len(v) >= LEAST}
        self.ordinary = Pairs(ordinary)

    def score(self, s: str) -> float:
        """Best log-likelihood ratio; minus infinity without automata."""
        plain = self.ordinary.log_likelihood(s)
        return max((a.log_likelihood(s) - plain for a in self.automata.values()), default=-math.inf)

    def is_credential(self, s: str) -> bool:
        return self.score(s) >= max(THRESHOLD, PER_CHARACTER * len(s))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1, a narrow table: ``id_col``, base spans, candidates."""
    def of(b):
        base, rest = [], []
        for t in b.column("_text").to_pylist():
            spans = base_spans(t or "")
            base.append([dict(zip(("kind", "start", "end", "value"), s)) for s in spans])
            rest.append([{"kind": "format", "start": s, "end": e, "value": v} for s, e, v in candidates(t or "", spans)])
        return {id_col: b.column(id_col), "base": base, "candidates": rest}
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), of,
                       f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, base array<{SPAN}>, candidates array<{SPAN}>")


def pair_counts(scanned: DataFrame) -> dict[tuple[str, str], int]:
    """Character pairs of all candidates (a space at both ends) and their numbers."""
    def run(batches):
        seen = Counter()
        for b in batches:
            for values in b.column("values").to_pylist():
                for s in values:
                    s = f" {s} "
                    seen.update(zip(s, s[1:]))
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in seen], pa.string()), "b": pa.array([b for _, b in seen], pa.string()),
                                          "n": pa.array(seen.values(), pa.int64())})
    values = scanned.select(F.transform("candidates", lambda s: s["value"]).alias("values"))
    counted = values.mapInArrow(run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return {(r["a"], r["b"]): r["n"] for r in counted.collect()}  # at most a row per pair of credential characters


def infer(scanned: DataFrame) -> Formats:
    """Pass 2: bounded samples of labelled values (the lowest hashes), pairs of all candidates."""
    def sample(kind: str) -> list[str]:
        values = (scanned.select(F.explode("base").alias("s")).select(F.col("s.kind").alias("kind"), F.col("s.value").alias("value"))
                  .where((F.col("kind") == kind) & (F.length("value") <= LONGEST)).select("value").distinct())
        return [r["value"] for r in values.orderBy(F.xxhash64("value"), "value").limit(SAMPLE).collect()]
    return Formats({k: sample(k) for k, *_ in BASE}, pair_counts(scanned))


def add_formats(scanned: DataFrame, formats: Formats, id_col: str = "doc_id") -> DataFrame:
    """Pass 3: ``id_col``, base spans and all spans, by start then kind."""
    def of(b):
        spans = []
        for base, rest in zip(b.column("base").to_pylist(), b.column("candidates").to_pylist()):
            found = [*base, *(c for c in rest if formats.is_credential(c["value"]))]
            spans.append(sorted(found, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
        return {id_col: b.column(id_col), "base": b.column("base"), "spans": spans}
    return map_batches(scanned, of, f"`{id_col}` {scanned.schema[id_col].dataType.simpleString()}, base array<{SPAN}>, spans array<{SPAN}>")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    scanned = materialise(scan(docs, id_col, text_col), "secrets")
    return add_formats(scanned, infer(scanned), id_col)


def redact(docs: DataFrame, formats: Formats, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All documents and columns, with every span replaced by ``mark`` and the length renewed."""
    def clean(t: str | None) -> str | None:
        if not t:
            return t
        base = base_spans(t)
        found = [(s, e) for _, s, e, _ in base] + [(s, e) for s, e, v in candidates(t, base) if formats.is_credential(v)]
        out, at = [], 0
        for s, e in sorted(found):
            if s >= at:
                out += [t[at:s], mark]
            at = max(at, e)
        return "".join([*out, t[at:]])

    def of(b):
        cols = {name: b.column(name) for name in b.schema.names}
        cols[text_col] = [clean(t) for t in b.column(text_col).to_pylist()]
        return cols
    out = map_batches(docs, of, docs.schema)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE],
                        F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
