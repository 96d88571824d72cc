"""Edit-aware token counts over pre-token segment trees.

A document is cut into pre-tokens by the tokenizer's pattern; pre-tokens encode independently,
so the count of a text is the sum of theirs. The pre-tokens are kept in segments of about
``SEGMENT`` under a binary tree whose nodes hold the sums of characters and tokens below them.
An edit descends by characters to the segments it touches, re-cuts from the pre-token that
holds the character before the edit, or from the white space or apostrophe before that (the
pattern looks ahead over a run of white space or a contraction, never back), until
a boundary of the new cut falls on an old boundary after the edit, replaces those segments and
renews the sums above them. Nothing else is read or encoded again.

Defined results: null and empty texts count 0; edits are (start, end, replacement) in code
points of the text before any of them, non-overlapping; an edit beyond the end is cut to it;
repeated rows each get their own result.
"""

from __future__ import annotations

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, table

#: Pre-tokens in a segment; pre-tokens whose counts a task remembers.
SEGMENT, REMEMBERED = 32, 500_000


class PieceCounter:
    """Token counts of pre-tokens by a ``tokenizers`` file with a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return n

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)


class SegmentTree:
    """A text as segments of pre-tokens with sums of (characters, tokens) over them."""

    def __init__(self, text: str, counter: PieceCounter, segment: int = SEGMENT):
        self.counter, self.segment = counter, segment
        self.encoded = 0  # characters cut and counted so far
        pieces = self._count(counter.cut(text))
        self.parts = [pieces[i:i + segment] for i in range(0, len(pieces), segment)] or [[]]
        self._build()

    def _count(self, pieces: list[str]) -> list[tuple[str, int]]:
        self.encoded += sum(map(len, pieces))
        return [(p, self.counter.count(p)) for p in pieces]

    def _sum(self, part: list[tuple[str, int]]) -> tuple[int, int]:
        return sum(len(p) for p, _ in part), sum(n for _, n in part)

    def _build(self) -> None:
        self.leaves = 1 << (len(self.parts) - 1).bit_length()
        self.tree = [(0, 0)] * (2 * self.leaves)
        self.tree[self.leaves:self.leaves + len(self.parts)] = map(self._sum, self.parts)
        for k in range(self.leaves - 1, 0, -1):
            self.tree[k] = tuple(a + b for a, b in zip(self.tree[2 * k], self.tree[2 * k + 1]))

    def _renew(self, part: int) -> None:
        k = part + self.leaves
        self.tree[k] = self._sum(self.parts[part])
        while k > 1:
            k >>= 1
            self.tree[k] = tuple(a + b for a, b in zip(self.tree[2 * k], self.tree[2 * k + 1]))

    @property
    def characters(self) -> int:
        return self.tree[1][0]

    @property
    def tokens(self) -> int:
        return self.tree[1][1]

    def text(self) -> str:
        return "".join(p for part in self.parts for p, _ in part)

    def _find(self, at: int) -> tuple[int, int]:
        """The segment that holds character ``at`` and the characters before the segment."""
        k, before = 1, 0
        while k < self.leaves:
            k *= 2
            if at - before >= self.tree[k][0]:
                before += self.tree[k][0]
                k += 1
        return min(k - self.leaves, len(self.parts) - 1), before

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters [start, end) by ``new``."""
        end = max(start, min(end, self.characters))
        start = min(start, self.characters)
        first, before = self._find(max(0, start - 1)) if self.characters else (0, 0)
        # the pre-token with the character before the edit
        keep, at = [], before
        for piece in self.parts[first]:
            if at + len(piece[0]) >= start:
                break
            keep.append(piece)
            at += len(piece[0])
        # how a run of white space or a contraction is cut depends on what follows: begin before it
        while at > 0:
            if not keep:
                first -= 1
                keep = list(self.parts[first])
                continue
            if not (keep[-1][0][-1].isspace() or keep[-1][0][-1] == "'"):
                break
            at -= len(keep.pop()[0])
        rest = [p for p, _ in self.parts[first][len(keep):]]
        last, held = first, "".join(rest)
        ends, pos = set(), at  # old boundaries from the edit's end on
        for p in rest:
            pos += len(p)
            ends.add(pos)
        while pos < end:
            last, pos = self._more(last, pos, ends, rest)
            held = "".join(rest)
        shift = len(new) - (end - start)
        while True:
            text = held[:start - at] + new + held[end - at:]
            done = last + 1 >= len(self.parts)
            cut = self.counter.cut(text)
            taken, p = [], at
            stop = None
            for piece in cut:
                taken.append(piece)
                p += len(piece)
                # safe if what the pattern could look at beyond this boundary was there
                if p - shift >= end and p >= start + len(new) and p - shift in ends and (p + 2 <= at + len(text) or done):
                    stop = p - shift
                    break
            if stop is not None or done:
                break
            last, pos = self._more(last, pos, ends, rest)
            held = "".join(rest)
        tail = []
        if stop is not None:
            q = at
            for p_ in rest:
                if q >= stop:
                    tail.append((p_, self.counter.count(p_)))
                q += len(p_)
        else:
            taken = cut
        pieces = keep + self._count(taken) + tail
        parts = [pieces[i:i + self.segment] for i in range(0, len(pieces), self.segment)] or [[]]
        if len(parts) == last - first + 1:
            for k, part in enumerate(parts, first):
                self.parts[k] = part
                self._renew(k)
        else:
            self.parts[first:last + 1] = parts
            self._build()

    def _more(self, last: int, pos: int, ends: set[int], rest: list[str]) -> tuple[int, int]:
        """Take the next segment's pre-tokens into an edit's region."""
        for p, _ in self.parts[last + 1]:
            rest.append(p)
            pos += len(p)
            ends.add(pos)
        return last + 1, pos


def masks(text: str, pattern: "regex.Pattern", mask: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), mask) for m in pattern.finditer(text)]


#: E-mail addresses, numbers of seven and more digits (with separators), credentials.
PERSONAL = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}"
            r"|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}")


def count_with_edits(docs: DataFrame, tokenizer_path: str, pattern: str, edits: str = PERSONAL, mask: str = "[MASKED]",
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: tokens before and after all matches of ``edits`` become ``mask``, the number of
    edits, the characters, and the characters that the edits made the counter read again."""
    held: list = []

    def of(b):
        if not held:
            held.extend([PieceCounter(tokenizer_path, pattern), regex.compile(edits), regex.compile(r"[@0-9]|[:=]|AKIA")])
        counter, find, hint = held
        out = {c: [] for c in ("n_chars", "n_tokens", "n_edits", "tokens_after", "chars_read_again")}
        for text in b.column("_text").to_pylist():
            text = text or ""
            todo = masks(text, find, mask) if hint.search(text) else []
            if todo:
                tree = SegmentTree(text, counter)
                before, read = tree.tokens, tree.encoded
                for start, end, new in reversed(todo):
                    tree.edit(start, end, new)
                after, again = tree.tokens, tree.encoded - read
            else:
                before = after = sum(map(counter.count, counter.cut(text)))
                again = 0
            for c, v in zip(out, (len(text), before, len(todo), after, again)):
                out[c].append(v)
        return {id_col: b.column(id_col), **out}
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), of,
                       f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_chars long, n_tokens long, n_edits long, "
                       "tokens_after long, chars_read_again long")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_with_edits(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
