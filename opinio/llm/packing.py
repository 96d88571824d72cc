"""Packing: documents to fixed-length training sequences by first-fit decreasing.

1. One pass tokenises every whole text and writes ids (16-bit where the vocabulary allows)
   and their number.
2. Whole sequences are cut from the front of each document; the rest of it is an item. Items
   go to random groups of about ``GROUP`` documents by a hash of their row, and each group is
   packed by itself: longest first, each into the first sequence with room, which a tournament
   tree over the sequences' free room finds in logarithmic time. What padding remains is then
   closed by cutting: the emptiest sequences are dealt out into the room of the others, so a
   group ends with at most one sequence that isn't full.
3. The plan (a few numbers per document) meets the ids again on the row: every piece is returned
   with its ids, so the pieces of a sequence in order of their offset are the sequence.

Defined results: a null or empty text is the end-of-document id alone; repeated rows are
packed each; nothing is dropped; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, table

LENGTH = 4096
END_ID = 2
#: Documents in a group, on average.
GROUP = 4096
#: Words whose ids a task remembers.
REMEMBERED = 500_000


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


BYTE_LETTERS = byte_letters()


#: The normaliser and splitter whose work on plain texts ``WordTokenizer`` does itself.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class WordTokenizer:
    """Ids of whole texts by any ``tokenizers`` file.

    If the file normalises and splits by ``WORD_NORMALIZER`` and ``WORD_SPLITTER``, a text of only ASCII and
    Latin-1 letters goes through the file's merges word by word, and words are remembered: normaliser and
    splitter do nothing else with such texts, and words are merged independently. Any other text, and
    every text of any other file, goes through the tokenizer as it is. Texts are never cut or padded, whatever the file says.
    """

    #: Characters whose NFC form, lower case and class are the same in every Unicode version.
    PLAIN = re.compile("[\\t\\n\\v\\f\\r\\x20-\\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
    SPLIT = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\s0-9a-z\xdf-\xf6\xf8-\xff]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.by_word = self._is_expected()
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers

    def _is_expected(self) -> bool:
        t = self.tokenizer
        if t.normalizer is None or t.pre_tokenizer is None or type(self.model).__name__ != "BPE" or self.model.dropout:
            return False
        added = [a.content for a in t.get_added_tokens_decoder().values()]
        return (json.loads(t.normalizer.__getstate__()) == WORD_NORMALIZER and json.loads(t.pre_tokenizer.__getstate__()) == WORD_SPLITTER
                and all(a.startswith("<|") for a in added))

    def _word(self, word: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        spelt = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self.known[word] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word or "<|" in text or not self.PLAIN.fullmatch(text) or not unicodedata.is_normalized("NFC", text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        get = self.known.get
        return np.frombuffer(b"".join([get(w) or self._word(w) for w in self.SPLIT.findall(text.lower())]), np.uint32)


class Room:
    """Tournament tree over the free room of sequences: the first one with at least ``n`` free."""

    def __init__(self, sequences: int, length: int):
        self.leaves = 1 << max(0, (max(1, sequences) - 1).bit_length())
        self.best = [length] * (2 * self.leaves)

    def take(self, n: int) -> int:
        """Put ``n`` into the first sequence with room; its number."""
        best, at = self.best, 1
        while at < self.leaves:
            at = 2 * at if best[2 * at] >= n else 2 * at + 1
        place = at - self.leaves
        best[at] -= n
        while at > 1:
            at >>= 1
            best[at] = max(best[2 * at], best[2 * at + 1])
        return place


def pack_group(sizes: list[tuple[int, int]], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (row, start, size) for (row, size) items of at most ``length``."""
    items = sorted(((n, row) for row, n in sizes if n), key=lambda x: (-x[0], x[1]))
    room = Room(len(items), length)
    packed: dict[int, list[tuple[int, int, int]]] = {}
    for n, row in items:
        packed.setdefault(room.take(n), []).append((row, 0, n))
    bins = sorted(packed.values(), key=lambda b: -sum(x[2] for x in b))
    free = [length - sum(x[2] for x in b) for b in bins]
    at, last = 0, len(bins) - 1
    while at < last:  # deal the emptiest sequence out into the room of the fullest
        if not free[at]:
            at += 1
            continue
        row, start, n = bins[last].pop()
        cut = min(n, free[at])
        bins[at].append((row, start, cut))
        free[at] -= cut
        free[last] += cut
        if cut < n:
            bins[last].append((row, start + cut, n - cut))
        if not bins[last]:
            last -= 1
    return [b for b in bins if b]


def tokenise(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row`` (unique), ``id_col``, ``n`` and the ids of each document, written once."""
    held: list[WordTokenizer] = []  # per task

    def of(b):
        if not held:
            held.append(WordTokenizer(tokenizer_path))
        ids = [np.append(held[0].encode(t or ""), np.uint32(END_ID)).astype("<u4") for t in b.column("_text").to_pylist()]
        narrow = [i.astype("<u2") if i.max() < 65536 else i for i in ids]
        return {"_row": b.column("_row"), id_col: b.column(id_col), "n": [len(i) for i in ids],
                "wide": [i.dtype.itemsize == 4 for i in narrow], "ids": [i.tobytes() for i in narrow]}
    d = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = f"_row long, `{id_col}` {docs.schema[id_col].dataType.simpleString()}, n long, wide boolean, ids binary"
    return materialise(map_batches(d, of, schema), "ids")


def plan(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """``_row`` and its pieces (start, length, sequence_id, offset)."""
    rows = tokens.count()
    groups = max(1, -(-rows // GROUP))

    def of_group(key, batch):
        first, sequence = int(key[0].as_py()) << 36, 0
        pieces: dict[int, list[dict]] = {}
        rest, begin = [], {}
        for row, n in zip(batch.column("_row").to_pylist(), batch.column("n").to_pylist()):
            whole = n // length
            pieces[row] = [{"start": k * length, "length": length, "sequence_id": first + sequence + k, "offset": 0} for k in range(whole)]
            sequence += whole
            begin[row] = whole * length
            rest.append((row, n - begin[row]))
        for made in pack_group(rest, length):
            offset = 0
            for row, start, n in made:
                pieces[row].append({"start": begin[row] + start, "length": n, "sequence_id": first + sequence, "offset": offset})
                offset += n
            sequence += 1
        return pa.Table.from_pydict({"_row": pa.array(list(pieces), pa.int64()), "pieces": pa.array(
            list(pieces.values()), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "sequence_id", "offset")])))})
    group = F.pmod(F.xxhash64("_row", F.lit(7)), F.lit(groups))
    return (tokens.select("_row", "n", group.alias("_group")).groupBy("_group")
            .applyInArrow(of_group, "_row long, pieces array<struct<start:long,length:long,sequence_id:long,offset:long>>"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids."""
    tokens = tokenise(docs, tokenizer_path, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
              "ids array<int>")
    planned = plan(tokens, length)
    joined = tokens.join(planned, "_row").select(id_col, "n", "wide", "ids", "pieces")

    def of(b):
        out = {c: [] for c in ("at", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        cuts = []
        rows = zip(b.column("n").to_pylist(), b.column("wide").to_pylist(), b.column("ids").to_pylist(), b.column("pieces").to_pylist())
        for at, (n, wide, data, pieces) in enumerate(rows):
            ids = np.frombuffer(data, "<u4" if wide else "<u2").astype("<u4")
            for p in pieces:
                out["at"].append(at)
                cuts.append(ids[p["start"]:p["start"] + p["length"]])
                out["ids_crc32"].append(zlib.crc32(cuts[-1].tobytes()))
                out["doc_tokens"].append(n)
                for c in ("start", "length", "sequence_id", "offset"):
                    out[c].append(p[c])
        at = pa.array(out.pop("at"), pa.int64())
        ends = np.cumsum([0, *map(len, cuts)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, "<u4"), *cuts]).astype("<i4")))
        return {id_col: b.column(id_col).take(at), **out, "ids": ids}
    return map_batches(joined, of, schema)


def op7_sequence_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")
