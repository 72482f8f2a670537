"""SentencePiece encoding and decoding as shortest paths through a weighted transducer.

The transducer is the normaliser (blanks become the piece letter, one is put in front), composed with one arc per
piece and, for letters without a piece, arcs that spell their bytes. For a unigram model an arc weighs minus the
piece's score. For a BPE model a second factor is composed: a transducer over neighbouring pieces that lets a pair
pass only if merging its letters gives that pair. A sequence all of whose neighbours pass is the BPE encoding, and
there is only one, so the shortest path in the tropical semiring is exactly it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from curvelake.llm.common import process_cache

BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Words remembered per process, and their greatest length; neighbouring pieces remembered. Some 200 and 90 bytes each, twice as many
#: while the older half is still held: some 150 MB together.
REMEMBERED, LONGEST, PAIRS = 250_000, 64, 250_000

#: Texts whose new words are composed together, and their bytes.
TOGETHER, BYTES = 2_000, 8_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message: varints, 32-bit words and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + n]
        at += n


class Transducer:
    """A compiled model file."""

    def __init__(self, path: str):
        self.pieces: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        self.prefix, self.squeeze, self.escape, self.model = True, True, True, UNIGRAM
        for number, value in _fields(Path(path).read_bytes()):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                self.score.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.kind.append(f.get(3, NORMAL))
            elif number == 2:
                self.model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2):
                    raise ValueError("only the identity character map is compiled")
                self.prefix, self.squeeze, self.escape = (bool(f.get(k, 1)) for k in (3, 4, 5))
        if self.model not in (UNIGRAM, BPE):
            raise ValueError("the model is neither unigram nor BPE")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kind[i] == NORMAL}
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece has a blank after a letter: texts do not fall apart at blanks")
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kind[i] == BYTE}
        self.unknown = self.kind.index(UNKNOWN) if UNKNOWN in self.kind else 0
        self.endings: dict = {}  # trie of the pieces read backwards; None leads to the piece
        for piece, i in self.ids.items():
            node = self.endings
            for letter in reversed(piece):
                node = node.setdefault(letter, {})
            node[None] = i
        shown = {NORMAL: lambda p: p.replace(BLANK, " "), UNKNOWN: lambda p: " ⁇ ", CONTROL: lambda p: "", BYTE: lambda p: chr(int(p[1:-1], 16) % 128)}
        self.shown = [shown.get(k, shown[NORMAL])(p) for p, k in zip(self.pieces, self.kind)]
        self.high = np.array([k == BYTE and int(p[1:-1], 16) > 127 for p, k in zip(self.pieces, self.kind)])
        self.floor = min(self.score[i] for i in self.ids.values()) - 10.0
        self.seen, self.seen_before = {}, {}
        self.word, self.last, self.cost = "", [-1], [0.0]
        self.passed, self.passed_before = {}, {}

    @classmethod
    def of(cls, path: str) -> Transducer:
        held = process_cache("transducers")
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def normalise(self, text: str) -> str:
        text = text.replace(BLANK, " ")
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return " " + text if self.prefix and text else text

    def merged(self, letters: str) -> list[str]:
        """The letters, merged pair by pair: the best-scored piece first, the leftmost of equals."""
        parts = list(letters)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def letters(self, i: int) -> str:
        """Letters of an arc: of a piece, or of a single letter without one; none for -1."""
        return "" if i < 0 else self.pieces[i] if i < len(self.pieces) else chr(i - len(self.pieces))

    def passes(self, a: int, b: int) -> bool:
        """The factor over neighbours: arc ``a`` then ``b`` may stand side by side; with -1 for ``a``, b stands alone."""
        key = a << 32 | b
        known = self.passed_before.get(key)
        if known is None:
            left, right = self.letters(a), self.letters(b)
            known = self.merged(left + right) == ([left, right] if left else [right])
        if len(self.passed) >= PAIRS:
            self.passed, self.passed_before = {}, self.passed
        self.passed[key] = known
        return known

    def path(self, word: str) -> list[int]:
        """Arcs on the shortest path for a word whose blanks are piece letters.

        The best way to a place depends on what is before it alone, so a word begins where it first differs from the one before.
        """
        n, same, other = len(word), 0, self.word
        for x, y in zip(word, other):
            if x != y:
                break
            same += 1
        last: list[int] = self.last[: same + 1] + [-1] * (n - same)
        cost = self.cost[: same + 1] + [float("inf")] * (n - same) if self.model == UNIGRAM else self.cost
        self.word, self.last, self.cost = word, last, cost
        (self._admitted if self.model == BPE else self._lightest)(word, same, last, cost)
        out, end = [], n
        while end:
            i = last[end]
            out.append(i)
            end -= len(self.pieces[i]) if i < len(self.pieces) else 1
        return out[::-1]

    def _admitted(self, word: str, same: int, last: list[int], _: list[float]) -> None:
        """BPE: one arc is admitted to each place, so weights need no comparing."""
        endings, single, passed = self.endings, len(self.pieces), self.passed
        before = last[same]
        for start in range(same, len(word)):
            # arcs that end behind this letter: backwards through the trie; a single letter always has one
            letter = word[start]
            node = endings.get(letter)
            i = single + ord(letter) if node is None or None not in node else node[None]
            at = start
            while True:
                if i is not None:
                    known = passed.get(before << 32 | i)
                    if known is None:
                        known = self.passes(before, i)
                        passed = self.passed
                    if known:
                        break
                while True:
                    at -= 1
                    node = node[word[at]]
                    if None in node:
                        break
                i, before = node[None], last[at]
            last[start + 1] = before = i

    def _lightest(self, word: str, same: int, last: list[int], cost: list[float]) -> None:
        """Unigram: the arc with the least weight up to each place, the shortest of equals."""
        endings, single = self.endings, len(self.pieces)
        for end in range(same + 1, len(word) + 1):
            start = end - 1
            node = endings.get(word[start])
            if node is None or None not in node:
                cost[end], last[end] = cost[start] - self.floor, single + ord(word[start])
            else:
                cost[end], last[end] = cost[start] - self.score[node[None]], node[None]
            while node is not None and start > 0:
                start -= 1
                node = node.get(word[start])
                if node is not None and None in node and (weight := cost[start] - self.score[node[None]]) < cost[end]:
                    cost[end], last[end] = weight, node[None]

    def _word(self, word: str) -> bytes:
        ids = self.path(word.replace(" ", BLANK) if self.escape else word)
        known = len(self.pieces)
        if ids and max(ids) >= known:
            spelt: list[int] = []
            for i in ids:
                if i < known:
                    spelt.append(i)
                elif self.bytes:
                    spelt += [self.bytes[b] for b in chr(i - known).encode()]
                else:
                    spelt.append(self.unknown)
            ids = spelt
        return struct.pack(f"<{len(ids)}i", *ids)

    def words(self, text: str | None) -> tuple[bool, list[str]]:
        """Words of a text; with True each has one blank before it that is not spelled out."""
        text = self.normalise(text or "")
        if text[:1] == " " and "  " not in text and text[-1] != " ":
            return True, text[1:].split(" ")
        return False, re.findall(" +[^ ]*|[^ ]+", text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of texts. A word, with the blanks before it, is composed on its own: no piece reaches over."""
        split = [self.words(t) for t in texts]
        if len(self.seen) > REMEMBERED:  # what is not asked for again goes with the older half
            self.seen, self.seen_before = {}, self.seen
        seen, before, held = self.seen, self.seen_before, {}
        new = set().union(*(w for simple, w in split if simple)).difference(seen)
        again = new.intersection(before)
        seen.update((w, before[w]) for w in again)
        room = max(0, 2 * REMEMBERED - len(seen))
        for k, w in enumerate(sorted(new - again)):  # neighbours share their beginnings
            (seen if len(w) <= LONGEST and k < room else held)[w] = self._word(" " + w)
        out = []
        for simple, words in split:
            if not simple:
                raw = b"".join([self._word(w) for w in words])
            elif held and not held.keys().isdisjoint(words):
                raw = b"".join([held[w] if w in held else seen[w] for w in words])
            else:
                raw = b"".join([seen[w] for w in words])
            out.append(np.frombuffer(raw, "<i4"))
        return out

    def decode(self, ids) -> str:
        """The text of ids: pieces side by side, bytes as UTF-8, the blank in front removed. Broken bytes become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        if not self.high[ids].any():
            text = "".join([self.shown[i] for i in ids.tolist()])
            return text[1:] if self.prefix and text[:1] == " " else text
        out: list[str] = []
        raw = bytearray()
        for i in ids.tolist():
            if self.kind[i] == BYTE:
                raw.append(int(self.pieces[i][1:-1], 16))
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw = bytearray()
            out.append(self.shown[i])
        if raw:
            out.append(raw.decode(errors="replace"))
        text = "".join(out)
        return text[1:] if self.prefix and text[:1] == " " else text


def encode(text: Column, path: str | None = None) -> Column:
    """Ids of a text column as an array of int; null and empty texts have none."""
    path = path or default_path()

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = Transducer.of(path)
        for batch in batches:
            texts = batch.tolist()
            parts = (t.encode(texts[at : at + TOGETHER]) for at in range(0, len(texts), TOGETHER))
            yield pd.Series([ids for part in parts for ids in part], dtype=object)

    return run(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of an array of ids; null is null."""
    path = path or default_path()

    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = Transducer.of(path)
        for batch in batches:
            yield pd.Series([None if x is None else t.decode(x) for x in batch], dtype=object)

    return run(ids)


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(start, number) of parts of a batch, of ``TOGETHER`` texts and ``BYTES`` bytes at most, or one longer text."""
    at = 0
    while at < len(sizes):
        n, held = 0, 0
        while at + n < len(sizes) and n < TOGETHER and (n == 0 or held + sizes[at + n] <= BYTES):
            held, n = held + sizes[at + n], n + 1
        yield at, n
        at += n


def transcode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row its id and text, ``ids`` and ``back``, the text that the ids decode to, both from one pass over the rows.

    A null text has no ids and an empty text back. A task holds the ids of one block of texts at a time, whatever the size of a batch.
    """
    path = path or default_path()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Transducer.of(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for start, n in _blocks(sizes):
                part = batch.slice(start, n)
                ids = t.encode([x or "" for x in part.column("text").to_pylist()])
                back = pa.array([t.decode(x) for x in ids], pa.string())
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                coded = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text"), coded, back], ["id", "text", "ids", "back"])

    added = [StructField("ids", ArrayType(IntegerType())), StructField("back", StringType())]
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *added]))
