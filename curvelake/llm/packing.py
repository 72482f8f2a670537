"""Packing documents into sequences of fixed length, online and in bounded space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.tokens import Encoder, default_path
from curvelake.session import materialize

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Partitions whose leftover windows are merged by one task: at most GROUP * windows * size ids.
GROUP = 256

#: Sequence ids are a partition's number times this plus a running number.
RANGE = 1 << 36


class Windows:
    """A fixed number of open windows. A piece goes to the window that it fills best. If none can take
    it, the fullest window is emitted: its gap is filled by cutting the piece, unless the gap is shorter than
    ``least`` ids."""

    def __init__(self, size: int, windows: int, least: int, first_id: int):
        self.size, self.windows, self.least, self.next_id = size, windows, least, first_id
        self.open: list[list] = []  # [ids used, sequence id]

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts of a document of n ids."""
        at = 0
        while n - at >= self.size:
            yield at, self.size, self._new(), 0
            at += self.size
        while at < n:
            rest = n - at
            fits = [w for w in self.open if w[0] + rest <= self.size]
            if fits:
                best = max(fits)
            elif len(self.open) < self.windows:
                best = [0, self._new()]
                self.open.append(best)
            else:
                best = max(self.open)
                self.open.remove(best)
                if self.size - best[0] < self.least:
                    continue
                rest = self.size - best[0]
            yield at, rest, best[1], best[0]
            best[0] += rest
            at += rest
            if best[0] == self.size and best in self.open:
                self.open.remove(best)


def pour(fills: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Moves (from sequence, at, length, to sequence, offset) that empty the emptiest windows into the gaps of the
    fullest, until at most one is left with a gap. At most half of the ids move."""
    order = sorted(fills, key=lambda s: (-fills[s], s))
    used, moves, i, j = dict(fills), [], 0, len(order) - 1
    taken = 0
    while i < j:
        to, source = order[i], order[j]
        n = min(size - used[to], fills[source] - taken)
        if n:
            moves.append((source, taken, n, to, used[to]))
            used[to] += n
            taken += n
        if used[to] == size:
            i += 1
        if taken == fills[source]:
            j, taken = j - 1, 0
    if i == j and taken:  # the last window lost its beginning: what is left moves to the front
        moves.append((order[j], taken, fills[order[j]] - taken, order[j], 0))
    return moves


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    size: int = 2048,
    end_id: int = 1,
    windows: int = 16,
    least: int = 32,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the piece's ``ids``.

    A document is its token ids and ``end_id``; a null or empty text is ``end_id`` alone. Each id lies in one
    piece, the pieces of a sequence lie side by side from offset 0. Documents longer than a sequence give
    whole sequences first. Repeated rows are packed each; a null id stays null. A partition
    keeps ``windows`` open windows; what they hold at its end is merged between partitions by cutting, so at most
    one sequence per GROUP partitions ends with a gap of its own, besides gaps under ``least`` ids.
    """
    path = tokenizer or default_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        encoder, w = Encoder.of(path), Windows(size, windows, least, part * RANGE)
        pending: dict[int, list] = {}

        def row(d, ids, s, n, q, o, is_open):
            cut = ids[s : s + n]
            raw = cut.tobytes()
            keep = raw if is_open or with_ids else None
            return (d, s, n, zlib.crc32(raw), len(ids), q, o, keep, is_open)

        def frame(rows):
            return pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "raw", "open"]).assign(
                part=part, doc_id=lambda f: f["doc_id"].astype("Int64")
            )

        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                done = []
                for d, ids in zip(some["doc_id"].tolist(), encoder.encode([t or "" for t in some["text"]])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for s, n, q, o in w.place(len(ids)):
                        (pending.setdefault(q, []) if n < size else done).append(row(d, ids, s, n, q, o, True))
                held = {q for _, q in w.open}
                for q in [q for q in pending if q not in held]:
                    done += [(*r[:7], r[7] if with_ids else None, False) for r in pending.pop(q)]
                done = [(*r[:7], r[7] if with_ids else None, False) for r in done]
                if done:
                    yield frame(done)
        if pending:
            yield frame([r for rows in pending.values() for r in rows])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sequence_id", "offset"])
        fills = rows.groupby("sequence_id")["length"].sum().to_dict()
        moves: dict[int, list] = {}
        for source, at, n, to, offset in pour(fills, size):
            moves.setdefault(source, []).append((at, n, to, offset))
        out = []
        for r in rows.itertuples(index=False):
            spans = moves.get(r.sequence_id, [])
            ids, left = np.frombuffer(r.raw, "<u4"), [(r.offset, r.offset + r.length)]
            for at, n, to, offset in spans:
                a, b = max(at, r.offset), min(at + n, r.offset + r.length)
                if a < b:
                    raw = ids[a - r.offset : b - r.offset].tobytes()
                    out.append((r.doc_id, r.start + a - r.offset, b - a, zlib.crc32(raw), r.doc_tokens, to, offset + a - at, raw))
                    left = [p for x, y in left for p in ((x, min(y, a)), (max(x, b), y)) if p[0] < p[1]]
            for a, b in left:
                raw = ids[a - r.offset : b - r.offset].tobytes()
                out.append((r.doc_id, r.start + a - r.offset, b - a, zlib.crc32(raw), r.doc_tokens, r.sequence_id, a, raw))
        frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "raw"])
        return frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(rows.mapInPandas(run, f"{PIECE}, raw binary, open boolean, part long"))
    leftovers = pieces.where("open").drop("open")
    merged = leftovers.groupBy(F.floor(F.col("part") / GROUP).alias("g")).applyInPandas(merge, f"{PIECE}, raw binary")
    both = pieces.where("not open").drop("open", "part").unionByName(merged)
    return both.withColumnRenamed("raw", "ids") if with_ids else both.drop("raw")
