"""Hierarchical packing of documents into training sequences of several lengths.

Each task packs the documents of its partition while it reads them, so nothing is shuffled and no
document is encoded twice. Whole windows of the longest tier are cut off long documents; what is
left of a document waits in a bounded pool. The longest piece of the pool is routed to the
smallest tier that holds it, and opens a window there. The gap behind it is filled with the
longest pieces of shorter tiers that fit, at last with a piece cut to size. Only the last window of
a task can stay short. Windows of one tier are dealt to step groups of equal tokens, so that the
groups of a deal have about the same attention cost (sum of squared piece lengths).
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tokens import encoder

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
POOL = 2048  # pieces that wait
GROUPS = 4  # step groups that are balanced against each other

PIECES = pa.schema(
    [
        *((n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        ("tier", pa.int32()), ("step_id", pa.int64()),
    ]
)
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_id long"
)


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:length], self.doc_tokens),
            Piece(self.doc_id, self.start + length, self.ids[length:], self.doc_tokens),
        )


class Packer:
    def __init__(self, tiers: tuple[int, ...], step_tokens: int, pool: int, first: int) -> None:
        self.tiers, self.step_tokens, self.pool = tiers, step_tokens, pool
        self.waiting: list[tuple[int, int, Piece]] = []
        self.windows: dict[int, list[list[Piece]]] = {t: [] for t in tiers}
        self.entered = 0
        self.sequences = self.steps = first

    def add(self, piece: Piece) -> Iterator[tuple]:
        longest = self.tiers[-1]
        while len(piece.ids) >= longest:
            window, piece = piece.cut(longest)
            yield from self._close([window], longest)
        if len(piece.ids):
            self._wait(piece)
        while len(self.waiting) > self.pool:
            yield from self._window()

    def finish(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self._window()
        for tier in self.tiers:
            yield from self._deal(tier)

    def _wait(self, piece: Piece) -> None:
        self.entered += 1
        insort(self.waiting, (len(piece.ids), self.entered, piece), key=lambda x: x[:2])

    def _window(self) -> Iterator[tuple]:
        _, _, piece = self.waiting.pop()
        tier = next(t for t in self.tiers if t >= len(piece.ids))
        window, gap = [piece], tier - len(piece.ids)
        while gap and self.waiting:
            fits = bisect_right(self.waiting, gap, key=lambda x: x[0]) - 1
            if fits >= 0:
                piece = self.waiting.pop(fits)[2]
            else:
                piece, rest = self.waiting.pop(0)[2].cut(gap)
                self._wait(rest)
            window.append(piece)
            gap -= len(piece.ids)
        yield from self._close(window, tier)

    def _close(self, window: list[Piece], tier: int) -> Iterator[tuple]:
        self.windows[tier].append(window)
        if len(self.windows[tier]) * tier >= GROUPS * self.step_tokens:
            yield from self._deal(tier)

    def _deal(self, tier: int) -> Iterator[tuple]:
        """Costliest first, to and fro over the groups."""
        windows = sorted(self.windows[tier], key=lambda w: -sum(len(p.ids) ** 2 for p in w))
        self.windows[tier] = []
        groups = max(1, -(-len(windows) * tier // self.step_tokens))
        for i, window in enumerate(windows):
            turn, place = divmod(i, groups)
            step = self.steps + (groups - 1 - place if turn % 2 else place)
            offset = 0
            for p in window:
                yield (p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens, self.sequences, offset, tier, step)
                offset += len(p.ids)
            self.sequences += 1
        self.steps += groups if windows else 0


def pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", spaced: bool = False, end_id: int = 1,
    tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, pool: int = POOL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    A sequence whose pieces add up to its tier needs no padding. A null or empty text is its end id
    alone; documents without an id are packed like others; rows that repeat an id are separate
    documents; an empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaced)
        end = encode.pack([end_id])
        packer = Packer(tiers, step_tokens, pool, TaskContext.get().partitionId() << 33)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(encode.encode(text.as_py()) + end, encode.dtype)
                rows.extend(packer.add(Piece(doc_id, 0, ids, len(ids))))
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
        rows.extend(packer.finish())
        yield _batch(rows)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(PIECES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES)
