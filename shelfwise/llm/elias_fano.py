"""Token-id files whose document boundaries are Elias-Fano encoded.

A file holds the concatenated ids of documents in ascending order of their id, then two
Elias-Fano sequences, the document ids and the ends of the documents, then a JSON footer, its
length and a magic word. Offsets come from select structures (a bit position for every 64th
entry), so no table of 64-bit offsets exists: a boundary costs about 2 + log2(tokens / documents)
bits. Tasks write and read files side by side; positions in the whole corpus are the sums of the
files before, which the manifest holds.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.scratch import new_place, stored
from shelfwise.llm.tokens import encoder

MAGIC = b"EFI1"
EVERY = 64  # ones per select sample

MANIFEST = "first_id long, path string, docs long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of non-negative integers with select in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.n, self.low_bits = n, low_bits
        self.low, self.high = (np.frombuffer(x, np.uint8) for x in (low, high))
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        x = np.asarray(values, dtype=np.uint64)
        n = len(x)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(x[-1]).bit_length() - max(1, n).bit_length())
        ones = (x >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((x[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(
            n, low_bits, np.packbits(low, bitorder="little").tobytes(),
            np.packbits(bits, bitorder="little").tobytes(), ones[::EVERY].astype("<u4").tobytes(),
        )

    def _low(self, i: int, count: int) -> np.ndarray:
        """Low parts of ``count`` entries from ``i`` on."""
        first = i * self.low_bits
        taken = self.low[first // 8 : (first + count * self.low_bits + 7) // 8]
        bits = np.unpackbits(taken, bitorder="little")[first % 8 :][: count * self.low_bits]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(count, self.low_bits).astype(np.uint64) * weights).sum(1, dtype=np.uint64)

    def stretch(self, i: int, count: int) -> np.ndarray:
        """``count`` entries from ``i`` on, all below the next sample: from the sample before them and the
        bits up to the next."""
        at = int(self.samples[i // EVERY])
        until = int(self.samples[i // EVERY + 1]) if i // EVERY + 1 < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[at // 8 : until // 8 + 1], bitorder="little")[at % 8 :]
        ones = at + np.flatnonzero(bits)[i % EVERY : i % EVERY + count]
        high = (ones - np.arange(i, i + count)).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self._low(i, count)

    def select(self, i: int) -> int:
        return int(self.stretch(i, 1)[0])

    def walk(self) -> Iterator[int]:
        """All entries, sample by sample; no more than ``EVERY`` are expanded at a time."""
        for i in range(0, self.n, EVERY):
            yield from self.stretch(i, min(EVERY, self.n - i)).tolist()

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self._low(0, self.n) if self.n else high

    def parts(self) -> tuple[bytes, ...]:
        return self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()

    def nbytes(self) -> int:
        return sum(map(len, self.parts()))


class ShardWriter:
    """One file, written front to back; only the boundaries wait in memory."""

    def __init__(self, folder: str, dtype: np.dtype) -> None:
        files, at = pafs.FileSystem.from_uri(folder)
        files.create_dir(at, recursive=True)
        self.name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.efi"
        self.path = f"{folder}/{self.name}"
        self.out = files.open_output_stream(f"{at}/{self.name}")
        self.dtype, self.ids, self.ends, self.size, self.missing = dtype, [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.size += len(ids) // self.dtype.itemsize
        self.ends.append(self.size)
        if doc_id is None:
            self.missing += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> tuple[int | None, str, int, int]:
        first = self.ids[0] if self.ids else 0
        footer: dict = {"type": self.dtype.str, "missing": self.missing, "first": first}
        for name, values in (
            ("ids", np.array([i - first for i in self.ids], np.uint64)),
            ("ends", np.array(self.ends, np.uint64)),
        ):
            sequence = EliasFano.of(values)
            parts = sequence.parts()
            footer[name] = [sequence.n, sequence.low_bits, *map(len, parts)]
            for part in parts:
                self.out.write(part)
        said = json.dumps(footer).encode()
        self.out.write(said + struct.pack("<I", len(said)) + MAGIC)
        self.out.close()
        return (self.ids[0] if self.ids else None), self.path, len(self.ends), self.size


class Shard:
    """Random access to one file: ``document(i)`` reads only that document's ids."""

    def __init__(self, path: str) -> None:
        files, at = pafs.FileSystem.from_uri(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        tail = self.file.read_at(8, size - 8)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a token-id file, or was cut off")
        said = struct.unpack("<I", tail[:4])[0]
        footer = json.loads(self.file.read_at(said, size - 8 - said))
        self.dtype, self.missing, self.first = np.dtype(footer["type"]), footer["missing"], footer["first"]
        lengths = footer["ids"][2:] + footer["ends"][2:]
        block = self.file.read_at(sum(lengths), size - 8 - said - sum(lengths))
        cuts = [0, *np.cumsum(lengths).tolist()]
        parts = [block[a:b] for a, b in pairwise(cuts)]
        self.ids = EliasFano(*footer["ids"][:2], *parts[:3])
        self.ends = EliasFano(*footer["ends"][:2], *parts[3:])

    def __len__(self) -> int:
        return self.ends.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.missing else self.first + self.ids.select(i - self.missing)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def read(self, start: int, end: int) -> np.ndarray:
        step = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * step, start * step), self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.read(*self.span(i))

    def documents(self, read: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of all documents, read in pieces of some ``read`` tokens. Boundaries come
        from the select samples in short runs and are never expanded as a whole."""
        ids = chain(repeat(None, self.missing), (self.first + x for x in self.ids.walk()))
        start, waiting = 0, []
        for doc_id, end in zip(ids, self.ends.walk(), strict=True):
            if waiting and end - waiting[0][1] > read:
                yield from self._read_all(waiting)
                waiting = []
            waiting.append((doc_id, start, end))
            start = end
        yield from self._read_all(waiting)

    def _read_all(self, waiting: list[tuple[int | None, int, int]]) -> Iterator[tuple[int | None, int, np.ndarray]]:
        if waiting:
            first = waiting[0][1]
            block = self.read(first, waiting[-1][2])
            for doc_id, start, end in waiting:
                yield doc_id, start, block[start - first : end - first]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", spaced: bool = True, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write all documents into files below ``folder``; returns the manifest, one row a file, with
    ``base``, the number of ids in the files before it.

    A null or empty text is its end id alone. Documents without an id come first. Rows that repeat
    an id are each written, in the order of their texts. An empty table gives an empty manifest.
    """
    end = encoder(tokenizer, spaced).pack([end_id])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer, spaced), None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = shard or ShardWriter(folder, encode.dtype)
                shard.add(doc_id, encode.encode(text.as_py()) + end)
        if shard:
            row = shard.close()
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("first_id", "path", "docs", "tokens"), row, strict=True)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ordered.mapInArrow(write, MANIFEST), "ids-manifest")
    # One row a file: a few bytes for each 100 MB of ids.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: its place in the whole corpus, its length and a check sum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(k).to_pylist() for k in ("path", "base")), strict=True):
                rows: list[tuple] = []
                for doc_id, start, ids in Shard(path).documents():
                    rows.append((doc_id, base + start, len(ids), crc(ids)))
                    if len(rows) == 10_000:
                        yield _documents(rows)
                        rows = []
                yield _documents(rows)

    files = max(1, manifest.count())
    return manifest.select("path", "base").repartition(files, "path").mapInArrow(read, DOCUMENTS)


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def token_files(docs: DataFrame) -> DataFrame:
    """Encode, write, read back: doc_id, start, n_tokens, ids_crc32."""
    return read_ids(write_ids(docs, new_place(docs.sparkSession, "ids")))
