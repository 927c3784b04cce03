"""Web archives: distributed writing, and reading in splits with boundary-chain verification.

A record starts with a magic word that may as well stand inside a payload. So no split trusts what it
finds: each task takes every place that looks like a header as a candidate, with the offset where its
record would end, and follows these offsets to the end of its split. Pointer jumping over the splits,
from the start of each file, keeps the places that are reached; records are read from there only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import new_place, stored

# Fixed values of the format.
MAGIC = b"WARC/1."
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SPLIT = 8 << 20
HEAD = 64 << 10

MANIFEST = "path string, bytes long, records long"
JUMPS = "path string, place long, exit long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, intact boolean"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Payload-Length", str(len(payload))),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for page_id, url, html, refers_to, revisit in zip(*columns, strict=True):
                if out is None:
                    files, at = pafs.FileSystem.from_uri(folder)
                    files.create_dir(at, recursive=True)
                    name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc"
                    path, out = f"{folder}/{name}", files.open_output_stream(f"{at}/{name}")
                data = record(page_id.as_py(), url.as_py(), html.as_py() or b"", refers_to.as_py(), revisit.as_py(), date)
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})

    return run


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, date: str = "2025-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write a record per row into archives below ``folder``; returns the manifest, one row a file.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest id is the
    response and the others revisit it. Null payloads are empty. Rows without an id can revisit,
    but are not referred to; rows that repeat the smallest id are all responses.
    """
    payload = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    sums = rows.where(F.length("html") >= least).select("page_id", "sha1")
    first = sums.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    # Only revisits are kept; their size tells the planner how to join them to the pages.
    again = stored(sums.join(first, "sha1").where("not page_id <=> refers_to").select("page_id", "sha1", "refers_to").distinct(), "revisits")
    known = again.select(F.col("page_id").alias("id"), F.col("sha1").alias("sum"), "refers_to")
    typed = rows.join(known, rows.page_id.eqNullSafe(known.id) & (rows.sha1 == known["sum"]), "left")
    typed = typed.select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    return stored(typed.mapInArrow(_write(folder, date), MANIFEST), "warc-manifest")


class _Bytes:
    """A stretch of a file that grows at its end as it is needed."""

    def __init__(self, path: str, start: int, end: int) -> None:
        files, at = pafs.FileSystem.from_uri(path)
        self.file = files.open_input_file(at)
        self.size = self.file.size()
        self.start = start
        self.data = self.file.read_at(max(0, min(end, self.size) - start), start)

    def until(self, end: int) -> bytes:
        have = self.start + len(self.data)
        if have < min(end, self.size):
            self.data += self.file.read_at(min(end, self.size) - have, have)
        return self.data


def _header(source: _Bytes, at: int) -> tuple[dict[str, str], int, int] | None:
    """(fields, start of the block, end of the record) of a header at ``at``, if it is one."""
    reach = HEAD
    while True:
        data = source.until(at + reach)
        end = data.find(b"\r\n\r\n", at - source.start)
        if end >= 0 or at + reach >= source.size:
            break
        reach *= 4
    if end < 0:
        return None
    lines = data[at - source.start : end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        return None
    block = source.start + end + 4
    after = block + int(length) + 4
    return (fields, block, after) if after <= source.size else None


def candidates(source: _Bytes, start: int, end: int) -> dict[int, int]:
    """Each place in ``[start, end)`` that looks like a record, and the place behind that record."""
    out, at = {}, source.data.find(MAGIC)
    while 0 <= at and source.start + at < end:
        place = source.start + at
        if place >= start and (found := _header(source, place)):
            out[place] = found[2]
        at = source.data.find(MAGIC, at + 1)
    return out


def _jumps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            next_of = candidates(_Bytes(path, start, end + HEAD), start, end)
            exits: dict[int, int | None] = {}
            for place in sorted(next_of, reverse=True):
                after = next_of[place]
                exits[place] = after if after >= end else exits.get(after)
            rows = [(path, p, e) for p, e in exits.items() if e is not None]
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "place", "exit"]
            )


def reachable(jumps: DataFrame, starts: DataFrame) -> DataFrame:
    """(path, place) of all that is reached from ``starts`` along ``jumps`` (path, place, exit), by
    pointer jumping: each round doubles the length of the jumps."""
    reached, n = starts.select("path", "place"), -1
    while True:
        step = reached.join(jumps, ["path", "place"]).select("path", F.col("exit").alias("place"))
        reached = stored(reached.unionAll(step).distinct(), "reached")
        before, n = n, reached.count()
        if n == before:
            return reached
        on = jumps.select("path", F.col("place").alias("exit"), F.col("exit").alias("further"))
        jumps = stored(jumps.join(on, ["path", "exit"]).select("path", "place", F.col("further").alias("exit")), "jumps")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in RECORDS.split(", ")]
    for batch in batches:
        for path, place, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            source, rows = _Bytes(path, place, end + HEAD), []
            while place < end and (found := _header(source, place)):
                fields, block, after = found
                data = source.until(after)[block - source.start : after - 4 - source.start]
                told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                size, kind = int(fields.get("warc-payload-length", -1)), fields.get("warc-type")
                intact = True
                if kind == "response":
                    payload = data.partition(b"\r\n\r\n")[2]
                    size, own = len(payload), digest(payload)
                    intact, told = own == told, own
                rows.append((_page(fields.get("warc-record-id")), size, told, kind, _page(fields.get("warc-refers-to")), fields.get("warc-target-uri"), intact))
                place = after
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_archives(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """The records of archives ``files`` (path, bytes), from splits of ``split`` bytes.

    What the chain from a file's start doesn't reach is no record: magic words inside payloads, and
    what follows a damaged header. Lengths and digests of responses are those of the payloads read;
    revisits carry them in their headers.
    """
    last = F.greatest(F.ceil(F.col("bytes") / split) - 1, F.lit(0)).cast("long")
    splits = files.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("n"))
    splits = splits.select("path", (F.col("n") * split).alias("start"), ((F.col("n") + 1) * split).alias("end"))
    tasks = max(1, splits.count())
    found = stored(splits.repartition(tasks, "path", "start").mapInArrow(_jumps, JUMPS), "candidates")
    starts = files.select("path", F.lit(0).cast("long").alias("place"))
    entries = starts.unionAll(found.select("path", F.col("exit").alias("place"))).distinct()
    jumps = stored(found.join(entries, ["path", "place"], "left_semi"), "jumps")
    reached = reachable(jumps, starts)
    end = (F.floor(F.col("place") / split) + 1) * split
    return reached.select("path", "place", end.alias("end")).repartition(tasks, "path", "place").mapInArrow(_read, RECORDS)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, url, intact.

    An empty table gives no archives and no rows; other columns are ignored.
    """
    manifest = write_archives(pages, new_place(pages.sparkSession, "warc"), least)
    return read_archives(manifest.select("path", "bytes"))
