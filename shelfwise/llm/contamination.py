"""Benchmark decontamination with a distributed positional inverted index.

1. Counts of the benchmark's terms over the corpus tell the two rarest terms of each window.
2. The index holds the postings (document, positions) of exactly these terms, from one pass over
   the whole texts; terms go to the tasks in blocks of bounded size, one pass per block.
3. The offset-adjusted lists of the two terms are intersected: both must put the item at the same
   place of the same document. The rarest list comes first, so what is left is small.
4. Each such place is read in the whole texts: runs of equal words that hold a window are hits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored
from shelfwise.llm.words import alnum_words

WINDOW = 13
SHARE = 20  # contaminated: at least one word of 20 is hit
#: Terms that are sent to the tasks at once; more terms take more passes.
TERMS = 500_000

INDEX = "row long, doc_id long, n_words long, postings array<struct<term binary, positions array<int>>>"
FOUND = "row long, n_hit long, item_ids array<string>, near_ids array<string>"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """With ``row``, which tells rows apart that repeat an id or have none."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")
    return docs.select(F.xxhash64(doc_id, text).alias("row"), doc_id.alias("doc_id"), text.alias("text"))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [alnum_words(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.binary()))], names=["item", "item_id", "words"]
            )

    named = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    keyed = named.where("item_id is not null").distinct().select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    return keyed.mapInArrow(split, "item long, item_id string, words array<binary>").where("size(words) > 0")


def _blocks(terms: DataFrame) -> Iterator[set[bytes]]:
    """The terms, in sets of about TERMS."""
    parts = -(-terms.count() // TERMS)
    for part in range(parts):
        chosen = terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part)
        yield {bytes(r[0]) for r in chosen.toLocalIterator()}


def _count(terms: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(filter(terms.__contains__, alnum_words(text.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
        )

    return run


def _index(terms: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, postings = [], []
            for text in batch.column(2):
                words = alnum_words(text.as_py())
                lists: dict[bytes, list[int]] = {}
                for i, word in enumerate(words):
                    if word in terms:
                        lists.setdefault(word, []).append(i)
                sizes.append(len(words))
                postings.append([{"term": t, "positions": p} for t, p in lists.items()])
            kind = pa.list_(pa.struct([("term", pa.binary()), ("positions", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(postings, kind)],
                names=["row", "doc_id", "n_words", "postings"],
            )

    return run


def _probes(window: int):
    """Per item the pairs of rarest terms of its windows, with their places in the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for item, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = {e["p"]: e["n"] for e in entries}
                terms = {e["p"]: e["term"] for e in entries}
                length = min(window, len(entries))
                for start in range(len(entries) - length + 1):
                    places = range(start, start + length)
                    if all(counts[p] for p in places):
                        a, *rest = sorted(places, key=lambda p: (counts[p], p))
                        b = rest[0] if rest else a
                        out.add((item, a, terms[a], b, terms[b]))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "p1", "t1", "p2", "t2"]
            )

    return run


def exact_runs(doc: list[bytes], item: list[bytes], shift: int, window: int) -> list[tuple[int, int]]:
    """Stretches of the document that hold a window of the item whose first word is at ``shift``."""
    need, out, run = min(window, len(item)), [], 0
    first, last = max(0, -shift), min(len(item), len(doc) - shift)
    for p in range(first, last + 1):
        if p < last and doc[shift + p] == item[p]:
            run += 1
        else:
            if run >= need:
                out.append((shift + p - run, shift + p))
            run = 0
    return out


def near(doc: list[bytes], item: list[bytes], shift: int, window: int, slop: int) -> bool:
    """Whether some window's words occur in order, within ``slop`` words more than the window has."""
    need = min(window, len(item))
    for w in range(len(item) - need + 1):
        for start in range(max(0, shift + w - slop), max(0, min(len(doc), shift + w + slop + 1))):
            rest = iter(doc[start : start + need + slop])
            if all(word in rest for word in item[w : w + need]):
                return True
    return False


def _verify(window: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                doc, hit, found, close = alnum_words(text.as_py()), set(), set(), set()
                for place in places.as_py():
                    for shift in place["shifts"]:
                        spans = exact_runs(doc, place["words"], shift, window)
                        for a, b in spans:
                            hit.update(range(a, b))
                        if spans:
                            found.add(place["item_id"])
                        elif slop and near(doc, place["words"], shift, window, slop):
                            close.add(place["item_id"])
                rows.append((row, len(hit), sorted(found), sorted(close - found)))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "n_hit", "item_ids", "near_ids"]
            )

    return run


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, near_ids.

    ``near_ids``: with a ``slop``, items that only occur with up to so many words in between (found
    where the two rarest terms stand within ``slop`` of each other's place). Null and empty texts
    have no words and are not contaminated; items without id or words are ignored; rows that repeat
    or lack an id are judged one by one; empty tables give no rows, or rows without hits.
    """
    rows = _rows(docs, id_col, text_col)
    listed = stored(_items(items, item_id_col, item_text_col), "items")
    places = listed.select("item", F.posexplode("words").alias("p", "term"))
    counted = _union(
        [rows.select("text").mapInArrow(_count(terms), "term binary, n long") for terms in _blocks(places.select("term").distinct())],
        rows, "term binary, n long",
    )
    counts = stored(counted.groupBy("term").agg(F.sum("n").alias("n")), "term-counts")
    entries = places.join(counts, "term", "left").select("item", "p", "term", F.coalesce("n", F.lit(0)).alias("n"))
    ordered = entries.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("p", "term", "n"))).alias("entries"))
    probes = stored(ordered.mapInArrow(_probes(window), "item long, p1 int, t1 binary, p2 int, t2 binary"), "probes")

    chosen = probes.select(F.col("t1").alias("term")).unionAll(probes.select("t2")).distinct()
    parts = [rows.mapInArrow(_index(terms), INDEX) for terms in _blocks(chosen)] or [rows.mapInArrow(_index(set()), INDEX)]
    indexes = [stored(part, "postings") for part in parts]
    postings = _union([i.select("row", F.explode("postings").alias("x")) for i in indexes], rows, "").select(
        "row", "x.term", F.explode("x.positions").alias("pos")
    ).distinct()

    first = probes.join(postings, probes.t1 == postings.term).select(
        "row", "item", (F.col("pos") - F.col("p1")).alias("shift"), "t2", "p2"
    )
    second = postings.select(F.col("row").alias("row2"), F.col("term").alias("term2"), F.col("pos").alias("pos2"))
    there = F.col("shift") + F.col("p2")
    same = (F.col("row") == F.col("row2")) & (F.col("t2") == F.col("term2"))
    met = same & ((F.abs(F.col("pos2") - there) <= slop) if slop else (F.col("pos2") == there))
    shifts = first.join(second, met, "left_semi").groupBy("row", "item").agg(F.collect_set("shift").alias("shifts"))
    by_doc = shifts.join(listed, "item").groupBy("row").agg(F.collect_list(F.struct("item_id", "words", "shifts")).alias("places"))
    by_doc = stored(by_doc, "places")
    texts = by_doc.join(rows.select("row", "text"), "row").select("row", "text", "places")
    hits = texts.mapInArrow(_verify(window, slop), FOUND).dropDuplicates(["row"])

    out = indexes[0].select("row", "doc_id", "n_words").join(hits, "row", "left")
    none = F.array().cast("array<string>")
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("item_ids", none)
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ids)).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(SHARE) * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("near_ids", none).alias("near_ids"),
    )


def _union(parts: list[DataFrame], rows: DataFrame, schema: str) -> DataFrame:
    """All parts; without any, an empty table."""
    out = parts[0] if parts else rows.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionAll(part)
    return out
