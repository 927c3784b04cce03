"""Quality by compression: how much better do texts compress after good than after bad examples?

Two zstandard dictionaries are built from a bounded sample of labelled texts. Every whole text is
compressed in pieces with each, so that long texts don't only learn from themselves. The normalised
difference of the sizes, with the compressed share of the text beside it (noise and repetition
differ from prose in that), is calibrated to a probability by logistic regression on another bounded
sample. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored

#: Bounds of the fit: labelled documents of each class for the dictionaries, of both for the
#: calibration, and pieces of each class's whole texts that a dictionary is trained on.
EXAMPLES, CALIBRATION, PIECES = 1500, 4000, 4000
DICTIONARY = 112 * 1024
PIECE = 2048  # bytes
LEVEL = 3
ACCEPT = 0.7
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def held_out(id_col: str = "doc_id"):
    """Rows whose labels the fit never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; of too few pieces to train on, the pieces themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)


class Sizes:
    """Compressed sizes of a text after each dictionary, as features."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.both = [self._compressor(x) for x in (good, bad)]

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        known = None
        if len(data) >= 8:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)

    def features(self, text: bytes | None) -> tuple[float, float, float]:
        pieces = _pieces(text or b"")
        good, bad = (sum(len(c.compress(p)) for p in pieces) + 8 for c in self.both)
        return 1.0, float(np.log(bad / good)), float(np.log(good / (len(text or b"") + 8)))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
        w += step * min(1.0, 4 / (1e-9 + np.abs(step).max()))
    return tuple(map(float, w))


def _chosen_pieces(rows: DataFrame) -> list[bytes]:
    """At most ``PIECES`` pieces of the whole texts in ``rows`` (doc_id, text), those with the least hashes."""
    at = F.sequence(F.lit(0), F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / PIECE).cast("int"))
    hashes = rows.select(F.explode(F.transform(at, lambda i: F.xxhash64("doc_id", i))).alias("h"))
    cut = hashes.orderBy("h").limit(PIECES).agg(F.max("h")).first()[0]
    if cut is None:
        return []
    low = F.filter(at, lambda i: F.xxhash64("doc_id", i) <= cut)
    cutout = F.transform(low, lambda i: F.struct(F.xxhash64("doc_id", i).alias("h"), F.substring("text", i * PIECE + 1, F.lit(PIECE)).alias("piece")))
    found = rows.select(F.explode(cutout).alias("x")).select("x.h", "x.piece").collect()
    return [bytes(r.piece) for r in sorted(found)]


def _measured(sizes: tuple[bytes, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Sizes(*sizes)
        for batch in batches:
            x = np.array([measure.features(t.as_py())[1:] for t in batch.column(3)], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(x[:, 0]), pa.array(x[:, 1])], names=["doc_id", "label", "example", "change", "share"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Labels outside 0 and 1, of held-out rows, of ids that are labelled both ways, without id or without
    document are not used. Of an id with several texts the least counts. Whole texts are measured where they
    are; the driver gets at most ``PIECES`` pieces of ``PIECE`` bytes of each class, and two numbers a document.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("other")
    )
    usable = usable.where("label = other").select("doc_id", "label")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    examples = {(r.doc_id, r.label) for k in (0, 1) for r in usable.where(F.col("label") == k).orderBy(*order).limit(EXAMPLES).collect()}
    others = {(r.doc_id, r.label) for r in usable.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(CALIBRATION).collect()}
    chosen = sorted([(*x, True) for x in examples] + [(*x, False) for x in others - examples])
    # At most 2 * EXAMPLES + CALIBRATION ids.
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int, example boolean")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id").where("text is not null")
    rows = stored(rows.groupBy("doc_id", "label", "example").agg(F.min("text").alias("text")), "labelled")
    good, bad = (_dictionary(_chosen_pieces(rows.where(F.col("example") & (F.col("label") == k)))) for k in (1, 0))
    measured = rows.mapInArrow(_measured((good, bad)), "doc_id long, label int, example boolean, change double, share double")
    measured = sorted(measured.collect())
    rest = [r for r in measured if not r.example]
    if len({r.label for r in rest}) < 2:
        rest = [r for r in measured if r.example]
    if not rest:
        return Model(good, bad, (0.0, 0.0, 0.0))
    x = np.array([(1.0, r.change, r.share) for r in rest])
    return Model(good, bad, _fit(x, np.array([r.label for r in rest], float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from its whole text alone.

    Null and empty texts get the score of an empty text; rows without an id or that repeat one are
    scored like others; without any labels all scores are 0.5; an empty table gives no rows.
    """
    good, bad, weights = model.good, model.bad, np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            z = [float(np.dot(sizes.features(t.as_py()), weights)) for t in batch.column(2)]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def filter_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text is accepted, with all their columns; judged while they are read."""
    good, bad, weights = model.good, model.bad, np.array(model.weights)
    least = float(np.log(ACCEPT / (1 - ACCEPT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary())
            yield batch.filter(pa.array([float(np.dot(sizes.features(t.as_py()), weights)) >= least for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
