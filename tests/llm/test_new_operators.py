"""Chat formatting, hard negatives and clustering against brute force, on odd rows, too."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shelfwise.llm import chat, kmeans, negatives

BITS = [
    "</s>", "[INST]", "[/INST]", "<s>", "<", "[", "\\", "\\\\", "/s>", "s>", "<<SYS>>", "<</SYS>>", "INST]", " ", "\n", "é", "ab",
    "😀", "[ROLE]", "[/ROLE]", "[/TURN]", "]",
]
TURNS = "conv_id long, turn long, role string, text string"


# --- chat


def _order(row):
    return [(x is not None, x if x is not None else 0 if i == 0 else "") for i, x in enumerate(row[1:4])]


def _expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=_order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[c] = (len(mine), hashlib.sha256(turns).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _found(formatted):
    return {r[0]: tuple(r)[1:5] for r in chat.digests(formatted).collect()}


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "[INST]", None, "", "a\nb", "</s>"]
    rows = []
    for c in [*range(40), None]:
        for t in range(rng.randint(1, 12)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(BITS) for _ in range(rng.choice([0, 1, 3, 8, 30])))
            rows.append((c, rng.choice([t, t, None]), rng.choice(roles), text))
    return rows + rows[:20]


@pytest.mark.parametrize("part_bytes", [chat.PART, 200, 10])
@pytest.mark.parametrize("records", ["10000", "5"])
def test_chat_comes_back(spark, turns, part_bytes, records):
    """Ties, repeated rows, null ids, turns, roles and texts; conversations in one and in many parts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        formatted = chat.format_chat(spark.createDataFrame(turns, TURNS), part_bytes=part_bytes)
        assert _found(formatted) == _expected(turns)
        assert (formatted.parts is None) == (part_bytes == chat.PART)
        assert formatted.whole.where("part > 0").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chat_text_and_mask(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "é [INST]"), (1, 2, "critic", None)]
    row = chat.format_chat(spark.createDataFrame(rows, TURNS)).rows().first()
    assert row.formatted == "[INST] hi <\\/s> [/INST]\n<s> é [\\INST] </s>\n[ROLE] critic [/ROLE]  [/TURN]\n"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss] == ["é [\\INST]"]


def test_chat_empty_long_and_clashing_names(spark):
    assert chat.digests(chat.format_chat(spark.createDataFrame([], TURNS))).count() == 0
    rows = [(1, t, "assistant", "word [INST] " * 20_000) for t in range(6)] + [(2, 0, "user", "x")]
    df = spark.createDataFrame([(*r, 1, 2, "f") for r in rows], TURNS + ", block int, part int, formatted string")
    formatted = chat.format_chat(df, part_bytes=500_000)
    assert formatted.parts.count() >= 3 and _found(formatted) == _expected(rows)


@given(st.lists(st.lists(st.sampled_from(BITS)).map("".join)))
def test_escapes_are_undone(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    safe, ends = chat.escape(data, offsets, chat.INSTRUCT.controls)
    for a, b in zip(ends, ends[1:], strict=False):
        assert not any(c in safe[a:b].tobytes() for c in chat.INSTRUCT.controls)
    back, same = chat.unescape(safe, ends, chat.INSTRUCT.controls)
    assert back.tobytes() == data.tobytes() and list(same) == list(offsets)


def test_template_rejects_ambiguous_marks():
    with pytest.raises(ValueError, match="inside"):
        chat.Template({"user": ("<a> ", " <b<a>\n")}, chat.INSTRUCT.named)
    with pytest.raises(ValueError, match="white space"):
        chat.Template({"user": ("<a>", " <b>\n")}, chat.INSTRUCT.named)
    with pytest.raises(ValueError, match="template"):
        text = np.frombuffer(b"[INST] open", np.uint8)
        chat.parse(text, np.array([0, len(text)]), chat.INSTRUCT)


# --- vectors

VECTORS = "vec_id long, embedding array<double>, label int, width int, block string"


def _vectors(seed: int, n: int, dims: int, spread: float = 1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    label = rng.integers(0, 6, n)
    v = (centers[label] + spread * rng.normal(size=(n, dims))) * 0.1
    return [(i, [float(x) for x in row], int(c), 1, "b") for i, (row, c) in enumerate(zip(v, label, strict=True))]


ODD = [
    (50, None, 1, 1, "b"), (51, [1.0, None], 1, 1, "b"), (100, [math.inf] * 8, 1, 1, "b"), (None, [0.5] * 8, 1, 1, "b"),
    (101, [math.nan] * 8, 2, 1, "b"), (150, [0.25] * 8, None, 1, "b"), (700, [], 1, 1, "b"), (701, [0.3, 0.2], 3, 1, "b"),
]


def _whole(rows):
    out = []
    for i, v, c, *_ in rows:
        if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, c, tuple(math.floor(256 * x) for x in v)))
    return sorted(set(out))


def _dot(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False))))


def _mined(rows, every, n_pos=5, n_neg=3):
    rows, out = _whole(rows), []
    for i, c, v in rows:
        if i % every:
            continue
        scored = sorted((-_dot(v, w), j, d) for j, d, w in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == c][:n_pos]:
            fits = [(k, -t) for t, k, d in scored if d != c and 50 * -s <= 100 * -t <= 95 * -s][:n_neg]
            out += [(i, j, r, k, -s, t) for r, (k, t) in enumerate(fits, 1)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("block", [4096, 60])
@pytest.mark.parametrize("dims", [8, 70])
def test_negatives(spark, block, dims):
    """All ties, repeated rows, odd rows; in one block and in many."""
    rows = _vectors(dims, 400, dims)
    rows += [(i + 1000, v, c, *more) for i, v, c, *more in rows[:60]] + rows[:30] + ODD
    found = negatives.mined(spark.createDataFrame(rows, VECTORS), every=10, block=block).select(*COLUMNS)
    assert sorted(map(tuple, found.collect())) == _mined(rows, 10)


def test_negatives_of_one_hot_label_and_huge_components(spark):
    rows = _vectors(3, 200, 4)
    hot = [(i, v, 1 if i % 5 else 2, *more) for i, v, c, *more in rows]
    huge = [(i + 500, [x * 1e16 for x in v], i % 2, *more) for i, v, _, *more in rows[:60]]
    same = [(i + 900, [0.5, 0.5], i % 3, 1, "b") for i in range(60)]
    for case in (hot, huge, same, hot[:1], []):
        found = negatives.mined(spark.createDataFrame(case, VECTORS), every=10, block=50).select(*COLUMNS)
        assert sorted(map(tuple, found.collect())) == _mined(case, 10)


def test_intervals_hold_the_scores_and_rule_rows_out():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 64)) * 100
    v = np.rint(centers[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 64)) * 25).astype(np.int64)
    rows = negatives.Rows.unpack(negatives.Rows(np.arange(2000), np.zeros(2000, np.int64), v).pack())
    low, high = negatives.intervals(v[:100], rows)
    exact = v[:100] @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    scored = [negatives.positives_of(i, rows, rows, low[i], high[i], [], 5)[1] for i in range(100)]
    assert 5 <= min(scored) and sum(scored) < 0.3 * 100 * 2000


def _clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept] if centroids else []
        for n in range(len(centroids)):
            mine = [v for (_, v), f in zip(kept, found, strict=True) if f == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept] if centroids else []
    total = sum(d for *_, d in last)
    top = 2**63 - 1
    each = {n: sum(d for _, m, d in last if m == n) for n in range(len(centroids))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, min(d, top), min(each[n], top), min(total, top), names[n]) for i, n, d in last]


def _key(row):
    return (row[0] is not None, row)


@pytest.mark.parametrize("records", ["10000", "17"])
def test_clusters(spark, records):
    rows = _vectors(5, 300, 8, 0.3)
    rows += [(i + 1000, v, c, *more) for i, v, c, *more in rows[:20]] + rows[:9] + ODD
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        found = kmeans.cluster(spark.createDataFrame(rows, VECTORS), clusters=7, rounds=4, width=8).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found), key=_key) == sorted(_clusters(rows, 7, 4, 8), key=_key)


def test_clusters_of_few_equal_and_huge_vectors(spark):
    few = _vectors(6, 3, 8)
    equal = [(i, [0.125] * 8, 1, 1, "b") for i in range(30)]
    huge = [(i, [x * 1e12 for x in v], c, *more) for i, v, c, *more in _vectors(7, 40, 8)]
    for rows in (few, equal, huge, [], [(None, [0.5] * 8, 1, 1, "b")]):
        found = kmeans.cluster(spark.createDataFrame(rows, VECTORS), clusters=5, rounds=3, width=8).collect()
        assert sorted(map(tuple, found)) == sorted(_clusters(rows, 5, 3, 8))
