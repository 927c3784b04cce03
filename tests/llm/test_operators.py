"""Each corpus operator against brute force, and with odd rows: nulls, empty and very long texts,
ties, repeated rows, empty tables and extra columns of clashing names."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import backoff, chains, compression, contamination, elias_fano, minhash, packing, topk, urls, warc
from shelfwise.llm.scratch import new_place
from shelfwise.llm.tokens import encoder
from shelfwise.llm.words import alnum_words, blank_words, shingles

SCHEMA = "doc_id long, text string, row long, term string, key long, component string, v long"
BASE = " ".join(f"w{i}" for i in range(200))


def _text(seed: int, n: int) -> str:
    return " ".join(f"x{i}" for i in np.random.default_rng(seed).integers(0, 10**9, n))


def _rows() -> list[tuple]:
    near = BASE.split()
    near[100] = "changed"
    texts = [
        (0, BASE), (1, BASE), (2, BASE.upper()), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "),
        (7, "one two"), (8, "one two"), (9, "Ünïcode ☂ text\nwith  blanks "), (10, _text(1, 30_000)),
        (11, _text(2, 80) + " " + _text(3, 60)), (12, _text(4, 70) + "\n" + _text(3, 60) + " " + _text(5, 10)),
        (None, "no id here"), (13, "repeated row"), (13, "repeated row"), (14, "<|endoftext|> it's"),
    ]
    return [(i, t, 7, "term", 1, "c", None) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def _collect(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


@cache
def _tokenizer(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def _encode(name: str, text: str | None, end: int) -> list[int]:
    return [*_tokenizer(name).encode(text or "", add_special_tokens=False).ids, end]


def _crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB é.,!'s\n\t 1ß中\u0301\u00a0ſİ🙂|"), max_size=20))
def test_words_encode_as_whole_texts(text):
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encode = encoder(name, spaced)
        assert encode.encode(text) == encode.whole(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "a", " ", "it's", "\n", "é"]), max_size=8))
def test_texts_with_added_tokens_encode_as_the_library_does(parts):
    text = "".join(parts)
    for name, spaced, end in (("byte_bpe_50k.json", True, 0), ("word_bpe_49k.json", False, 1)):
        encode = encoder(name, spaced)
        assert np.frombuffer(encode.encode(text), encode.dtype).tolist() == _encode(name, text, end)[:-1]


def test_ids_of_added_tokens(spark):
    """Both vocabularies give the token's own id, at the ends of a text and inside it."""
    texts = ["<|endoftext|>", "a <|endoftext|> b", "<|startoftext|>x", "x<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    files = {r["doc_id"]: r for r in _collect(elias_fano.token_files(docs))}
    packed = {r["doc_id"]: r for r in _collect(packing.pack(docs))}
    assert _encode("byte_bpe_50k.json", texts[1], 0) == [64, 220, 50256, 275, 0]
    for i, text in enumerate(texts):
        ids = _encode("byte_bpe_50k.json", text, 0)
        assert (files[i]["n_tokens"], files[i]["ids_crc32"]) == (len(ids), _crc(ids))
        ids = _encode("word_bpe_49k.json", text, 1)
        assert (packed[i]["doc_tokens"], packed[i]["ids_crc32"]) == (len(ids), _crc(ids))


def test_memos_are_bounded_by_bytes(monkeypatch):
    from shelfwise.llm import tokens, words

    monkeypatch.setattr(tokens, "MEMO", 5000)
    monkeypatch.setattr(words, "MEMO", 5000)
    encode = tokens.Encoder("byte_bpe_50k.json", True)
    text = _text(77, 300)
    assert encode.encode(text) == encode.whole(text) and len(encode._later) < 25
    memo = words._Hashes()
    first = [memo[w.encode()] for w in text.split()]
    assert first == [memo[w.encode()] for w in text.split()] and len(memo) < 30


def test_passages_are_cut_only_from_their_own_text(spark):
    """A row that shares an id, but not the text, keeps its words; a column called like an inner one stays."""
    docs = spark.createDataFrame(
        [(1, "a b c d e", "x"), (2, "a b c d e", "x"), (2, "v w x y z", "x"), (3, "q a b c d e", "x")],
        "doc_id long, text string, _spans string",
    )
    found = spark.createDataFrame([(2, 0, 5), (3, 1, 5)], "doc_id long, start int, n_words int")
    left = chains.without_passages(docs, found)
    assert sorted(tuple(r) for r in left.collect()) == [
        (1, "a b c d e", "x"), (2, "a b c d e", "x"), (2, "v w x y z", "x"), (3, "q ", "x")
    ]


def test_scores_beyond_long(spark):
    rows = spark.createDataFrame([(i, [(-1.0) ** i * 1e17, 1e17 + i]) for i in range(0, 60)], "vec_id long, embedding array<double>")
    found = _collect(topk.top_k(rows))
    assert len(found) == 10 and {r["score"] for r in found} == {2**63 - 1}
    assert [r["vec_id"] for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])) if r["query_id"] == 0] == [2, 4, 6, 8, 10]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    sequence = elias_fano.EliasFano.of(np.array(values, np.uint64))
    assert sequence.values().tolist() == values
    assert [sequence.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(100, 2000, 10_000)).astype(np.uint64)
    assert elias_fano.EliasFano.of(ends).nbytes() < 10_000 * 14 / 8


def test_token_files(spark, docs, no_docs):
    found = _collect(elias_fano.token_files(docs))
    expected, start = [], 0
    for row in sorted(_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = _encode("byte_bpe_50k.json", row[1], 0)
        expected.append((row[0], start, len(ids), _crc(ids)))
        start += len(ids)
    assert sorted((tuple(r.values()) for r in found), key=lambda r: r[1]) == expected
    manifest = elias_fano.write_ids(docs, new_place(spark, "ids")).collect()
    shard = elias_fano.Shard(manifest[0].path)
    for i in range(len(shard)):
        assert shard.document(i).tolist() in [_encode("byte_bpe_50k.json", r[1], 0) for r in _rows() if r[0] == shard.doc_id(i)]
    assert _collect(elias_fano.token_files(no_docs)) == []


def test_packing(docs, no_docs):
    pieces = _collect(packing.pack(docs))
    by_doc = defaultdict(list)
    for r in _rows():
        by_doc[r[0]].append(_encode("word_bpe_49k.json", r[1], 1))
    covered = Counter()
    for p in pieces:
        assert any(_crc(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] and len(ids) == p["doc_tokens"] for ids in by_doc[p["doc_id"]])
        covered[p["doc_id"]] += p["length"]
    assert covered == {k: sum(map(len, v)) for k, v in by_doc.items()}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    for s in sequences.values():
        s.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in s] == np.cumsum([0, *(p["length"] for p in s)])[:-1].tolist()
        assert sum(p["length"] for p in s) <= s[0]["tier"] <= 2048
    short = [s for s in sequences.values() if sum(p["length"] for p in s) < s[0]["tier"]]
    assert len(short) <= 3  # the last of each task
    assert _collect(packing.pack(no_docs)) == []


def _components(rows: list[tuple]) -> dict:
    sets = {i: shingles(blank_words((t or "").encode()), 5) for i, t, *_ in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(np.intersect1d(sets[a], sets[b]))
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates(spark, docs, no_docs):
    found = _collect(minhash.near_duplicates(docs))
    expected = _components(_rows())
    assert len(found) == len(_rows())
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert _collect(minhash.near_duplicates(no_docs)) == []


def test_near_duplicates_chain_without_a_common_centre(spark):
    """Each text is like its neighbours only; small blocks take every block with every other."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i : 12 * i + 200])) for i in range(16)]
    rows = [(50 - i, t) for i, t in rows] + [(60 + i, _text(i, 50)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = _components(rows)
    before, minhash.BLOCK = minhash.BLOCK, 2000
    try:
        found = {r["doc_id"]: r["component_id"] for r in _collect(minhash.near_duplicates(docs))}
    finally:
        minhash.BLOCK = before
    assert found == {i: c for i, (_, c) in expected.items()}


def test_contamination(spark, docs, no_docs):
    words = BASE.split()
    items = [(1, " ".join(words[20:60])), (2, "One, two!"), (3, None), (4, " ".join(words[150:162])), (None, BASE), (5, "absent words"), (2, "one two three")]
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, row long, words string")
    found = _collect(contamination.contamination(docs, bench))
    windows = defaultdict(set)
    for i, t in items:
        w = alnum_words((t or "").encode())
        n = min(13, len(w))
        if w and i is not None:
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add(str(i))
    expected = []
    for i, t, *_ in _rows():
        w, hit, ids = alnum_words((t or "").encode()), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found_ids := windows.get(tuple(w[k : k + n])):
                    ids |= found_ids
                    hit.update(range(k, k + n))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r.values())[:6] for r in found), key=key) == sorted(expected, key=key)
    assert _collect(contamination.contamination(no_docs, bench)) == []
    clean = _collect(contamination.contamination(docs, bench.where("item_id = 99")))
    assert len(clean) == len(_rows()) and not any(r["contaminated"] for r in clean)


def test_contamination_in_term_blocks_and_by_proximity(spark, docs):
    words = BASE.split()
    broken = [*words[20:26], "between", *words[26:33]]
    bench = spark.createDataFrame([(1, " ".join(broken[:6] + broken[7:])), (2, " ".join(words[60:90]))], "item_id long, text string")
    text = spark.createDataFrame([(1, " ".join(broken)), (2, BASE)], "doc_id long, text string")
    before, contamination.TERMS = contamination.TERMS, 4
    try:
        found = {r["doc_id"]: r for r in _collect(contamination.contamination(text, bench, slop=2))}
    finally:
        contamination.TERMS = before
    assert found[1]["n_items"] == 0 and found[1]["near_ids"] == ["1"]
    assert found[2]["n_items"] == 2 and found[2]["near_ids"] == []


def test_passages(spark, docs, no_docs):
    found = _collect(chains.passages(docs))
    got = {(r["doc_id"], r["source_id"]): r for r in found}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (12, 11)}
    assert (got[12, 11]["start"], got[12, 11]["n_words"], got[12, 11]["matched"]) == (70, 60, 60)
    assert got[3, 0]["n_words"] == 200 and got[3, 0]["matched"] == 199
    kept = {r["doc_id"]: r["text"] for r in _collect(chains.without_passages(docs.where("doc_id <> 13"), chains.passages(docs)))}
    assert kept[12] == _text(4, 70) + "\n" + _text(5, 10) and kept[1] == "" and kept[0] == BASE and kept[4] is None
    assert _collect(chains.passages(no_docs)) == []


def test_passages_whose_pieces_stand_in_earlier_documents(spark):
    """Pieces shorter than a passage are no passages, and don't hide the whole ones behind them."""
    passage = _text(50, 60).split()
    rows = [
        (0, " ".join([_text(51, 30), *passage[:45], _text(52, 30)])),
        (1, " ".join([_text(53, 30), *passage[52:], _text(54, 30)])),
        *((i, " ".join([_text(50 + 2 * i, 20 + i), *passage, _text(51 + 2 * i, 40)])) for i in range(4, 8)),
    ]
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string")))
    got = sorted((r["doc_id"], r["source_id"], r["start"], r["n_words"], r["matched"]) for r in found)
    assert got == [(i, 4, 20 + i, 60, 60) for i in range(5, 8)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=25))
def test_best_chain_is_the_best(matches):
    """The first chain's score equals that of a quadratic search."""
    k, cost, gap = 8, 0.25, 10**6
    order = sorted(set(matches))
    best = {}
    for a, b in order:
        before = [best[x, y] - cost * (a - x + b - y) for x, y in best if x < a and y < b]
        best[a, b] = k + max([0, *before])
    found = chains.chain(matches, k, gap, cost)
    assert sorted(m for c in found for m in c) == order
    if found:
        c = found[0]
        score = k * len(c) - sum(cost * (p[0] - q[0] + p[1] - q[1]) for q, p in zip(c, c[1:]))
        assert score == pytest.approx(max(best.values()))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 25)), st.sets(st.integers(0, 25)), st.sets(st.tuples(st.integers(0, 250), st.integers(0, 250)), max_size=20))
def test_all_chains_within_the_gap_are_the_best(one, two, others):
    """With the production gap, every chain is that of a quadratic search: two stretches and strays."""
    matches = [(5 * i, 5 * i) for i in one] + [(200 + 5 * i, 200 + 5 * i) for i in two] + sorted(others)
    k, cost, reach = chains.K, chains.GAP_COST, chains.GAP + chains.K
    order = sorted(set(matches), key=lambda m: (m[1], -m[0]))
    score, before = [], []
    for i, (a, b) in enumerate(order):
        near = [(score[j] + cost * (x + y), j) for j, (x, y) in enumerate(order[:i]) if 0 < a - x <= reach and 0 < b - y <= reach]
        best, j = max(near, default=(0.0, -1))
        linked = j >= 0 and best - cost * (a + b) > 0
        score.append(k + best - cost * (a + b) if linked else float(k))
        before.append(j if linked else -1)
    used, expected = set(), []
    for i in sorted(range(len(order)), key=lambda i: -score[i]):
        path = []
        while i >= 0 and i not in used:
            used.add(i)
            path.append(order[i])
            i = before[i]
        if path:
            expected.append(path[::-1])
    assert chains.chain(matches) == expected


def test_second_passage_of_a_pair(spark):
    """A long passage does not keep a later, edited one of the same two documents from being found."""
    long, second = _text(70, 200).split(), _text(71, 100).split()
    edited = [f"new{i}" if i % 15 == 14 else w for i, w in enumerate(second)]
    assert len(chains.chain([(i, i) for i in range(0, 200, 6)] + [(i, i) for i in range(260, 360, 6)])) == 2
    rows = [
        (1, " ".join([*long, *_text(72, 60).split(), *second])),
        (2, " ".join([*long, *_text(73, 60).split(), *edited])),
    ]
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert any(r["start"] < 10 and r["n_words"] >= 200 for r in found)
    assert any(r["start"] >= 250 and r["n_words"] >= 50 for r in found)


def test_passages_behind_overlapping_pieces(spark):
    """Two earlier documents hold overlapping short pieces, so no seed points to a holder of the whole."""
    passage = _text(90, 60).split()
    rows = [
        (0, " ".join([*_text(91, 30).split(), *passage[:40], *_text(92, 30).split()])),
        (1, " ".join([*_text(93, 30).split(), *passage[25:], *_text(94, 30).split()])),
        *((i, " ".join([*_text(90 + 2 * i, 20 + i).split(), *passage, *_text(91 + 2 * i, 40).split()])) for i in range(4, 8)),
    ]
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string")))
    got = sorted((r["doc_id"], r["source_id"], r["start"], r["n_words"], r["matched"]) for r in found)
    assert got == [(i, 4, 20 + i, 60, 60) for i in range(5, 8)]


def test_edited_passages_standing_alone(spark):
    """Of 100-word passages with a word in 8 changed, spread evenly or by chance, most are found."""
    rng, rows = np.random.default_rng(80), []
    for i in range(40):
        words = _text(1000 + i, 100).split()
        edited = [f"new{j}" if (j % 8 == 7 if i % 2 else rng.random() < 1 / 8) else w for j, w in enumerate(words)]
        rows.append((i, " ".join([*_text(1100 + i, 60).split(), *words, *_text(1200 + i, 60).split()])))
        rows.append((100 + i, " ".join([*_text(1300 + i, 60).split(), *edited, *_text(1400 + i, 60).split()])))
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(r["source_id"] == r["doc_id"] - 100 and r["matched"] >= 0.8 * r["n_words"] for r in found)
    assert len({r["doc_id"] for r in found if r["n_words"] >= 80}) >= 36


def _short(a: list[int]) -> np.ndarray:
    return np.array(a, chains.WORDS).astype("<u2")


def _can_reach(a: list[int], b: list[int], path: list[tuple[int, int]], k: int, min_words: int) -> bool:
    view = _short(a)[max(0, path[0][0] - min_words) : path[-1][0] + k + min_words]
    return bool(chains.can_reach([(view, np.array(b, chains.WORDS), path)], k, min_words)[0])


@settings(max_examples=300, deadline=None)
@given(
    st.integers(0, 2**32), st.sampled_from([3, 20, 10**6]), st.integers(0, 90), st.integers(0, 90), st.integers(3, 30),
    st.sampled_from([6, 20, 50]),
)
def test_words_around_a_chain_rule_out_no_passage(seed, vocabulary, before, after, every, min_words):
    rng, k = np.random.default_rng(seed), 6
    a = rng.integers(1, vocabulary + 1, before + k + after).tolist()
    b, start = [], 0
    for i, word in enumerate(a):
        if i == before:
            start = len(b)
        edit = int(rng.integers(0, every * 3)) if not before <= i < before + k else 9
        b += [[2**20 + i], [], [2**20 + i, word]][edit] if edit < 3 else [word]
    path = [(before, start)]
    if chains.found_around(a, b, path, k, min_words, 0.0):
        assert _can_reach(a, b, path, k, min_words)


def test_edits_beside_a_seed_do_not_hide_a_long_copy():
    """120 words with every third changed lie between a seed and 300 equal words; a seed alone leads nowhere."""
    seed, mixed, equal = list(range(6)), list(range(100, 220)), list(range(300, 600))
    edited = [10_000 + i if i % 3 == 2 else w for i, w in enumerate(mixed)]
    a, b = [*seed, *edited, *equal], [*seed, *mixed, *equal]
    assert chains.found_around(a, b, [(0, 0)], 6, 50, 0.8) and _can_reach(a, b, [(0, 0)], 6, 50)
    strange = list(range(20_000, 20_426))
    assert not _can_reach(a, [*strange, *seed, *strange], [(0, len(strange))], 6, 50)


def test_short_passages_behind_pieces(spark):
    """With a small least length seeds lie closer, so that pieces in earlier documents hide no run of it."""
    passage = _text(110, 12).split()
    rows = [
        (0, " ".join([*_text(111, 9).split(), *passage[:9], *_text(112, 9).split()])),
        (1, " ".join([*_text(113, 9).split(), *passage[3:], *_text(114, 9).split()])),
        *((i, " ".join([*_text(115 + i, i).split(), *passage, *_text(125 + i, 20).split()])) for i in (4, 5, 6)),
    ]
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string"), min_words=10))
    assert sorted((r["doc_id"], r["source_id"], r["start"], r["n_words"]) for r in found) == [(i, 4, i, 12) for i in (5, 6)]


def test_chain_over_unlike_words_is_split():
    """Two passages that lie too far apart for one are both found."""
    one, two = list(range(100, 170)), list(range(200, 270))
    a, b = [*one, *range(1000, 1039), *two], [*one, *range(2000, 2039), *two]
    path = [(i, i) for i in [*range(0, 64, 5), *range(109, 173, 5)]]
    assert chains.found_around(a, b, path, 6, 50, 0.8) == [(0, 70, 0, 70, 70), (109, 179, 109, 179, 70)]


def test_backoff_scores(docs, no_docs):
    found = _collect(backoff.scores(docs))
    words = [(i, blank_words((t or "").encode())) for i, t, *_ in _rows()]
    one, two = Counter(), Counter()
    for _, w in words:
        one.update(w)
        two.update(zip(w, w[1:]))
    expected = []
    for i, w in words:
        own, pairs, score = Counter(w), Counter(zip(w, w[1:])), 0.0
        for p, x in enumerate(w):
            step = np.log(max(one[x] - own[x], 0.5) / max(one.total() - len(w), 1))
            if p:
                y = w[p - 1]
                n = two[y, x] - pairs[y, x]
                step = np.log(n / (one[y] - own[y])) if n else np.log(0.4) + step
            score += step
        expected.append((i is not None, i or 0, len(w), round(score, 6)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], round(r["score"], 6)) for r in found) == sorted(expected)
    assert _collect(backoff.scores(no_docs)) == []


def test_backoff_in_many_chunks_is_the_same(docs):
    whole = sorted((str(r["doc_id"]), r["score"]) for r in _collect(backoff.scores(docs, order=3)))
    before = backoff.CHUNK, backoff.PARTITION
    backoff.CHUNK, backoff.PARTITION = 5000, 10_000
    try:
        parts = sorted((str(r["doc_id"]), r["score"]) for r in _collect(backoff.scores(docs, order=3)))
    finally:
        backoff.CHUNK, backoff.PARTITION = before
    assert [k for k, _ in whole] == [k for k, _ in parts]
    assert [v for _, v in whole] == pytest.approx([v for _, v in parts])


def test_quality(spark, docs, no_docs):
    source = "/root/testdata/sf0.01"
    texts, labels = (spark.read.parquet(f"{source}/{t}.parquet") for t in ("documents", "labels"))
    model = compression.fit(texts, labels)
    scored = compression.score(texts, model).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    assert np.mean([r.predicted == r.quality for r in scored]) >= 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    odd = _collect(compression.score(docs, model))
    assert len(odd) == len(_rows()) and len({r["score"] for r in odd if r["doc_id"] in (4, 5)}) == 1
    assert len(_collect(compression.filter_rows(docs, model))) == sum(r["predicted"] for r in odd)
    assert _collect(compression.score(no_docs, model)) == []
    untaught = compression.fit(texts, labels.limit(0))
    assert {r["score"] for r in _collect(compression.score(docs, untaught))} == {0.5}


def test_quality_against_brute_force(spark):
    """Sizes, scores and the calibration computed directly; ids labelled both ways and second texts."""
    rng = np.random.default_rng(5)
    good, bad = ([f"{p}{i}" for i in range(60)] for p in ("clear", "junk!"))
    texts = [(i, " ".join(rng.choice(bad if i % 3 else good, 30 + 7 * i))) for i in range(90)] + [(0, " ".join(bad)), (500, "x " * 9000), (501, None)]
    marks = [(i, 0 if i % 3 else 1) for i in range(90)] + [(500, 0), (500, 1), (501, 1), (None, 1), (7, None), (8, 5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = compression.fit(docs, labels)
    assert model == compression.fit(docs.where("doc_id < 500"), labels.where("doc_id < 500"))

    packers = [
        zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
        for d in (model.good, model.bad)
    ]

    def features(text: str | None) -> list[float]:
        data = (text or "").encode()
        cut = [data[i : i + 2048] for i in range(0, len(data), 2048)] or [b""]
        a, b = (sum(len(c.compress(p)) for p in cut) + 8 for c in packers)
        return [1.0, np.log(b / a), np.log(a / (len(data) + 8))]

    x = np.array([features(t) for _, t in texts])
    expected = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))
    got = sorted((str(r["doc_id"]), r["score"]) for r in _collect(compression.score(docs, model)))
    assert [g[0] for g in got] == sorted(str(i) for i, _ in texts)
    assert [g[1] for g in got] == pytest.approx([e for _, e in sorted(zip((str(i) for i, _ in texts), expected.tolist()))], rel=1e-9)
    # All usable rows are examples here, so the calibration is fitted on them: the gradient is zero.
    least = {}
    for i, t in texts:
        if i < 90 and zlib.crc32(str(i).encode()) % 4 != 2:
            least[i] = min(t, least.get(i, t))
    x, y = np.array([features(t) for t in least.values()]), np.array([i % 3 == 0 for i in least], float)
    p = 1 / (1 + np.exp(-(x @ np.array(model.weights))))
    assert np.abs(x.T @ (y - p) - 0.05 * np.array(model.weights)).max() < 1e-4


def test_pieces_of_whole_texts_are_chosen(spark, monkeypatch):
    """Without a bound, the pieces are those of the whole texts; with one, the same rule picks some from anywhere."""
    rows = spark.createDataFrame([(1, bytearray(_text(1, 3000).encode())), (2, bytearray(b"short")), (3, bytearray(b""))], "doc_id long, text binary")
    every = [bytes(t[i : i + 2048]) for _, t in rows.collect() for i in range(0, max(1, len(t)), 2048)]
    assert sorted(compression._chosen_pieces(rows)) == sorted(every)
    monkeypatch.setattr(compression, "PIECES", 5)
    few = compression._chosen_pieces(rows)
    assert len(few) == 5 and set(few) <= set(every)
    assert compression._chosen_pieces(rows.limit(0)) == []


def test_archives(spark):
    trap = warc.record(999, "http://x/", b"inner", None, False, "2025-01-01T00:00:00Z").decode()
    rows = [
        (0, "http://a/", "same"), (3, "http://b/", "same"), (2, None, "same"), (None, "http://c/", "same"), (4, "http://d/\r\nWARC-Type: x", trap * 40),
        (5, "http://e/", None), (6, "http://f/", ""), (7, "", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (7, "", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"),
        (8, "u", "é" * 50_000), (None, None, "alone"), (None, None, "alone"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string").repartition(2)
    manifest = warc.write_archives(pages, new_place(spark, "warc"))
    for split in (500, 4096, warc.SPLIT):
        found = _collect(warc.read_archives(manifest.select("path", "bytes"), split))
        got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in found)
        expected = []
        for i, _, html in rows:
            data = (html or "").encode()
            first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
            again = first is not None and i != first
            sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
            expected.append((str(i), len(data), sha, "revisit" if again else "response", str(first if again else None)))
        assert got == sorted(expected) and all(r["intact"] for r in found)
    assert _collect(warc.archived(pages.limit(0))) == []
    large = _collect(warc.archived(pages, least=10))
    assert {r["record_type"] for r in large if r["payload_bytes"] < 10} == {"response"}


URLS = [
    "http://a.com/x", "https://Example.COM/en/1", "https://www.example.com/en/1?q#f", "http://com", "http://n.net/es/", "ftp://n.net/fr/a",
    "no scheme", None, "", "http://", "http://x.org/a?b://c", "://h/p", "http://notexample.com/en/", "http://com/", "HTTP://WWW.EXAMPLE.COM/de/#x", "x" * 5000,
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, 1.0, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], 1.0, "h")] * 2, "page_id long, url string, score double, host string")
    found = _collect(urls.judge_urls(pages))
    assert len(found) == len(URLS) + 2
    for r in found:
        url = URLS[r["page_id"]] if r["page_id"] is not None else URLS[0]
        rest = url.partition("://")[2] if url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        assert (r["host"], r["path"]) == (host, path)
        fits = [(h + p, k) for k, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=lambda f: len(f[0]), default=(None, None))
        assert r["rule"] == rule[0] and (r["verdict"] == rule[1] if rule[0] else r["verdict"] in ("allow", "block"))
    assert _collect(urls.judge_urls(pages.limit(0))) == []
    alone = _collect(urls.judge_urls(pages.where("page_id = 10")))
    assert alone[0]["verdict"] == "allow" and alone[0]["score"] == 0


def test_url_model_against_brute_force(spark):
    """Witten-Bell interpolation of the same counts over whole URLs, in plain Python; calibrated on those held out."""
    accepted = [f"http://{c}.com/news?p={i}#😀" for i, c in enumerate("abcdefgh")]
    rejected = [f"https://{c}.net/{k}/buy" for c in "abcdefgh" for k in ("es", "fr")]
    asked = [*accepted, *rejected, "http://c.org/buy?p=7"]
    pages = spark.createDataFrame(list(enumerate(asked)), "page_id long, url string")
    ratios = {}
    found = {r["page_id"]: r for r in _collect(urls.judge_urls(pages, order=2))}
    held = {r["url"] for r in _collect(pages.where(urls.held_out(F.col("url"))))}
    assert held & set(accepted) and held & set(rejected)
    for name, known in (("allow", accepted), ("block", rejected)):
        counts = defaultdict(Counter)
        for u in set(known) - held:
            text = "\x02\x02" + u + "\x03"
            for i in range(2, len(text)):
                for k in range(3):
                    counts[text[i - k : i]][text[i]] += 1

        def p(context: str, c: str) -> float:
            less = p(context[1:], c) if context else 1 / 256
            seen = counts[context]
            return (seen[c] + len(seen) * less) / (seen.total() + len(seen)) if seen else less

        for i, u in enumerate(asked):
            text = "\x02\x02" + u + "\x03"
            ratios.setdefault(i, {})[name] = np.mean([np.log(p(text[j - 2 : j], text[j])) for j in range(2, len(text))])
    raw = {i: r["allow"] - r["block"] for i, r in ratios.items()}
    a, b = (np.array([raw[asked.index(u)] for u in known if u in held]) for known in (accepted, rejected))
    spread = (a.var() * len(a) + b.var() * len(b)) / (len(a) + len(b))
    slope = (a.mean() - b.mean()) / spread
    for i, r in found.items():
        assert r["score"] == pytest.approx(slope * (raw[i] - (a.mean() + b.mean()) / 2), rel=1e-6)


def test_long_url_and_query_strings(spark):
    """A URL of a million characters is cut in linear time; URLs that differ in their query only get own scores."""
    known = [f"http://{c}{d}.com/a" for c in "abcdef" for d in "gh"] + [f"http://{c}{d}.net/es/zz" for c in "abcdef" for d in "gh"]
    rows = [*known, "http://x.org/" + "abc/" * 250_000, "http://x.org/?a", "http://x.org/?zzzz", "HTTP://X.org/?a"]
    found = {r["page_id"]: r for r in _collect(urls.judge_urls(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")))}
    n = len(known)
    assert len(found) == len(rows) and len(found[n]["path"]) == 1_000_001
    assert found[n + 1]["score"] != found[n + 2]["score"] and found[n + 3]["host"] == "x.org"


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(9)]  # ties
    rows += [(500, [1.0, float("nan")]), (501, None), (502, [0.1, None]), (503, [float("inf")]), (None, [0.5] * 6), (550, []), (600, [0.5])]
    rows += [rows[3], (650, [1e9] * 6)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, number int")
    sound = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            sound[i] = [int(np.floor(256 * x)) for x in v]
    expected = []
    for q in (i for i in sound if i % 50 == 0):
        scores = sorted((-sum(x * y for x, y in zip(sound[q], v)), i) for i, v in sound.items() if i != q)[:5]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    before = topk.BLOCK, topk.QUERIES
    for topk.BLOCK, topk.QUERIES in (before, (50, 3)):
        assert sorted(tuple(r.values()) for r in _collect(topk.top_k(table))) == sorted(expected)
    topk.BLOCK, topk.QUERIES = before
    assert _collect(topk.top_k(table.limit(0))) == []


def test_large_batches_are_worked_on_in_slices():
    """What is made of a batch of matches, and kept of words, stays small."""
    import pyarrow as pa

    from shelfwise.llm import words

    matches = [[{"source_id": s, "place": p, "source_place": p + s} for s in range(i % 3) for p in range(0, 40, 9)] for i in range(2000)]
    packed = np.arange(60).astype(chains.WORDS).tobytes()
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "matches": matches, "words": [packed] * 2000})
    out = list(chains._views(6, 40, 0.25, 50)(iter([batch])))
    assert max(b.num_rows for b in out) <= 2 * chains.SLICE < 2000
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["doc_id"], r["source_id"]) for r in rows] == [(i, s) for i in range(2000) for s in range(i % 3)]
    for r in rows:
        pairs = [(p, p + r["source_id"]) for p in range(0, 40, 9)]
        assert [[(m["place"], m["source_place"]) for m in path] for path in r["chains"]] == chains.chain(pairs)
    words.hashes([b"%d" % i for i in range(10_000)])
    assert not [x for x in vars(words).values() if isinstance(x, dict) and len(x) >= 10_000]


def test_reach_of_rows_that_repeat_an_id():
    """Chains whose places lie beyond the ends of both texts are judged beside others."""
    text = np.arange(100).astype(chains.WORDS)
    whole = (text.astype("<u2")[:56], text, [(0, 0)])
    short = (text.astype("<u2")[:3], text[:2], [(70, 90)])
    assert chains.can_reach([whole, short, whole], 6, 50).tolist() == [True, False, True]
    assert chains.can_reach([], 6, 50).tolist() == []


def test_words_of_one_token_share_its_bytes():
    """Words are encoded without an array for each; that of one token is the token's own bytes."""
    from shelfwise.llm.tokens import Encoder

    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encode = Encoder(name, spaced)
        one = encode._first["the"]
        assert one is encode._bytes[int.from_bytes(one, "little")] and one == encode.whole("the")
        for text in ("The naïve Straße costs 12 µs, ﬁne.", "ÀÉ ÿ K Ωmega x" + "yz" * 40, "don't well-known (the) end!"):
            assert encode.encode(text) == encode.whole(text)


def test_one_passage_for_a_block_of_repeated_lines(spark):
    """Documents that share a line repeated 60 times share one passage, not one for each shift of the lines."""
    lines = " ".join([" ".join(_text(140, 9).split())] * 60).split()
    rows = [(i, " ".join([*_text(141 + 2 * i, 20 + i).split(), *lines, *_text(142 + 2 * i, 30).split()])) for i in range(6)]
    found = _collect(chains.passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted((r["doc_id"], r["start"], r["n_words"], r["source_id"], r["source_start"], r["matched"]) for r in found) == [
        (i, 20 + i, 540, 0, 20, 540) for i in range(1, 6)
    ]


@given(st.lists(st.tuples(st.integers(0, 10), st.integers(1, 10), st.integers(0, 3), st.integers(1, 9), st.integers(0, 9)), max_size=12))
def test_longest_passages_hold_the_words_of_all(found):
    found = [(start, start + n, from_, from_ + m, equal) for start, n, from_, m, equal in found]
    kept = chains.longest(found)
    assert {p for x in kept for p in range(x[0], x[1])} == {p for x in found for p in range(x[0], x[1])}
    assert all(any(y[0] <= x[0] and x[1] <= y[1] for y in kept) for x in found)
    assert not [(x, y) for x in kept for y in kept if x is not y and x[0] <= y[0] and y[1] <= x[1]]


@given(st.integers(0, 10**9), st.integers(0, 40), st.sampled_from([2, 5, 40, 1000]), st.sampled_from([10, 20, 50]), st.sampled_from([0, 1, 24]))
@settings(deadline=None, max_examples=100)
def test_chains_aligned_together_and_alone(seed, edits, vocabulary, min_words, few):
    """Passages around many chains of several texts agree with those around each."""
    rng = np.random.default_rng(seed)
    pairs = []
    for _ in range(rng.integers(1, 4)):
        a = rng.integers(0, vocabulary, rng.integers(20, 160)).tolist()
        b = list(a)
        for _ in range(edits):
            p = int(rng.integers(0, len(b)))
            b[p : p + int(rng.integers(0, 2))] = [-1 - int(x) for x in rng.integers(0, 5, rng.integers(0, 2))]
            b = b or [0]
        matches = [(p, q) for p in range(len(a) - 2) for q in range(len(b) - 2) if a[p : p + 3] == b[q : q + 3]]
        matches = [matches[i] for i in rng.permutation(len(matches))[:30]]
        pairs.append((a, b, [c for c in chains.chain(matches, 3) if c] if matches else []))
    flat = [np.array([x for pair in pairs for x in pair[i]], np.int64).astype(chains.WORDS) for i in (0, 1)]
    asked, expected, at = [], [], [0, 0]
    for a, b, paths in pairs:
        for path in paths:
            asked.append(((at[0], at[0] + len(a)), (at[1], at[1] + len(b)), path))
            expected.append(chains.found_around(a, b, path, 3, min_words, 0.8))
        at = [at[0] + len(a), at[1] + len(b)]
    before, chains.FEW = chains.FEW, few
    try:
        found = chains.found_around_all(*flat, asked, 3, min_words, 0.8)
    finally:
        chains.FEW = before
    assert found == expected


def test_passage_that_scores_beyond_the_words_beside_a_chain():
    """Of the words beside a chain 20 are looked at; the best end lies beyond them."""
    alike = "00101100110010100111101111111101110111011101111"
    a = list(range(56))
    b = [x if x >= 47 or alike[46 - x] == "1" else 1000 + x for x in a[:53]] + [2000, 2001, 2002]
    assert chains.found_around(a, b, [(47, 47)], 6, 20, 0.0) == [(0, 53, 0, 53, 38)]
    assert _can_reach(a, b, [(47, 47)], 6, 20)


def test_seeds_of_texts_together_and_alone():
    rng = np.random.default_rng(150)
    for _ in range(60):
        sizes = rng.choice([0, 1, 5, 6, 7, 13, 14, 30, 100], rng.integers(1, 9))
        texts = [rng.integers(0, rng.choice([2, 10**6]), n).astype(np.uint64) for n in sizes]
        ends = np.cumsum([0, *sizes])
        for k, neighbours in ((6, 8), (3, 1), (2, 5)):
            flat, places, counts = chains.minimizers_all(np.concatenate([*texts, np.empty(0, np.uint64)]), ends, k, neighbours)
            cuts = np.cumsum(counts)[:-1]
            for text, h, p in zip(texts, np.split(flat, cuts), np.split(places, cuts), strict=True):
                alone = chains.minimizers(text, k, neighbours)
                assert h.tolist() == alone[0].tolist() and p.tolist() == alone[1].tolist()
