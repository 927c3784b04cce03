"""Repeated passages, also with small changes, by collinear chaining of shared seeds.

1. Seeds are the minimizers of runs of 6 words (the least of 8 neighbours by hash): equal stretches
   of 13 words or more share at least one.
2. Each seed points to its first holder (least document id, then place). So a passage in a thousand
   documents gives a thousand links, not all pairs, and joins stay in proportion to the text.
3. Per document and holder, ordered matches are chained with linear gap costs through a tree of
   best scores over the document's places, among the matches that a chain can still bridge to.
4. Every chain, also of one seed, is aligned on the words of both whole texts: over the gaps between
   seeds, and beyond both ends, across changed, missing and added words, as far as the equal ones
   outweigh them. Chains around which too few words occur in the other text are left out first; that
   bound rules out no passage.
5. Where a shared seed is in no passage found so, all runs of the least length around it point to
   the first holder of the whole run, whatever earlier documents hold of its pieces.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored
from shelfwise.llm.words import blank_words, hashes, runs

K, NEIGHBOURS = 6, 8
MIN_WORDS = 50
IDENTITY = 0.8
GAP = 40  # words that a chain may bridge
GAP_COST = 0.25
PRICES = (2, 3, 4)  # equal words that pay for a changed one beyond a chain's ends; tried in turn
DROP = 12  # equal words that a passage's end may fall behind its best

SLICE = 512  # rows of a batch that are worked on at a time
ALIGNED = 4096  # chains that are aligned at a time
WORDS_AT_ONCE = 1 << 20  # whose seeds are taken at a time
FEW = 24  # of them, from which on each is aligned by itself

#: A word of a text where texts are compared: 32 bits of its hash. Seeds hash whole ones.
WORDS = "<u4"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

SEEDS = "doc_id long, n_words int, hashes array<long>, places array<int>, words binary"
CHAINS = "doc_id long, source_id long, chains array<array<struct<place int, source_place int>>>"
VIEWS = CHAINS + ", views array<binary>"
RUNS = "doc_id long, seed long, place int"
PASSAGES = "doc_id long, start int, n_words int, source_id long, source_start int, source_words int, matched int"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch holds 10,000 rows; what is made of them at a time stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def _lists(column: pa.ListArray) -> tuple[list[int], pa.Array]:
    """Where each row's entries begin, with the end of the last, and the entries of all rows."""
    offsets = column.offsets.to_numpy()
    return (offsets - offsets[0]).tolist(), column.flatten()


def _paths(column: pa.ListArray) -> Iterator[list[list[tuple[int, int]]]]:
    """Each row's chains."""
    rows, chains = _lists(column)
    ends, matches = _lists(chains)
    pairs = list(zip(*(x.to_numpy().tolist() for x in matches.flatten()), strict=True))
    for a, b in pairwise(rows):
        yield [pairs[ends[i] : ends[i + 1]] for i in range(a, b)]


def _path_lists(rows: list[list[list[tuple[int, int]]]]) -> pa.ListArray:
    """The column of each row's chains."""
    chains = [path for row in rows for path in row]
    pairs = np.array([m for path in chains for m in path], np.int32).reshape(-1, 2)
    matches = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["place", "source_place"])
    return pa.ListArray.from_arrays(_ends(rows), pa.ListArray.from_arrays(_ends(chains), matches))


def _ends(lists: list[list]) -> pa.Array:
    return pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())


def _pairs(column: pa.ListArray) -> Iterator[dict[int, list[tuple[int, int]]]]:
    """Each row's matches by source."""
    rows, matches = _lists(column)
    names = [f.name for f in matches.type]
    source, place, source_place = (matches.field(names.index(n)).to_numpy().tolist() for n in ("source_id", "place", "source_place"))
    for a, b in pairwise(rows):
        sources: dict[int, list[tuple[int, int]]] = {}
        for i in range(a, b):
            sources.setdefault(source[i], []).append((place[i], source_place[i]))
        yield sources


def minimizers(words: np.ndarray, k: int, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the least of each ``neighbours`` runs of ``k`` words."""
    h = runs(words, k)
    if not len(h):
        return h.view(np.int64), np.empty(0, np.int32)
    width = min(neighbours, len(h))
    least = np.lib.stride_tricks.sliding_window_view(h, width).argmin(1) + np.arange(len(h) - width + 1)
    places = np.unique(least)
    return h[places].view(np.int64), places.astype(np.int32)


def minimizers_all(words: np.ndarray, ends: np.ndarray, k: int, neighbours: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``minimizers`` of many texts, whose words begin at ``ends`` and end with the last: (hashes, places, numbers)."""
    sizes = np.diff(ends)
    counts = np.maximum(sizes - k + 1, 0)  # runs; fewer than neighbours are one window
    h = runs(words, k)
    least, width = np.arange(len(h)), 1
    while width < neighbours:
        step = min(width, neighbours - width)
        one, two = least[: max(len(least) - step, 0)], least[step:]
        least, width = np.where(h[one] <= h[two], one, two), width + step
    windows = np.maximum(counts - neighbours + 1, 0)
    text = np.repeat(np.arange(len(sizes)), windows)
    found = least[np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + ends[text]]
    first = np.flatnonzero(np.diff(found, prepend=-1))  # windows that follow one another have ascending places
    found, text = found[first], text[first]
    few = np.flatnonzero((counts > 0) & (counts < neighbours))
    alone = np.array([ends[i] + h[ends[i] : ends[i] + counts[i]].argmin() for i in few], np.int64)
    found, text = np.concatenate([found, alone]), np.concatenate([text, few])
    order = np.argsort(text, kind="stable")
    found, text = found[order], text[order]
    return h[found].view(np.int64), (found - ends[text]).astype(np.int32), np.bincount(text, minlength=len(sizes))


def _seeds(k: int, neighbours: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [hashes(blank_words(text.as_py())) for text in batch.column(1)]
            ends = np.cumsum([0, *map(len, texts)])
            # Some texts are long: as many at a time as hold a million words, or one.
            cuts = np.unique([0, *np.searchsorted(ends, np.arange(0, ends[-1], WORDS_AT_ONCE)), len(texts)]).tolist()
            found = [
                minimizers_all(np.concatenate([*texts[lo:hi], np.empty(0, np.uint64)]), ends[lo : hi + 1] - ends[lo], k, neighbours)
                for lo, hi in pairwise(cuts)
            ]
            flat, places, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.diff(ends), pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                    pa.array([x.astype(WORDS).tobytes() for x in texts], pa.binary()),
                ],
                names=["doc_id", "n_words", "hashes", "places", "words"],
            )

    return run


def chain(matches: list[tuple[int, int]], k: int = K, gap: int = GAP, cost: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Disjoint chains of matches that ascend in both texts, best first.

    Score: ``k`` for each match, less ``cost`` for each word of either text from match to match. A match
    follows the best of those at most ``gap`` + ``k`` words before it in both texts. A tree over places in
    the first text holds the best scores with their starts' costs added; matches that lie too far back in
    the second text are taken out of it.
    """
    if len(matches) == 1:
        return [list(matches)]
    order = sorted(set(matches), key=lambda m: (m[1], -m[0]))
    places = sorted({m[0] for m in order})
    n, none = len(places), (0.0, -1)
    tree: list[tuple[float, int]] = [none] * (2 * n)
    live: list[deque[tuple[float, int]]] = [deque() for _ in places]  # per place: falling scores, oldest first
    ranks = [bisect_left(places, m[0]) for m in order]

    def put(r: int) -> None:
        entry, x = live[r][0] if live[r] else none, r + n
        tree[x] = entry
        while x > 1:
            x >>= 1
            one, two = tree[2 * x], tree[2 * x + 1]
            most = one if one >= two else two
            if most == tree[x]:
                break
            tree[x] = most

    scores, before, old = [0.0] * len(order), [-1] * len(order), 0
    for i, (a, b) in enumerate(order):
        while order[old][1] < b - gap - k:
            waiting = live[ranks[old]]
            if waiting and waiting[0][1] == old:
                waiting.popleft()
                put(ranks[old])
            old += 1
        best, x, y = none, bisect_left(places, a - gap - k) + n, ranks[i] + n
        while x < y:
            if x & 1:
                best, x = max(best, tree[x]), x + 1
            if y & 1:
                y -= 1
                best = max(best, tree[y])
            x, y = x >> 1, y >> 1
        scores[i] = float(k)
        if best[1] >= 0 and best[0] - cost * (a + b) > 0:
            scores[i], before[i] = k + best[0] - cost * (a + b), best[1]
        entry, waiting = (scores[i] + cost * (a + b), i), live[ranks[i]]
        while waiting and waiting[-1] < entry:
            waiting.pop()
        waiting.append(entry)
        put(ranks[i])
    used, chains = [False] * len(order), []
    for i in sorted(range(len(order)), key=lambda i: -scores[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(order[i])
            i = before[i]
        if path:
            chains.append(path[::-1])
    return chains


def _chains(k: int, gap: int, cost: float):
    """Chains of each pair of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, sources, found = [], [], []
            for doc_id, pairs in zip(batch.column(0).to_pylist(), _pairs(batch.column(1)), strict=True):
                ids += [doc_id] * len(pairs)
                sources += pairs
                found += [chain(x, k, gap, cost) for x in pairs.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sources, pa.int64()), _path_lists(found)], names=["doc_id", "source_id", "chains"]
            )

    return run


def _views(k: int, gap: int, cost: float, min_words: int):
    """Chains of each pair of documents, and short hashes of the ``min_words`` words on both sides of
    those that are not yet as long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, sources, chains, views = [], [], [], []
            for doc_id, pairs, packed in zip(batch.column(0).to_pylist(), _pairs(batch.column(1)), batch.column(2), strict=True):
                words = np.frombuffer(packed.as_buffer(), WORDS).astype("<u2")
                ids += [doc_id] * len(pairs)
                sources += pairs
                for x in pairs.values():
                    found = chain(x, k, gap, cost)
                    chains.append(found)
                    for path in found:
                        a, b = path[0][0], path[-1][0] + k
                        views.append(None if b - a >= min_words else words[max(0, a - min_words) : b + min_words].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sources, pa.int64()), _path_lists(chains),
                    pa.ListArray.from_arrays(_ends(chains), pa.array(views, pa.binary())),
                ],
                names=["doc_id", "source_id", "chains", "views"],
            )

    return run


def furthest(present: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per row, how many words ``_extend`` can go on at most at the least price, for rows of words that occur
    near the other text's place or don't; rows hold ``sizes`` words. A word that does not occur costs an
    edit, so no path scores more than here. An end scores more than 0; a path at ``-DROP`` ends, but one just
    above may make one more edit before equal words follow. One that is not over where a whole row ends may
    score more beyond it."""
    bound = np.cumsum(np.where(present, np.int32(1), np.int32(-PRICES[0])), 1, np.int32)
    alive = np.logical_and.accumulate(bound > -DROP - PRICES[0], 1)
    at = np.arange(1, present.shape[1] + 1, dtype=np.int32)
    goes_on = (bound > 0) | (at == present.shape[1])
    return np.where(alive & goes_on & (at <= sizes[:, None]), at, 0).max(1, initial=0)


#: Views that are judged at a time, and which words occur on either side of each in the other text.
REACHED = 64
_SEEN = np.zeros((2 * REACHED, 1 << 16), bool)


def can_reach(views: list[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]], k: int, min_words: int) -> np.ndarray:
    """Whether the passages around chains can have ``min_words`` words, for (words around the chain, words of the
    other text, chain). Never false where ``align`` finds one: equal words are among those that
    occur in the stretch of the other text that its paths can get to, and it may not pass either end."""
    out = [_can_reach(views[i : i + REACHED], k, min_words) for i in range(0, len(views), REACHED)]
    return np.concatenate(out) if out else np.empty(0, bool)


def _can_reach(views: list[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]], k: int, min_words: int) -> np.ndarray:
    wide = min_words + (min_words + DROP) // PRICES[0] + 1  # and as many edits as a path lives through
    first = np.array([path[0] for _, _, path in views], np.int64).reshape(-1, 2)
    last = np.array([path[-1] for _, _, path in views], np.int64).reshape(-1, 2) + k
    lengths, spans = np.array([len(view) for view, _, _ in views]), last[:, 0] - first[:, 0]
    # Rows that repeat an id may hold shorter texts than the chain's.
    left, right = (np.minimum(np.minimum(first[:, 0], min_words) + x, lengths) for x in (0, spans))
    starts = np.cumsum(lengths) - lengths
    words = np.concatenate([*(view for view, _, _ in views), [0]]).astype("<u2")
    beside = [
        near.astype("<u2") for (_, other, _), a, b in zip(views, first[:, 1].tolist(), last[:, 1].tolist(), strict=True)
        for near in (other[max(0, a - wide) : a], other[b : b + wide])
    ]
    near, owners = np.concatenate(beside), np.repeat(np.arange(2 * len(views)), list(map(len, beside)))
    seen = _SEEN[: 2 * len(views)]
    seen[owners, near] = True
    at, rows = np.arange(min_words), np.arange(len(views))[:, None]
    reach = spans
    for side, sizes, places in (
        (0, left, (starts + left)[:, None] - 1 - at),
        (1, np.minimum(lengths - right, min_words), (starts + right)[:, None] + at),
    ):
        inside = at < sizes[:, None]
        reach = reach + furthest(inside & seen[2 * rows + side, words[np.where(inside, places, 0)]], sizes)
    seen[owners, near] = False
    return reach >= min_words


def _reaching(k: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            chains = list(_paths(batch.column(2)))
            ends, views = _lists(batch.column(3))
            views = views.to_pylist()
            keep = np.ones(len(views), bool)
            asked, places, j = [], [], 0
            for paths, other in zip(chains, batch.column(4), strict=True):
                b = np.frombuffer(other.as_buffer(), WORDS)
                for path in paths:
                    if views[j] is not None:
                        asked.append((np.frombuffer(views[j], "<u2"), b, path))
                        places.append(j)
                    j += 1
            keep[places] = can_reach(asked, k, min_words)
            keep = keep.tolist()
            kept = [[path for path, ok in zip(paths, keep[a:b], strict=True) if ok] for paths, (a, b) in zip(chains, pairwise(ends), strict=True)]
            rows = [i for i, paths in enumerate(kept) if paths]
            ids = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*ids.columns, _path_lists([kept[i] for i in rows])], names=["doc_id", "source_id", "chains"])

    return run


def _stretches(places: list[int], ok: set[int], n_words: int, k: int, edge: int, min_words: int) -> list[tuple[int, int]]:
    """Ranges of starts of runs of ``min_words`` words whose inner seeds are all in ``ok``. Inner seeds
    lie ``edge`` places from both ends of a run or more: each holder of the run has the same ones."""
    reach = min_words - k - edge
    ends = [-(edge + 1), *sorted({p for p in places if p not in ok}), n_words + min_words]
    starts = ((max(0, u - edge + 1), min(n_words - min_words, v - reach - 1)) for u, v in pairwise(ends))
    return [(lo, hi) for lo, hi in starts if lo <= hi]


def _open_seeds(k: int, neighbours: int, min_words: int):
    """Seeds in and beside a shared seed outside the found passages, where a whole run may be repeated."""
    edge = neighbours - 1
    reach = min_words - k - edge

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out: set[int] = set()
            sizes = batch.column(0).to_pylist()
            (at, places_), (shared_at, shared_), (span_at, spans) = (_lists(batch.column(i)) for i in (2, 3, 4))
            places_, seeds_, shared_ = places_.to_numpy(), _lists(batch.column(1))[1].to_numpy(), shared_.to_numpy()
            starts_, counts_ = (spans.field(i).to_numpy() for i in range(2))
            for i, n_words in enumerate(sizes):
                own = places_[at[i] : at[i + 1]]
                mine = shared_[shared_at[i] : shared_at[i + 1]]
                starts, ends = (x[span_at[i] : span_at[i + 1]] for x in (starts_, starts_ + counts_ - k))
                rows = np.argsort(starts, kind="stable")
                furthest_end = np.concatenate([[-1], np.maximum.accumulate(ends[rows])])
                covered = furthest_end[np.searchsorted(starts[rows], own, "right")] >= own
                left = own[np.isin(own, mine) & ~covered].tolist()
                if not left:
                    continue
                ok, places, seeds = set(mine.tolist()), own.tolist(), seeds_[at[i] : at[i + 1]].tolist()
                for lo, hi in _stretches(places, ok, n_words, k, edge, min_words):
                    for t in left[bisect_left(left, lo + edge) : bisect_right(left, hi + reach)]:
                        a, b = max(lo, t - reach) + edge, min(hi, t - edge) + reach
                        out.update(seeds[bisect_left(places, a) : bisect_right(places, b)])
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64())], names=["seed"])

    return run


def _whole_runs(k: int, neighbours: int, min_words: int):
    """Hashes of the runs of ``min_words`` words with open inner seeds only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, found, at = [], [], []
            for doc_id, n_words, places, ok, packed in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                ranges = _stretches(places, set(ok), n_words, k, neighbours - 1, min_words)
                words = np.frombuffer(packed, WORDS).astype(np.uint64)
                for lo, hi in ranges:
                    h = runs(words[lo : hi + min_words], min_words).view(np.int64)
                    ids += [doc_id] * len(h)
                    found.append(h)
                    at.append(np.arange(lo, lo + len(h), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(np.concatenate(found) if found else [], pa.int64()),
                    pa.array(np.concatenate(at) if at else [], pa.int32()),
                ],
                names=["doc_id", "seed", "place"],
            )

    return run


def _common(a: list, b: list) -> int:
    """Length of the longest common subsequence of two short lists."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def _extend(
    a: list, b: list, i: int, j: int, step: int, price: int, state: tuple[dict[int, int], int, int, tuple[int, int, int]] | None = None
) -> tuple[int, int, int]:
    """Go on from ``(i, j)`` in one direction to the best score: equal words less ``price`` for each changed,
    missing or added one; (words of a, words of b, equal words). Ends once all paths have lost ``DROP``; of ends
    equally good after as many edits, that with the least shift counts. ``state`` goes on from where ``extend_all`` has come to."""
    n, m = (len(a) - i, len(b) - j) if step > 0 else (i + 1, j + 1)
    # reached: by difference of words of b and a: words of a, equal words in the lower 32 bits
    reached, spent, best, end = state or ({0: 0}, 0, 0, (0, 0, 0))
    while reached:
        on: dict[int, int] = {}
        get, before, shift = on.get, best, (0, 0)
        for d, code in reached.items():
            x, equal = code >> 32, code & 0xFFFFFFFF
            limit = n if n < m - d else m - d
            if x < limit:
                p, last = i + step * x, i + step * limit
                q = p + j - i + step * d
                while p != last and a[p] == b[q]:
                    p, q = p + step, q + step
                run = (p - i) * step - x
                x, equal = x + run, equal + run
            score = equal - spent
            if score > best or score == best > before and (abs(d), d) < shift:
                best, end, shift = score, (x, x + d, equal), (abs(d), d)
            if score <= before - DROP:
                continue
            code = x << 32 | equal
            changed = code + (1 << 32)
            if x < limit and get(d, -1) < changed:
                on[d] = changed
            if x < n and get(d - 1, -1) < changed:
                on[d - 1] = changed
            if x + d < m and get(d + 1, -1) < code:
                on[d + 1] = code
        reached, spent = on, spent + price
    return end


def _equal_runs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, limits: np.ndarray, step: int) -> np.ndarray:
    """Equal words from each pair of places on, ``limits`` at most."""
    out = np.zeros(len(i), np.int64)
    rows, width = np.flatnonzero(limits > 0), 1
    while len(rows):
        left = limits[rows] - out[rows]
        ahead = np.minimum(np.arange(width), left[:, None] - 1) * step
        at = (out[rows] * step)[:, None] + ahead
        differ = a[i[rows][:, None] + at] != b[j[rows][:, None] + at]
        alike = ~differ.any(1)
        out[rows] += np.where(alike, np.minimum(width, left), differ.argmax(1))
        rows, width = rows[alike & (left > width)], min(4 * width, 64)
    return out


def extend_all(
    a: np.ndarray, b: np.ndarray, own: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray, step: int, price: int
) -> np.ndarray:
    """``_extend`` from many places at a time, as rows (words of a, words of b, equal words). ``a`` and ``b`` hold the
    words of many texts; ``own`` and ``other`` are where the texts of each place begin and end in them. All paths make
    their next edit together; the last few, with many edits, go on by themselves."""
    n, m = (own[:, 1] - i, other[:, 1] - j) if step > 0 else (i - own[:, 0] + 1, j - other[:, 0] + 1)
    ends, best, spent = np.zeros((len(i), 3), np.int64), np.zeros(len(i), np.int64), 0
    row = np.arange(len(i))
    d, x, equal = (np.zeros(len(i), np.int64) for _ in range(3))
    while len(row):
        firsts = np.flatnonzero(np.diff(row, prepend=-1))
        if len(firsts) <= FEW and spent > 0:
            for lo, hi in pairwise([*firsts.tolist(), len(row)]):
                r = int(row[lo])
                (s, e), (s2, e2) = own[r].tolist(), other[r].tolist()
                reached = dict(zip(d[lo:hi].tolist(), (x[lo:hi] << 32 | equal[lo:hi]).tolist(), strict=True))
                state = (reached, spent, int(best[r]), tuple(ends[r].tolist()))
                ends[r] = _extend(a[s:e].tolist(), b[s2:e2].tolist(), int(i[r]) - s, int(j[r]) - s2, step, price, state)
            break
        limit = np.minimum(n[row], m[row] - d)
        run = _equal_runs(a, b, i[row] + step * x, j[row] + step * (x + d), limit - x, step)
        x, equal = x + run, equal + run
        score = equal - spent
        alive = score > best[row] - DROP
        most = np.maximum.reduceat(score, firsts)
        better = np.repeat(most > best[row[firsts]], np.diff(firsts, append=len(row)))
        top = np.flatnonzero(better & (score == np.repeat(most, np.diff(firsts, append=len(row)))))
        # Of equally good ends, that with the least shift.
        top = top[np.lexsort((d[top], np.abs(d[top]), row[top]))]
        top = top[np.flatnonzero(np.diff(row[top], prepend=-1))]
        best[row[top]] = score[top]
        ends[row[top]] = np.stack([x[top], x[top] + d[top], equal[top]], 1)
        row, d, x, equal, limit = row[alive], d[alive], x[alive], equal[alive], limit[alive]
        code = x << 32 | equal
        ways = [(x < limit, 0, 1 << 32), (x < n[row], -1, 1 << 32), (x + d < m[row], 1, 0)]
        keys = np.concatenate([(row[ok] << 32) + d[ok] + shift for ok, shift, _ in ways])
        codes = np.concatenate([code[ok] + more for ok, _, more in ways])
        order = np.argsort(keys, kind="stable")
        keys, codes = keys[order], codes[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-(1 << 62)))
        keys = keys[starts]
        codes = np.maximum.reduceat(codes, starts) if len(starts) else codes
        row = (keys + (1 << 31)) >> 32
        d, x, equal, spent = keys - (row << 32), codes >> 32, codes & 0xFFFFFFFF, spent + price
    return ends


def _inside(a: list, b: list, path: list[tuple[int, int]]) -> int:
    """Equal words from a chain's first match to its last."""
    equal, (i, j) = 0, path[0]
    for (p, q), (p2, q2) in pairwise(path):
        i, j = max(i, p), max(j, q)
        while i < p2 and j < q2 and a[i] == b[j]:
            i, j, equal = i + 1, j + 1, equal + 1
        if i < p2 or j < q2:
            equal += _common(a[i:p2], b[j:q2])
        i, j = p2, q2
    return equal


def align(a: list, b: list, path: list[tuple[int, int]], k: int, price: int = 2) -> tuple[int, int, int, int, int]:
    """(start, end, source start, source end, equal words) of the passage around a chain."""
    (i, j), (i2, j2) = path[0], path[-1]
    back, source_back, equal = _extend(a, b, i - 1, j - 1, -1, price)
    on, source_on, more = _extend(a, b, i2, j2, 1, price)
    return i - back, i2 + on, j - source_back, j2 + source_on, equal + _inside(a, b, path) + more


def found_around(a: list, b: list, path: list[tuple[int, int]], k: int, min_words: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """Passages around a chain: of the whole chain, else around single matches, with ends that bridge less."""

    def first(part: list[tuple[int, int]]) -> tuple[bool, list[tuple[int, int, int, int, int]]]:
        """(is it long enough, the passage if it is alike enough, too)"""
        for price in PRICES:
            start, end, from_, to, equal = align(a, b, part, k, price)
            if end - start < min_words:
                return price != PRICES[0], []
            if equal >= identity * max(end - start, to - from_):
                return True, [(start, end, from_, to, equal)]
        return True, []

    long, out = first(path)
    if out or not long or len(path) == 1:
        return out
    for match in path:
        if not out or match[0] >= out[-1][1]:
            out += first([match])[1]
    return out


Text = tuple[int, int]  # where it begins and ends in an array of many


def found_around_all(
    a: np.ndarray, b: np.ndarray, chains: list[tuple[Text, Text, list[tuple[int, int]]]], k: int, min_words: int, identity: float
) -> list[list[tuple[int, int, int, int, int]]]:
    """``found_around`` of many chains (text in ``a``, text in ``b``, path) at a time."""
    out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in chains]
    texts = np.array([[*one, *two] for one, two, _ in chains], np.int64).reshape(-1, 4)
    first = np.array([path[0] for _, _, path in chains], np.int64).reshape(-1, 2) + texts[:, ::2]
    last = np.array([path[-1] for _, _, path in chains], np.int64).reshape(-1, 2) + texts[:, ::2]
    asked, inside = np.arange(len(chains)), np.zeros(len(chains), np.int64)
    again: list[int] = []
    for price in PRICES:
        groups = [asked[i : i + ALIGNED] for i in range(0, len(asked), ALIGNED)]
        asked = np.empty(0, np.int64)
        for group in groups:
            own, other, f, g = texts[group, :2], texts[group, 2:], first[group], last[group]
            back = extend_all(a, b, own, other, f[:, 0] - 1, f[:, 1] - 1, -1, price)
            on = extend_all(a, b, own, other, g[:, 0], g[:, 1], 1, price)
            start, end = f - back[:, :2], g + on[:, :2]
            words = end - start
            long = words[:, 0] >= min_words
            if price == PRICES[0]:
                for r in group[long].tolist():
                    (s, _), (s2, _), path = chains[r]
                    if len(path) > 1:
                        (i, j), (i2, j2) = path[0], path[-1]
                        moved = [(p - i, q - j) for p, q in path]
                        inside[r] = _inside(a[s + i : s + i2].tolist(), b[s2 + j : s2 + j2].tolist(), moved)
            else:
                again += group[~long].tolist()
            equal = back[:, 2] + inside[group] + on[:, 2]
            good = long & (equal >= identity * words.max(1))
            places = np.concatenate([start - texts[group, ::2], end - texts[group, ::2], equal[:, None]], 1)[good]
            for r, (x, y, x2, y2, e) in zip(group[good].tolist(), places.tolist(), strict=True):
                out[r] = [(x, x2, y, y2, e)]
            asked = np.concatenate([asked, group[long & ~good]])
    for r in [*again, *asked.tolist()]:
        (s, e), (s2, e2), path = chains[r]
        if len(path) > 1:  # as a whole it is long, but not alike enough
            out[r] = found_around(a[s:e].tolist(), b[s2:e2].tolist(), path, k, min_words, identity)
    return out


def longest(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The passages of two documents that lie in no other one of them; of those in the same place, that
    with the most equal words. They hold the same words of the document as all of them."""
    kept: list[tuple[int, int, int, int, int]] = []
    for x in sorted(found, key=lambda x: (x[0], -x[1], -x[4], x[2:])):
        if not kept or x[1] > kept[-1][1]:
            kept.append(x)
    return kept


def _flat(column: pa.BinaryArray) -> tuple[np.ndarray, list[int]]:
    """Words of all rows, and where each row's begin, with the end of the last."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32 if column.type == pa.binary() else np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", WORDS, int(ends[-1]) // 4), (ends // 4).tolist()


def _align(k: int, min_words: int, identity: float):
    def found_in(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, int, int, int]]]:
        """Each row's passages."""
        (a, own), (b, other) = (_flat(batch.column(i)) for i in (3, 4))
        asked, ends = [], [0]
        for r, paths in enumerate(_paths(batch.column(2))):
            one, two = (own[r], own[r + 1]), (other[r], other[r + 1])
            n, m = one[1] - one[0], two[1] - two[0]
            for matches in paths:
                path = [(p, q) for p, q in matches if p + k <= n and q + k <= m]
                if path:
                    asked.append((one, two, path))
            ends.append(len(asked))
        found = found_around_all(a, b, asked, k, min_words, identity)
        for lo, hi in pairwise(ends):
            yield [x for part in found[lo:hi] for x in part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            ids = (batch.column(i).to_pylist() for i in range(2))
            for doc_id, source, found in zip(*ids, found_in(batch), strict=True):
                for start, end, from_, to, equal in longest(found):
                    out.append((doc_id, start, end - start, source, from_, to - from_, equal))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            names = [c.split()[0] for c in PASSAGES.split(", ")]
            kinds = [pa.int64() if "long" in c else pa.int32() for c in PASSAGES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def passages(
    docs: DataFrame, min_words: int = MIN_WORDS, k: int = K, neighbours: int = NEIGHBOURS, identity: float = IDENTITY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Passages of at least ``min_words`` words that an earlier document (smaller id) also holds:
    doc_id, start, n_words, source_id, source_start, source_words, matched. Places count the
    document's words (between ASCII white space, case ignored).

    Each passage is tied to one earlier holder, not to all. A repeated run of ``min_words`` unchanged words
    is found whatever earlier documents hold of its pieces; where one holds a passage of its middle, up to
    ``neighbours`` + ``k`` words at its ends may be left out. A changed passage without such a run is not found if its every
    seed stands in shorter pieces of still earlier documents. Null, empty and short texts have none;
    rows without an id take no part; rows that repeat an id count as one document; passages
    repeated only inside one document are not reported; an empty table gives no rows. Where chains of the same
    two documents give passages inside one another, as in repeated lines, that which holds the others is reported.
    """
    # All seeds of a repeated run must lie inside it.
    k = min(k, min_words)
    neighbours = min(neighbours, (min_words - k) // 2 + 1)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = rows.where("doc_id is not null")
    # Texts are split into words once; later steps move and compare their short hashes.
    packed = stored(rows.mapInArrow(_seeds(k, neighbours), SEEDS), "seeds")
    words = packed.select("doc_id", "words")
    seeds = packed.select("doc_id", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "doc_id", F.col("s.hashes").alias("seed"), F.col("s.places").alias("place")
    )
    matches = _matches(seeds, "shared-seeds")
    # No more matches than the document has seeds, as each points to one holder.
    matched = stored(
        matches.groupBy("doc_id").agg(F.collect_list(F.struct("source_id", "place", "source_place")).alias("matches")), "matched"
    )
    # Few chains become passages. Words around a chain tell which can; only for those do whole documents move by pair.
    viewed = stored(matched.join(words, "doc_id").mapInArrow(_views(k, GAP, GAP_COST, min_words), VIEWS), "views")
    sided = viewed.join(words.toDF("source_id", "other"), "source_id").select("doc_id", "source_id", "chains", "views", "other")
    chained = sided.mapInArrow(_reaching(k, min_words), CHAINS)
    found = stored(_aligned(words, chained, k, min_words, identity), "found")
    # Seeds whose holder has no passage there: whole runs of words point to the first holder of the run.
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words")).alias("spans"))
    sides = matched.join(packed.select("doc_id", "n_words", "hashes", "places"), "doc_id").join(spans, "doc_id", "left")
    sides = sides.select("n_words", "hashes", "places", F.col("matches.place").alias("shared"), "spans")
    open_ = stored(sides.mapInArrow(_open_seeds(k, neighbours, min_words), "seed long").distinct(), "open-seeds")
    places = seeds.join(open_, "seed", "left_semi").groupBy("doc_id").agg(F.collect_list("place").alias("open"))
    asked = packed.select("doc_id", "n_words", "places", "words").join(places, "doc_id")
    whole = stored(
        asked.select("doc_id", "n_words", "places", "open", "words").mapInArrow(_whole_runs(k, neighbours, min_words), RUNS), "whole-runs"
    )
    again = _matches(whole, "shared-runs").groupBy("doc_id").agg(F.collect_list(F.struct("source_id", "place", "source_place")).alias("matches"))
    chained = again.mapInArrow(_chains(1, 0, 0.0), CHAINS)
    return found.unionAll(_aligned(words, chained, k, min_words, identity)).distinct()


def _matches(seeds: DataFrame, name: str) -> DataFrame:
    """Each seed (doc_id, seed, place) with its first holder, if that is an earlier document."""
    first = seeds.groupBy("seed").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("last"))
    shared = stored(
        first.where("last > first.doc_id").select("seed", F.col("first.doc_id").alias("source_id"), F.col("first.place").alias("source_place")),
        name,
    )
    return seeds.join(shared, "seed").where("doc_id > source_id")


def _aligned(words: DataFrame, chains: DataFrame, k: int, min_words: int, identity: float) -> DataFrame:
    """The passages around chains, from the words of both documents."""
    chained = stored(chains, "chains")
    needed = chained.select("doc_id").unionAll(chained.select("source_id")).distinct()
    texts = stored(words.join(needed, "doc_id", "left_semi"), "chain-texts")
    both = chained.join(texts.toDF("doc_id", "own"), "doc_id").join(texts.toDF("source_id", "other"), "source_id")
    both = both.select("doc_id", "source_id", "chains", "own", "other")
    return both.mapInArrow(_align(k, min_words, identity), PASSAGES).distinct()


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans (start, number of words) and the blanks after them."""
    data = text.encode()
    at = [m.start() for m in WORD.finditer(data)]
    at.append(len(data))
    kept, place, word = [], 0, 0
    for start, n in sorted(spans):
        first, last = max(start, word), min(start + n, len(at) - 1)
        if first < last:
            kept.append(data[place : at[first]])
            place, word = at[last], last
    return (b"".join(kept) + data[place:]).decode()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column holds the spans to cut from ``text``."""
    for batch in batches:
        spans = [[(s["start"], s["n_words"]) for s in found or ()] for found in batch.column(batch.num_columns - 1).to_pylist()]
        i = batch.schema.get_field_index("text")
        texts = [cut_words(t, s) if s else t for t, s in zip(batch.column(i).to_pylist(), spans, strict=True)]
        columns, fields = batch.columns[:-1], list(batch.schema)[:-1]
        columns[i] = pa.array(texts, fields[i].type)
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))


def without_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) less the found passages; their first holder keeps them. Passages are
    places in the text of an id: rows that share an id, but not the text, stay as they are."""
    name = "_spans"
    while name in docs.columns:
        name = f"_{name}"
    text = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n_words")).alias(name))
    spans = spans.join(several, "doc_id", "left_anti")
    return docs.join(spans, "doc_id", "left").select(*docs.columns, name).mapInArrow(_cut, docs.schema)
