"""Conversations as training text, assembled as columns of bytes.

A batch of turns is one buffer of text bytes with offsets. NumPy finds the control strings in it,
the lengths of all segments (header, content, trailer of each turn), their cumulative offsets and
the place of every content byte; headers and contents are then copied into one preallocated Arrow
buffer, which becomes the column of formatted conversations. Reading back takes the same steps the
other way round.

Control strings inside texts get a backslash after their first character (one more if they have
some already), so that each unescaped control string is a mark of the template and texts come back
as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.scratch import stored

#: Bytes of a conversation after which it goes on in a further row.
PART = 16 << 20

#: Bytes that a turn counts for besides its role and text.
TURN = 32

#: Bytes of text that are assembled at once, if no single conversation has more.
CHUNK = 4 << 20

_BACKSLASH = 0x5C


@dataclass(frozen=True)
class Template:
    """Marks before and after the turns of a role. Roles without marks of their own are written
    between ``named`` marks: name, middle mark, text, end mark.

    A mark is a control string with white space between it and the content, so none arises
    where content and mark meet.
    """

    roles: dict[str, tuple[str, str]]
    named: tuple[str, str, str]
    loss_roles: frozenset[str] = frozenset({"assistant"})
    controls: tuple[bytes, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = [m for pair in self.roles.values() for m in pair] + list(self.named)
        controls = [m.strip().encode() for m in marks]
        if len(set(controls)) < len(controls) or any(len(c) < 2 or b"\\" in c or len(c.split()) != 1 for c in controls):
            raise ValueError("marks have to be different, of one word and without backslashes")
        for c in controls:
            for d in controls:
                if any(d.startswith(c[i:]) or c[i:].startswith(d) for i in range(1, len(c))):
                    raise ValueError(f"{d!r} can begin inside {c!r}")
        starts = [pair[0] for pair in self.roles.values()] + [self.named[0]]
        middles = [pair[1] for pair in self.roles.values()] + list(self.named[1:])
        if not all(m[-1].isspace() for m in starts) or not all(m[0].isspace() for m in middles) or not self.named[1][-1].isspace():
            raise ValueError("white space has to stand between a mark and the content")
        object.__setattr__(self, "controls", tuple(controls))


# The marks of a widely used instruction format; assistant turns are its whole sequences.
INSTRUCT = Template(
    roles={
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": ("[INST] ", " [/INST]\n"),
        "assistant": ("<s> ", " </s>\n"),
    },
    named=("[ROLE] ", " [/ROLE] ", " [/TURN]\n"),
)


# --- control strings in columns of bytes


def _skip_backslashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first place from ``at`` on without a backslash."""
    if not len(at) or not (data[np.minimum(at, len(data) - 1)] == _BACKSLASH).any():
        return at
    others = np.append(np.flatnonzero(data != _BACKSLASH), len(data))
    return others[np.searchsorted(others, at)]


def find_controls(data: np.ndarray, ends: np.ndarray, controls: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control strings, escaped or not: their first byte, their number, and how many backslashes follow
    the first byte. ``ends`` are the ends of the texts that ``data`` holds; none is found across an end."""
    controls = list(controls)
    heads = np.flatnonzero(np.isin(data, np.frombuffer(bytes({c[0] for c in controls}), np.uint8)))
    tails = _skip_backslashes(data, heads + 1)
    number = np.full(len(heads), -1)
    limit = ends[np.minimum(np.searchsorted(ends, heads, "right"), len(ends) - 1)] if len(heads) else heads
    for k, control in enumerate(controls):
        fits = np.flatnonzero((data[heads] == control[0]) & (tails + len(control) - 1 <= limit)) if len(heads) else heads
        for i, byte in enumerate(control[1:]):
            fits = fits[data[tails[fits] + i] == byte]
        number[fits] = k
    found = number >= 0
    return heads[found], number[found], (tails - heads - 1)[found]


def _shifted(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, by: int) -> np.ndarray:
    """Offsets after one byte more (``by`` 1) or less (-1) at each of the ``cuts``."""
    return offsets + by * np.searchsorted(cuts, offsets, "left")


def escape(data: np.ndarray, offsets: np.ndarray, controls: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts (bytes and offsets) with a backslash after the first byte of each control string."""
    heads, _, _ = find_controls(data, offsets[1:], controls)
    if not len(heads):
        return data, offsets
    return np.insert(data, heads + 1, _BACKSLASH), _shifted(data, offsets, heads + 1, 1)


def unescape(data: np.ndarray, offsets: np.ndarray, controls: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    heads, _, backslashes = find_controls(data, offsets[1:], controls)
    cuts = heads[backslashes > 0] + 1
    if not len(cuts):
        return data, offsets
    return np.delete(data, cuts), _shifted(data, offsets, cuts, -1)


def characters(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, and of all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


# --- assembly


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets, from 0 on, of a column of texts; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _fixed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return _bytes(pa.array(texts, pa.string()))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def assemble(columns: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[pa.Buffer, np.ndarray]:
    """Rows of segments as one buffer. A column of segments is (bytes, offsets, the number of the
    segment that each row takes). Returns the buffer and the offset of each segment, row by row."""
    picked = [(data, offsets[:-1][pick], np.diff(offsets)[pick]) for data, offsets, pick in columns]
    lengths = np.stack([length for _, _, length in picked], axis=1)
    offsets = np.concatenate([[0], np.cumsum(lengths.ravel())])
    buffer = pa.allocate_buffer(int(offsets[-1]))
    out = np.frombuffer(buffer, np.uint8)
    targets = offsets[:-1].reshape(lengths.shape)
    for k, (data, starts, length) in enumerate(picked):
        out[_ranges(targets[:, k], length)] = data[_ranges(starts, length)]
    return buffer, offsets


def _format(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[pa.Buffer, np.ndarray]:
    """Buffer of all turns, and the offsets of header, content and trailer of each."""
    coded = pc.fill_null(roles, "").dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    names = coded.dictionary.to_pylist()
    safe, ends = escape(*_fixed(names), template.controls)
    escaped = [safe[a:b].tobytes().decode() for a, b in zip(ends, ends[1:], strict=False)]
    first, middle, last = template.named
    marks = [template.roles.get(n, (first + e + middle, last)) for n, e in zip(names, escaped, strict=True)]
    data, offsets = escape(*_bytes(texts), template.controls)
    return assemble(
        [
            (*_fixed([m[0] for m in marks]), code),
            (data, offsets, np.arange(len(texts))),
            (*_fixed([m[1] for m in marks]), code),
        ]
    )


def _part(roles: pa.Array, texts: pa.Array, groups: np.ndarray, template: Template) -> tuple[pa.Array, pa.Array]:
    """Formatted texts and loss spans (in code points) of consecutive groups of turns; ``groups`` are
    their first rows and, at last, the number of rows."""
    buffer, offsets = _format(roles, texts, template)
    ends = offsets[3 * groups]
    formatted = pa.Array.from_buffers(pa.string(), len(groups) - 1, [None, pa.py_buffer(ends.astype(np.int32)), buffer])
    before = characters(np.frombuffer(buffer, np.uint8))
    learned = pc.is_in(pc.fill_null(roles, ""), pa.array(sorted(template.loss_roles), pa.string())).to_numpy(zero_copy_only=False)
    turns = np.flatnonzero(learned)
    group = np.searchsorted(groups, turns, "right") - 1
    start = before[offsets[3 * turns + 1]] - before[ends[group]]
    length = before[offsets[3 * turns + 2]] - before[offsets[3 * turns + 1]]
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(length, pa.int64())], ["start", "length"])
    places = pa.array(np.searchsorted(turns, groups), pa.int32())
    return formatted, pa.ListArray.from_arrays(places, spans)


def _starts(rows: pa.Table) -> np.ndarray:
    """First rows of the groups of conv_id and block."""
    changed = np.zeros(rows.num_rows, bool)
    changed[:1] = True
    for name in ("conv_id", "block"):
        code = rows[name].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        changed[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(changed)


def _parts(rows: pa.Table, groups: np.ndarray, number: int, template: Template) -> Iterator[pa.RecordBatch]:
    """One row per group; the first one is the part ``number`` of its group, others are part 0."""
    size = pc.fill_null(pc.binary_length(rows["text"]), 0).to_numpy()
    before = np.concatenate([[0], np.cumsum(size)])[groups]
    at = 0
    while at < len(groups) - 1:
        to = max(at + 1, int(np.searchsorted(before, before[at] + CHUNK, "right")) - 1)
        chosen = rows.slice(groups[at], groups[to] - groups[at]).combine_chunks()
        local = groups[at : to + 1] - groups[at]
        formatted, loss = _part(_one(chosen, "role"), _one(chosen, "text"), local, template)
        first = chosen.take(pa.array(local[:-1]))
        numbers = np.zeros(to - at, np.int64)
        numbers[0] = number if at == 0 else 0
        yield pa.RecordBatch.from_arrays(
            [_one(first, "conv_id"), _one(first, "block"), pa.array(numbers), pa.array(np.diff(local)), formatted, loss],
            names=["conv_id", "block", "part", "n_turns", "formatted", "loss"],
        )
        at = to


def _one(rows: pa.Table, name: str) -> pa.Array:
    column = rows[name].combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _formatter(template: Template, part_bytes: int):
    """Turns in order to formatted parts. The last group of a batch waits for the next batch; beyond
    ``part_bytes`` it becomes a part, and the rest of its turns go to further parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, opened, number = None, None, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([waiting, rows]) if waiting is not None else rows
            if not rows.num_rows:
                continue
            starts = _starts(rows)
            if _key(rows, 0) != opened:
                opened, number = None, 0
            if len(starts) > 1:
                yield from _parts(rows, starts, number, template)
                opened, number = None, 0
            waiting = rows.slice(starts[-1])
            if _weight(waiting) >= part_bytes:
                yield from _parts(waiting, np.array([0, waiting.num_rows]), number, template)
                waiting, opened, number = None, _key(waiting, 0), number + 1
        if waiting is not None:
            number = number if _key(waiting, 0) == opened else 0
            yield from _parts(waiting, np.array([0, waiting.num_rows]), number, template)

    return run


def _weight(rows: pa.Table) -> int:
    return sum(pc.sum(pc.binary_length(rows[c])).as_py() or 0 for c in ("role", "text")) + TURN * rows.num_rows


def _key(rows: pa.Table, i: int) -> tuple:
    return rows["conv_id"][i].as_py(), rows["block"][i].as_py()


class Chat(NamedTuple):
    """Formatted conversations: conv_id, block, part, n_turns, formatted, loss (start and length, in code
    points, of each text to learn from). ``whole`` has a row per conversation; ``parts``, if there are long
    conversations, several rows for each of these, in the order of block and part."""

    whole: DataFrame
    parts: DataFrame | None

    def rows(self) -> DataFrame:
        return self.whole if self.parts is None else self.whole.unionAll(self.parts)


def format_chat(
    conversations: DataFrame, template: Template = INSTRUCT, part_bytes: int = PART,
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> Chat:
    """Turns of each conversation in the order of turn (null first), role and text, as training text.

    Null texts and roles are empty. Rows with a null id are one conversation; repeated rows are turns
    of their own. Texts move once, to the task of their conversation. A conversation of more than
    ``part_bytes`` is cut into blocks of turns that go to different tasks, so no task or row
    holds it whole.
    """
    turns = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    weight = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("role", "text")), F.lit(TURN))
    sizes = turns.groupBy(F.col("conv_id").alias("_id")).agg(
        F.sum(weight).alias("_bytes"),
        F.min("turn").cast("double").alias("_first"), F.max("turn").cast("double").alias("_last"),
    )
    long = stored(sizes.where(F.col("_bytes") > part_bytes), "long_conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    if long.isEmpty():
        return Chat(_assembled(turns.withColumn("block", F.lit(0).cast("long")), template, part_bytes + 1), None)
    ordinary = turns.join(long, same, "left_anti").withColumn("block", F.lit(0).cast("long"))
    blocks = F.ceil(F.col("_bytes") / part_bytes)
    block = F.floor((F.col("turn") - F.col("_first")) / (F.col("_last") - F.col("_first") + 1) * blocks)
    spread = turns.join(long, same).withColumn("block", F.coalesce(block, F.lit(-1)).cast("long"))
    return Chat(
        _assembled(ordinary, template, part_bytes + 1),
        stored(_assembled(spread, template, part_bytes), "long_formatted"),
    )


def _assembled(turns: DataFrame, template: Template, part_bytes: int) -> DataFrame:
    columns = ["conv_id", "block", "turn", "role", "text"]
    ordered = turns.select(columns).repartition("conv_id", "block").sortWithinPartitions(columns)
    schema = T.StructType(
        [T.StructField("conv_id", turns.schema["conv_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("block", "part", "n_turns")]
        + T._parse_datatype_string("formatted string, loss array<struct<start:long,length:long>>").fields
    )
    return ordered.select("conv_id", "block", "role", "text").mapInArrow(_formatter(template, part_bytes), schema)


# --- reading back


class _Turns(NamedTuple):
    """Turns of a batch of formatted texts: the row each stands in, its role and its text."""

    row: np.ndarray
    roles: list[str]
    role: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[_ranges(starts, ends - starts)], np.concatenate([[0], np.cumsum(ends - starts)])


def parse(data: np.ndarray, offsets: np.ndarray, template: Template) -> _Turns:
    """The turns, with all control strings in their texts as they were."""
    heads, number, backslashes = find_controls(data, offsets[1:], template.controls)
    heads, number = heads[backslashes == 0], number[backslashes == 0]
    marks = [m for pair in template.roles.values() for m in pair] + list(template.named)
    behind = np.array([len(m.lstrip().encode()) for m in marks])
    ahead = np.array([len(m.encode()) - len(m.lstrip().encode()) for m in marks])
    middle = len(marks) - 2
    is_end = (number < middle - 1) & (number % 2 == 1) | (number == middle + 1)
    begin, end = np.flatnonzero(~is_end & (number != middle)), np.flatnonzero(is_end)
    own = number[begin] == middle - 1
    if len(begin) != len(end) or (end != begin + 1 + own).any():
        raise ValueError("marks don't alternate: not a text of this template")
    opened = begin + own  # the mark right before the content
    roles = list(template.roles)
    role = number[begin] // 2
    start = heads[opened] + behind[number[opened]]
    known = {}
    for i in np.flatnonzero(own):
        name = data[heads[begin[i]] + behind[middle - 1] : heads[opened[i]] - ahead[middle]]
        plain, _ = unescape(name, np.array([0, len(name)]), template.controls)
        role[i] = known.setdefault(plain.tobytes(), len(roles) + len(known))
    texts = unescape(*_gathered(data, start, heads[end] - ahead[number[end]]), template.controls)
    row = np.searchsorted(offsets, heads[begin], "right") - 1
    return _Turns(row, roles + [k.decode() for k in known], role, *texts)


def _learned(data: np.ndarray, offsets: np.ndarray, loss: pa.ListArray, template: Template) -> tuple[np.ndarray, np.ndarray]:
    """All text under the loss spans, unescaped, and its offsets by row."""
    spans = loss.flatten()
    counts = loss.value_lengths().to_numpy(zero_copy_only=False)
    before = characters(data)
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = before[offsets[:-1]].repeat(counts) + spans.field("start").to_numpy()
    last = first + spans.field("length").to_numpy()
    text, ends = unescape(*_gathered(data, lead[first], lead[last]), template.controls)
    return text, ends[np.concatenate([[0], np.cumsum(counts)])]


class _Digest:
    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self, conv_id) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def _digests(template: Template, schema: T.StructType):
    names = [f.name for f in schema]

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        kinds = [kind, *(pa.string() if n.endswith("sha256") else pa.int64() for n in names[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            data, offsets = _bytes(batch.column(1))
            found = parse(data, offsets, template)
            newline = (*_fixed(["\n"]), np.zeros(len(found.role), np.int64))
            buffer, ends = assemble(
                [(*_fixed(found.roles), found.role), newline, (found.data, found.offsets, np.arange(len(found.role))), newline]
            )
            ends = ends[4 * np.searchsorted(found.row, np.arange(len(offsets)))]
            learned, places = _learned(data, offsets, batch.column(2), template)
            chars, learned_chars = characters(data)[offsets], characters(learned)[places]
            turns, view, out = np.bincount(found.row, minlength=len(batch)), memoryview(buffer), []
            for i, conv_id in enumerate(batch.column(0).to_pylist()):
                if digest is None or conv_id != current:
                    if digest is not None:
                        out.append(digest.row(current))
                    current, digest = conv_id, _Digest()
                digest.n_turns += int(turns[i])
                digest.turns.update(view[ends[i] : ends[i + 1]])
                digest.loss.update(learned[places[i] : places[i + 1]])
                digest.loss_chars += int(learned_chars[i + 1] - learned_chars[i])
                digest.formatted_chars += int(chars[i + 1] - chars[i])
            yield batch_of(out, batch.column(0).type)
        if digest is not None:
            yield batch_of([digest.row(current)], batch.column(0).type)

    return run


def digests(chat: Chat, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from what the formatted
    texts and their loss spans hold. The parts of a long conversation run through one task, one after
    the other, as a digest can't be put together from parts; no task holds more than a batch of them."""
    kind = chat.whole.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    columns = ("conv_id", "formatted", "loss")
    found = chat.whole.select(*columns).mapInArrow(_digests(template, schema), schema)
    if chat.parts is None:
        return found
    ordered = chat.parts.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    return found.unionAll(ordered.select(*columns).mapInArrow(_digests(template, schema), schema))
