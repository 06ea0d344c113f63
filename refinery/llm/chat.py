"""Chat formatting by columnar byte assembly.

Rows of turns, sorted by conversation and turn, become one text per conversation:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

For a run of turns the lengths of all segments (header, content, footer) are laid out, their
cumulative sums are the places of the segments, and the bytes of headers and contents are scattered
into one preallocated buffer, which becomes an Arrow string column without further copies.

Inside contents every ``<|`` gets a backslash, and so does every ``<`` that is followed by
backslashes and ``|``; taking one backslash away restores the text. In roles line ends and
backslashes are escaped first, so a header always ends at its first line end. Nothing but the
template can therefore contain ``<|``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from refinery.llm.textbatch import string_buffers

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
#: Bytes of contents that are scattered at a time.
BLOCK_BYTES = 4 << 20
#: Characters by which rows of one turn and role are dealt to tasks; enough to part texts that differ.
RANGE_CHARS = 32
#: Bytes of a conversation's texts that a task holds before it leaves its digest to the next step.
HELD_BYTES = 4 << 20
_FRAGMENT = (
    "conv_id bigint, part bigint, n_turns bigint, formatted string, n_chars bigint, "
    "loss array<struct<start:bigint,end:bigint>>"
)


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column.cast(pa.large_string()).fill_null(""), r"<(\\*)\|", r"<\\\1|")


def escape_role(column: pa.Array) -> pa.Array:
    plain = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), "\\", "\\\\")
    return escape(pc.replace_substring(plain, "\n", "\\n"))


_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPED = re.compile(r"\\(\\|n)")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def _around(before: str, column: pa.Array, after: str) -> pa.Array:
    wide = [pa.scalar(text, pa.large_string()) for text in (before, after, "")]
    return pc.binary_join_element_wise(wide[0], column, wide[1], wide[2])


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> None:
    """Copy row i of (data, offsets) to ``places[i]`` of ``out``, a block of rows at a time."""
    row, rows = 0, len(places)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        sizes = offsets[row + 1 : end + 1] - offsets[row:end]
        part = data[offsets[row] : offsets[end]]
        out[np.arange(len(part)) + np.repeat(places[row:end] - (offsets[row:end] - offsets[row]), sizes)] = part
        row = end


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, each turn's offsets, and where its content starts."""
    headers, header_at = string_buffers(_around(START, escape_role(roles), "\n"))
    contents, content_at = string_buffers(escape(texts))
    footer = np.frombuffer(END.encode(), np.uint8)
    sizes = np.stack((np.diff(header_at), np.diff(content_at), np.full(len(roles), len(footer))), axis=1)
    places = np.concatenate(([0], np.cumsum(sizes.reshape(-1))))
    segment = places[:-1].reshape(-1, 3)
    out = np.empty(places[-1], np.uint8)
    _scatter(out, headers, header_at, segment[:, 0])
    _scatter(out, contents, content_at, segment[:, 1])
    out[segment[:, 2][:, None] + np.arange(len(footer))] = footer
    return out, places[::3], segment[:, 1]


def _characters(data: np.ndarray) -> np.ndarray:
    """How many code points lie before each byte, and in all."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one conversation's turns within a batch; a long conversation has several parts.

    Tasks hold ranges of the sorted rows, so parts numbered within tasks in their order ascend.
    """
    part = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        if not ids:
            continue
        data, turn_at, content_at = assemble(batch.column("role"), batch.column("text"))
        content_end = turn_at[1:] - len(END)
        counts = _characters(data)
        starts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
        parts = range(part, part := part + len(starts) - 1)
        firsts, lasts = turn_at[starts[:-1]], turn_at[starts[1:]]
        learned = pc.equal(batch.column("role"), LEARNED).fill_null(False).to_numpy(zero_copy_only=False)
        bases = np.repeat(counts[firsts], np.diff(starts))
        spans = pa.StructArray.from_arrays(
            [
                pa.array((counts[content_at] - bases)[learned]),
                pa.array((counts[content_end] - bases)[learned]),
            ],
            ["start", "end"],
        )
        span_at = np.concatenate(([0], np.cumsum(learned)))[starts].astype(np.int32)
        texts = pa.LargeStringArray.from_buffers(len(firsts), pa.py_buffer(np.append(firsts, lasts[-1:])), pa.py_buffer(data))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id").take(pa.array(starts[:-1], pa.int64())),
                pa.array(parts, pa.int64()),
                pa.array(np.diff(starts).astype(np.int64)),
                texts.cast(pa.string()),
                pa.array(counts[lasts] - counts[firsts]),
                pa.ListArray.from_arrays(pa.array(span_at), spans),
            ],
            ["conv_id", "part", "n_turns", "formatted", "n_chars", "loss"],
        )


def format_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, part, n_turns, formatted, n_chars, loss.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Turns are ordered by
    turn, rows that tie by role and text, nulls first. A null role or text counts as empty, a null
    conv_id is a conversation of its own. ``loss`` lists the code point spans of the assistants'
    contents within the part. Rows are dealt to tasks by ranges of that order, so a conversation with
    many turns is formatted by many tasks. One that a task or an Arrow batch does not hold whole has
    several parts, whose numbers ascend in its order (with gaps); the longest one needs no more memory
    than others. Only rows of one conversation, turn and role that begin with the same
    ``RANGE_CHARS`` characters stay together. An empty table gives an empty result.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(RANGE_CHARS)))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_fragments, _FRAGMENT)


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text; anything else in it is an error."""
    turns, place = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != place:
            raise ValueError("formatted text is broken")
        turns.append((unescape_role(found[1]), unescape(found[2])))
        place = found.end()
    if place != len(formatted):
        raise ValueError("formatted text is broken")
    return turns


class _Digest:
    """Running hashes of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, read: dict) -> None:
        self.turns += read["n_turns"]
        self.loss_chars += read["loss_chars"]
        self.chars += read["formatted_chars"]
        self.turn_hash.update(read["said"])
        self.loss_hash.update(read["learned"])

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.turn_hash.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss_hash.hexdigest(), "formatted_chars": self.chars,
        }


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)
_DIGEST_COLUMNS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)
#: Either a digest, or (``said`` not null) what a part adds to the running hashes of its conversation.
_READ = pa.schema([*_DIGESTS, ("part", pa.int64()), ("said", pa.binary()), ("learned", pa.binary())])
_READ_COLUMNS = f"{_DIGEST_COLUMNS}, part bigint, said binary, learned binary"


def _read(row: dict) -> dict:
    """What a reader finds in a part: its turns, and the unescaped text under the loss mask."""
    turns = read_turns(row["formatted"])
    learned = [unescape(row["formatted"][span["start"] : span["end"]]) for span in row["loss"]]
    return {
        "conv_id": row["conv_id"], "part": row["part"], "n_turns": len(turns),
        "said": "".join(f"{role}\n{text}\n" for role, text in turns).encode(),
        "learned": "".join(learned).encode(), "loss_chars": sum(map(len, learned)), "formatted_chars": len(row["formatted"]),
    }


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Digests of the conversations that begin and end in this task, the parts of all others.

    The first and the last conversation of a task may go on in its neighbours. One of over
    ``HELD_BYTES`` is not held until its end is seen, either.
    """
    held: list[dict] = []
    size, whole, begun, last = 0, False, False, None
    for batch in batches:
        for row in batch.select(["conv_id", "part", "formatted", "loss"]).to_pylist():
            if not begun or row["conv_id"] != last:
                if held:
                    digest = _Digest(last)
                    for read in held:
                        digest.add(read)
                    yield digest.row()
                held, size, whole, begun, last = [], 0, begun, True, row["conv_id"]
            read = _read(row)
            size += len(read["said"]) + len(read["learned"])
            if whole and size <= HELD_BYTES:
                held.append(read)
                continue
            whole = False
            yield from held
            held = []
            yield read
    yield from held


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Digests as they are; parts, which are sorted, in the running hashes of their conversation."""
    current = None
    for batch in batches:
        for row in batch.to_pylist():
            if current and (row["said"] is None or row["conv_id"] != current.conv_id):
                yield current.row()
                current = None
            if row["said"] is None:
                yield row
            else:
                current = current or _Digest(row["conv_id"])
                current.add(row)
    if current:
        yield current.row()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of up to 1,000 rows, or about ``BLOCK_BYTES`` of texts."""
    done: list[dict] = []
    size = 0
    for row in rows:
        done.append(row)
        size += len(row.get("said") or b"") + len(row.get("learned") or b"")
        if len(done) >= 1000 or size >= BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist(done, schema)
            done, size = [], 0
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted texts finds, per conversation: counts, characters and SHA-256.

    ``formatted`` comes from :func:`format_conversations`. The tasks that format also read back and
    unescape; a conversation inside one task is digested there. Of those that several tasks share, or
    that are long, the parts are sent on and hashed in their order, which a running hash needs:
    reading and unescaping a hot conversation is spread over tasks, only its hash is not.
    """
    read = formatted.mapInArrow(lambda batches: _batched(_read_back(batches), _READ), _READ_COLUMNS)
    sent = read.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return sent.mapInArrow(lambda batches: _batched(_finished(batches), _DIGESTS), _DIGEST_COLUMNS)
