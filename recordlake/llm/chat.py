"""Chat formatting by columnar byte assembly.

The segments of all turns of a batch (header, text, end mark) are laid out at once: numpy
computes segment lengths, their cumulative offsets and a scatter index for every byte, and
headers and contents are copied into one preallocated buffer, which becomes an Arrow column.

Template, per turn: ``### Role: text</turn>`` and a line feed. In roles and texts a backslash
goes before every backslash and before every control string (``###`` and ``</turn>``); in a
role also before a colon. So an end mark without a backslash always is a real one, and taking
away one backslash of each escape gives the text back. The loss mask covers the texts of the
assistant's turns, escapes included, without header and end mark.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.bpe import _type

HEADER, COLON, END = b"### ", b": ", b"</turn>\n"
CONTROL = [b"###", b"</turn>"]
ASSISTANT = b"assistant"
# Characters of a role or text that decide which range a turn is in.
BEGINNING = 64
TURN = re.compile(rb"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
UNESCAPE = re.compile(rb"\\(.)", re.S)


def _found(data: np.ndarray, offsets: np.ndarray, pattern: bytes) -> np.ndarray:
    """Where ``pattern`` begins inside a text, leftmost and without overlaps."""
    if len(data) < len(pattern):
        return np.zeros(0, np.int64)
    n = len(data) - len(pattern) + 1
    hit = data[:n] == pattern[0]
    for k in range(1, len(pattern)):
        hit &= data[k : n + k] == pattern[k]
    at = np.flatnonzero(hit)
    row = np.searchsorted(offsets, at, "right") - 1
    at = at[at + len(pattern) <= offsets[row + 1]]
    if len(set(pattern)) == 1 and len(at):
        # A run of the same byte: only every len(pattern)-th place of it counts.
        row = np.searchsorted(offsets, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(row) != 0)
        at = at[(at - at[new][np.cumsum(new) - 1]) % len(pattern) == 0]
    return at


def escape(data: np.ndarray, offsets: np.ndarray, also: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the escaped texts."""
    marked = np.zeros(len(data), bool)
    marked[data == 92] = True
    for b in also:
        marked[data == b] = True
    for pattern in CONTROL:
        marked[_found(data, offsets, pattern)] = True
    moved = np.concatenate([[0], np.cumsum(marked)])
    out = np.full(len(data) + int(moved[-1]), 92, np.uint8)
    # The byte itself follows the backslashes of all marked bytes up to its own.
    out[np.arange(len(data)) + moved[1:]] = data
    return out, offsets + moved[offsets]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``out`` from ``at[i]`` on, all segments at once."""
    lengths = np.diff(offsets)
    out[np.arange(len(data)) + np.repeat(at - offsets[:-1], lengths)] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns; turn offsets (n + 1); text spans within it (n x 2)."""
    role, role_at = escape(*bs.flat(roles), also=b":")
    text, text_at = escape(*bs.flat(texts))
    n = len(role_at) - 1
    parts = [
        (np.frombuffer(HEADER * n, np.uint8), np.arange(n + 1) * len(HEADER)),
        (role, role_at),
        (np.frombuffer(COLON * n, np.uint8), np.arange(n + 1) * len(COLON)),
        (text, text_at),
        (np.frombuffer(END * n, np.uint8), np.arange(n + 1) * len(END)),
    ]
    lengths = np.stack([np.diff(at) for _, at in parts], 1)
    turn_at = np.concatenate([[0], np.cumsum(lengths.sum(1))])
    place = turn_at[:-1, None] + np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(lengths, 1)[:, :-1]], 1)
    out = np.empty(int(turn_at[-1]), np.uint8)
    for k, (data, at) in enumerate(parts):
        _scatter(out, place[:, k], data, at)
    return out, turn_at, np.stack([place[:, 3], place[:, 3] + lengths[:, 3]], 1)


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted conversations: (conv_id, chunk, formatted binary, loss_starts, loss_ends).

    ``turns`` has conv_id, turn, role, text. Turns are in the order of turn (null first), then
    role, then text, so ties and repeated rows have a fixed place; repeated rows all count. A
    null role or text is empty; rows with a null conv_id are one conversation. A conversation
    comes as one row per batch of turns, in the order of ``chunk``, whose numbers have gaps, so
    a very long conversation never has to fit into one value and is formatted in several
    tasks. Loss spans are byte positions within the chunk. Other columns are not read.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Ranges follow the beginnings of roles and texts: what is sampled for them stays small. A
    # text only counts after a whole role, so ranges never contradict the order.
    role, whole = F.left("role", F.lit(BEGINNING)), F.length("role") < BEGINNING
    text = F.when(whole, F.left("text", F.lit(BEGINNING))).otherwise("")
    rows = rows.repartitionByRange("conv_id", "turn", role, text).sortWithinPartitions("conv_id", "turn", "role", "text")

    def build(batches):
        # Ranges are in order, so the partition's number comes first.
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                ids = batch.column(0)
                buffer, turn_at, spans = assemble(batch.column(2), batch.column(3))
                loss = pc.equal(batch.column(2), ASSISTANT.decode()).to_numpy(zero_copy_only=False)
                keys = ids.to_pylist()
                cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                numbers = []
                for first in cuts[:-1]:
                    chunk += 1
                    numbers.append(chunk)
                base = turn_at[cuts]
                own = [spans[a:b][loss[a:b]] - base[i] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(cuts[:-1])),
                        pa.array(numbers, pa.int64()),
                        pa.Array.from_buffers(
                            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(base.astype(np.int64)), pa.py_buffer(buffer)]
                        ).cast(pa.binary()),
                        pa.array([s[:, 0] for s in own], pa.list_(pa.int64())),
                        pa.array([s[:, 1] for s in own], pa.list_(pa.int64())),
                    ],
                    ["conv_id", "chunk", "formatted", "loss_starts", "loss_ends"],
                )

    schema = (
        f"conv_id {_type(turns, 'conv_id')}, chunk long, formatted binary, "
        "loss_starts array<long>, loss_ends array<long>"
    )
    return rows.mapInArrow(build, schema)


def unescape(data: bytes) -> bytes:
    return UNESCAPE.sub(rb"\1", data)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of a formatted run of turns."""
    turns, end = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != end:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(m[1]), unescape(m[2])))
        end = m.end()
    if end != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def _chars(data: bytes) -> int:
    return len(data.decode("utf-8"))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from :func:`format_turns`'s output alone.

    Chunks are read in their order within a partition, so a digest grows with the stream and
    nothing is gathered. A digest is a sequence: one conversation's is taken in one task.
    """

    def read(batches):
        state = None
        for batch in batches:
            done = []
            for conv, data, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state:
                        done.append(_finish(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(data):
                    state[1] += 1
                    state[2].update(role + b"\n" + text + b"\n")
                for a, b in zip(starts, ends):
                    text = unescape(data[a:b])
                    state[3] += _chars(text)
                    state[4].update(text)
                state[5] += _chars(data)
            yield from _rows(done)
        if state:
            yield from _rows([_finish(state)])

    def _finish(s):
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

    def _rows(done):
        if done:
            columns = list(zip(*done))
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[_type(formatted, "conv_id")]
    schema = (
        f"conv_id {_type(formatted, 'conv_id')}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return ordered.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(read, schema)
