r"""Chat formatting by columnar byte assembly.

A conversation becomes one text of turns ``### role: text</turn>\n``.  Inside
roles and texts a backslash goes before every backslash, before each ``#``
that follows two others and before the slash of ``</turn>`` (in roles before
every colon too), so control strings occur only as marks, and dropping each
escaping backslash gives the original back.

Turns are dealt by ranges of (conversation, turn) and sorted.  A worker takes
steps of bounded bytes: it lays out the segments of all turns of the step
(mark, role, colon, text, end), works out their lengths with escapes, their
cumulative offsets and the scatter index of every source byte in numpy, and
copies marks and contents into one preallocated Arrow buffer, whose offsets
are the conversations.  Loss spans are the places of assistant texts there.

Output rows are pieces of conversations in the order of ``at``; ``whole``
says that a piece is its whole conversation.  Only conversations at the edge
of a range or step, or longer than a step, have several pieces, so one with
a third of all turns is spread over tasks.  Reading back takes whole pieces
as they are and streams the others by conversation; the digest of one
conversation is a chain, so its pieces pass through one task, in steps.

Defined results: null roles and texts are empty; turns are ordered by turn
(null first), ties by role and text; repeated rows are turns of their own; a
null conv_id is one conversation; an empty table gives an empty table; other
columns are not read; a text of any length is formatted whole and is the
least that a step holds (its bytes a few times over, as numpy arrays).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.bpe import spans
from tablework.llm.common import handover, need

# The template.
MARK, COLON, END = b"### ", b": ", b"</turn>\n"
TRAINED = "assistant"

STEP_BYTES = 4 << 20        # text bytes per step in a worker
FORMATTED = ("conv_id long, at long, whole boolean, n_turns long, formatted string, "
             "loss array<struct<start:int,stop:int>>")
READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


# ----------------------------------------------------------- byte columns

def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values end to end, offsets from 0) of a string column."""
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]] if len(offsets) else body[:0], offsets - offsets[0]


def followed_by(b: np.ndarray, mark: bytes) -> np.ndarray:
    """Positions where ``mark`` stands in b."""
    at = np.flatnonzero(b[:max(0, len(b) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        at = at[b[at + k] == mark[k]]
    return at


def escapes(b: np.ndarray, offsets: np.ndarray, colons: bool) -> np.ndarray:
    """Mask of the bytes that get a backslash before them; a mark that would
    reach over the end of a value is none."""
    out = b == ord("\\")
    if colons:
        out |= b == ord(":")
    for mark, place in ((b"###", 2), (b"</turn>", 1)):
        at = followed_by(b, mark)
        last = np.searchsorted(offsets, at, "right")
        out[at[at + len(mark) <= offsets[np.minimum(last, len(offsets) - 1)]] + place] = True
    return out


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, end of each turn, start and stop of each turn's text) of the
    formatted turns end to end."""
    columns = []
    for column, colons in ((roles, True), (texts, False)):
        b, offsets = byte_column(column)
        mask = escapes(b, offsets, colons)
        before = np.concatenate([[0], np.cumsum(mask)])
        columns.append((b, offsets, mask, before, np.diff(offsets) + before[offsets[1:]] - before[offsets[:-1]]))
    role_len, text_len = columns[0][4], columns[1][4]
    n = len(role_len)
    lengths = np.stack([np.full(n, len(MARK)), role_len, np.full(n, len(COLON)), text_len, np.full(n, len(END))], 1)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    starts = ends - lengths
    buffer = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for segment, mark in ((0, MARK), (2, COLON), (4, END)):
        buffer[starts[:, segment][:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    for segment, (b, offsets, mask, before, _) in ((1, columns[0]), (3, columns[1])):
        size = np.diff(offsets)
        # a byte goes to its segment's start + its place in the value + the escapes up to it
        to = (np.repeat(starts[:, segment] - offsets[:-1] - before[offsets[:-1]], size)
              + np.arange(len(b)) + before[1:])
        buffer[to] = b
        buffer[to[mask] - 1] = ord("\\")
    return buffer, ends[:, 4], starts[:, 3], ends[:, 3]


# --------------------------------------------------------------- formatting

def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, role, text) sorted by conversation and turn in ranges."""
    need(turns, "conv_id", "turn", "role", "text")
    clean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (clean.repartitionByRange(F.col("conv_id"), F.col("turn"))
            .sortWithinPartitions(F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")))


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """(rows, last) in steps of bounded bytes that end with a conversation
    unless it alone fills the step."""
    held, size = None, 0
    for batch in batches:
        bytes_ = np.zeros(len(batch), np.int64)
        for name in ("role", "text"):
            bytes_ += np.diff(byte_column(batch.column(name))[1])
        a = 0
        while a < len(batch):
            grown = size + np.cumsum(bytes_[a:])
            b = a + max(1, int(np.searchsorted(grown, STEP_BYTES, "right")))
            part = batch.slice(a, b - a)
            held = part if held is None else pa.concat_batches([held, part])
            size, a = int(grown[min(b, len(batch)) - a - 1]), b
            if size < STEP_BYTES and a >= len(batch):
                break                                   # room for rows of the next batch
            conv = held.column("conv_id")
            same = np.flatnonzero(changes(conv))
            cut = int(same[-1]) if len(same) > 1 else len(held)
            yield held.slice(0, cut), False
            held = held.slice(cut) if cut < len(held) else None
            size = 0 if held is None else int(sum(byte_column(held.column(c))[1][-1] for c in ("role", "text")))
    if held is not None:
        yield held, True


def changes(conv: pa.Array) -> np.ndarray:
    """Mask of the rows that start another conversation than the row before."""
    null = np.asarray(conv.is_null())
    value = conv.fill_null(0).to_numpy(zero_copy_only=False)
    out = np.ones(len(conv), bool)
    out[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return out


def format_conversations(turns: DataFrame) -> DataFrame:
    """Pieces (conv_id, at, whole, n_turns, formatted, loss) of the formatted
    conversations; ``loss`` holds the byte spans of assistant texts in
    ``formatted``."""
    def run(batches):
        number, before = 0, None
        for rows, last in steps(batches):
            buffer, ends, starts, stops = assemble(rows.column("role"), rows.column("text"))
            heads = np.flatnonzero(changes(rows.column("conv_id")))
            tails = np.append(heads[1:], len(rows))
            cuts = np.concatenate([[0], ends[tails - 1]]) if len(rows) else np.zeros(1, np.int64)
            ids = rows.column("conv_id").take(pa.array(heads))
            # the first and last conversation of a range may go on in the next one,
            # and one that continues the step before is in several pieces anyway
            whole = np.ones(len(heads), bool)
            first, final = ids[0].as_py(), ids[-1].as_py()
            if number == 0 or before == (first,):
                whole[0] = False
            if last or len(heads) == 1:
                whole[-1] = False
            before = (final,) if not whole[-1] else None
            trained = pc.equal(rows.column("role"), TRAINED).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(heads)), tails - heads)[trained]
            base = cuts[:-1][owner]
            struct = pa.StructArray.from_arrays([pa.array((starts[trained] - base).astype(np.int32)),
                                                 pa.array((stops[trained] - base).astype(np.int32))], ["start", "stop"])
            per = np.bincount(owner, minlength=len(heads))
            loss = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), struct)
            text = pa.StringArray.from_buffers(len(heads), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(buffer))
            at = rows.column("at").take(pa.array(heads))
            yield pa.RecordBatch.from_arrays([ids, at, pa.array(whole), pa.array((tails - heads).astype(np.int64)),
                                              text, loss], names=["conv_id", "at", "whole", "n_turns", "formatted", "loss"])
            number += 1

    return (ordered(turns).select("conv_id", F.monotonically_increasing_id().alias("at"), "role", "text")
            .mapInArrow(run, FORMATTED))


# ------------------------------------------------------------- reading back

def decode(b: np.ndarray, offsets: np.ndarray, loss_start: np.ndarray, loss_stop: np.ndarray):
    """Per piece of formatted bytes: (turns, bytes of ``role\\ntext\\n`` of
    all turns, their offsets, bytes under the loss mask, their offsets)."""
    slash = b == ord("\\")
    run_start = np.flatnonzero(slash & ~np.concatenate([[False], slash[:-1]]))
    place = np.arange(len(b))
    within = place - run_start[np.maximum(np.searchsorted(run_start, place, "right") - 1, 0)] if len(run_start) else place
    escape = slash & (within % 2 == 0)
    plain = np.ones(len(b), bool)                       # not escaped by the byte before
    plain[1:] = ~escape[:-1]
    ends = followed_by(b, END)
    begins = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], (ends + len(END))[:-1]])) if len(ends) else ends
    begins = np.unique(begins)
    colons = np.flatnonzero((b == ord(":")) & plain)
    colon = colons[np.searchsorted(colons, begins)] if len(begins) else begins
    keep = ~escape
    keep[spans(begins, np.full(len(begins), len(MARK)))] = False
    keep[colon + 1] = False
    keep[spans(ends, np.full(len(ends), len(END) - 1))] = False
    lines = b.copy()
    lines[colon] = ord("\n")
    kept = np.concatenate([[0], np.cumsum(keep)])
    under = np.zeros(len(b) + 1, np.int64)
    np.add.at(under, loss_start, 1)
    np.add.at(under, loss_stop, -1)
    masked = (np.cumsum(under[:-1]) > 0) & ~escape
    lost = np.concatenate([[0], np.cumsum(masked)])
    turns = np.diff(np.searchsorted(ends, offsets))
    return turns, lines[keep], kept[offsets], b[masked], lost[offsets]


def code_points(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each value of UTF-8 bytes."""
    return np.diff(np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])[offsets])


def read_pieces(batches, joined: bool):
    """Figures per conversation from pieces; ``joined``: pieces come sorted
    and a conversation goes on over rows and batches."""
    state = None                                        # [conv_id, turns, sha, loss chars, loss sha, chars]

    def row(s):
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

    def table(rows):
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[x.split()[0] for x in READ.split(", ")])

    for batch in batches:
        sizes = np.diff(byte_column(batch.column("formatted"))[1])
        a, done = 0, []
        while a < len(batch):
            k = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:]), STEP_BYTES, "right")))
            part = batch.slice(a, k - a)
            a = k
            b, offsets = byte_column(part.column("formatted"))
            loss = part.column("loss")
            base = np.repeat(offsets[:-1], np.asarray(loss.value_lengths().fill_null(0)))
            flat = loss.flatten()
            turns, lines, cut, masked, mask_cut = decode(
                b, offsets, base + flat.field("start").to_numpy(), base + flat.field("stop").to_numpy())
            chars, loss_chars = code_points(b, offsets), code_points(masked, mask_cut)
            for i, conv in enumerate(part.column("conv_id").to_pylist()):
                if not joined or state is None or state[0] != conv:
                    if state is not None:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += int(turns[i])
                state[2].update(lines[cut[i]:cut[i + 1]].tobytes())
                state[3] += int(loss_chars[i])
                state[4].update(masked[mask_cut[i]:mask_cut[i + 1]].tobytes())
                state[5] += int(chars[i])
        if done:
            yield table(done)
    if state is not None:
        yield table([row(state)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns, digests and loss figures of each conversation, from the pieces
    of ``format_conversations`` (a written table)."""
    def one(batches):
        return read_pieces(batches, False)

    def several(batches):
        return read_pieces(batches, True)

    columns = ["conv_id", "formatted", "loss"]
    whole = formatted.filter("whole").select(*columns).mapInArrow(one, READ)
    rest = (formatted.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "at")
            .select(*columns).mapInArrow(several, READ))
    return whole.unionAll(rest)


def round_trip(turns: DataFrame) -> DataFrame:
    """The conversations formatted, written, and read back."""
    return read_back(handover(format_conversations(turns), "chat-formatted"))
