"""Byte-level BPE: encoding and decoding by a public vocabulary of ranks.

Text is cut into pre-tokens on code-point arrays (the rules of the
``public_tokenizers.PATTERN`` regex, stated on runs of letters, numbers, white space
and the rest).  Pre-tokens not met before by the worker go into
length-bucketed, padded numpy matrices of token ids; in each round every row
merges its leftmost pair of minimum rank, found by a hashed pair table, rows
are shifted left and finished rows leave the matrix.  A pre-token that is a
token as a whole is that token, as in the tiktoken library.  Two kinds of
pre-tokens go around the matrices, with the same merges: up to ``FEW`` short
ones that a step meets new, for which a matrix is not worth its set-up, and
ones of more than ``LONG`` bytes, whose padding would fill the matrix.

The rank file and the classes of code points are read on the driver and
broadcast (about 2 MB, whatever the input).  Nothing is shuffled.

Defined results: a null or empty text has no tokens and decodes to no bytes;
null ids decode to no bytes; an id outside the vocabulary raises; text is
encoded whole, with pre-tokens of any length (a round costs a row's length,
so one pre-token of n bytes costs n^2 at worst); rows are encoded one by
one; other columns pass through, but the output column is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablework.llm.common import need, released, without

NONE = np.int32(2**31 - 1)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CHUNK_BYTES = 1 << 20       # text per step: bounds the worker's memory
CACHE_PIECES = 1 << 18      # the cache of pre-tokens starts anew beyond this
CELLS = 1 << 20             # matrix cells per step
FEW, SHORT = 16, 64         # up to so many pre-tokens, and bytes, are merged without arrays
LONG = 1 << 10              # pre-tokens of more bytes are merged one by one


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def code_point_classes() -> bytes:
    """Class of each code point by the regex engine that tiktoken uses."""
    import tiktoken
    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        enc = tiktoken.Encoding(f"class{kind}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        out[[ord(c) for c in enc.decode(enc.encode_ordinary(every))]] = kind
    return out.tobytes()


# ------------------------------------------------------------- pre-tokens

def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def among(values: np.ndarray, few: list[int]) -> np.ndarray:
    found = np.zeros(len(values), bool)
    for x in few:
        found |= values == x
    return found


def piece_starts(codes: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Mask of the positions where a pre-token starts; ``first`` marks the
    first code point of each text."""
    n = len(codes)
    kind = classes[codes]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    run = first | (kind != before)
    white = kind == SPACE
    blank = np.zeros(n, bool)                       # the code point before is U+0020 of the same text
    blank[1:] = (codes[:-1] == 32) & ~first[1:]
    starts = run & (white | ~blank)
    last = np.zeros(n, bool)                        # white space right before something else in the text
    last[:-1] = white[:-1] & ~white[1:] & ~first[1:]
    starts |= last
    # contractions: an apostrophe that starts a pre-token, with its letters
    at = np.flatnonzero(starts & (codes == 39))
    at = at[at + 1 < n]
    at = at[~first[at + 1]]
    one = at[among(codes[at + 1], [ord(c) for c in "stmd"])]
    two = at[at + 2 < n]
    two = two[~first[two + 2]]
    pair = codes[two + 1].astype(np.int64) << 32 | codes[two + 2]
    two = two[among(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    for where, length in ((one, 2), (two, 3)):
        starts[where + 1] = False
        after = where + length
        after = after[after < n]
        starts[after[~first[after]]] |= kind[after[~first[after]]] == LETTER
    return starts


# ------------------------------------------------------------ vocabulary

def spans(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions begin .. begin + length - 1 of each span, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - ends + lengths, lengths) + np.arange(total)


class PairTable:
    """Open-addressing hash table from pairs of ids to the merged id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(merged)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at, todo = self.slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == -1]
            self.keys[at[free]] = keys[free]        # of keys for one slot the last one written stays
            own = todo[self.keys[at[todo]] == keys[todo]]
            self.values[at[own]] = merged[own]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE for pairs that do not merge."""
        keys = left.astype(np.int64) << 32 | right
        at = self.slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class Vocabulary:
    """Ranks of a tiktoken file with the tables to encode and decode."""

    def __init__(self, file: bytes):
        pairs = [line.split() for line in file.splitlines() if line]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, i in self.ranks.items():
            tokens[i] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get = self.ranks.get
        merges = [(left, right, i) for token, i in self.ranks.items() for cut in range(1, len(token))
                  if (left := get(token[:cut])) is not None and (right := get(token[cut:])) is not None]
        self.pairs = PairTable(*np.array(merges, np.int64).reshape(-1, 3).T)

    def merge(self, matrix: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
        """Merge the rows of a padded matrix of byte ids; yields finished
        rows as (row numbers, ids per row, ids end to end)."""
        rows = np.arange(len(matrix))
        width = matrix.shape[1]
        ranks = np.full((len(matrix), width), NONE, np.int32)      # of the pair at each position
        if width > 1:
            found = self.pairs.find(matrix[:, :-1].ravel(), matrix[:, 1:].ravel()).reshape(len(matrix), -1)
            ranks[:, :-1] = np.where(np.arange(1, width) < lengths[:, None], found, NONE)
        while len(rows):
            at = ranks.argmin(axis=1)                              # the first of equal minima is the leftmost
            best = ranks[np.arange(len(rows)), at]
            going = best != NONE
            if not going.all():
                size = lengths[~going]
                yield rows[~going], size, matrix[~going][np.arange(matrix.shape[1]) < size[:, None]]
                rows, at, best, lengths = rows[going], at[going], best[going], lengths[going]
                if not len(rows):
                    return
                width = int(lengths.max())
                matrix, ranks = matrix[going, :width], ranks[going, :width]
            own = np.arange(len(rows))
            matrix[own, at] = best
            columns = np.arange(width)
            matrix = np.take_along_axis(matrix, np.minimum(columns + (columns > at[:, None]), width - 1), 1)
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            lengths = lengths - 1
            for side in (at - 1, at):                              # the two pairs of the merged token
                ok = (side >= 0) & (side + 1 < lengths)
                r, c = own[ok], side[ok]
                ranks[r, c] = self.pairs.find(matrix[r, c], matrix[r, c + 1])
            ranks[own, lengths - 1] = NONE

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """``merge`` for one long row: merged places stay as gaps, linked
        over, and are compacted when they are half of the row."""
        while True:
            n = len(ids)
            ranks = np.full(n, NONE, np.int32)
            ranks[:-1] = self.pairs.find(ids[:-1], ids[1:])
            after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), n
            while alive * 2 > n or n < 64:
                at = int(ranks.argmin())
                if ranks[at] == NONE:
                    return ids[ids >= 0]
                gone = int(after[at])
                ids[at], ids[gone], ranks[gone] = ranks[at], -1, NONE
                follow, previous = int(after[gone]), int(before[at])
                after[at] = follow
                if follow < n:
                    before[follow] = at
                left = [p for p in (previous, at) if p >= 0 and after[p] < n]
                ranks[at] = NONE
                if left:
                    ranks[left] = self.pairs.find(ids[left], ids[after[left]])
                alive -= 1
            ids = ids[ids >= 0]

    def merge_short(self, piece: bytes) -> list[int]:
        """``merge`` for one short pre-token, without the cost of arrays."""
        get, parts = self.ranks.get, [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((get(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NONE:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces end to end, ids per piece)."""
        if len(pieces) <= FEW and max(map(len, pieces)) <= SHORT:
            ids = [[self.ranks[p]] if p in self.ranks else self.merge_short(p) for p in pieces]
            return np.array([i for x in ids for i in x], np.int32), np.array(list(map(len, ids)), np.int64)
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        lone = np.flatnonzero((whole >= 0) | (size == 0))
        found = [(lone, (size[lone] > 0).astype(np.int64), whole[lone][size[lone] > 0].astype(np.int32))]
        rest = np.flatnonzero((whole < 0) & (size > 0))
        for i in rest[size[rest] > LONG]:
            ids = self.merge_long(self.byte_ids[np.frombuffer(pieces[i], np.uint8)])
            found.append((np.array([i]), np.array([len(ids)]), ids))
        rest = rest[size[rest] <= LONG]
        bucket = np.maximum(2, np.ceil(np.log2(size[rest])).astype(np.int64))
        for width in np.unique(bucket):
            members = rest[bucket == width]
            step = max(1, CELLS >> int(width))
            for k in range(0, len(members), step):
                part = members[k:k + step]
                lengths = size[part]
                data = np.zeros((len(part), int(lengths.max())), np.uint8)
                data[np.arange(data.shape[1]) < lengths[:, None]] = np.frombuffer(
                    b"".join([pieces[i] for i in part]), np.uint8)
                found += [(part[r], n, ids) for r, n, ids in self.merge(self.byte_ids[data], lengths)]
        order, counts, flat = (np.concatenate([f[i] for f in found]) for i in range(3))
        begin = (np.cumsum(counts) - counts)[np.argsort(order)]
        counts = counts[np.argsort(order)]
        return flat[spans(begin, counts)], counts

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each id."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id outside the vocabulary")
        return self.lengths[ids]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, end to end."""
        return self.bytes[spans(self.offsets[ids], self.sizes(ids))]


def put(buffer: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """values written at a place of a buffer that grows by doubling."""
    if at + len(values) > len(buffer):
        buffer = np.concatenate([buffer, np.zeros(max(len(buffer), len(values)), buffer.dtype)])
    buffer[at:at + len(values)] = values
    return buffer


class Numbers(dict):
    """Numbers pre-tokens in the order in which they come up first."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class Encoder:
    """A vocabulary with the classes of code points and a cache of
    pre-tokens, kept as one flat array of ids."""

    def __init__(self, vocabulary: bytes, classes: bytes):
        self.vocabulary = Vocabulary(vocabulary)
        self.classes = np.frombuffer(classes, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.known = Numbers()
        self.lengths, self.offsets, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        self.flat, self.filled = np.zeros(0, np.int32), 0

    def learn(self) -> None:
        """Ids for the pre-tokens that were numbered since the last time."""
        ids, lengths = self.vocabulary.encode_pieces([p.encode("utf-8", "surrogatepass") for p in self.known.new])
        self.known.new.clear()
        self.offsets = put(self.offsets, self.used, self.filled + np.cumsum(lengths) - lengths)
        self.lengths = put(self.lengths, self.used, lengths)
        self.flat = put(self.flat, self.filled, ids)
        self.used, self.filled = self.used + len(lengths), self.filled + len(ids)

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all texts in order, and how many each text has."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = np.zeros(len(texts), np.int64)
        if not joined:
            return [], counts
        ends = np.cumsum(sizes)
        first = np.zeros(len(joined), bool)
        first[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(piece_starts(code_points(joined), first, self.classes))
        cuts = [*starts.tolist(), len(joined)]
        counts = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - sizes)
        return [joined[a:b] for a, b in zip(cuts, cuts[1:])], counts

    def number(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pre-tokens, with ids for those that are new."""
        if len(self.known) > CACHE_PIECES:
            self.clear()
        index = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.new:
            self.learn()
        return index

    def token_counts(self, pieces: list[str]) -> np.ndarray:
        index = self.number(pieces)
        return self.lengths[index]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text)."""
        pieces, counts = self.pieces(texts)
        index = self.number(pieces)
        lengths = self.lengths[index]
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return self.flat[spans(self.offsets[index], lengths)], np.diff(upto)


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(vocabulary: bytes, classes: bytes) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    name = hashlib.sha256(vocabulary).digest()
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary, classes)
    return _ENCODERS[name]


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``most``, or single rows."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    return chunks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), CHUNK_BYTES)


# ------------------------------------------------------------- DataFrames

def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df plus ``ids``, the token ids (array of int) of each whole text."""
    need(df, text)
    df = without(df, ids)
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((read_vocabulary(vocabulary_path), code_point_classes()))

    def run(batches):
        enc = encoder(*shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in text_chunks(column):
                part = batch.slice(a, b - a)
                flat, counts = enc.encode([t or "" for t in column.slice(a, b - a).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, ids])

    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(released(run), schema)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", out: str = "decoded",
           keep: bool = False) -> DataFrame:
    """df with ``decoded``, the bytes that ``ids`` stand for, in their place
    (or beside them with ``keep``)."""
    need(df, ids)
    df = without(df, out)
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((read_vocabulary(vocabulary_path), code_point_classes()))

    def run(batches):
        vocabulary = encoder(*shared.value).vocabulary
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            column = batch.column(at)
            sizes = [n or 0 for n in pc.list_value_length(column).to_pylist()]
            for a, b in chunks(sizes, CHUNK_BYTES // 4):
                part = batch.slice(a, b - a)
                flat = part.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(vocabulary.sizes(flat))])
                offsets = upto[np.concatenate([[0], np.cumsum(sizes[a:b])])].astype(np.int32)
                data = vocabulary.decode(flat)
                column = pa.Array.from_buffers(pa.binary(), b - a, [
                    None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
                rest = [c for i, c in enumerate(part.columns) if keep or i != at]
                names = [c for i, c in enumerate(part.schema.names) if keep or i != at]
                yield pa.RecordBatch.from_arrays([*rest, column], names=[*names, out])

    fields = [f for f in df.schema.fields if keep or f.name.lower() != ids.lower()]
    return df.mapInArrow(released(run), T.StructType([*fields, T.StructField(out, T.BinaryType())]))
