"""Edit-aware token counts: a segment tree of pre-tokens per document.

A leaf stands for up to ``LEAF`` neighbouring pre-tokens and holds their
characters and tokens; every inner node holds the sums of its two children.
The tree is two flat arrays in heap order, so the count is at the root and
an edit's place is found by descending on characters.

Whether a pre-token starts at a character depends on at most four characters
to either side.  An edit is thus answered from the leaves that it touches,
widened by ``CONTEXT`` characters: their text is cut into pre-tokens anew,
encoded, dealt to the same leaves, and the sums above them are updated; all
other leaves stay.  The first edits of many documents are cut and encoded
together, then their second ones, and so on.  A leaf that has grown beyond ``SPLIT`` pre-tokens makes
the document's tree be laid out anew, which encodes its text once more.

Defined results: a null or empty text has no tokens; places beyond the end
of the text mean its end, negative ones its begin, a stop before the start
means the start; a null replacement is empty; null edits, or none, change
nothing; a document's edits apply in order, each to the text that the ones
before have left; repeated rows are handled one by one; other columns pass
through, but those the operator adds are replaced; a document and its edits
are one row, so a very long text is held whole in a worker (its tree takes
two numbers per ``LEAF`` pre-tokens).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm.bpe import (CHUNK_BYTES, Encoder, chunks, code_point_classes, code_points, encoder, piece_starts, read_vocabulary,
                               spans, text_chunks)
from tablework.llm.common import need, without

LEAF = 32
SPLIT = 4 * LEAF
CONTEXT = 8
EDITS = "array<struct<start:bigint,stop:bigint,replacement:string>>"
INTS = T.ArrayType(T.IntegerType())


class Tree:
    """Sums of characters and tokens in heap order: the root is 1, the
    children of i are 2i and 2i + 1, the leaves are the second half.  Lists,
    as an edit reads and writes a few places of them."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens

    @property
    def size(self) -> int:
        return len(self.chars) // 2

    @property
    def count(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a character."""
        node, begin, size, chars = 1, 0, self.size, self.chars
        while node < size:
            node *= 2
            if place - begin >= chars[node] and chars[node + 1]:
                begin += chars[node]
                node += 1
        return node - size, begin

    def update(self, first: int, chars: list[int], tokens: list[int]) -> None:
        """Replace leaves from ``first`` on and the sums above them."""
        low, high = first + self.size, first + self.size + len(chars) - 1
        self.chars[low:high + 1], self.tokens[low:high + 1] = chars, tokens
        while low > 1:
            low, high = low // 2, high // 2
            for sums in (self.chars, self.tokens):
                for i in range(low, high + 1):
                    sums[i] = sums[2 * i] + sums[2 * i + 1]


def forest(sizes: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers per tree, characters, tokens) of the trees of documents, end
    to end, from the sizes and token counts of their pre-tokens and the
    pre-tokens per document."""
    leaves = -(-counts // LEAF)
    width = 2 << np.ceil(np.log2(np.maximum(1, leaves))).astype(np.int64)
    begin, offsets = np.cumsum(counts) - counts, np.cumsum(width) - width
    cuts = np.repeat(begin, leaves) + LEAF * spans(np.zeros(len(leaves), np.int64), leaves)
    place = spans(offsets + width // 2, leaves)
    out = []
    for values in (sizes, tokens):
        sums = np.zeros(int(width.sum()), np.int64)
        if len(cuts):
            sums[place] = np.add.reduceat(values, cuts)
        for w in np.unique(width):
            root, half = offsets[width == w][:, None], int(w) // 4
            while half:
                left = root + np.arange(2 * half, 4 * half, 2)
                sums[root + np.arange(half, 2 * half)] = sums[left] + sums[left + 1]
                half //= 2
        out.append(sums)
    return width, *out


def lay_out(pieces: list[str], enc: Encoder) -> Tree:
    """The tree of a document's pre-tokens."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    _, chars, tokens = forest(sizes, enc.token_counts(pieces), np.array([len(pieces)]))
    return Tree(chars.tolist(), tokens.tolist())


def pieces_between(windows: list[str], begins: np.ndarray, ends: np.ndarray, enc: Encoder) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(pre-tokens, their sizes, pre-tokens per window) of the parts begin to
    end of windows, both being pre-token boundaries."""
    joined = "".join(windows)
    if not joined:
        return [], np.zeros(0, np.int64), np.zeros(len(windows), np.int64)
    sizes = np.fromiter(map(len, windows), np.int64, len(windows))
    offsets = np.cumsum(sizes) - sizes
    first = np.zeros(len(joined), bool)
    first[offsets[sizes > 0]] = True
    at = np.flatnonzero(piece_starts(code_points(joined), first, enc.classes))
    low, high = np.searchsorted(at, offsets + begins), np.searchsorted(at, offsets + ends)
    counts = high - low
    starts = at[spans(low, counts)]
    stops, some = np.append(starts[1:], 0)[:len(starts)], counts > 0
    stops[np.cumsum(counts)[some] - 1] = (offsets + ends)[some]
    return [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())], stops - starts, counts


def edit_round(texts: list[str], trees: list[Tree], edits: list[tuple[int, int, str]], enc: Encoder) -> list[int]:
    """One replacement (start, stop, new) in each text: texts and trees are
    replaced by those after it; characters encoded anew of each.  The parts
    to encode are cut and encoded together, in bounded steps."""
    places, windows = [], []
    for i, (text, tree, (start, stop, new)) in enumerate(zip(texts, trees, edits)):
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        first, begin = tree.find(max(0, start - CONTEXT))
        last, last_begin = tree.find(min(stop + CONTEXT, max(0, len(text) - 1)))
        end = last_begin + tree.chars[tree.size + last] + len(new) - (stop - start)
        texts[i] = text = text[:start] + new + text[stop:]
        left = max(0, begin - CONTEXT)
        windows.append(text[left:end + CONTEXT] if begin < end else "")
        places.append((first, last - first + 1, begin, end, left if begin < end else begin))
    touched = []
    for a, b in chunks([len(w) for w in windows], CHUNK_BYTES // 4):
        begins, ends = (np.array([p[k] - p[4] if p[2] < p[3] else 0 for p in places[a:b]], np.int64) for k in (2, 3))
        pieces, sizes, counts = pieces_between(windows[a:b], begins, ends, enc)
        chars_to, tokens_to = ([0, *np.cumsum(x).tolist()] for x in (sizes, enc.token_counts(pieces)))
        x = 0
        for i, n in zip(range(a, b), counts.tolist()):
            first, leaves, begin, end, _ = places[i]
            each = -(-n // leaves)
            if each > SPLIT:
                trees[i] = lay_out(enc.pieces([texts[i]])[0], enc)
                touched.append(len(texts[i]))
            else:
                cuts = [min(x + k * each, x + n) for k in range(leaves + 1)]
                trees[i].update(first, *[[to[q] - to[p] for p, q in zip(cuts, cuts[1:])] for to in (chars_to, tokens_to)])
                touched.append(end - begin)
            x += n
    return touched


def apply_edit(text: str, tree: Tree, start: int, stop: int, new: str, enc: Encoder) -> tuple[str, Tree, int]:
    """(text, tree, characters encoded anew) after one replacement."""
    texts, trees = [text], [tree]
    (touched,) = edit_round(texts, trees, [(start, stop, new)], enc)
    return texts[0], trees[0], touched


def _columns(batch: pa.RecordBatch, drop: set[str]) -> tuple[list, list]:
    kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names) if n.lower() not in drop]
    return [c for c, _ in kept], [n for _, n in kept]


def build(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """docs plus ``n_tokens`` and the tree (``tree_chars``, ``tree_tokens``)."""
    need(docs, text)
    docs = without(docs, "n_tokens", "tree_chars", "tree_tokens")
    shared = docs.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary_path), code_point_classes()))

    def run(batches):
        enc = encoder(*shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in text_chunks(column):
                pieces, counts = enc.pieces([t or "" for t in column.slice(a, b - a).to_pylist()])
                sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
                width, chars, tokens = forest(sizes, enc.token_counts(pieces), counts)
                offsets = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(tokens[offsets[:-1] + 1]),
                     *[pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32))) for x in (chars, tokens)]],
                    names=[*part.schema.names, "n_tokens", "tree_chars", "tree_tokens"])

    fields = [*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("tree_chars", INTS),
              T.StructField("tree_tokens", INTS)]
    return docs.mapInArrow(run, T.StructType(fields))


def apply_edits(trees: DataFrame, vocabulary_path: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """trees (from ``build``) with a column of edits (EDITS) applied: text,
    tree and ``n_tokens`` are those after the edits, ``n_reencoded`` counts
    the characters that were encoded for them."""
    need(trees, text, edits, "n_tokens", "tree_chars", "tree_tokens")
    trees = without(trees, "n_reencoded")
    shared = trees.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary_path), code_point_classes()))
    changed = [text, "n_tokens", "tree_chars", "tree_tokens"]
    drop = {c.lower() for c in (*changed, edits)}

    def run(batches):
        enc = encoder(*shared.value)
        for batch in batches:
            def column(name, rows):
                return rows.column(rows.schema.get_field_index(name))

            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                before, todo, chars, tokens = (column(c, rows).to_pylist() for c in (text, edits, "tree_chars", "tree_tokens"))
                texts, trees = [t or "" for t in before], [Tree(c, n) for c, n in zip(chars, tokens)]
                touched = [0] * len(texts)
                for k in range(max((len(e) for e in todo if e), default=0)):       # the k-th edits of all rows
                    at = [i for i, e in enumerate(todo) if e and k < len(e) and e[k] is not None]
                    some, own = [texts[i] for i in at], [trees[i] for i in at]
                    wanted = [(e["start"] or 0, e["stop"] or 0, e["replacement"] or "") for e in (todo[i][k] for i in at)]
                    for i, after, tree, n in zip(at, some, own, edit_round(some, own, wanted, enc)):
                        texts[i], trees[i], touched[i] = after, tree, touched[i] + n
                out = [(None if t is None and not after else after, tree.count, tree.chars, tree.tokens, n)
                       for t, after, tree, n in zip(before, texts, trees, touched)]
                columns, names = _columns(rows, drop)
                kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                                                 names=[*names, *changed, "n_reencoded"])

    fields = [f for f in trees.schema.fields if f.name.lower() not in drop]
    added = [T.StructField(text, T.StringType()), T.StructField("n_tokens", T.LongType()),
             T.StructField("tree_chars", INTS), T.StructField("tree_tokens", INTS),
             T.StructField("n_reencoded", T.LongType())]
    return trees.mapInArrow(run, T.StructType([*fields, *added]))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """trees plus ``edits`` from a table (doc_id, seq, start, stop,
    replacement), each document's in the order of seq."""
    need(trees, "doc_id")
    need(edits, "doc_id", "seq", "start", "stop", "replacement")
    own = (edits.groupBy(F.col("doc_id").alias("_edited"))
           .agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "replacement"))).alias("_all"))
           .select("_edited", F.transform("_all", lambda e: F.struct(
               e["start"].cast("long").alias("start"), e["stop"].cast("long").alias("stop"),
               e["replacement"].alias("replacement"))).alias("edits")))
    return without(trees, "edits").join(own, F.col("doc_id") == F.col("_edited"), "left").drop("_edited")
