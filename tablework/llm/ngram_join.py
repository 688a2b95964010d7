"""N-gram Jaccard join on count-vector R-trees; groups of linked documents.

A document is the set of its word n-gram hashes.  Hashing the n-grams into
groups gives a count per group, a point; the sum of coordinate minima of two
points is at least the overlap of the two sets, so it bounds the similarity,
and the coordinate maxima of an R-tree node bound it for all points below.

One R-tree over all points would prune next to nothing (a threshold allows a
distance of a tenth of the size, which is more than one coordinate spreads),
so the points are dealt to trees first, without losing a pair.  Sets of like
size use one number of groups, larger than the n-grams in which a linked
pair may differ; such a pair then has a group with the same n-grams.  A key
is a group together with a hash of its n-grams.  Empty groups need no key:
there are more groups than differences by a slack that nearly no set has as
empty groups, and sets that do also have the keys of their empty groups.
Sets that share keys, directly or through others, are a family: a linked
pair is in one family, and each family is one tree.

Keys that one set alone has, nearly all, are found without a row per key:
workers send sorted blocks of 32 bits of their keys, one per key and step, to
the key's range.  Keys that may be shared connect their sets; there, too, a
worker joins its own sets of a key and sends one entry on, so a key that a
third of the sets have is no large group.

A family's sets go to one task (many small families to one).  There the
first members are compared with all others, as an entry bound: families of
near copies end here.  Sets still apart meet in an R-tree over points of
about twice as many groups as a set has n-grams, so the bound tells 0.85
from 0.90; survivors are verified on the n-gram sets, pairs already joined
are passed over, and what leaves the task is at most one link per member.
A family of more than TILE members, such as all sets with a passage, is first
dealt by the least of the sets that a member shares a key with, which copies
of a text have in common (and beyond TILE members to tiles that also get the
first of them).  Only if it stays in several components are its sets split
again, by their rare n-grams: in one order of all n-grams, those that few
members have first, a linked pair shares one of the first of each set, as
many as the set may miss and one more.  Sets that share such n-grams are a
narrow family; one that has fewer n-grams in common with the others than a
link needs is in none.  A passage is no longer a reason to meet, unless
it is nearly the whole text.  In a narrow family the members outside the
largest component meet all others, tile by tile beyond TILE members: points
go there, a byte for four n-grams, and sets only of the pairs that the bound
leaves.  Only sets that are nearly a common passage and still unlinked, more
than TILE of them, make work with the square of their number and points with
members x tiles; all else grows in proportion.

Defined results: a null text, or one without words, has an empty set and is
its own group; fewer words than n make one n-gram of all words; equal sets
link; repeated rows are listed each; a null doc_id joins the group of its
text but never names it; an empty table gives an empty table; other columns
of the input are not read; a very long text is one set, held whole in one
step of a worker and in its family's tile (8 bytes per n-gram).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm import bloom
from tablework.llm.bpe import spans
from tablework.llm.common import BROADCAST_BYTES, discard, handover, lower_ascii, need, pack, released, small, unpack, word_array
from tablework.llm.components import components

BAND_RATIO = 1.5            # largest to smallest size of a band
CHUNK_WORDS = 1 << 18       # words per step in a worker
KEYS_PER_PART = 1 << 20     # keys of one range
TILE = 2048                 # members of a family that one task holds, at most
TILE_GRAMS = 1 << 21        # and their n-grams
BATCH_GRAMS = 1 << 20       # n-grams of small families that one task holds, or of a large one that it sends
LEADS = 4                   # first members that all others are compared with
LEAF = 16
MOST_GROUPS = 4096          # coordinates of a point, at most
CELLS = 1 << 22             # coordinates compared in one step


# ------------------------------------------------------------ n-gram sets

def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_sets(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of all documents end to end, set sizes)
    of documents given as word hashes end to end."""
    begin = np.cumsum(counts) - counts
    width = np.minimum(counts, n)
    grams = np.where(counts > 0, counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), grams)
    first = np.repeat(begin, grams) + np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams)
    h = mix(width[owner].astype(np.uint64))
    for k in range(n):
        inside = width[owner] > k
        h[inside] = h[inside] * np.uint64(0x9E3779B97F4A7C15) + words[first[inside] + k]
    h = mix(h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(counts))


class Bands:
    """Bands of set sizes with their numbers of groups.

    Pairs of a band have sizes up to ``high`` and up to ``reach``, the
    largest partner of ``high``; ``parts`` is above their largest
    difference by one and the slack."""

    def __init__(self, largest: int, num: int, den: int):
        low, lows, highs, reach, parts, slack = 1, [], [], [], [], []
        while low <= max(1, largest):
            high = max(low, math.ceil(low * BAND_RATIO) - 1)
            partner = high * den // num
            differ = (high + partner) * (den - num) // (den + num)
            spare = 0
            for _ in range(20):
                p = differ + 1 + spare
                empty = p * math.exp(-low / p)
                spare = math.ceil(empty + 4 * math.sqrt(empty)) if differ else 0
            lows.append(low), highs.append(high), reach.append(partner)
            parts.append(differ + 1 + spare if differ else 0), slack.append(spare)
            low = high + 1
        self.lows, self.reach = np.array(lows), np.array(reach)
        self.parts, self.slack = np.array(parts), np.array(slack)

    def places(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, band): the own band, and the bands below that reach
        up to the document's size."""
        own = np.searchsorted(self.lows, sizes, "right") - 1
        who, where = [np.flatnonzero(sizes > 0)], [own[sizes > 0]]
        step = 1
        while True:
            at = np.flatnonzero((sizes > 0) & (own >= step))
            at = at[self.reach[own[at] - step] >= sizes[at]]
            if not len(at):
                break
            who.append(at), where.append(own[at] - step)
            step += 1
        who, where = np.concatenate(who), np.concatenate(where)
        some = self.parts[where] > 0
        return who[some], where[some]


def tree_keys(h: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all documents end to end, keys per document)."""
    bands = Bands(int(sizes.max(initial=0)), num, den)
    who, band = bands.places(sizes)
    order = np.argsort(who, kind="stable")
    who, band = who[order], band[order]
    parts, begin = bands.parts[band], np.cumsum(sizes) - sizes
    slot = np.cumsum(parts) - parts                        # a slot per document, band and group
    gram = np.repeat(begin[who] - np.cumsum(sizes[who]) + sizes[who], sizes[who]) + np.arange(sizes[who].sum())
    place = np.repeat(np.arange(len(who)), sizes[who])
    at = slot[place] + ((h[gram] >> np.uint64(20)) % parts[place].astype(np.uint64)).astype(np.int64)
    total = int(parts.sum())
    content = np.zeros(total, np.uint64)
    np.add.at(content, at, mix(h[gram] + np.uint64(1)))
    filled = np.bincount(at, minlength=total) > 0
    owner = np.repeat(np.arange(len(who)), parts)
    part = np.arange(total) - slot[owner]
    keys = mix(content ^ mix((band[owner].astype(np.uint64) << np.uint64(40)) + part.astype(np.uint64)))
    empty = parts - np.bincount(owner[filled], minlength=len(who))
    emit = filled | (empty > bands.slack[band])[owner]
    return keys[emit].view(np.int64), np.bincount(who[owner[emit]], minlength=len(sizes))


def word_chunks(column: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, word hashes or keys, their number per row) in
    bounded steps."""
    counts = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(counts)
    a = 0
    while a < len(counts):
        base = ends[a] - counts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + CHUNK_WORDS, "right")))
        at = int(column.offsets[a].as_py())
        yield a, b, values[at:at + int(ends[b - 1] - base)], counts[a:b].astype(np.int64)
        a = b


def as_lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def word_hashes(docs: DataFrame, text: str) -> Column:
    return F.transform(word_array(lower_ascii(F.col(text))), lambda w: F.xxhash64(w))


def signatures(docs: DataFrame, n: int, num: int, den: int, text: str = "text") -> DataFrame:
    """(doc_id, hash, size, sid, keys) per row of docs: ``hash`` is of the
    text, ``sid`` of the set (null for an empty one)."""
    def run(batches):
        for batch in batches:
            for a, b, words, counts in word_chunks(batch.column(2)):
                h, sizes = gram_sets(words, counts, n)
                owner = np.repeat(np.arange(b - a), sizes)
                sid = np.zeros(b - a, np.uint64)
                np.add.at(sid, owner, mix(h ^ np.uint64(0x5851F42D4C957F2D)))
                sid = mix(sid + sizes.astype(np.uint64))
                keys, per = tree_keys(h, sizes, num, den)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array(sizes.astype(np.int64)), pa.array(sid.view(np.int64), mask=sizes == 0),
                    as_lists(keys, per)], names=["doc_id", "hash", "size", "sid", "keys"])

    return (docs.select("doc_id", F.xxhash64(text).alias("hash"), word_hashes(docs, text).alias("words"))
            .mapInArrow(released(run), "doc_id long, hash long, size long, sid long, keys array<long>"))


# ----------------------------------------------------------- shared keys

def ranges(signed: DataFrame) -> int:
    """Bits of the range number of a key: about KEYS_PER_PART keys a range."""
    total = signed.agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    return max(4, math.ceil(math.log2(max(1, total / KEYS_PER_PART))))


def blocks_by_range(keys: np.ndarray, bits: int, *columns: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(ranges that occur, each column cut into one block per range) of
    sorted keys."""
    cut = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cut))
    return some, [pa.array([x[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary()) for x in columns]


def short_blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(part, shorts, again) of rows (sid, keys), in bounded steps: a batch
    of documents has millions of keys, which sorted at once would be most of
    a worker's memory."""
    for batch in batches:
        sids = batch.column(0).to_numpy()
        for a, b, keys, counts in word_chunks(batch.column(1)):
            sid = np.repeat(sids[a:b], counts)
            order = np.argsort(keys, kind="stable")
            keys, sid = keys[order], sid[order]
            again = np.zeros(len(keys), bool)
            again[1:] = (keys[1:] == keys[:-1]) & (sid[1:] != sid[:-1])
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            for mine, part in ((False, keys[new]), (True, keys[again])):
                some, (shorts,) = blocks_by_range(part, bits, (part >> np.uint64(32 - bits)).astype(np.uint32))
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), shorts, pa.array(np.full(len(some), mine))],
                                                     names=["part", "shorts", "again"])


def shared_shorts(signed: DataFrame, bits: int) -> DataFrame:
    """(short): the first ``bits`` + 32 bits of the keys that two or more
    sets may have.  What moves is four bytes a key: a worker sends sorted
    blocks of its keys' 32 bits, each once, to their range, and the few that
    several of its own sets have beside them.  One in some thousands is there
    by chance (or for an exact copy); no shared key is missing."""
    def blocks(batches):
        return short_blocks(batches, bits)

    def meet(table: pa.Table) -> pa.Table:
        part = np.int64(table.column("part")[0].as_py())
        again = table.column("again").to_numpy()
        every = [np.unique(np.frombuffer(x.as_py(), np.uint32)) for x in table.column("shorts")]
        alone = np.sort(np.concatenate([x for x, a in zip(every, again) if not a] or [np.zeros(0, np.uint32)]))
        twice = alone[1:][alone[1:] == alone[:-1]]
        shared = np.unique(np.concatenate([twice, *[x for x, a in zip(every, again) if a]]))
        return pa.table([pa.array((part << 32) | shared.astype(np.int64))], names=["short"])

    return (signed.select("sid", "keys").mapInArrow(released(blocks), "part int, shorts binary, again boolean")
            .groupBy("part").applyInArrow(meet, "short long"))


def star_edges(keys: np.ndarray, sid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in unsigned order, least sid of each, distinct (least
    sid, other sid) pairs)."""
    order = np.lexsort((sid, keys))
    keys, sid = keys[order], sid[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    least = sid[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))] if len(keys) else sid
    pairs = np.unique(np.stack([least, sid], 1)[least != sid], axis=0)
    return keys[first], sid[first], pairs


def key_edges(rows: DataFrame, bits: int) -> DataFrame:
    """(a, b): pairs that connect all sets of a key, for rows (sid, key).  A
    worker joins its own rows of a key to the least sid among them, and sends
    one entry per key to the key's range, where these are joined; so a key
    that very many sets have is a few entries."""
    def sent(keys, sid) -> Iterator[pa.RecordBatch]:
        keys, least, pairs = star_edges(np.concatenate(keys).view(np.uint64), np.concatenate(sid))
        some, (k, x) = blocks_by_range(keys, bits, keys, least)
        parts, first, second = some.tolist(), k.to_pylist(), x.to_pylist()
        if len(pairs):                                        # edges already: any range below 0
            parts.append(-1 - int(pairs[0, 0] % (1 << bits)))
            first.append(np.ascontiguousarray(pairs[:, 0]).tobytes())
            second.append(np.ascontiguousarray(pairs[:, 1]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(first, pa.binary()), pa.array(second, pa.binary())],
                                         names=["part", "first", "second"])

    def blocks(batches):
        keys, sid, held = [], [], 0
        for batch in batches:
            sid.append(batch.column(0).to_numpy())
            keys.append(batch.column(1).to_numpy())
            held += len(batch)
            if held >= KEYS_PER_PART:
                yield from sent(keys, sid)
                keys, sid, held = [], [], 0
        if held:
            yield from sent(keys, sid)

    def meet(table: pa.Table) -> pa.Table:
        first, second = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("first", "second"))
        if table.column("part")[0].as_py() < 0:
            pairs = np.unique(np.stack([first, second], 1), axis=0)
        else:
            pairs = star_edges(first.view(np.uint64), second)[2]
        return pa.table([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])

    return (rows.select("sid", "key").mapInArrow(released(blocks), "part int, first binary, second binary")
            .groupBy("part").applyInArrow(meet, "a long, b long").distinct())


def likely(rows: DataFrame, shorts: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be shared: a Bloom filter, while it is small
    enough to broadcast, keeps the others out of the shuffle."""
    table, blocks = bloom.build(shorts, "short", shorts.count())
    if blocks * bloom.BLOCK_BYTES > BROADCAST_BYTES:
        return rows
    short = F.shiftrightunsigned("key", 32 - bits)
    return bloom.probe(rows, short, handover(table, "join-filter"), blocks).filter("maybe").drop("maybe")


def sets_of(docs: DataFrame, wanted: DataFrame, n: int, text: str = "text", points: bool = False) -> DataFrame:
    """(sid, grams) of the documents in wanted (sid, doc_id, hash, repeated),
    a written table; with ``points`` their (sid, size, point), made in the
    same worker, as a second one beside it would hold its memory too.  Only
    rows that the table repeats need their sets told apart again."""
    def run(batches):
        for batch in batches:
            for a, b, words, counts in word_chunks(batch.column(1)):
                h, sizes = gram_sets(words, counts, n)
                sid = batch.column(0).slice(a, b - a)
                if points:
                    yield pa.RecordBatch.from_arrays([sid, pa.array(sizes), pa.array(points_of(h, sizes), pa.binary())],
                                                     names=["sid", "size", "point"])
                else:
                    yield pa.RecordBatch.from_arrays([sid, as_lists(h.view(np.int64), sizes)], names=["sid", "grams"])

    made = "sid long, size long, point binary" if points else "sid long, grams array<long>"
    named = docs.select(F.col("doc_id").alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))

    def read(some: DataFrame) -> DataFrame:
        same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("hash"))
        return (named.join(small(some, 48), same).select("sid", word_hashes(named, "_text").alias("words"))
                .mapInArrow(released(run), made))

    several = wanted.filter("repeated")
    if several.isEmpty():
        return read(wanted)
    return read(wanted.filter("NOT repeated")).unionAll(read(several).dropDuplicates(["sid"]))


# ---------------------------------------------------------------- R-trees

class RTree:
    """Points packed into leaves in order of size, nodes with the maxima of
    their coordinates and the least size below."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((*points.T[:2], sizes))
        self.order = order
        self.levels = [(points[order], sizes[order])]
        while len(self.levels[-1][1]) > LEAF:
            p, s = self.levels[-1]
            cuts = np.arange(0, len(s), LEAF)
            self.levels.append((np.maximum.reduceat(p, cuts), np.minimum.reduceat(s, cuts)))

    def search(self, points: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs whose bound reaches the overlap needed."""
        top, step = len(self.levels) - 1, max(1, CELLS // points.shape[1])
        q, at = (x.ravel() for x in np.meshgrid(np.arange(len(sizes)), np.arange(len(self.levels[top][1])), indexing="ij"))
        for level in range(top, -1, -1):
            p, s = self.levels[level]
            keep = np.zeros(len(q), bool)
            for k in range(0, len(q), step):
                a, b = q[k:k + step], at[k:k + step]
                bound = np.minimum(points[a], p[b]).sum(1, dtype=np.int64)
                keep[k:k + step] = bound * (num + den) >= num * (sizes[a] + s[b])
            q, at = q[keep], at[keep]
            if level:
                below = len(self.levels[level - 1][1])
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                q = np.repeat(q, LEAF)[at < below]
                at = at[at < below]
        return q, self.order[at]


class Family:
    """The sets of one family, or of two parts of it, in one task."""

    def __init__(self, sid: np.ndarray, root: np.ndarray, grams: np.ndarray, sizes: np.ndarray, num: int, den: int):
        self.sid, self.grams, self.sizes, self.num, self.den = sid, grams, sizes, num, den
        self.begin = np.cumsum(sizes) - sizes
        self.component = np.unique(root, return_inverse=True)[1].astype(np.int64)
        self.links: list[tuple[int, int]] = []

    def compare(self, q: int, others: np.ndarray) -> None:
        """Join q with those of the others, in other components, that it links to."""
        others = others[self.component[others] != self.component[q]]
        if not len(others):
            return
        own = self.grams[self.begin[q]:self.begin[q] + self.sizes[q]]
        theirs = self.grams[spans(self.begin[others], self.sizes[others])]
        at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        overlap = np.add.reduceat((own[at] == theirs).astype(np.int64), np.cumsum(self.sizes[others]) - self.sizes[others])
        for p in others[(self.num + self.den) * overlap >= self.num * (self.sizes[q] + self.sizes[others])]:
            if self.component[p] != self.component[q]:
                self.component[self.component == self.component[p]] = self.component[q]
                self.links.append((int(self.sid[q]), int(self.sid[p])))

    def points(self) -> np.ndarray:
        """Counts of hashed groups, about twice as many as a set has n-grams."""
        groups = 1 << math.ceil(math.log2(2 * max(1.0, float(np.median(self.sizes)))))
        groups = max(32, min(groups, MOST_GROUPS, CELLS * 4 // max(1, len(self.sizes))))
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        counts = np.bincount(owner * groups + (self.grams % np.uint64(groups)).astype(np.int64), minlength=len(self.sizes) * groups)
        kind = np.uint8 if counts.max(initial=0) < 256 else np.int32
        return counts.astype(kind).reshape(-1, groups)

    def search(self, left: np.ndarray, right: np.ndarray) -> None:
        """Join all linked pairs of the two sides (positions; equal: of all)."""
        for q in np.union1d(left, right)[:LEADS]:
            self.compare(int(q), right if q in left else left)
        if len(np.unique(self.component)) < 2:
            return
        points = self.points()
        tree = RTree(points[right], self.sizes[right])
        for k in range(0, len(left), 256):
            some = left[k:k + 256]
            q, p = tree.search(points[some], self.sizes[some], self.num, self.den)
            q, p = some[q], right[p]
            apart = self.component[q] != self.component[p]
            q, p = q[apart], p[apart]
            order = np.argsort(q, kind="stable")
            q, p = q[order], p[order]
            for one in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1) if len(q) else []:
                self.compare(int(q[one[0]]), p[one])


def family_links(table: pa.Table, num: int, den: int) -> pa.Table:
    """Links (a, b) of a batch: rows (family, t1, t2, part, sid, root, grams),
    where a unit (family, t1, t2) asks for the pairs of two parts."""
    names = ["family", "t1", "t2", "sid"]
    table = table.sort_by([(c, "ascending") for c in names])
    unit = [table.column(c).to_numpy() for c in names[:3]]
    new = np.ones(len(table), bool)
    new[1:] = np.any([u[1:] != u[:-1] for u in unit], axis=0)
    lists = table.column("grams").combine_chunks()
    sizes, grams = np.asarray(lists.value_lengths()).astype(np.int64), lists.flatten().to_numpy().view(np.uint64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    sid, root, part = (table.column(c).to_numpy() for c in ("sid", "root", "part"))
    found = []
    cuts = np.flatnonzero(new)
    for a, b in zip(cuts, [*cuts[1:], len(table)]):
        family = Family(sid[a:b], root[a:b], grams[begin[a]:begin[b]], sizes[a:b], num, den)
        left, right = (np.flatnonzero(part[a:b] == u[a]) for u in unit[1:])
        extra = np.flatnonzero(part[a:b] < 0)                # first members of the family, in all its tiles
        if len(extra):
            left = right = np.arange(b - a)
        family.search(left, right)
        found += family.links
    return pa.table([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def search_units(rows: DataFrame, members: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links of the units in rows (batch, family, t1, t2, part, sid, root);
    the sets of their members are made from the documents again and go
    straight to their batches."""
    def search(table: pa.Table) -> pa.Table:
        return family_links(table, num, den)

    rows = handover(rows.select("batch", "family", "t1", "t2", "part", "sid", "root"), "join-units")
    wanted = handover(members.join(rows.select("sid").distinct(), "sid", "left_semi")
                      .select("sid", "doc_id", "hash", "repeated"), "join-wanted")
    return (sets_of(docs, wanted, n).join(small(rows, 80), "sid").select("batch", "family", "t1", "t2", "part", "sid", "root", "grams")
            .groupBy("batch").applyInArrow(search, "a long, b long"))


def tiles_of() -> Column:
    """Tiles for the members (size) of a group."""
    return F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_GRAMS)).cast("int")


def first_tiles(members: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links inside every unit of one tile, and inside the tiles of larger
    ones, each with the unit's first members.  A unit is a family, or in a
    large one the members of one least lead, which copies of a text share.
    members: (sid, unit, unit_parts, size, family, parts, doc_id, hash, repeated)."""
    weight = members.filter("unit_parts = 1").agg(F.sum("size").alias("n")).first()["n"] or 0
    batches = max(1, math.ceil(weight / BATCH_GRAMS))
    zero = F.lit(0)
    tile = F.pmod(F.xxhash64("sid", F.lit(3)), F.col("unit_parts")).cast("int")
    own = members.withColumn("t1", F.when(F.col("unit_parts") > 1, tile).otherwise(zero)).withColumn("part", F.col("t1"))
    nth = F.row_number().over(Window.partitionBy("unit").orderBy("sid"))
    first = (members.filter("unit_parts > 1").withColumn("nth", nth).filter(F.col("nth") <= LEADS).drop("nth")
             .withColumn("t1", F.explode(F.sequence(zero, F.col("unit_parts") - 1))).withColumn("part", F.lit(-1)))
    first = first.filter(tile != F.col("t1"))
    rows = own.unionByName(first).withColumns({"t2": F.col("t1"), "root": F.col("sid"), "family": F.col("unit")}).withColumn(
        "batch", F.when(F.col("unit_parts") > 1, F.xxhash64("unit", "t1")).otherwise(F.pmod(F.xxhash64("unit"), F.lit(batches))))
    return search_units(rows, members, docs, n, num, den)


def rare_grams(sets: DataFrame, total: int, num: int, den: int) -> DataFrame:
    """(sid, keys): n-grams of which linked sets share one, for sets (sid,
    grams) with ``total`` n-grams.  In the order of the n-grams by the number
    of sets that have them (then by hash), the first that a linked pair has in
    common comes before the last ``need`` of either set.  N-grams of one set
    alone come first and connect nothing; they are left out, and so are sets
    that share fewer than ``need``.  40 bits of a hash are sent; n-grams that
    agree in them count as one, which hides no common one."""
    held = F.count("*").over(Window.partitionBy("gram"))
    short = F.array_distinct(F.transform("grams", lambda g: g.bitwiseAND(F.lit(-1 << 24))))
    rows = (sets.coalesce(max(1, math.ceil(total / BATCH_GRAMS))).select("sid", F.size("grams").alias("size"), short.alias("short"))
            .select("sid", "size", F.size("short").alias("distinct"), F.explode("short").alias("gram")))
    shared = (rows.withColumn("held", held).filter("held > 1").groupBy("sid")
              .agg(F.first("size").alias("size"), F.first("distinct").alias("distinct"), F.sort_array(F.collect_list(F.struct("held", "gram"))).alias("shared")))
    miss = F.col("size") - F.ceil(num * F.col("size") / den)
    first = (miss + 1 - (F.col("distinct") - F.size("shared"))).cast("int")
    return shared.filter(first > 0).select("sid", F.slice("shared", F.lit(1), first).getField("gram").alias("keys"))


def narrow_families(large: DataFrame, members: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(sid, family, parts, size, root) of the members of large families that
    share rare n-grams; these families are narrower, and any linked pair is
    in one."""
    wanted = handover(large.select("sid").join(members, "sid").select("sid", "doc_id", "hash", "repeated", "size"), "join-wanted")
    total = wanted.agg(F.sum("size").alias("n")).first()["n"] or 0
    rare = handover(rare_grams(sets_of(docs, wanted.drop("size"), n), total, num, den), "join-rare")
    narrow = families(rare)
    placed = large.select("sid", "size", "root").join(narrow.select(F.col("node").alias("sid"), F.col("root").alias("family")), "sid")
    found = handover(placed.join(placed.groupBy("family").agg(tiles_of().alias("parts")), "family")
                     .select("sid", "family", "parts", "size", "root"), "join-narrow")
    discard(wanted, rare, narrow)
    return found


def in_components(large: DataFrame) -> DataFrame:
    """(family, main, m, all, components, parts) of the families that are in
    several components; main is the largest, with m members."""
    of = large.groupBy("family", "root").agg(F.count("*").alias("m"), F.first("parts").alias("parts"))
    return (of.groupBy("family").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("m"),
                                     F.sum("m").alias("all"), F.count("*").alias("components"), F.first("parts").alias("parts"))
            .filter("components > 1"))


def other_tiles(members: DataFrame, roots: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame | None:
    """Links between the units and tiles of large families that are still in
    several components: members of a narrow family outside its largest
    component against all.  Points go to the tiles, a byte for four n-grams;
    the few pairs whose bound reaches the overlap needed are verified on
    their sets.  None if there are no such families."""
    large = (members.filter("parts > 1").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
             .select("sid", "family", "parts", "size", F.coalesce("root", "sid").alias("root")))
    large = handover(large, "join-large")
    apart = handover(in_components(large).select("family"), "join-apart")
    if apart.isEmpty():
        return None
    large = narrow_families(large.join(apart, "family", "left_semi"), members, docs, n, num, den)
    main = in_components(large)
    share = F.col("all") / F.col("parts")
    plan = handover(main.select("family", "main", F.ceil(F.col("m") / share).cast("int").alias("p"),
                                F.ceil((F.col("all") - F.col("m")) / share).cast("int").alias("q")), "join-plan")
    if plan.isEmpty():
        return None
    stray = F.col("root") != F.col("main")
    h = F.xxhash64("sid", F.lit(5))
    placed = large.join(plan, "family").withColumn(
        "part", F.when(stray, F.col("p") + F.pmod(h, F.col("q"))).otherwise(F.pmod(h, F.col("p"))).cast("int"))
    last = F.col("p") + F.col("q") - 1

    def tiles(t1, t2) -> Column:
        return F.struct(t1.cast("int").alias("t1"), t2.cast("int").alias("t2"))

    with_strays = F.transform(F.sequence(F.greatest("p", "part"), last), lambda t: tiles(F.col("part"), t))
    before = F.transform(F.sequence(F.lit(0), F.col("part")), lambda t: tiles(t, F.col("part")))
    at = F.array_distinct(F.when(F.col("part") >= F.col("p"), F.concat(before, with_strays)).otherwise(with_strays))
    batches = large.filter("parts = 1").agg(tiles_of().alias("n")).first()["n"] or 1
    batch = F.when(F.col("parts") > 1, F.xxhash64("family", "t1", "t2")).otherwise(F.pmod(F.xxhash64("family"), F.lit(batches)))
    rows = (placed.withColumn("at", F.explode(at)).select("sid", "family", "parts", "root", "part", "at.t1", "at.t2")
            .withColumn("batch", batch))
    rows = handover(rows, "join-pairs-units")
    wanted = handover(large.join(plan, "family", "left_semi").select("sid").join(members, "sid")
                      .select("sid", "doc_id", "hash", "repeated"), "join-wanted")
    points = handover(sets_of(docs, wanted, n, points=True), "join-points")

    def search(table: pa.Table) -> pa.Table:
        return candidates(table, num, den)

    pairs = handover(points.join(small(rows, 80), "sid").select("batch", "family", "t1", "t2", "part", "sid", "root", "size", "point")
                     .groupBy("batch").applyInArrow(search, "a long, b long").distinct(), "join-pairs")
    both = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    sets = handover(sets_of(docs, handover(wanted.join(both, "sid", "left_semi"), "join-wanted"), n), "join-sets")
    met = (pairs.join(sets.select(F.col("sid").alias("a"), F.col("grams").alias("ga")), "a")
           .join(sets.select(F.col("sid").alias("b"), F.col("grams").alias("gb")), "b"))
    overlap = F.size(F.array_intersect("ga", "gb"))
    found = handover(met.filter((num + den) * overlap >= num * (F.size("ga") + F.size("gb"))).select("a", "b"), "join-more")
    discard(rows, points, pairs, sets)
    return found


def points_of(grams: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Points of sets end to end: counts of about a quarter as many hashed
    groups as n-grams, a byte each (255 stands for more)."""
    cut = np.concatenate([[0], np.cumsum(sizes)])
    found = []
    for i, size in enumerate(sizes):
        groups = min(MOST_GROUPS, max(32, 1 << math.ceil(math.log2(max(1, size / 4)))))
        counts = np.bincount((grams[cut[i]:cut[i + 1]] % np.uint64(groups)).astype(np.int64), minlength=groups)
        found.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    return found


def bound_pairs(points: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int) -> Iterator[tuple]:
    """(left, right) positions whose bound reaches the overlap needed.  Sets
    of unlike size have unlike numbers of groups, powers of two; the finer
    point is folded onto the coarser."""
    groups = np.array([len(p) for p in points])
    full = np.array([255 in p for p in points])

    def matrix(at: np.ndarray, width: int) -> np.ndarray:
        counts = np.stack([np.frombuffer(points[i], np.uint8) for i in at]).astype(np.int32)
        counts[counts == 255] = 1 << 20                       # a full byte bounds nothing
        return counts.reshape(len(at), -1, width).sum(1)

    reach = 1 + math.ceil(math.log2(den / num))
    for g in np.unique(groups):
        for first, mine, theirs in ((0, left, right), (1, right, left)):
            a = mine[groups[mine] == g]
            for k in range(first, reach + 1):                 # equal widths are met once
                b = theirs[groups[theirs] == g << k]
                if len(a) and len(b):
                    pa_, pb = matrix(a, g), matrix(b, g)
                    if not (full[a].any() or full[b].any()):
                        kind = np.uint8 if max(pa_.max(), pb.max()) < 256 else np.int32
                        pa_, pb = pa_.astype(kind), pb.astype(kind)
                    tree = RTree(pb, sizes[b])
                    for c in range(0, len(a), 256):
                        some = a[c:c + 256]
                        q, p = tree.search(pa_[c:c + 256], sizes[some], num, den)
                        yield some[q], b[p]


def candidates(table: pa.Table, num: int, den: int) -> pa.Table:
    """Distinct pairs (a, b) of sets in different components that the bound
    lets through; rows (family, t1, t2, part, sid, root, size, point)."""
    table = table.sort_by([(c, "ascending") for c in ("family", "t1", "t2", "sid")])
    unit = [table.column(c).to_numpy() for c in ("family", "t1", "t2")]
    new = np.ones(len(table), bool)
    new[1:] = np.any([u[1:] != u[:-1] for u in unit], axis=0)
    sid, root, part, size = (table.column(c).to_numpy() for c in ("sid", "root", "part", "size"))
    points = table.column("point").to_pylist()
    found = [np.zeros((0, 2), np.int64)]
    cuts = np.flatnonzero(new)
    for a, b in zip(cuts, [*cuts[1:], len(table)]):
        left, right = (np.flatnonzero(part[a:b] == u[a]) for u in unit[1:])
        for q, p in bound_pairs(points[a:b], size[a:b], left, right, num, den):
            q, p = q + a, p + a
            apart = root[q] != root[p]
            pairs = np.stack([np.minimum(sid[q], sid[p])[apart], np.maximum(sid[q], sid[p])[apart]], 1)
            found.append(np.unique(pairs, axis=0))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])


# ------------------------------------------------------------------ join

def families(signed: DataFrame) -> DataFrame:
    """(node, root, label): the sets that share keys, with their family and
    their least lead."""
    bits = ranges(signed)
    shorts = handover(shared_shorts(signed, bits), "join-shorts")
    rows = signed.select("sid", F.explode("keys").alias("key"))
    edges = handover(key_edges(likely(rows, shorts, bits), bits), "join-edges")
    least = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    found = handover(components(edges).join(least, "node", "left").withColumn("label", F.coalesce("label", "node")), "join-families")
    discard(shorts, edges)
    return found


def link_groups(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of docs (doc_id, text):
    two documents link when ``den`` x overlap >= ``num`` x union of their
    sets of n-word shingles; the component is the smallest doc_id that links
    reach, itself included."""
    need(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = handover(signatures(docs, n, num, den), "join-signatures")
    some = whole.filter("sid IS NOT NULL")
    # one node per distinct set, with a document to read the set from again
    again = (some.groupBy(F.col("doc_id").alias("again_id"), F.col("hash").alias("again_hash"))
             .agg(F.count("*").alias("m")).filter("m > 1").drop("m"))
    nodes = handover(some.groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "hash")).alias("rep"), F.first("size").alias("size"))
        .join(again, F.col("rep.doc_id").eqNullSafe(F.col("again_id")) & (F.col("rep.hash") == F.col("again_hash")), "left")
        .select("sid", "least", "rep", "size", F.col("again_hash").isNotNull().alias("repeated")), "join-nodes")
    family = families(some)
    signed = handover(whole.drop("keys", "hash"), "join-signed")
    discard(whole)
    sized = family.join(nodes.select(F.col("sid").alias("node"), "size", "rep", "repeated"), "node")
    tiles = tiles_of()
    large = sized.groupBy("root").agg(tiles.alias("parts")).filter("parts > 1")
    placed = sized.join(large, "root", "left").select(
        F.col("node").alias("sid"), F.col("root").alias("family"), "size", F.coalesce("parts", F.lit(1)).alias("parts"),
        F.when(F.col("parts") > 1, F.col("label")).otherwise(F.col("root")).alias("unit"),
        F.col("rep.doc_id").alias("doc_id"), F.col("rep.hash").alias("hash"), "repeated")
    placed = handover(placed, "join-placed")
    crowded = placed.groupBy("unit").agg(tiles.alias("unit_parts")).filter("unit_parts > 1")
    members = handover(placed.join(crowded, "unit", "left").withColumn("unit_parts", F.coalesce("unit_parts", F.lit(1))), "join-members")
    links = handover(first_tiles(members, docs, n, num, den), "join-links")
    found = components(links)
    more = other_tiles(members, found, docs, n, num, den)
    if more is not None:
        found = components(links.unionAll(more))
    discard(members, placed, family)
    rooted = nodes.join(found.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "least", F.coalesce("root", "sid").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    owners = handover(rooted.join(named, "root").select("sid", "component_id"), "join-owners")
    discard(nodes, links, *([more] if more is not None else []))
    return (signed.select("doc_id", F.col("size").alias("n_shingles"), "sid")
            .join(owners, "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs that name their group: one document of each group
    (its smallest doc_id) stays, and every row with a null doc_id."""
    groups = link_groups(docs, n, num, den)
    gone = groups.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone")).distinct()
    return unpack(pack(docs, "doc_id").join(handover(gone, "join-gone").hint("shuffle_hash"),
                                            F.col("doc_id") == F.col("gone"), "left_anti"))
