"""Prefix trie of conversations with shared heads, by composable fingerprints.

A conversation c is rebuilt from the first h turns of its base c - c % 20 and
its own turns after its first h (h = crc32 of its decimal number, mod 4); a
node of the trie is a distinct sequence of first turns, and carries the
figures of its subtree.

Texts are never put together.  A sequence of turns is an element (length n,
hash f) of a monoid, (n, f) . (m, g) = (n + m, f + s^n * g) modulo a prime,
where a turn is (1, x) and s a fixed number; four such hashes run side by
side.  Prefix hashes of every original conversation are running sums (over
blocks of positions, then over blocks, so a very long conversation is spread
over tasks).  The own suffix of c is the difference of two prefixes of c,
moved to its place by a power of s, and the prefixes of the rebuilt
conversation follow by one product with the base's head.

Each prefix keeps a reference (conversation, position) to its last turn in
the table.  Equal fingerprints are verified: in every group of prefixes the
parents' fingerprints agree and all referenced turns have one role and text
(read once, by reference, and compared by minimum and maximum), which proves
by induction on the depth that groups are equal sequences.  If a group fails,
everything is worked out again with other numbers.

Defined results: null roles and texts are empty; turns are ordered by turn
(null first), ties by role and text; repeated rows are turns of their own;
rows with a null conv_id are no conversation and are left out; % keeps the
sign of the number, as in SQL; an empty table has no nodes; a text of any
length is hashed whole inside Spark; other columns are not read.  A node that
many conversations share is aggregated before the shuffle; the digest of its
members is a chain, so their numbers pass through one task as a stream of
joined chunks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import handover, need, word_array

GROUP, HEAD = 20, 4         # conversations per base; heads have fewer turns than HEAD
PRIME = 2**31 - 1           # products of two residues fit a long
STEPS = (48271, 69621, 1226874159, 950706376)   # s of the four hashes
BLOCK = 4096                # positions of one conversation per window
CHUNK_CHARS = 1 << 16       # characters of joined numbers per row
FPS = ("f1", "f2")          # two residues each, side by side in a long


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEAD


def base_of(conv: Column) -> Column:
    return conv - conv % GROUP


# ----------------------------------------------------------- modular hashes

def times(a: Column, b) -> Column:
    return a * b % PRIME


def power(s: int, n: Column) -> Column:
    """s^n by the binary digits of n (as many steps as n has digits)."""
    squares = [pow(s, 2**k, PRIME) for k in range(31)]
    table = F.array(*[F.lit(x).cast("long") for x in squares])
    digits = F.reverse(F.split(F.bin(n), ""))
    chosen = F.zip_with(digits, F.slice(table, 1, F.size(digits)), lambda d, x: F.when(d == "1", x).otherwise(F.lit(1).cast("long")))
    return F.aggregate(chosen, F.lit(1).cast("long"), lambda acc, x: times(acc, x))


def residues(role: Column, text: Column, seed: int, prime: int) -> list[Column]:
    """Four residues of a turn."""
    out = []
    for k in (0, 1):
        h = F.xxhash64(F.lit(2 * seed + k), role, text)
        out += [F.pmod(h, F.lit(prime).cast("long")), F.shiftrightunsigned(h, 33) % prime]
    return out


def fingerprint(f: list[Column]) -> list[Column]:
    return [F.shiftleft(f[0], 31).bitwiseOR(f[1]).alias(FPS[0]), F.shiftleft(f[2], 31).bitwiseOR(f[3]).alias(FPS[1])]


# ---------------------------------------------------------- running sums

def blocked(df: DataFrame, key: str, at: Column, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with running sums of long columns per key in the given order, where
    ``at`` (not falling in that order) tells blocks: sums inside a block,
    then over the blocks before, so no window holds a whole hot key."""
    cut = df.withColumn("_block", at)
    inside = Window.partitionBy(key, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    totals = cut.groupBy(key, "_block").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(key).alias("_key"), F.col("_block").alias("_of"),
                          *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_carry_{n}") for n in sums])
    joined = local.join(carry, (F.col(key) == F.col("_key")) & F.col("_block").eqNullSafe(F.col("_of")))
    return joined.withColumns({n: F.col(f"_{n}") + F.col(f"_carry_{n}") for n in sums}) \
        .drop("_block", "_key", "_of", *[f"_{n}" for n in sums], *[f"_carry_{n}" for n in sums])


def positions(turns: DataFrame) -> DataFrame:
    """(conv, pos, role, text) with positions from 1 in each conversation."""
    need(turns, "conv_id", "turn", "role", "text")
    clean = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return blocked(clean, "conv", F.floor(F.col("turn") / BLOCK), order, {"pos": F.lit(1).cast("long")}).drop("turn")


def prefixes(turns: DataFrame, seed: int, prime: int) -> DataFrame:
    """(conv, pos, words, t0..t3, p0..p3): each turn's moved residues s^(pos-1) * x
    and the prefix hashes of the original conversations up to it."""
    moved = turns.select("conv", "pos", F.size(word_array(F.col("text"))).cast("long").alias("words"), *[
        (times(x, power(s, F.col("pos") - 1)) % prime).alias(f"t{k}")
        for k, (x, s) in enumerate(zip(residues(F.col("role"), F.col("text"), seed, prime), steps(seed)))])
    summed = blocked(moved, "conv", F.floor(F.col("pos") / BLOCK), [F.col("pos")], {f"p{k}": F.col(f"t{k}") for k in range(4)})
    return summed.withColumns({f"p{k}": F.col(f"p{k}") % PRIME for k in range(4)})


def steps(seed: int) -> list[int]:
    return [pow(s, 2 * seed + 1, PRIME) for s in STEPS]


# -------------------------------------------------------------- the paths

def rebuilt(original: DataFrame, seed: int) -> DataFrame:
    """(conv, depth, f1, f2, up1, up2, ref_conv, ref_pos, words, last): every
    prefix of every rebuilt conversation, its parent's fingerprint and the
    reference to its last turn.  original: a written table of ``prefixes``."""
    p, t = [f"p{k}" for k in range(4)], [f"t{k}" for k in range(4)]
    sized = original.groupBy("conv").agg(F.count("*").alias("n"))
    heads = original.filter(F.col("pos") < HEAD)
    # the plan of a conversation: its base's head (k turns) and where its own turns go on
    head_size = heads.groupBy("conv").agg(F.max("pos").alias("m")).select(F.col("conv").alias("base"), "m")
    plan = (sized.withColumns({"h": head_length(F.col("conv")), "base": base_of(F.col("conv"))})
            .join(head_size, "base", "left").withColumn("k", F.least(F.col("h"), F.coalesce("m", F.lit(0)))).drop("m"))
    plan = handover(plan.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-plan")

    def prefix_at(conv: str, pos: str, name: str) -> DataFrame:
        """Prefix hashes of conversation ``conv`` after ``pos`` turns (0 if none)."""
        some = heads.select(F.col("conv").alias("_c"), F.col("pos").alias("_p"), *[F.col(x).alias(f"{name}{x}") for x in p])
        return plan.select("conv", F.col(conv).alias("_c"), F.col(pos).alias("_p")).join(some, ["_c", "_p"]).drop("_c", "_p")

    whole = (plan.withColumn("own", F.least("h", "n")).join(prefix_at("base", "k", "h"), "conv", "left")
             .join(prefix_at("conv", "h", "o"), "conv", "left").na.fill(0, [f"{a}{x}" for a in "ho" for x in p]))
    own = original.join(whole.select("conv", "h", "k", "length", *[f"{a}{x}" for a in "ho" for x in p]), "conv") \
        .filter(F.col("pos") > F.col("h"))
    # a suffix moved from position h + 1 to k + 1 is divided by s^(h - k)
    hashes, parents = [], []
    for j, s in enumerate(steps(seed)):
        back = [pow(pow(s, -1, PRIME), d, PRIME) for d in range(HEAD)]
        shift = F.element_at(F.array(*[F.lit(x).cast("long") for x in back]), (F.col("h") - F.col("k") + 1).cast("int"))
        suffix = times((F.col(f"p{j}") - F.col(f"op{j}") + PRIME) % PRIME, shift)
        f = (F.col(f"hp{j}") + suffix) % PRIME
        hashes.append(f)
        parents.append((f - times(F.col(f"t{j}"), shift) + PRIME) % PRIME)

    def path(depth: Column, f: list[Column], up: list[Column], ref: Column, pos: Column, words: Column) -> list[Column]:
        ups = [x.alias(f"up{i}") for i, x in enumerate(fingerprint(up), 1)]
        return [F.col("conv"), depth.cast("long").alias("depth"), *fingerprint(f), *ups, ref.alias("ref_conv"),
                pos.alias("ref_pos"), words.alias("words"), (F.col("length") == depth).alias("last")]

    zero = F.lit(0).cast("long")
    tails = own.select(*path(F.col("k") + F.col("pos") - F.col("h"), hashes, parents, F.col("conv"), F.col("pos"), F.col("words")))
    taken = plan.filter("k > 0").select("conv", "k", "length", F.col("base").alias("_base"))
    fronts = (taken.join(heads.withColumnRenamed("conv", "_of"), (F.col("_base") == F.col("_of")) & (F.col("pos") <= F.col("k")))
              .select(*path(F.col("pos"), [F.col(x) for x in p], [(F.col(a) - F.col(b) + PRIME) % PRIME for a, b in zip(p, t)],
                            F.col("_base"), F.col("pos"), F.col("words"))))
    roots = plan.select(*path(zero, [zero] * 4, [zero] * 4, F.lit(None).cast("long"), F.lit(None).cast("long"), zero))
    return tails.unionAll(fronts).unionAll(roots)


KEY = ["depth", *FPS]


def clashes(paths: DataFrame, turns: DataFrame) -> int:
    """Groups of equal fingerprints whose parents or referenced turns differ."""
    refs = paths.filter("depth > 0").select(*KEY, "up1", "up2", "ref_conv", "ref_pos").distinct()
    read = refs.join(turns.select(F.col("conv").alias("ref_conv"), F.col("pos").alias("ref_pos"), "role", "text"), ["ref_conv", "ref_pos"])
    unlike = None
    for c in ("up1", "up2", "role", "text"):
        differs = F.min(c) != F.max(c)
        unlike = differs if unlike is None else unlike | differs
    return read.groupBy(*KEY).agg(unlike.alias("unlike")).filter("unlike").count()


def verified_paths(turns: DataFrame, prime: int = PRIME, tries: int = 8) -> DataFrame:
    """The written paths, whose fingerprint groups are proven equal.  Wrong
    groups have a chance of 2^-120 per pair, so a second try is not expected;
    ``prime`` (for tests) makes the residues of turns small."""
    for seed in range(tries):
        original = handover(prefixes(turns, seed, prime if seed == 0 else PRIME), "trie-prefixes")
        paths = handover(rebuilt(original, seed), "trie-paths")
        if not clashes(paths, turns):
            return paths
    raise RuntimeError("fingerprints of different turns stay equal")


# ------------------------------------------------------------------ figures

def member_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of ends (key, conv): numbers are joined in chunks
    by ranges of (key, conv), and the chunks of a key stream through one hash."""
    ends = handover(ends, "trie-ends")
    key = [f"{c} long" for c in KEY]

    def runs(batches):
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in KEY]))
            convs = batch.column("conv").to_pylist()
            out, a = [], 0
            while a < len(keys):
                b, size = a, 0
                while b < len(keys) and keys[b] == keys[a] and size < CHUNK_CHARS:
                    size += len(str(convs[b])) + 1
                    b += 1
                out.append((*keys[a], convs[a], ",".join(map(str, convs[a:b]))))
                a = b
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*KEY, "first", "joined"])

    def digest(batches):
        at, sha = None, None
        for batch in batches:
            done = []
            for *k, joined in zip(*[batch.column(c).to_pylist() for c in [*KEY, "joined"]]):
                if k != at:
                    if at is not None:
                        done.append((*at, sha.hexdigest()))
                    at, sha = k, hashlib.sha256(joined.encode())
                else:
                    sha.update(b"," + joined.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, sha.hexdigest())], names=[*KEY, "ends_sha256"])

    chunks = (ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
              .mapInArrow(runs, ", ".join([*key, "first long", "joined string"])))
    return (chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digest, ", ".join([*key, "ends_sha256 string"])))


def trie(turns: DataFrame, prime: int = PRIME) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A node's subtree consists of prefixes of its members, and a conversation
    is the smallest member of a node and of all nodes below on its path; so
    the sums over a subtree are sums over the node's members of what their
    own nodes hold at that depth or below (a running sum on each path)."""
    turns = handover(positions(turns), "trie-turns")
    paths = verified_paths(turns, prime)
    nodes = paths.groupBy(*KEY).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
                                    F.min("up1").alias("up1"), F.min("up2").alias("up2"))
    children = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("f1"), F.col("up2").alias("f2"))
                .agg(F.count("*").alias("n_children")))
    nodes = handover(nodes.join(children, KEY, "left").na.fill(0, ["n_children"]), "trie-nodes")
    held = nodes.select(F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("value"),
                        (F.col("n_children") == 0).cast("long").alias("leaf"))
    below = blocked(paths.select("conv", *KEY).join(held, ["conv", "depth"], "left").na.fill(0, ["value", "leaf"]), "conv",
                    -F.floor(F.col("depth") / BLOCK), [F.col("depth").desc()],
                    {"saved_tokens": F.col("value"), "n_leaves": F.col("leaf")})
    sums = below.groupBy(*KEY).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    digests = member_digests(paths.filter("last").select(*KEY, "conv"))
    # all nodes of depth 1 have one parent, the root: its number is one value
    root = nodes.filter("depth = 0").select("conv_id").scalar()
    parents = nodes.filter("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("up1"), F.col("f2").alias("up2"),
                                               F.col("conv_id").alias("_parent"))
    return (nodes.join(parents, ["depth", "up1", "up2"], "left").join(sums, KEY).join(digests, KEY, "left")
            .select("conv_id", "depth", F.when(F.col("depth") == 1, root).otherwise(F.col("_parent")).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
