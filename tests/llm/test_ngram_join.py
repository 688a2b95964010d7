import random

import edge
import numpy as np
import pytest

from tablework.llm import ngram_join as J


def corpus(seed, families=14, copies=7):
    random.seed(seed)
    rows, n = [], 0
    for f in range(families):
        base = [f"w{random.randint(0, 400)}" for _ in range(random.choice([2, 3, 5, 9, 12, 25, 60, 140, 300]))]
        for c in range(copies):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
                at = random.randrange(len(text))
                text[at:at + random.randint(0, 1)] = [f"w{random.randint(0, 400)}"]
            rows.append((n, " ".join(text)))
            n += 1
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(n + i, passage + " " + " ".join(f"q{random.randint(0, 10**6)}" for _ in range(60))) for i in range(20)]
    return rows


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100)])
def test_equals_all_pairs(spark, n, num, den):
    rows = corpus(n)
    got = J.link_groups(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == edge.groups(rows, n, num, den)


def test_edges(spark):
    got = J.link_groups(edge.documents(spark, extra=True)).collect()
    assert len(got) == len(edge.EDGE)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4)
    assert by[5][1] == by[6][1] == 5 and by[12][1] == by[13][1] == 12 and by[9][1] == 9
    assert by[None][1] is None
    assert J.link_groups(edge.documents(spark, [])).collect() == []
    kept = J.keep_one(edge.documents(spark, extra=True), 3, 90)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i, _, _ in edge.EDGE if i not in (6, 13)) and set(edge.EXTRA) <= set(kept.columns)


def test_linked_sets_share_a_tree():
    """Sets at the threshold share a key, also across bands and with empty
    groups, for many sizes."""
    rng = np.random.default_rng(8)
    for num, den in ((90, 100), (80, 100)):
        for size in [1, 2, 4, 5, 9, 10, 11, 19, 20, 40, 41, 63, 100, 101, 250, 1000]:
            for _ in range(25):
                a = rng.integers(0, 2**63, size).astype(np.uint64)
                more = rng.integers(0, size * den // num - size + 1)
                drop = 0
                while den * (size - drop - 1) >= num * (size + more) and drop < size - 1:
                    drop += 1                            # |a & b| = size - drop, |a | b| = size + more
                b = np.concatenate([a[drop:], rng.integers(0, 2**63, more).astype(np.uint64)])
                if den * (size - drop) < num * (size + more):
                    continue
                h = np.concatenate([np.sort(a), np.sort(b)])
                keys, per = J.tree_keys(h, np.array([len(a), len(b)]), num, den)
                equal = drop == 0 and more == 0
                assert equal or set(keys[:per[0]]) & set(keys[per[0]:]), (num, size, drop, more)


def test_tree_finds_what_the_bound_lets_through():
    rng = np.random.default_rng(9)
    points = rng.poisson(rng.integers(1, 9, (600, 1)), (600, 32)).astype(np.int32)
    points[300:] = np.maximum(0, points[:300] + rng.integers(-1, 2, (300, 32)) * (rng.random((300, 32)) < .1))
    sizes = points.sum(1).astype(np.int64)
    q, p = J.RTree(points, sizes).search(points[:100], sizes[:100], 90, 100)
    bound = np.minimum(points[:100, None], points[None]).sum(2)
    want = np.argwhere(bound * 190 >= 90 * (sizes[:100, None] + sizes[None]))
    assert sorted(zip(q, p)) == sorted(map(tuple, want))


def linked(sets, num, den):
    """Components by comparing all pairs of sets."""
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if den * k >= num * (len(sets[i]) + len(sets[j]) - k):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(sets))]


def families_of_sets(seed, n, size, replaced):
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 2**62, size)
    sets = []
    for _ in range(n):
        own = base.copy()
        own[rng.choice(size, replaced, replace=False)] = rng.integers(1, 2**62, replaced)
        sets.append(set(own.tolist()))
    return sets


@pytest.mark.parametrize("replaced", [2, 4, 6, 9, 14])
def test_a_family_is_searched_whole_with_few_links(replaced):
    sets = families_of_sets(replaced, 120, 100, replaced)
    grams = [np.sort(np.array(list(x), np.uint64)) for x in sets]
    f = J.Family(np.arange(120), np.arange(120), np.concatenate(grams), np.array([len(g) for g in grams]), 90, 100)
    f.search(np.arange(120), np.arange(120))
    want = linked(sets, 90, 100)
    assert len(f.links) == 120 - len(set(want))                  # one link less than members, per component
    first = {}
    assert [first.setdefault(int(c), i) for i, c in enumerate(f.component)] == want


@pytest.mark.parametrize("replaced", [3, 5, 8])
def test_tiles_of_a_large_family_cover_its_pairs(spark, monkeypatch, replaced):
    """Tiles of ten members: first tiles, then members outside the largest
    component against all."""
    monkeypatch.setattr(J, "TILE", 10)
    random.seed(replaced)
    rows = []
    for f in range(2):
        base = [f"b{f}x{i}" for i in range(120)]
        for c in range(60):
            text = list(base)
            for at in random.sample(range(120), replaced if c % 7 else 12):
                text[at] = f"r{random.randint(0, 10**9)}"
            rows.append((f * 100 + c, " ".join(text)))
    got = J.link_groups(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == edge.groups(rows, 1, 90, 100)


def near_copies(n):
    random.seed(n)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        text = list(base)
        for at in random.sample(range(150), 3):
            text[at] = f"x{random.randint(0, 10**9)}"
        rows.append((i, " ".join(text)))
    return rows


def test_candidates_grow_in_proportion_to_a_group(spark, monkeypatch):
    """n copies with 3 of 150 words replaced share keys but hardly link: the
    tables handed over grow with n, not with its square."""
    sizes = {}
    write = J.handover

    def counted(df, name):
        table = write(df, name)
        sizes[name] = sizes.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(J, "handover", counted)
    grown = []
    for n in (300, 600, 1200):
        sizes.clear()
        J.link_groups(spark.createDataFrame(near_copies(n), "doc_id long, text string"), 3, 90, 100).collect()
        grown.append(dict(sizes))
    for name in grown[-1]:
        for few, many in zip(grown, grown[1:]):
            assert many[name] <= 2.5 * few.get(name, 0) + 200, (name, few.get(name), many[name])


def test_shared_keys_connect_their_sets(spark):
    """Against a plain count of sets per key: no shared key is missing from
    the filter, few others are in it, and the edges connect all its sets."""
    random.seed(3)
    rows = [(sid, [random.choice([random.randint(-2**63, 2**63 - 1), random.randint(0, 40) * 10**17]) for _ in range(random.randint(0, 30))])
            for sid in range(300)] + [(5, [77])] * 2
    df = spark.createDataFrame(rows, "sid long, keys array<long>").repartition(5)
    holders = {}
    for sid, keys in rows:
        for k in keys:
            holders.setdefault(k, set()).add(sid)
    shared = {k for k, v in holders.items() if len(v) > 1}
    bits = J.ranges(df)
    shorts = {r.short for r in J.shared_shorts(df, bits).collect()}
    def short(k):
        return (k % 2**64) >> (32 - bits)
    assert {short(k) for k in shared} <= shorts and len(shorts) <= len(shared) + 5
    exploded = df.selectExpr("sid", "explode(keys) AS key")
    for some in (exploded, J.likely(exploded, J.handover(J.shared_shorts(df, bits), "test-shorts"), bits)):
        edges = [(r.a, r.b) for r in J.key_edges(some, bits).collect()]
        up = list(range(300))
        def top(i):
            while up[i] != i:
                i = up[i]
            return i
        for a, b in edges:
            up[max(top(a), top(b))] = min(top(a), top(b))
        assert all(len({top(x) for x in holders[k]}) == 1 for k in shared)
        assert all(any({a, b} <= holders[k] for k in shared) for a, b in edges)
    assert J.shared_shorts(df.filter("false"), 4).collect() == [] and J.key_edges(exploded.filter("false"), 4).collect() == []


def test_components(spark):
    from tablework.llm.components import components
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] \
        + [(5000, 5000 + i) for i in range(1, 50)] + [(7, 7)]
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: top(i) for e in edges if e[0] != e[1] for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (45, 100)])
def test_points_let_no_linked_pair_go(num, den):
    """Against the overlaps of all pairs, over sizes that have unlike points."""
    rng = np.random.default_rng(num)
    sets = []
    for size in (30, 120, 130, 250, 260, 500, 520, 1100, 4000):
        base = rng.integers(0, 2**62, size)
        for drop in (0, size // 25, size // 9, size // 5, size // 2):
            sets.append(np.unique(np.concatenate([base[drop:], rng.integers(0, 2**62, drop // 2)])).astype(np.uint64))
    sets.append(np.concatenate([sets[0], np.arange(1, 400, dtype=np.uint64) * np.uint64(2**30)]))     # full coordinates
    sizes = np.array([len(x) for x in sets])
    points = []
    for x in sets:
        groups = min(J.MOST_GROUPS, max(32, 1 << int(np.ceil(np.log2(max(1, len(x) / 4))))))
        points.append(np.minimum(np.bincount((x % np.uint64(groups)).astype(int), minlength=groups), 255).astype(np.uint8).tobytes())
    every = np.arange(len(sets))
    for left, right in ((every, every), (every[::2], every[1::2])):
        got = {tuple(sorted((int(a), int(b)))) for q, p in J.bound_pairs(points, sizes, left, right, num, den) for a, b in zip(q, p)}
        for i in left:
            for j in right:
                k = len(np.intersect1d(sets[i], sets[j]))
                if i != j and den * k >= num * (sizes[i] + sizes[j] - k):
                    assert tuple(sorted((int(i), int(j)))) in got
        assert len(got) < len(left) * len(right) / 2


def test_blocks_of_shorts_are_made_in_bounded_steps():
    import pyarrow as pa
    rng = np.random.default_rng(4)
    keys = rng.integers(-2**63, 2**63 - 1, (3000, 300))
    keys[1:, 0] = keys[0, 0]                                 # a key of all sets
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3000)), pa.array(list(keys))], names=["sid", "keys"])
    out = list(J.short_blocks(iter([batch.slice(0, 1000), batch.slice(1000)]), 4))
    assert max(sum(len(x.as_py()) for x in b.column(1)) for b in out) <= 4 * J.CHUNK_WORDS
    alone, again = [], []
    for b in out:
        for part, x, mine in zip(*(c.to_pylist() for c in b.columns)):
            shorts = (part << 32) | np.frombuffer(x, np.uint32).astype(np.int64)
            (again if mine else alone).extend(shorts.tolist())
    every = (keys.ravel().view(np.uint64) >> np.uint64(28)).astype(np.int64)
    hot = int(keys[:1, 0].view(np.uint64)[0] >> np.uint64(28))
    assert set(alone) == set(every.tolist()) and set(again) == {hot} and len(alone) < len(every)


def test_points_are_made_by_the_workers_of_the_sets(spark, monkeypatch):
    """One Python worker per task, not a second one for the points."""
    rng, rows = random.Random(5), []
    for i in range(60):
        text = [f"b{k}" for k in range(120)]
        for at in rng.sample(range(120), 8 if i % 7 else 12):
            text[at] = f"r{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(J, "TILE", 10)
    workers, write = {}, J.handover

    def handover(df, name):
        workers[name] = df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
        return write(df, name)

    monkeypatch.setattr(J, "handover", handover)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.link_groups(docs, 1, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == edge.groups(rows, 1, 90, 100)
    assert workers["join-points"] == 1


def test_workers_give_memory_back_when_a_step_is_over(monkeypatch):
    from types import SimpleNamespace
    from tablework.llm import common
    seen = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: seen.append("back")))
    seen += common.released(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert seen == [2, 4, "back"]
    frames = [J.signatures, J.shared_shorts, J.key_edges]
    assert all("released" in f.__code__.co_names for f in frames)


def test_a_passage_does_not_bring_its_sets_together(spark, monkeypatch):
    """Sets of three fourths one passage are one large family and hardly
    link: the rows dealt to tiles stay within two a set, and the pairs that
    do link are found."""
    rng, rows = random.Random(11), []
    passage = [f"p{k}" for k in range(90)]
    for i in range(200):
        if i % 10 == 9:
            own = own[:27] + [f"c{i}x{k}" for k in range(3)]
        else:
            own = [f"o{rng.randint(0, 10**9)}" for _ in range(30)]
        rows.append((i, " ".join(passage + own)))
    monkeypatch.setattr(J, "TILE", 20)
    counts, write = {}, J.handover

    def counted(df, name):
        table = write(df, name)
        if name in ("join-large", "join-pairs-units"):
            counts[name] = table.count()
        return table

    monkeypatch.setattr(J, "handover", counted)
    got = J.link_groups(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == edge.groups(rows, 1, 90, 100)
    assert len({r.component_id for r in got}) == 180
    assert counts["join-large"] >= 150 and counts.get("join-pairs-units", 0) <= 2 * len(rows)


def test_linked_sets_share_a_rare_gram(spark):
    """Sets at the threshold beside very common n-grams."""
    rng = np.random.default_rng(12)
    common = rng.integers(-2**62, 2**62, 60)
    sets = []
    for size in (1, 4, 5, 20, 75, 100, 400):
        for _ in range(4):
            base = np.concatenate([rng.integers(-2**62, 2**62, size), common[:rng.integers(0, 60)]])
            drop = rng.integers(0, 1 + len(base) // 5)
            sets += [base, base[drop:], np.concatenate([base, rng.integers(-2**62, 2**62, len(base) // 4)])]
    sets = [set(x.tolist()) for x in sets]
    df = spark.createDataFrame([(i, list(x)) for i, x in enumerate(sets)], "sid long, grams array<long>")
    for num in (80, 90):
        keys = {r.sid: set(r["keys"]) for r in J.rare_grams(df, 10**4, num, 100).collect()}
        assert all(k <= {g & -1 << 24 for g in sets[i]} for i, k in keys.items())
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= num * len(a | b):
                    assert keys[i] & keys[j], (num, i, j)
