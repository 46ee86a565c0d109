import random

import numpy as np
import pytest

from spotgrid.llm import jaccard_join as jj
from spotgrid.llm import queries
from spotgrid.llm.components import components


def shingles(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    """(id, shingles, component, links) by comparing all pairs that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    where, parent, links = {}, list(range(len(rows))), [0] * len(rows)
    for a, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(a)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, s in enumerate(sets):
        for b in {b for x in s for b in where[x] if b > a}:
            n = len(s & sets[b])
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                parent[root(b)] = root(a)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[root(a)] = min(least.get(root(a), i), i)
    return sorted((i, len(sets[a]), least[root(a)], links[a]) for a, (i, _) in enumerate(rows))


def run(spark, documents, rows, k, percent):
    return sorted(tuple(r) for r in jj.jaccard_join(spark, documents(rows), k=k, percent=percent).collect())


def corpus(seed, n=260):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(50)]
    bases = [[rng.choice(words) for _ in range(rng.randint(4, 110))] for _ in range(14)]
    rows = []
    for i in range(n):
        kind = rng.random()
        body = list(bases[0] if kind < 0.3 else rng.choice(bases)) if kind < 0.6 else passage + rng.choices(words, k=rng.randint(3, 50)) if kind < 0.8 else rng.choices(words, k=rng.randint(0, 60))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            if body:
                body[rng.randrange(len(body))] = rng.choice(words)
        rows.append((i, " ".join(body)))
    return rows + [(1000, None), (1001, ""), (1002, "a b"), (1003, "A \t B"), (1004, "a"), (1005, "a b c"), (1002, "a b")]


@pytest.mark.parametrize(("k", "percent", "leaf"), [(3, 90, 512), (5, 80, 512), (3, 90, 12), (2, 60, 8)])
def test_all_links_and_components(spark, documents, monkeypatch, k, percent, leaf):
    """Small leaves force second cuts, pivots and block pairs."""
    monkeypatch.setattr(jj, "LEAF", leaf)
    monkeypatch.setattr(jj, "STAR_PIVOTS", 512 if leaf > 8 else 3)
    rows = corpus(k + leaf)
    assert run(spark, documents, rows, k, percent) == brute(rows, k, percent)


def test_pivots_split_a_region_of_several_clusters(spark):
    """Voronoi regions hold every pair within the radius once."""
    rng, percent = np.random.default_rng(5), 80
    sets, centres = [], [rng.integers(1, 2**62, 60, dtype=np.uint64) for _ in range(6)]
    for i in range(240):
        own = centres[i % 6].copy()
        own[rng.integers(0, 60, 3)] = rng.integers(1, 2**62, 3, dtype=np.uint64)
        sets.append(np.unique(own))
    rows = spark.createDataFrame([("r", jj.digest(s), len(s), i, 1, s.view(np.int64).tolist(), 0, 240, int(sum(map(len, sets)))) for i, s in enumerate(sets)],
                                 "region string, digest binary, n long, rep long, copies long, items array<long>, mask long, classes long, shingles long")
    before = jj.LEAF
    jj.LEAF = 40
    try:
        cut = jj.voronoi(rows, percent, 0).collect()
    finally:
        jj.LEAF = before
    assert len({r.region for r in cut}) > 1
    place = {}
    for r in cut:
        place.setdefault(r.region, []).append((r.rep, r.mask))
    met = {}
    for members in place.values():
        for a, (x, p) in enumerate(members):
            for y, q in members[a + 1 :]:
                if not p & q:
                    met[min(x, y), max(x, y)] = met.get((min(x, y), max(x, y)), 0) + 1
    assert set(met.values()) == {1}
    for x in range(240):
        for y in range(x + 1, 240):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                assert (x, y) in met


def test_ties_meet_whenever_sets_link():
    rng = np.random.default_rng(3)
    for percent in (60, 80, 90):
        for n in (*range(1, 40), 55, 90, 200, 700):
            a = np.unique(rng.integers(1, 2**62, n, dtype=np.uint64))
            for change in range(0, n + 1):
                b = np.unique(np.concatenate([a[: len(a) - change], rng.integers(1, 2**62, rng.integers(0, change + 1), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if change and 100 * both < percent * (len(a) + len(b) - both):
                    break
                if change and len(b):
                    assert all(np.intersect1d(jj.ties(a, percent, seed), jj.ties(b, percent, seed)).size for seed in (0, 1))


def test_bitmaps_are_never_farther_apart_than_sets():
    rng = np.random.default_rng(4)
    for n in (4, 30, 300):
        a = np.unique(rng.integers(1, 2**62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(1, 2**62, n, dtype=np.uint64)]))
        size = jj._bits(n // 2, jj.BITS)
        apart = int(np.bitwise_count(jj._fold(jj.bitmap(a), size) ^ jj._fold(jj.bitmap(b), size)).sum())
        assert 0 < apart <= len(np.setxor1d(a, b))
        assert (jj._fold(jj.bitmap(a), 8) == np.packbits(np.unpackbits(jj.bitmap(a)).reshape(8, -1).max(1))).all()


def test_query(spark, sf, sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    assert sorted(tuple(r) for r in queries.op7_jaccard_join(spark, sf).collect()) == brute(rows, 3, 90)


def test_keep_one(spark, documents):
    rows = corpus(1, 80)
    docs = documents(rows).selectExpr("*", "doc_id AS _row", "text AS name", "source AS row", "lang AS of")
    want = {c for _, _, c, _ in brute(rows, 5, 80)}
    out = jj.keep_one(spark, docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert all(r._row == r.doc_id and r.name == r.text for r in got)
    assert jj.jaccard_join(spark, documents([])).collect() == []


def test_keep_one_tells_rows_apart_by_id_and_text(spark, documents):
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    near = lambda name: text(name, 59) + " end"
    rows = [
        (1, text("b")), (5, text("a")), (5, near("b")),  # 5's second text is linked to 1, its first one to no other
        (None, near("a")), (None, text("c")), (None, near("c")), (None, text("c")),  # copies without ids
        (7, text("d")), (7, text("e")), (7, text("e")), (8, "short"), (8, "brief"), (8, "brief"), (None, ""), (None, None),
    ]
    got = [(r.doc_id, r.text) for r in jj.keep_one(spark, documents(rows)).collect()]
    c = [t for i, t in got if i is None and t and t.startswith("c")]
    assert len(c) == 1 and c[0] in (text("c"), near("c"))
    got.remove((None, c[0]))
    want = [(1, text("b")), (5, text("a")), (7, text("d")), (7, text("e")), (8, "short"), (8, "brief"), (None, ""), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("small", [200_000, 10])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr("spotgrid.llm.components.SMALL", small)
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 560)] + [(700, 700)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_only_needed_ties_are_sent():
    """As many as linked sets can differ in, and one: parts of one element, which a common phrase alone can fill, come last."""
    rng, edges = np.random.default_rng(6), jj.bands(80)[0]
    for n in (int(n) for n in edges[8:14]):
        found = jj.ties(np.unique(rng.integers(1, 2**62, n, dtype=np.uint64)), 80)
        assert len(found) == (n + n * 100 // 80) * 20 // 180 + 1


@pytest.mark.parametrize(("slack", "most"), [(0, 4096), (5, 4096), (5, 3), (20, 2)])
def test_linked_classes_of_a_star_share_a_pivot(monkeypatch, slack, most):
    monkeypatch.setattr(jj, "STAR_PIVOTS", most)
    rng, percent = np.random.default_rng(slack + most), 80
    centres, sets = [rng.integers(1, 2**62, 90, dtype=np.uint64) for _ in range(8)], []
    for i in range(200):
        keep = centres[i % 8][: rng.integers(60, 91)]
        sets.append(np.unique(np.concatenate([keep[rng.integers(0, 8) :], rng.integers(1, 2**62, rng.integers(0, 8), dtype=np.uint64)])))
    sets.sort(key=len)
    star, joined = jj.Star(jj._bits(len(sets[0]), jj.BITS), percent, slack), jj.Forest()
    for i, s in enumerate(sets):
        for other in star.meet(i, len(s), jj.bitmap(s)):
            joined.join(i, other)
    linked = 0
    for x in range(200):
        for y in range(x + 1, 200):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                linked += 1
                assert joined.root(x) == joined.root(y)
    assert linked > 200
    if most > 200 and slack < 10:
        assert len({joined.root(x) for x in range(200)}) >= 8


def test_a_group_of_near_copies_makes_few_edges(spark, documents, monkeypatch):
    """However many tasks the stars are dealt to."""
    rng = random.Random(8)
    base, rows = [f"w{i}" for i in range(400)], []
    for i in range(60):
        body = list(base)
        for _ in range(12):
            body[rng.randrange(400)] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(body)))
    made = []
    monkeypatch.setattr(jj, "components", lambda s, edges: made.append(edges.count()) or components(s, edges))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("60", "false"), strict=True):
            spark.conf.set(k, v)
        jj.jaccard_join(spark, documents(rows), k=2, percent=80).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 59 <= made[0] <= 3 * 60
