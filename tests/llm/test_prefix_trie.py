import hashlib
import random
import zlib

import pytest

from spotgrid.llm import prefix_trie
from spotgrid.llm.queries import op11_prefix_trie

TURNS = "conv_id long, turn int, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def place(row):
    role, text = row[2] or "", row[3] or ""
    return (row[1] is not None, row[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30])


def by_conversation(rows):
    found = {}
    for row in sorted((r for r in rows if r[0] is not None), key=place):
        found.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    return found


def rebuilt(found):
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    base = lambda c: found.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
    return {c: base(c)[: h(c)] + own[h(c) :] for c, own in found.items()}


def plain_trie(found):
    """Every node by its sequence of turns; sums over subtrees by looking at all nodes."""
    nodes = {}
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {n: [k for k in nodes if len(k) == len(n) + 1 and k[: len(n)] == n] for n in nodes}
    rows = []
    for n, members in nodes.items():
        subtree = [k for k in nodes if k[: len(n)] == n]
        ends = sorted(c for c in members if len(found[c]) == len(n))
        rows.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids[n]), sum(not kids[k] for k in subtree),
                     sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in subtree if k), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def rows_of(frame):
    assert frame.columns == list(COLUMNS) and [f.dataType.simpleString() for f in frame.schema] == ["bigint"] * 7 + ["string"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def talks(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in [*range(n), 100, 101, 207, 205, -3, -100, -102]:
        start = rng.choice(["hello", "ä b", "", None])
        for i in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([i, i, None]), rng.choice(["user", "assistant", None]), start if i == 0 else rng.choice(["yes", "no", "x" * 40])))
    return rows + rows[:5] + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_trie(spark, seed):
    rows = talks(seed)
    frame = spark.createDataFrame(rows, TURNS)
    assert rows_of(prefix_trie.prefix_trie(spark, frame)) == plain_trie(by_conversation(rows))


def test_branched_conversations(spark, tmp_path):
    rows = talks(3)
    spark.createDataFrame([(*r, 1, "z") for r in rows], TURNS + ", rep long, depth string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(op11_prefix_trie(spark, str(tmp_path))) == plain_trie(rebuilt(by_conversation(rows)))


def test_a_full_sketch_only_passes_more(spark):
    rows = talks(4)
    slim = prefix_trie.slim_turns(spark.createDataFrame(rows, TURNS))
    placed = prefix_trie.stage(spark, prefix_trie.placed_turns(spark, slim), "placed")
    got = prefix_trie.trie(spark, placed, placed.select("conv").distinct(), most_cells=16)
    assert rows_of(got) == plain_trie(by_conversation(rows))


def test_the_screen_lets_most_tails_out(spark):
    rows = [(c, i, "user", f"{c} {i}" if i else "hello") for c in range(200) for i in range(8)]
    placed = prefix_trie.stage(spark, prefix_trie.placed_turns(spark, prefix_trie.slim_turns(spark.createDataFrame(rows, TURNS))), "placed")
    paths = prefix_trie.stage(spark, prefix_trie.prefixes(spark, placed), "paths")
    met = prefix_trie.screened(paths, prefix_trie.sketch(spark, paths)).where("meets")
    # The first turn, the first of each tail, and what collides.
    assert 400 <= met.count() < 500


def test_long_conversation_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [(5, i, "user", str(i)) for i in range(150)] + [(c, i, "user", str(i)) for c in range(1000, 1040) for i in range(3)] + [(7, None, "u", "same")] * 20
    got = rows_of(prefix_trie.prefix_trie(spark, spark.createDataFrame(rows, TURNS).repartition(5)))
    assert got == plain_trie(by_conversation(rows))


def test_empty_table(spark):
    assert rows_of(prefix_trie.prefix_trie(spark, spark.createDataFrame([], TURNS))) == []


def test_only_one_bare_conversation(spark, tmp_path):
    # Conversation 4 loses its only turns to a group that isn't there.
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(c, 0, "user", "a")]
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(op11_prefix_trie(spark, str(tmp_path))) == plain_trie({c: []})
