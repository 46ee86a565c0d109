import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotgrid.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<float>, label int, block string, anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [x if x is None else float(x) for x in v], y, "x", "y") for i, v, y in rows], ROWS)


def plain(rows, is_anchor, positives=5, negatives=10, band=(30, 90)):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out, seen = [], set()
    for i, v, y in good:
        if not is_anchor(i) or (i, tuple(v), y) in seen:
            continue
        seen.add((i, tuple(v), y))
        scored = sorted((-dot(v, w), j, z) for j, w, z in good if j != i)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            fits = [(n, j) for n, j, z in scored if z != y and band[0] * -s <= 100 * -n <= band[1] * -s][:negatives]
            out += [(i, p, rank, j, -s, -n) for rank, (n, j) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every=5, **more):
    got = hn.mine_negatives(spark, frame(spark, rows), F.col("id") % every == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def cloud(seed, n=300, dim=8, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dim))
    return [(i, [float(np.float32(x)) for x in middle[i % 6] + 0.7 * rng.normal(size=dim)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block, members, step", [(8192, 256, 64), (40, 7, 4)])
def test_equals_all_pairs(spark, monkeypatch, block, members, step):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    monkeypatch.setattr(hn, "MEMBERS", members)
    monkeypatch.setattr(hn, "FIRST_STEP", step)
    rows = cloud(1)
    expected = plain(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows) == expected and len(expected) > 500


def test_unusable_rows_ties_and_repeats(spark):
    rows = cloud(2, 80, 3)
    rows += [(None, [1.0, 1, 1], 1), (200, None, 1), (205, [1.0, 1, 1], None), (210, [1.0, None, 1], 1), (215, [float("nan"), 1, 1], 1), (220, [float("inf"), 1, 1], 1)]
    rows += [(300 + i, [0.5, 0.5, 0.5], i % 2) for i in range(30)]  # ties everywhere
    rows += rows[:3] + rows[-3:] + [(0, [1.0, 0, 0], 3)]  # repeated rows, and another anchor of id 0
    rows += [(400, [0.0, 0, 0], 1), (405, [], 1), (410, [2.0], 2), (415, [-1.0, -1, -1], 0)]
    assert mined(spark, rows) == plain([(i, None if v is None else v + [0.0] * (3 - len(v)), y) for i, v, y in rows], lambda i: i % 5 == 0)


def test_one_label_has_no_negatives(spark):
    assert mined(spark, [(i, [1.0, i], 1) for i in range(20)]) == []


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_other_parameters(spark):
    rows = cloud(3, 120, 5, 3)
    assert mined(spark, rows, 7, positives=2, negatives=3, band=(10, 50)) == plain(rows, lambda i: i % 7 == 0, 2, 3, (10, 50))


def test_walks_end_early():
    rng = np.random.default_rng(4)
    near, far = rng.normal(size=(50, 16)) * 5 + 200, rng.normal(size=(5000, 16)) * 20
    vectors = np.rint(np.concatenate([far, near])).astype(np.int64)
    members = np.rint(rng.normal(size=(9, 16)) * 3 + 100).astype(np.int64)
    shared, ids, met = hn.Shared(members, vectors), np.arange(len(vectors)), []

    def fits(requests, places, scores):
        met.append(len(places))
        return np.ones(scores.shape, bool)

    request, place, score = shared.walk(np.arange(9), fits, ids, 5, np.full(9, hn.LOW))
    every = members @ vectors.T
    for m in range(9):
        order = np.lexsort((ids, -every[m]))[:5]
        assert place[request == m].tolist() == order.tolist() and score[request == m].tolist() == every[m][order].tolist()
    assert sum(met) < 500


def test_scores_that_fit_no_long_are_refused():
    with pytest.raises(OverflowError):
        hn.Shared(np.full((1, 2), 2**40), np.full((1, 2), 2**40))
