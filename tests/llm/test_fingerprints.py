import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotgrid.llm import fingerprints as fp


def text_of(words, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))


def test_likeness(words):
    a, b = text_of(words, 800, 1), text_of(words, 800, 2)
    chain = fp.digest(a)
    assert fp.likeness(chain, fp.digest(a)) == 1 and fp.to_string(fp.digest(a)) == fp.to_string(chain)
    assert fp.likeness(chain, fp.digest(b)) < 0.1
    near = fp.likeness(chain, fp.digest(fp.edited(a, b)))
    assert 0.5 < near < 0.95
    assert near == fp.likeness(fp.digest(fp.edited(a, b)), chain)
    assert fp.likeness(chain, fp.digest("zz " + a)) > 0.9  # a shift moves every byte and no feature
    assert [(n, bits.tolist()) for n, bits in fp.from_string(fp.to_string(chain))] == [(n, bits.tolist()) for n, bits in chain]


def test_small_texts():
    assert fp.digest("") == [] and fp.likeness([], []) == 1 and fp.likeness([], fp.digest("a")) == 0
    for t in ("a", "é" * 5, "x" * 5000, "ab", "a" * fp.WIDTH, "a" * (fp.WIDTH + 1)):
        assert fp.digest(t) and fp.likeness(fp.digest(t), fp.digest(t)) == 1


def plain_favourites(data):
    """The definition, window by window."""
    info = [0] * len(data)
    for i, c in enumerate(data):
        far = next((d for d in range(1, fp.FARTHEST) if i >= d and data[i - d] == c), fp.FARTHEST)
        info[i] = int(fp._INFORMATION[far])
    rank = [sum(info[i : i + fp.WIDTH]) for i in range(len(data) - fp.WIDTH + 1)]
    votes = {}
    for i in range(len(rank) - fp.SPAN + 1):
        best = max(range(i, i + fp.SPAN), key=lambda j: (rank[j], -j))
        votes[best] = votes.get(best, 0) + 1
    return sorted(i for i, n in votes.items() if n >= fp.LEAST_VOTES)


def test_features_by_definition(words):
    data = text_of(words, 120, 3).encode()
    assert fp._favourites(np.frombuffer(data, np.uint8)).tolist() == plain_favourites(data)


def test_segments_change_nothing(words, monkeypatch):
    data = text_of(words, 900, 4).encode()
    want = fp.features(data).tolist()
    monkeypatch.setattr(fp, "SEGMENT", 1000)
    assert fp.features(data).tolist() == want


@pytest.mark.parametrize("parts", ["1", "4", "9", "97"])
def test_neighbours(spark, documents, words, parts):
    rows = [(i * 3, text_of(words, i % 40, i)) for i in range(60)] + [(1000, None), (1001, ""), (1002, "é" * 9), (30, "again"), (30, "again"), (None, "no id, first"), (-5, "a" * 40_000)]
    random.Random(1).shuffle(rows)
    order = sorted(((i is not None, i or 0), t or "") for i, t in rows)
    want = []
    for n, ((known, i), t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        changed = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        a, e = fp.digest(t), fp.digest(changed)
        want.append((i if known else None, len(t), sha256(changed.encode()).hexdigest(), fp.to_string(a), fp.to_string(e), fp.likeness(a, e),
                     fp.likeness(a, fp.digest(after))))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = [tuple(r) for r in fp.compare_neighbours(spark, documents(rows)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_row_and_none(spark, documents):
    [r] = fp.compare_neighbours(spark, documents([(5, "abcdefgh" * 20)])).collect()
    assert r.near_next == 1
    assert fp.compare_neighbours(spark, documents([])).collect() == []


def test_a_block_is_a_task_of_its_own(spark, documents):
    rows = [(i // 2 * 7, f"text {i}") for i in range(4000)]
    dealt = fp.with_neighbours(spark, documents(rows), "doc_id", "text").withColumn("task", F.spark_partition_id())
    found = dealt.groupBy("task").agg(F.count_distinct("block").alias("blocks"), F.count("*").alias("n")).collect()
    assert len(found) == 8 and all(r.blocks == 1 and r.n < 1500 for r in found)
    assert dealt.where("guest = 0").count() == 4000 and dealt.where("guest = 1").select("block").distinct().count() == 8


@pytest.mark.parametrize("kind", ["string", "decimal(20,0)", "date"])
def test_keys_of_other_types(spark, documents, kind):
    docs = documents([(i, f"text {i} " * 5) for i in range(300)])
    key = F.date_from_unix_date(F.col("doc_id").cast("int")) if kind == "date" else F.format_string("%05d", "doc_id") if kind == "string" else F.col("doc_id").cast(kind)
    want = {(r.doc_id, r.edited_sha256) for r in fp.compare_neighbours(spark, docs).collect()}
    named = docs.select("doc_id", key.alias("name"))
    got = fp.compare_neighbours(spark, docs.withColumn("name", key), "name").join(named, "name")
    assert {(r.doc_id, r.edited_sha256) for r in got.collect()} == want
