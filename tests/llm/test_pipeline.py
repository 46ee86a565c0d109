import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spotgrid.llm import mixing
from spotgrid.sources.shared import stage
from tests.llm.test_jaccard_join import brute
from tests.llm.test_mixing import plain_targets, size
from tests.llm.test_quality import plain as counts
from tests.llm.test_secret_scan import base


@pytest.fixture(scope="module")
def steps(spark, sf):
    """What each stage got and gave."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        made = stage(spark, function(spark, docs, sf), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_columns(steps):
    columns = steps["quality_rules"][0].columns
    assert all(made.columns == columns for name, (_, made) in steps.items() if name != "tokens")


def test_quality(steps):
    before, after = (x.collect() for x in steps["quality_rules"])
    kept = {r.doc_id for r in after}
    assert set(after) <= set(before) and not any(counts(r.text)[5] for r in after)
    assert len(kept) > 0.8 * len(before)


def test_near_duplicates(steps):
    before, after = (x.collect() for x in steps["near_duplicates"])
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c, _ in brute([(r.doc_id, r.text) for r in before], 5, 80)})
    assert set(after) <= set(before)


def test_secrets(steps):
    before, after = ({r.doc_id: r for r in x.collect()} for x in steps["secrets"])
    assert set(before) == set(after)
    for i, r in after.items():
        spans = base(before[i].text)
        assert (r.text == before[i].text) >= (not spans and "[secret]" not in r.text)
        assert len(r.text) == r.n_chars and all(before[i].text[s:e] not in r.text for s, _, e in spans)


def test_mix(steps):
    before, after = (x.collect() for x in steps["mix"])
    totals, given = {}, {}
    for r in before:
        totals[r.source] = totals.get(r.source, 0) + size(r.text)
    for r in after:
        given[r.source] = given.get(r.source, 0) + size(r.text)
    longest = max(size(r.text) for r in before)
    for source, target in plain_targets(totals).items():
        assert abs(given.get(source, 0) - target) <= longest
    assert set(after) <= set(before) and max(after.count(r) for r in after[:50]) <= mixing.MOST_REPEATS


def test_tokens(spark, sf, steps):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    before, after = ({r.doc_id: r for r in x.collect()} for x in steps["tokens"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(before[i].text, add_special_tokens=False).ids
    assert steps["tokens"][0].count() == steps["tokens"][1].count()


def test_stages_bear_nulls_and_no_rows(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, long, None, None, 1), (2, long, None, None, 1), (None, long + " x", None, "s", 2), (3, long * 300, "en", "s", 3)]
    for made in (rows, []):
        docs = spark.createDataFrame(made, schema)
        for name, function in corpus_pipeline.STAGES:
            docs = stage(spark, function(spark, docs, sf), name)
            docs.collect()


def test_run_and_names():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and [sum(bool(re.match(rf"op{n}_", x)) for x in names) for n in range(1, 11)] == [1] * 10
