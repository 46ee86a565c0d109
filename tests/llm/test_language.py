import zlib

import numpy as np

from spotgrid.llm import language, queries


def test_held_out_accuracy(spark, sf_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = queries.op4_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r for r in held if truth[r.doc_id] and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in judged]) > 0.97
    accepted = [r for r in judged if r.accepted]
    assert len(accepted) > 0.8 * len(judged) and np.mean([r.lang_pred == truth[r.doc_id] for r in accepted]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows} <= {*truth.values(), "und"}


def test_learns_from_its_folds_only(spark, documents):
    """Documents of the held-out fold, or without a language, leave no trace in the model."""
    rows = [(i, f"text {chr(97 + i % 5) * 3} {i}", "en" if i % 2 else "fr", None, 1) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    changed = [(i, t, lang, s, n) if zlib.crc32(str(i).encode()) % 5 else (i, "xyz", "tlh", s, n) for i, t, lang, s, n in rows]
    other = spark.createDataFrame([*changed, (None, "q", "la", None, 1), (7000, "q", None, None, 1)], frame.schema)
    a, b = language.train(frame), language.train(other)
    assert a.languages == b.languages == ("en", "fr") and np.array_equal(a.scores, b.scores)


def test_the_sample_of_a_large_language_is_no_smaller():
    for rows in (10, 3_000, 10**6, 10**10, 10**13):
        share = language.sampling_bound(750, rows) / 2**language.HASH_BITS
        assert abs(share * rows - min(750, rows)) < 1e-3 * min(750, rows)


def test_scores_of_long_texts_are_sums_over_their_subwords():
    rng = np.random.default_rng(1)
    model = language.LanguageModel(("a", "b", "c"), rng.normal(size=(language.BUCKETS, 3)).astype(np.float32), rng.normal(size=3), 1.0, 0.5)
    for text in ("short text", "longer words here " * 20_000):
        buckets = np.concatenate(list(language.subwords(text)))
        assert np.allclose(model.logits(text), model.scores[buckets].astype(np.float64).mean(0) + model.bias)


def test_cases(spark, documents):
    model = language.LanguageModel(("de", "en"), np.zeros((language.BUCKETS, 2), np.float32), np.zeros(2), 1.0, 0.9)
    rows = [(1, None), (2, ""), (3, "12 34 !"), (4, "é"), (5, "word " * 300_000), (4, "é")]
    got = language.identify(spark, documents(rows), model).collect()
    assert sorted((r.doc_id, r.lang_pred, r.score, r.accepted) for r in got) == [
        (1, "und", 0.0, False), (2, "und", 0.0, False), (3, "und", 0.0, False), (4, "de", 0.5, False), (4, "de", 0.5, False), (5, "de", 0.5, False)]
    untrained = language.train(documents([(1, "no language")]))
    assert [r.lang_pred for r in language.identify(spark, documents([(1, "text")]), untrained).collect()] == ["und"]


def test_subwords_by_definition(monkeypatch):
    def plain(text):
        data, found = [language._FOLD[b] for b in b" " + text.encode() + b" "], []
        for size in (2, 3, 4):
            for i in range(len(data) - size + 1):
                run = data[i : i + size]
                if all(b != 32 for b in run[1:-1]) and not (size == 2 and run[0] == run[1] == 32):
                    code = sum(int(b) << 8 * j for j, b in enumerate(run))
                    found.append((code * 2654435761 + size * 0x9E3779B1) % 2**32 >> 16)
        return sorted(found)

    text = "Hello, wörld  a b!c" * 40
    assert sorted(np.concatenate(list(language.subwords(text))).tolist()) == plain(text)
    monkeypatch.setattr(language, "SEGMENT", 100)
    assert sorted(np.concatenate(list(language.subwords(text))).tolist()) == plain(text)
