import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from spotgrid.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_same_as_the_library(coder, library):
    rng = random.Random(1)
    bits = ["a", "e", "t", "in", " ", "  ", "\n", "é", "ß", "日本", "😀", "<|endoftext|>", "<|end", "123", ".", "...", "--", "'s", "'ll", "\t", "\x00", "\x85", "\xa0", "The", "http",
            "qu", "AAAA", "ing", "tion", "st", "‍"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 90))) for _ in range(1000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 700), rng.randint(0x4E00, 0x4FFF)])) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    coded = coder.encode(texts)
    for text, got in zip(texts, coded, strict=True):
        assert got == ids(library, text), text
        assert coder.decode(got) == text == library.decode(np.frombuffer(got, "<u4").tolist(), skip_special_tokens=False)


def test_verification_accepts_exactly_the_right_proposals(coder):
    """The pair test passes a proposal if and only if merging gives it."""
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 12))).encode() for _ in range(3000)]
    for word in words:
        guess = np.array(coder.propose(word))
        passed = coder._no_conflict(guess[:-1], guess[1:]).all()
        assert passed == (guess.tolist() == coder.exact(word))
    assert coder.exact_many(words) == [coder.exact(w) for w in words]


def test_long_words_and_a_small_cache(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    texts = ["ab" * 4000, "x" * 3000 + " " * 3000, "word " * 5000, *[f"w{i} v{i}" for i in range(300)]]
    for i in range(0, len(texts), 7):
        assert coder.encode(texts[i : i + 7]) == [ids(library, t) for t in texts[i : i + 7]]


def test_workers_free_the_vocabulary_with_the_task(spark, documents):
    """The next stage's tasks run in the same workers and need the memory."""
    bpe.encode_texts(documents([(i, f"text {i}") for i in range(8)]), PATH).collect()

    def held(batches):
        import gc

        for batch in batches:
            n = sum(type(x).__name__ == "Bpe" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int64())], names=["held"])

    assert {r.held for r in spark.range(0, 64, 1, 16).mapInArrow(held, "held long").collect()} == {0}


def test_rows(spark, documents, library):
    rows = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (None, "<|endoftext|>"), (4, "é" * 70_000)]
    got = bpe.encode_texts(documents(rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r.doc_id) or ""
        assert bytes(r.ids) == ids(library, text) and r.decoded == text and r.n_tokens * 4 == len(r.ids)
    assert bpe.encode_texts(documents([]), PATH).collect() == []


def test_query(spark, sf, sf_docs, library):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    rows = queries.op8_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = ids(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want) // 4, sha256(want).hexdigest(), sha256(texts[r.doc_id].encode()).hexdigest())
