import random
import re
import string
from collections import Counter

import zstandard

from spotgrid.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            len(words) < 10 or 100 * len(inside) > 20 * len(words))


CASES = [(1, None), (2, ""), (3, "a b c d e a b c d e f g"), (4, "x\x1cy\x85z\xa0w u\x0bv\x0cq"), (5, "l\n\n \nl\nl \n"), (6, "é" * 30 + " # $ | <é>"), (7, "a " * 5000),
         (7, "a " * 5000), (None, "one two three four five six seven eight nine ten eleven")]


def test_counts(documents):
    got = quality.judge_quality(documents(CASES)).collect()
    assert len(got) == len(CASES)
    for r in got:
        text = next(t for i, t in CASES if i == r.doc_id)
        assert tuple(r)[1:7] == plain(text), text
        assert not (r.base_failed and r.kept)


def test_query_counts(spark, sf, sf_docs):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    rows = queries.op3_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts) and all(tuple(r)[1:7] == plain(texts[r.doc_id]) for r in rows)


def test_bands(words):
    rng, compressor = random.Random(2), zstandard.ZstdCompressor(level=quality.LEVEL)
    fine = lambda t: quality.measure(t, compressor)[6]
    for n in (12, 60, 300, 1500, 9000):
        assert fine(" ".join(rng.choice(words) + rng.choice(words) for _ in range(n)))
    noise = "".join(chr(rng.randint(0x100, 0x2FFF)) if rng.random() < 0.9 else " " for _ in range(9000)).encode("utf-16").decode("latin-1")
    assert not fine(noise)
    line = " ".join(rng.choice(words) for _ in range(4))
    assert not fine("\n".join(f"{line} {i}" for i in range(400)))  # no five words repeat, yet it compresses too well
    half = " ".join(rng.choice(words) + rng.choice(words) for _ in range(2500))
    assert not fine(half + "\n" + "\n".join(f"{line} {i}" for i in range(1400)))


def judged(text):
    return quality.measure(text, zstandard.ZstdCompressor(level=quality.LEVEL))[6]


def test_noise_of_letters_and_digits_is_rejected():
    rng = random.Random(5)
    alphabets = {"printable": "".join(map(chr, range(33, 127))), "alphanumeric": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/"}
    for name, letters in alphabets.items():
        for n in (300, 1500, 6000, 40_000, 1_000_000):
            noise = "".join(rng.choice(letters) for _ in range(n))
            assert not judged(" ".join(noise[i : i + 7] for i in range(0, n, 7))[:n]), (name, n)


def test_repetitive_tails_are_rejected(words):
    rng = random.Random(6)
    for good, tail in ((4096, 4000), (8192, 4000), (2000, 2000), (700, 700), (40_000, 20_000)):
        prose = " ".join(rng.choice(words) + rng.choice(words) for _ in range(good)).encode()[:good].decode(errors="ignore")
        lines = "".join(f"item of the list {i}\n" for i in range(tail))[:tail]
        assert judged(prose), good
        assert judged(prose + " " + prose[:50][::-1]), good  # a short rest
        assert not judged(prose + "\n" + lines), (good, tail)


def test_long_clean_text_of_three_byte_letters_is_kept():
    """Invented words of Burmese letters, that compress about as translated messages of the script do (0.21 of 100,000 bytes)."""
    rng = random.Random(7)
    mark = lambda first, last: rng.choice(["", chr(rng.randint(first, last))])
    syllables = [chr(0x1000 + rng.randint(0, 33)) + mark(0x102B, 0x1032) + mark(0x1037, 0x103B) for _ in range(90)]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(4, 9))) for _ in range(6000)]
    for n in (3000, 20_000, 100_000, 300_000, 1_200_000):
        text = " ".join(vocabulary[int(6000 * rng.random() ** 4)] for _ in range(n // 20)).encode()[:n]
        ratio, share, fine = quality.compression(text, zstandard.ZstdCompressor(level=quality.LEVEL))
        assert fine and share < 0.1, (n, ratio, share)


def test_clean_labelled_text_is_kept(spark, sf, sf_docs):
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    rows = [r for r in quality.judge_quality(sf_docs).collect() if r.doc_id in good]
    assert rows and all(r.kept for r in rows if not r.base_failed)


def test_keep_good(documents):
    docs = documents(CASES)
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [None]
    assert quality.judge_quality(documents([])).collect() == []
