r"""Quality rules by compression bands.

A text is compressed by zstandard as a whole and in fixed chunks. Repetitive text compresses too well and random text
too badly; what is too well or too badly depends on the length, since short texts have no past to refer to. So the
limits are bands by length. A text is rejected if its ratio lies outside its band, or if more than ``MOST_BAD_CHUNKS``
of its chunks lie outside the band of a chunk. Short texts have smaller chunks; a last one that overlaps covers the rest.

The counts that come with the verdict are plain: words are runs without ``\x20`` and ``\x09`` to ``\x0D``, lines are
parted by ``\n``. Two words, or two windows of five words, are the same if their 64-bit hashes are.

Defined cases: null text is empty; it has no words and is rejected as too short. Repeated rows give repeated results;
an empty table gives none; columns other than key and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from spotgrid.llm.batches import Field, chunks, map_batches, map_text

LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
#: (bytes from, chunk) of a text; shorter ones are judged as a whole only.
CHUNKS = ((16384, 4096), (4096, 1024), (1024, 512), (512, 256))
MOST_BAD_CHUNKS = 0.3
#: (bytes, lowest ratio, highest ratio, highest ratio of ASCII) of compressed to plain size, straight in the logarithm of the bytes between two rows.
#: The highest lie just above what translated messages in all scripts of /usr/share/locale reach (Chinese and Czech the most); text that is
#: nearly all ASCII reaches less. The lowest lie below what scripts of three-byte letters (Burmese, Khmer, Dzongkha) reach. Shorter texts have no band.
BANDS = (
    (128, 0.40, 1.10, 1.10), (192, 0.37, 1.07, 0.97), (256, 0.35, 1.02, 0.885), (384, 0.33, 0.97, 0.845), (512, 0.32, 0.91, 0.79), (1024, 0.30, 0.80, 0.72),
    (2048, 0.28, 0.72, 0.65), (4096, 0.255, 0.66, 0.61), (8192, 0.235, 0.62, 0.58), (16384, 0.21, 0.59, 0.55), (32768, 0.19, 0.57, 0.52), (65536, 0.18, 0.55, 0.50),
    (131072, 0.17, 0.55, 0.50), (262144, 0.16, 0.55, 0.50), (1048576, 0.14, 0.55, 0.50),
)
#: Text counts as ASCII if so many percent of its bytes begin a code point.
ASCII_PERCENT = 98

FIELDS: list[Field] = [
    ("n_words", "long", pa.int64()), ("word_chars", "long", pa.int64()), ("n_symbols", "long", pa.int64()), ("n_dup_lines", "long", pa.int64()),
    ("n_repeat_words", "long", pa.int64()), ("base_failed", "boolean", pa.bool_()), ("kept", "boolean", pa.bool_()),
    ("ratio", "double", pa.float64()), ("bad_chunks", "double", pa.float64()),
]
_CONTINUED = bytes(range(0x80, 0xC0))
_BYTES, _LOWEST, _HIGHEST, _HIGHEST_ASCII = (np.array(x) for x in zip(*BANDS, strict=True))
_LOGS = np.log2(_BYTES)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words inside five-word windows that stand twice or more in the text, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code ^= code >> np.uint64(29)
    key = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        key += code[i : i + n] * _MIX[i]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.isin(key, twice))
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def in_band(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, bool]:
    """Ratio of compressed to plain size, and whether it lies in the band of the length."""
    n = len(data)
    ratio = len(compressor.compress(data)) / n
    if n < BANDS[0][0]:
        return ratio, True
    ascii = 100 * len(data.translate(None, _CONTINUED)) >= ASCII_PERCENT * n
    low, high = (float(np.interp(math.log2(n), _LOGS, x)) for x in (_LOWEST, _HIGHEST_ASCII if ascii else _HIGHEST))
    return ratio, low <= ratio <= high


def compression(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its chunks that are outside their band, and the verdict."""
    if not data:
        return 1.0, 0.0, True
    ratio, fine = in_band(data, compressor)
    size = next((size for least, size in CHUNKS if len(data) >= least), 0)
    # What full chunks leave over is judged with bytes before it, as a chunk of the same size.
    starts = [*range(0, len(data) - size + 1, size), *([len(data) - size] if len(data) % size else [])] if size else []
    bad, n = sum(not in_band(data[i : i + size], compressor)[1] for i in starts), len(starts)
    share = bad / n if n else 0.0
    return ratio, share, fine and share <= MOST_BAD_CHUNKS


def measure(text: str, compressor: zstandard.ZstdCompressor) -> tuple:
    data = text.encode()
    words = data.split()  # bytes.split() parts at \x20 and \x09 to \x0D only
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = repeat_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEAT_PERCENT * len(words)
    ratio, bad, fine = compression(data, compressor)
    word_chars = len(text) - (len(data) - sum(map(len, words)))
    return (len(words), word_chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed,
            fine and not failed, ratio, bad)


def judge_quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, the counts, base_failed, kept, the whole text's ratio and the share of bad chunks."""
    def make():
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        return lambda t: measure(t, compressor)

    return map_text(docs, key, text, FIELDS, make)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            kept = [measure(t, compressor)[6] for texts in chunks(batch.column(at)) for t in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, run, docs.schema)
