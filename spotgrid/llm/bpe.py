"""Byte-level BPE by speculation and verification.

A word is first cut greedily into the longest tokens. That guess is the BPE result exactly if every token encodes to
itself and every two neighbours are compatible, that is, if no merge across their border would have come before the
merges that made them. Compatibility is tested for all distinct neighbouring pairs of a batch at once, with arrays:
both tokens are taken apart, last merge first, and at every stage the pair of pieces that face each other must not be a
merge of lower rank. Only words with a failing pair are merged step by step.

Words that a task has seen are kept (up to twice ``CACHE`` of them), so most words are one lookup. Words and vocabulary
go with the task: the worker's next task may be of another operator, and needs the memory.

Defined cases: null text is empty and has no tokens; the text of an added token (``<|endoftext|>``) becomes that token,
as the library does; very long texts and words are encoded whole; repeated rows give repeated results.
The vocabulary file is read on the driver and sent to the tasks; its path is a parameter.
"""

from __future__ import annotations

import json
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from spotgrid.llm.batches import Field, map_texts

CACHE = 250_000
#: Failing words of at most so many bytes are merged together, others one by one; words merged at a time, and of like length.
SHORT = 48
BLOCK = 20_000
GROUP = 2_000
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@cache
def byte_alphabet() -> dict[str, int]:
    """The characters that vocabulary files write for bytes: printable Latin-1 bytes as themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b > 32 and b not in (0x7F, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """``spec`` is the text of a byte-level BPE file of the tokenizers library."""

    def __init__(self, spec: str):
        model, alphabet = json.loads(spec), byte_alphabet()
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in vocabulary.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in merges]
        size = max(self.bytes_of) + 1
        self.base = [self.id_of[bytes([b])] for b in range(256)]
        #: (left, right) -> (rank, merged); left, right and rank of the merge that makes a token; itself and -1 for a byte.
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.left, self.right, self.rank = np.arange(size), np.arange(size), np.full(size, -1)
        for rank, (a, b) in enumerate(pairs):
            left, right, both = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.merge.setdefault((left, right), (rank, both))
            if self.rank[both] < 0:
                self.left[both], self.right[both], self.rank[both] = left, right, rank
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.merged = np.zeros(len(pairs), np.int64)
        for rank, both in self.merge.values():
            self.merged[rank] = both
        self.size, self.keys, self.ranks = size, keys[order], np.array([r for r, _ in self.merge.values()])[order]
        # A token may be proposed only if it encodes to itself: its two halves do, and they don't conflict.
        made = np.flatnonzero(self.rank >= 0)
        self.sound = np.ones(size, bool)
        self.sound[made] = self._no_conflict(self.left[made], self.right[made], self.rank[made])
        for token in made[np.argsort(self.rank[made])]:
            self.sound[token] &= self.sound[self.left[token]] and self.sound[self.right[token]]
        self.by_length: dict[int, dict[bytes, int]] = {}
        for token, data in self.bytes_of.items():
            if self.sound[token]:
                self.by_length.setdefault(len(data), {})[data] = token
        self.longest = max(self.by_length)
        self.proposals = {data: token for group in self.by_length.values() for data, token in group.items()}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or a number above all ranks."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], np.iinfo(np.int64).max)

    def _no_conflict(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether two tokens that stand side by side stay as they are.

        Backwards in time: the merge of higher rank was the later one, so its token is taken apart first. Until then the
        faces of the two pieces stood side by side, and would have merged if their merge ranked lower than the next to
        come. ``before``: only merges of lower rank than this count, as for the halves of a token.
        """
        left, right, fine = left.copy(), right.copy(), np.ones(len(left), bool)
        limit = np.full(len(left), np.iinfo(np.int64).max) if before is None else before.copy()
        at = np.arange(len(left))
        while len(at):
            a, b, until = left[at], right[at], limit[at]
            clash = self._pair_rank(a, b)
            # A merge across the border that ties with the left token's next merge comes later in the word, so it waits.
            bad = clash < until
            fine[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            going = ~bad & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[going], a[going], b[going], ra[going], rb[going]
            # The later merge is undone: of equal ones the right token's, since merges of one rank go from left to right.
            undo_left = ra > rb
            left[at] = np.where(undo_left, self.right[a], a)
            right[at] = np.where(undo_left, b, self.left[b])
            # Across the border a merge of the same rank as the right token's stands left of it and would come first.
            limit[at] = np.where(undo_left, ra, rb + 1)
        return fine

    def exact(self, word: bytes) -> list[int]:
        """Merge by merge, lowest rank first, leftmost first."""
        token = [self.base[b] for b in word]
        after, before, alive = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1)), [True] * len(token)
        queue = [(m[0], i, token[i], token[i + 1], m[1]) for i in range(len(token) - 1) if (m := self.merge.get((token[i], token[i + 1])))]
        heapify(queue)
        while queue:
            _, i, a, b, both = heappop(queue)
            j = after[i]
            if not alive[i] or token[i] != a or j >= len(token) or token[j] != b:
                continue
            token[i], alive[j], after[i] = both, False, after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(token) and (m := self.merge.get((token[left], token[right]))):
                    heappush(queue, (m[0], left, token[left], token[right], m[1]))
        return [t for t, on in zip(token, alive, strict=True) if on]

    def propose(self, word: bytes) -> list[int]:
        """Longest tokens, from the left."""
        whole = self.proposals.get(word)
        if whole is not None:
            return [whole]
        found, at, n = [], 0, len(word)
        while at < n:
            for stop in range(min(n, at + self.longest), at, -1):
                token = self.proposals.get(word[at:stop])
                if token is not None:
                    found.append(token)
                    at = stop
                    break
        return found

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Propose all, test all distinct neighbouring pairs at once, merge the failing words exactly."""
        guesses = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((t for g in guesses for t in g), np.int64, int(sizes.sum()))
        if len(flat) < 2:
            return guesses
        owner = np.repeat(np.arange(len(guesses)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs, which = np.unique(flat[:-1][inside] * self.size + flat[1:][inside], return_inverse=True)
        fine = self._no_conflict(pairs // self.size, pairs % self.size)
        failed = np.unique(owner[1:][inside][~fine[which]]).tolist()
        short = [i for i in failed if len(words[i]) <= SHORT]
        for step in range(0, len(short), BLOCK):
            part = short[step : step + BLOCK]
            for i, ids in zip(part, self.exact_many([words[i] for i in part]), strict=True):
                guesses[i] = ids
        for i in failed:
            if len(words[i]) > SHORT:
                guesses[i] = self.exact(words[i])
        return guesses

    def exact_many(self, words: list[bytes]) -> list[list[int]]:
        """``exact`` for short words, one merge of every word at a time."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        found: list[list[int]] = [[]] * len(words)
        for step in range(0, len(order), GROUP):  # of like lengths
            group = order[step : step + GROUP]
            for i, ids in zip(group, self._merged([words[i] for i in group]), strict=True):
                found[i] = ids
        return found

    def _merged(self, words: list[bytes]) -> list[list[int]]:
        sizes, width = np.array([len(w) for w in words]), max(map(len, words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        token = np.where(np.arange(width) < sizes[:, None], np.array(self.base)[raw], -1)
        never = np.iinfo(np.int64).max
        rank = np.where(token[:, 1:] >= 0, self._pair_rank(token[:, :-1], token[:, 1:]), never)
        rows = np.arange(len(words))
        while rank.shape[1] and len(rows):
            at = rank[rows].argmin(1)
            low = rank[rows, at]
            rows, at, low = rows[low < never], at[low < never], low[low < never]
            # The pair becomes one token; what stands right of it moves one to the left.
            token[rows, at] = self.merged[low]
            columns = np.arange(width - 1)
            moved = columns + (columns > at[:, None])
            token[rows, :-1] = np.take_along_axis(token[rows], moved, 1)
            token[rows, -1] = -1
            rank[rows, :-1] = np.take_along_axis(rank[rows], moved[:, :-1], 1)
            rank[rows, -1] = never
            for near in (at - 1, at):
                inside = (near >= 0) & (near < width - 1)
                r, c = rows[inside], near[inside]
                left, right = token[r, c], token[r, c + 1]
                rank[r, c] = np.where((left >= 0) & (right >= 0), self._pair_rank(left, right), never)
        return [t[: (t >= 0).sum()].tolist() for t in token]

    def _learn(self, pieces: set[str]) -> None:
        """Make sure that all pieces are in ``words``. Words not met for a while are dropped with the older half."""
        if len(self.words) + len(pieces) > CACHE:
            self.older, self.words = self.words, {}
        new = []
        for piece in pieces:
            if piece not in self.words:
                ids = self.older.get(piece)
                if ids is None:
                    new.append(piece)
                else:
                    self.words[piece] = ids
        for piece, ids in zip(new, self.encode_words([p.encode() for p in new]), strict=True):
            self.words[piece] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [[PIECES.findall(part) if i % 2 == 0 else part for i, part in enumerate(self._parts(t))] for t in texts]
        self._learn({piece for parts in cut for words in parts[::2] for piece in words})
        out = []
        for parts in cut:
            coded = [b"".join(map(self.words.__getitem__, part)) if i % 2 == 0 else np.array(self.added[part], "<u4").tobytes() for i, part in enumerate(parts)]
            out.append(b"".join(coded))
        return out

    def _parts(self, text: str) -> list[str]:
        """Plain text and added tokens by turns."""
        return self.added_pattern.split(text) if self.added_pattern else [text]

    def decode(self, ids: bytes) -> str:
        table = self.table
        return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")

    @property
    def table(self) -> dict[int, bytes]:
        if "_table" not in self.__dict__:
            self._table = self.bytes_of | {i: t.encode() for t, i in self.added.items()}
        return self._table


FIELDS: list[Field] = [("n_tokens", "long", pa.int64()), ("ids", "binary", pa.binary()), ("decoded", "string", pa.string())]


def encode_texts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_tokens, ids (little-endian unsigned 32-bit integers) and the text decoded from them."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def make():
        bpe = Bpe(spec.value)

        return lambda texts: [(len(ids) // 4, ids, bpe.decode(ids)) for ids in bpe.encode(texts)]

    return map_texts(docs, key, text, FIELDS, make)
