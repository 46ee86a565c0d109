"""URL filter: host and path rules first, then a weighted vocabulary.

An Aho-Corasick automaton finds strict and soft terms in one pass over a url. A hit counts only where neither the
character before nor the one after is an ASCII letter or digit, so that terms inside longer words do not count. One
strict term, or several distinct soft terms, reject the url.

Defined cases: a null url, or one without "://", has an empty host and path, matches no rule, and is judged by its
terms alone (null has none and is allowed). Repeated rows give repeated results; an empty table gives none; columns other
than key and url are ignored. Of rules of one length that fit, which can only be one rule twice, the first counts. The work for
a url grows with its length, however many labels its host has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed rules: (host, path, verdict).
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Fixed vocabulary. Strict terms reject alone; soft terms need company.
STRICT = ("adult-x", "cheap-pills", "escorts", "porn", "spam-farm", "viagra", "xxx")
SOFT = ("ads", "adult", "bet", "bets", "casino", "cheap", "click", "farm", "free", "loan", "pills", "poker", "spam", "track", "win")
LEAST_SOFT = 2

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class UrlRules:
    rules: tuple[tuple[str, str, str], ...] = RULES
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    least_soft: int = LEAST_SOFT


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = min((i for i in (rest.find(c, end) for c in "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:tail]


class _Judge:
    def __init__(self, config: UrlRules):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in config.rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        self.most_labels = max((host.count(".") + 1 for host in self.by_host), default=0)
        self.least_soft, self.automaton = config.least_soft, ahocorasick.Automaton()
        for term in {*config.strict, *config.soft}:
            self.automaton.add_word(term, (term, term in config.strict))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        # No rule has more labels, so longer ends of the host needn't be tried.
        labels = host.rsplit(".", self.most_labels)[-self.most_labels :] if self.most_labels else []
        for size in range(len(labels), 0, -1):
            host = ".".join(labels[-size:])
            for start, verdict in self.by_host.get(host, ()):
                if path.startswith(start) and len(host + start) > len(best[0] or ""):
                    best = (host + start, verdict)
        return best

    def hits(self, url: str) -> tuple[int, int]:
        """Distinct strict and soft terms."""
        low, found = url.translate(_LOWER), set()
        for end, (term, strict) in self.automaton.iter(low):
            start = end + 1 - len(term)
            if (start == 0 or low[start - 1] not in _WORD) and (end + 1 == len(low) or low[end + 1] not in _WORD):
                found.add((term, strict))
        strict = sum(s for _, s in found)
        return strict, len(found) - strict

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = split_url(url)
        rule, verdict = self.rule(host, path)
        strict, soft = self.hits(url or "")
        return host, path, rule, verdict or ("block" if strict or soft >= self.least_soft else "allow"), strict, soft


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", config: UrlRules = UrlRules()) -> DataFrame:
    """One row per page: key, host, path, the rule that fits best or null, verdict, and distinct strict and soft terms."""
    rows = pages.select(key, url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(config)
        for batch in batches:
            found = list(zip(*map(judge, batch.column(1).to_pylist()), strict=True)) or [()] * 6
            types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(list(c), t) for c, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "host", "path", "rule", "verdict", "strict_terms", "soft_terms"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string, strict_terms long, soft_terms long")
