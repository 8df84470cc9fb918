"""URL filter: host and path rules, then a weighted vocabulary found by Aho-Corasick.

A rule names a host and the start of a path; it fits the host itself and all its
subdomains.  Of the rules that fit, the one with the longest host and path wins
(of two as long, the one with the longer host) and gives the verdict.

All other URLs are judged by their words.  One Aho-Corasick automaton finds every
term of the vocabulary in the whole URL (A-Z lower-cased) in one pass.  A hit
counts only between boundaries: neither neighbour is a letter or a digit, so
``win`` counts in ``casino-win.example`` and not in ``window``.  A term whose
weight reaches ``limit`` is strict and blocks alone; the others are soft, and
block when the weights of the *distinct* soft terms hit reach ``limit``
together, which takes two of them at least.

Rules and vocabulary are parameters; the automaton is built once in a Python
worker.  URLs are judged where they are scanned: no shuffle, and only the URL
goes to Python.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits
no rule and is judged by its words (null: none); an empty path fits no rule that
asks for ``/``; hosts keep a port or user name if they have one; repeated rows
are judged each on their own; extra columns are kept, those with the name of an
output (in any case) are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import LOWER, UPPER, columns_but, python_ready

#: (verdict, host, start of the path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Weight at which a URL is blocked.
LIMIT = 4

# --- fixed values: the vocabulary, by weight ---------------------------------
_WORDS = {
    4: "camgirl camgirls casino casinos cialis hentai keygen milf phishing porn porno pornhub viagra warez xvideos xxx",
    3: "bet bets betting escort escorts gambling jackpot nude nudes poker roulette sex sexy slots",
    2: "ad adserver ads adult adults banner clickbait crack cracked doubleclick popup torrent torrents track tracker tracking",
    1: "bonus cam cams cheap deal deals earn free girls hot money pills promo win winner",
}
# -----------------------------------------------------------------------------
VOCABULARY = {term: weight for weight, terms in _WORDS.items() for term in terms.split()}

OUTPUT = "host string, path string, rule string, verdict string, strict_hits long, soft_terms array<string>, weight long"
_COLUMNS = tuple(part.split()[0] for part in OUTPUT.split(", "))
_AFTER = re.compile(r"([^/?#]*)([^?#]*)")
_LOW = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty where there is no ``://``."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    host, path = _AFTER.match(url, at + 3).groups()
    return host.translate(_LOW), path


class Judge:
    """Rules by host and the automaton of the vocabulary."""

    def __init__(self, rules: Iterable[tuple[str, str, str]], vocabulary: Mapping[str, int], limit: int):
        self.limit, self.by_host = limit, {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block") or not host:
                raise ValueError(f"a rule is allow or block and has a host: {(verdict, host, path)}")
            paths = self.by_host.setdefault(host.translate(_LOW), {})
            if paths.setdefault(path, verdict) != verdict:
                raise ValueError(f"two rules for {host}{path} differ")
        self.longest = max(map(len, self.by_host), default=0)
        self.automaton = ahocorasick.Automaton()
        for term, weight in vocabulary.items():
            if not term or weight <= 0:
                raise ValueError(f"a term is not empty and has a positive weight: {term!r}")
            term = term.translate(_LOW)
            self.automaton.add_word(term, (term, weight))
        if vocabulary:
            self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best, at = None, max(0, len(host) - self.longest - 1)  # no rule is for a longer ending
        ends = [0] if at == 0 else []
        while (at := host.find(".", at)) >= 0:
            ends.append(at := at + 1)
        for end in ends:
            for start, verdict in self.by_host.get(host[end:], {}).items():
                size = (len(host) - end + len(start), len(host) - end)
                if path.startswith(start) and (best is None or size > best[0]):
                    best = size, host[end:] + start, verdict
        return best and best[1:]

    def words(self, url: str) -> tuple[int, list[str], int]:
        """(hits of strict terms, distinct soft terms, weight of the distinct terms)."""
        text, strict, found = url.translate(_LOW), 0, {}
        if len(self.automaton) == 0:
            return 0, [], 0
        for last, (term, weight) in self.automaton.iter(text):
            first = last - len(term) + 1
            if (first and text[first - 1].isalnum()) or (last + 1 < len(text) and text[last + 1].isalnum()):
                continue
            found[term] = weight
            strict += weight >= self.limit
        return strict, sorted(t for t, w in found.items() if w < self.limit), sum(found.values())

    def __call__(self, url: str | None) -> tuple:
        host, path = split_url(url)
        strict, soft, weight = self.words(url or "")
        ruled = self.rule(host, path)
        rule, verdict = ruled or (None, "block" if weight >= self.limit else "allow")
        return host, path, rule, verdict, strict, soft, weight


_WORKER: dict[str, Judge] = {}


def judge_urls(
    pages: DataFrame,
    *,
    url: str = "url",
    rules: Iterable[tuple[str, str, str]] = RULES,
    vocabulary: Mapping[str, int] = VOCABULARY,
    limit: int = LIMIT,
) -> DataFrame:
    """``pages`` plus host, path, rule (null: none fits), verdict (allow or
    block), strict_hits, soft_terms (distinct, sorted) and weight."""
    python_ready(pages.sparkSession)
    rules, vocabulary, token = tuple(rules), dict(vocabulary), uuid.uuid4().hex
    Judge(rules, vocabulary, limit)  # wrong parameters fail here, not in a task

    @F.pandas_udf(OUTPUT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        if token not in _WORKER:
            _WORKER.clear()
            _WORKER[token] = Judge(rules, vocabulary, limit)
        return pd.DataFrame([_WORKER[token](u) for u in urls], columns=list(_COLUMNS), dtype=object)

    judged = pages.withColumn("__ll_judged", judge(F.col(url)))
    return judged.select(*columns_but(pages, _COLUMNS), *(F.col(f"__ll_judged.{c}").alias(c) for c in _COLUMNS))
