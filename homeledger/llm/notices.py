"""License notices in texts: exact phrases, and short notices with a few wrong letters.

A text is lower-cased (A-Z) and cut into words of letters, digits and anything beyond ASCII; it is searched
as its words joined by single spaces. Phrases are found exactly, at every place.

A notice of n letters may hold up to k errors (letters missing, added or changed, spaces too). Cut
into k + 1 parts, at least one part stands unchanged (pigeonhole), so the parts of all notices are
sought at once by one Aho-Corasick automaton; each hit gives a window in which the ``regex``
library's bounded-error matching confirms the notice between word borders and counts its errors. Windows of
one notice that touch are searched once. Matches without the notice's ``fixed`` word unchanged do not
count: one wrong letter turns "mit" into other words.

Of matches of a label that overlap, those with fewest errors stay, leftmost first. The likeness of a span is
1 minus errors over letters; a text's score is its highest, 1 where a phrase stands exactly, 0
without any. Null and empty texts have no words. Repeated rows are documents of their own. Other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from homeledger.llm.common import ddl


class Notice(NamedTuple):
    label: str
    text: str
    errors: int
    fixed: str = ""


# --- fixed values: exact phrases by label, and wordings of public licenses ---
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
NOTICES = (
    Notice("mit", "mit license", 1, "mit"),
    Notice("mit", "permission is hereby granted free of charge", 3),
    Notice("mit", "the software is provided as is without warranty", 3),
    Notice("apache", "apache license", 2),
    Notice("apache", "licensed under apache", 2, "apache"),
    Notice("gpl", "general public license", 3),
    Notice("gpl", "gnu general public", 2),
    Notice("lgpl", "lesser general public license", 3),
    Notice("agpl", "affero general public license", 3),
    Notice("mpl", "mozilla public license", 3),
    Notice("epl", "eclipse public license", 3),
    Notice("bsd", "bsd license", 1, "bsd"),
    Notice("bsd", "redistribution and use in source and binary forms", 3),
    Notice("isc", "isc license", 1, "isc"),
    Notice("cc", "creative commons attribution", 3),
    Notice("cc", "licensed under cc by", 2, "cc by"),
    Notice("boost", "boost software license", 3),
    Notice("artistic", "the artistic license", 2, "artistic"),
    Notice("unlicense", "free and unencumbered software", 3),
    Notice("public-domain", "released into the public domain", 3),
)
# --- end of fixed values ---

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_text(text: str | None) -> str:
    """The words joined by spaces, with a space at either end; one space for no words."""
    # ASCII characters are single bytes in UTF-8 and in no other character
    words = (text or "").encode("utf-8").translate(_WORD_BYTES).split()
    return f" {b' '.join(words).decode()} " if words else " "


def parts_of(notice: Notice) -> list[tuple[int, str]]:
    """``errors`` + 1 parts of nearly equal length and where they begin."""
    n, k = len(notice.text), notice.errors + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    """Searches word texts for phrases and notices."""

    def __init__(self, phrases: dict[str, str], notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.phrases, self.notices = phrases, notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for at, part in parts_of(notice):
                seeds.setdefault(part, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for part, uses in seeds.items():
            self.seeds.add_word(part, (len(part), uses))
        self.seeds.make_automaton()
        # a pattern per number of errors: the library reports a match, not always the one with fewest
        self.patterns = [[
            regex.compile(f"(?<= )(?:{regex.escape(n.text, literal_spaces=True)}){{e<={k}}}(?= )") for k in range(n.errors + 1)]
            for n in notices]

    def exact(self, text: str) -> list[tuple[int, str]]:
        """(position, label) of every place of a phrase."""
        found = []
        for label, phrase in self.phrases.items():
            at = text.find(f" {phrase} ")
            while at >= 0:
                found.append((at + 1, label))
                at = text.find(f" {phrase} ", at + 1)
        return sorted(found)

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """By notice, the places where it may stand: [start, end) with room for its errors."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for i, offset in uses:
                notice = self.notices[i]
                first = end + 1 - size - offset
                # one more character on either side is the border
                window = [max(0, first - notice.errors - 1), min(len(text), first + len(notice.text) + notice.errors + 1)]
                mine = found.setdefault(i, [])
                if mine and window[0] <= mine[-1][1]:
                    mine[-1][1] = max(mine[-1][1], window[1])
                    mine[-1][0] = min(mine[-1][0], window[0])
                else:
                    mine.append(window)
        return found

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, errors, letters of the notice) of every match."""
        found = []
        for i, places in self.windows(text).items():
            notice = self.notices[i]
            for a, b in places:
                near = text[a:b]
                for pattern in self.patterns[i]:
                    for m in pattern.finditer(near, overlapped=True):
                        if notice.fixed and f" {notice.fixed} " not in f" {m[0]} ":
                            continue
                        found.append((a + m.start(), a + m.end(), notice.label, sum(m.fuzzy_counts), len(notice.text)))
        return found


@lru_cache(maxsize=8)
def matcher(phrases: tuple[tuple[str, str], ...], notices: tuple[Notice, ...]) -> Matcher:
    """One automaton per worker."""
    return Matcher(dict(phrases), notices)


class Span(NamedTuple):
    label: str
    start: int  # number of its first word
    end: int  # after its last word
    errors: int
    likeness: float
    matched: str


def best_spans(matches: list[tuple[int, int, str, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """Of matches of a label that overlap, the one with fewest errors, then the longest, then the first."""
    taken: dict[str, list[tuple[int, int]]] = {}
    out = []
    for m in sorted(matches, key=lambda m: (m[3], m[0] - m[1], m[0])):
        mine = taken.setdefault(m[2], [])  # disjoint, by start
        i = bisect.bisect(mine, (m[0], m[1]))
        if (not i or mine[i - 1][1] <= m[0]) and (i == len(mine) or mine[i][0] >= m[1]):
            mine.insert(i, (m[0], m[1]))
            out.append(m)
    return out


def scan_text(text: str | None, search: Matcher) -> tuple[int, list[tuple[str, int]], list[Span]]:
    """Number of words, places of phrases as (label, word), and spans of notices."""
    joined = word_text(text)
    exact = search.exact(joined)
    fuzzy = sorted(best_spans(search.fuzzy(joined)))
    number, at, numbers = -1, 0, {}
    for p in sorted({p for p, _ in exact} | {m[0] for m in fuzzy}):
        number, at = number + joined.count(" ", at, p), p
        numbers[p] = number
    spans = [Span(label, numbers[a], numbers[a] + joined.count(" ", a, b) + 1, errors, 1 - errors / letters, joined[a:b])
             for a, b, label, errors, letters in fuzzy]
    return max(0, joined.count(" ") - 1), [(label, numbers[p]) for p, label in exact], spans


SPAN_TYPE = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int64()),
                       ("likeness", pa.float64()), ("matched", pa.string())])


def scan_notices(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
                 notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(key, n_words, places, spans, score): ``places`` are (label, word) of exact phrases, ``spans`` the notices
    with their word range, errors, likeness and matched words."""
    given = tuple(phrases.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = matcher(given, notices)
        for batch in batches:
            rows = [scan_text(t, search) for t in batch.column(1).to_pylist()]
            places = [[{"label": label, "word": w} for label, w in exact] for _, exact, _ in rows]
            spans = [[s._asdict() for s in found] for _, _, found in rows]
            score = [1.0 if exact else max((s.likeness for s in found), default=0.0) for _, exact, found in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in rows], pa.int64()),
                 pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                 pa.array(spans, pa.list_(SPAN_TYPE)), pa.array(score, pa.float64())],
                names=[key, "n_words", "places", "spans", "score"])

    span = "struct<label: string, start: bigint, end: bigint, errors: bigint, likeness: double, matched: string>"
    return docs.select(key, text).mapInArrow(
        run, f"{ddl(docs, key)}, n_words bigint, places array<struct<label: string, word: bigint>>, spans array<{span}>, score double")
