"""License scans: ordered signature rules with keyword prefilter, priorities and containment suppression.

A rule is a label, a priority, a confidence, keywords and a pattern. Its pattern is tried only on texts that hold
all keywords as words. Of overlapping detections, one that lies inside an accepted one of the same or higher priority is
suppressed. Texts are read as bytes with A-Z in lower case; a word is a run of digits, letters a-z and bytes of
characters beyond ASCII.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_bytes, small_batches

_IN = rb"[0-9a-z\x80-\xff]"
_OUT = rb"[^0-9a-z\x80-\xff]"
#: Between two words of a signature: any run of punctuation, spaces, line breaks and comment marks. A word follows, so
#: nothing is ever given back. The second one holds no end of a sentence.
_GAP = _OUT + rb"++"
_INNER = rb"(?:(?![.!?](?:\s|\Z))" + _OUT + rb")++"

# The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License families. Label; names as they stand in prose; versions, the empty one for none.
FAMILIES = (
    ("apache", ("apache license", "apache software license"), ("2.0", "1.1", "1.0", "")),
    ("gpl", ("gnu general public license", "gnu gpl", "gpl"), ("3.0", "2.0", "1.0", "")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("3.0", "2.1", "2.0", "")),
    ("agpl", ("gnu affero general public license", "gnu agpl", "agpl"), ("3.0", "1.0", "")),
    ("gfdl", ("gnu free documentation license",), ("1.3", "1.2", "1.1", "")),
    ("mit", ("mit license", "expat license", "x11 license"), ("",)),
    ("bsd-2-clause", ("simplified bsd license", "bsd 2 clause license", "freebsd license"), ("",)),
    ("bsd-3-clause", ("new bsd license", "modified bsd license", "bsd 3 clause license", "revised bsd license"), ("",)),
    ("bsd", ("bsd license", "berkeley software distribution license"), ("",)),
    ("isc", ("isc license", "internet systems consortium license"), ("",)),
    ("zlib", ("zlib license", "zlib libpng license"), ("",)),
    ("mpl", ("mozilla public license",), ("2.0", "1.1", "1.0", "")),
    ("epl", ("eclipse public license",), ("2.0", "1.0", "")),
    ("cddl", ("common development and distribution license",), ("1.1", "1.0", "")),
    ("cpl", ("common public license",), ("1.0", "")),
    ("eupl", ("european union public licence", "european union public license"), ("1.2", "1.1", "1.0", "")),
    ("artistic", ("artistic license",), ("2.0", "1.0", "")),
    ("bsl", ("boost software license",), ("1.0", "")),
    ("busl", ("business source license",), ("1.1", "")),
    ("unlicense", ("the unlicense",), ("",)),
    ("wtfpl", ("do what the fuck you want to public license",), ("2.0", "")),
    ("psf", ("python software foundation license",), ("2.0", "")),
    ("php", ("php license",), ("3.01", "3.0", "")),
    ("ofl", ("sil open font license", "open font license"), ("1.1", "1.0", "")),
    ("osl", ("open software license",), ("3.0", "2.1", "2.0", "1.1", "1.0", "")),
    ("afl", ("academic free license",), ("3.0", "2.1", "2.0", "1.2", "1.1", "")),
    ("ms-pl", ("microsoft public license",), ("",)),
    ("ms-rl", ("microsoft reciprocal license",), ("",)),
    ("ncsa", ("university of illinois open source license", "ncsa open source license"), ("",)),
    ("postgresql", ("postgresql license",), ("",)),
    ("odbl", ("open database license", "open data commons open database license"), ("1.0", "")),
    ("odc-by", ("open data commons attribution license",), ("1.0", "")),
    ("pddl", ("public domain dedication and license",), ("1.0", "")),
    ("cecill", ("cecill free software license", "cecill license"), ("2.1", "2.0", "")),
    ("sspl", ("server side public license",), ("1.0", "")),
    ("elastic", ("elastic license",), ("2.0", "")),
    ("openssl", ("openssl license",), ("",)),
    ("apsl", ("apple public source license",), ("2.0", "1.2", "1.1", "1.0", "")),
)

# The Creative Commons licenses in short form, and how their parts are spelled in prose, each of whose
# words may be joined to the next ("ShareAlike", "NoDerivs").
CC_PARTS = ("by-nc-nd", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by")
CC_PROSE = {
    "by": rb"attribution", "nc": rb"non" + _OUT + rb"*commercial", "nd": rb"no" + _OUT + rb"*deriv(?:ative)?s?(?:" + _GAP + rb"works?)?",
    "sa": rb"share" + _OUT + rb"*alike",
}
CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0", "")

# Sentences that identify a license text. Label, confidence, words ("..." leaves a gap).
SENTENCES = (
    ("mit", 0.98, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 0.9, "the above copyright notice and this permission notice shall be included"),
    ("isc", 0.98, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 0.9, "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", 0.9, "neither the name of ... nor the names of its contributors may be used"),
    ("bsd-4-clause", 0.9, "all advertising materials mentioning features or use of this software"),
    ("apache-2.0", 0.9, "unless required by applicable law or agreed to in writing software"),
    ("apache-2.0", 0.98, "licensed to the apache software foundation"),
    ("gpl", 0.9, "this program is free software you can redistribute it and or modify it"),
    ("lgpl", 0.9, "this library is free software you can redistribute it and or modify it"),
    ("gpl", 0.8, "without even the implied warranty of merchantability or fitness"),
    ("mpl-2.0", 0.98, "this source code form is subject to the terms of the mozilla public license"),
    ("zlib", 0.95, "this software is provided as is without any express or implied warranty in no event will the authors"),
    ("bsl-1.0", 0.95, "distributed under the boost software license"),
    ("unlicense", 0.98, "this is free and unencumbered software released into the public domain"),
    ("cc0", 0.95, "has waived all copyright and related or neighboring rights"),
    ("cc0", 0.95, "cc0"),
    ("cc0", 0.95, "creative commons zero"),
    ("public-domain", 0.8, "placed in the public domain"),
    ("public-domain", 0.8, "dedicated to the public domain"),
    ("proprietary", 0.8, "proprietary and confidential"),
    ("proprietary", 0.7, "unauthorized copying of this file via any medium is strictly prohibited"),
    ("ofl", 0.9, "this font software is licensed under the sil open font license"),
    ("jsr", 0.6, "java community process"),
    ("beerware", 0.95, "beer ware license"),
    ("copyright", 0.5, "copyright c"),
)

# Longer words too common to serve as keywords.
_COMMON = frozenset("this with without that from used".split())

# How a grant begins.
GRANTS = "licensed|released|distributed|available|published|provided|covered|redistributed|shared|made available"


_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TABLE = np.isin(np.arange(256), list(_WORD_BYTES))


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    confidence: float
    keywords: frozenset[bytes]
    pattern: re.Pattern


def _keywords(phrase: str) -> frozenset[bytes]:
    """Words that every text holds that matches the phrase: those of four letters or more, else the longest."""
    words = phrase.replace("...", "").split()
    return frozenset(w.encode() for w in [w for w in words if len(w) > 3 and w not in _COMMON] or [max(words, key=len)])


def _words(text: str) -> bytes:
    """A pattern for the words of ``text`` one after another. Three dots stand for any words up to the end of the sentence
    and up to six more, as names hold dots; they end where the first word comes again, so that none is read twice."""
    first, parts = text.split()[0].encode(), []
    rest = rb"(?:(?!" + re.escape(first) + rb"(?!" + _IN + rb"))" + _IN + rb"++" + _INNER + rb")*?(?:" + _IN + rb"++" + _GAP + rb"){0,6}?"
    for word in text.split():
        parts.append(rest if word == "..." else re.escape(word.encode()) + _GAP)
    pattern = b"".join(parts)
    return pattern[: -len(_GAP)]


def _whole(pattern: bytes) -> re.Pattern:
    return re.compile(rb"(?<!" + _IN + rb")(?:" + pattern + rb")(?!" + _IN + rb")")


def _version(version: str) -> bytes:
    """A version as prose has it: with or without "version", a closing ".0" optional."""
    head, _, tail = version.partition(".")
    digits = re.escape(head.encode()) + (rb"(?:\.0)?" if tail == "0" else rb"\." + re.escape(tail.encode()))
    return _GAP + rb"(?:version" + _GAP + rb"|v" + _OUT + rb"*+)?" + digits + rb"(?![0-9]|\.[0-9])"


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in their order: identifiers, grants with version, license sentences, grants, then bare names."""
    grant = rb"(?:" + GRANTS.encode() + rb")" + _GAP + rb"under" + _GAP + rb"(?:the" + _GAP + rb")?(?:terms" + _GAP
    grant += rb"of" + _GAP + rb"(?:the" + _GAP + rb")?)?"
    found: list[Rule] = []

    def add(name: str, label: str, priority: int, confidence: float, phrase: str, pattern: bytes) -> None:
        found.append(Rule(name, label, priority, confidence, _keywords(phrase), _whole(pattern)))

    spdx = rb"spdx" + _GAP + rb"license" + _GAP + rb"identifier" + _GAP
    for label, names, versions in FAMILIES:
        for version in versions:
            full = f"{label}-{version}" if version else label
            tail = _version(version) if version else b""
            add(f"id:{full}", full, 100, 1.0, "spdx", spdx + re.escape(label.encode()) + (rb"-" + re.escape(version.encode()) if version else b""))
            for name in names:
                add(f"grant:{name}:{version}", full, 90 if version else 70, 0.97 if version else 0.9, name, grant + _words(name) + tail)
                add(f"name:{name}:{version}", full, 60 if version else 40, 0.8 if version else 0.6, name, _words(name) + tail)
    further = rb"(?!" + _GAP + rb"(?:and" + _GAP + rb")?(?:" + b"|".join(v for k, v in CC_PROSE.items() if k != "by") + rb")(?!" + _IN + rb"))"
    for parts in CC_PARTS:
        for version in CC_VERSIONS:
            full = f"cc-{parts}-{version}" if version else f"cc-{parts}"
            tail = _version(version) if version else b""
            short = _words("cc " + parts.replace("-", " "))
            long_ = _GAP.join([_words("creative commons"), *(CC_PROSE[p] for p in parts.split("-"))]) + further
            long_ += rb"(?:" + _GAP + rb"(?:international|unported|generic|public|licen[cs]e))*"
            add(f"id:{full}", full, 100, 1.0, "spdx", spdx + short + tail)
            add(f"grant:{full}", full, 90 if version else 70, 0.97 if version else 0.9, "cc", grant + short + tail)
            add(f"name:{full}", full, 65 if version else 45, 0.8 if version else 0.6, "cc", short + tail)
            add(f"prose:{full}", full, 65 if version else 45, 0.9 if version else 0.8, "creative", long_ + tail)
    for i, (label, confidence, sentence) in enumerate(SENTENCES):
        add(f"text:{i}:{label}", label, 80 if confidence >= 0.9 else 50, confidence, sentence, _words(sentence))
    return tuple(sorted(found, key=lambda r: -r.priority))


@cache
def _by_keywords() -> dict[frozenset[bytes], tuple[Rule, ...]]:
    kinds = dict.fromkeys(r.keywords for r in rules())
    return {k: tuple(r for r in rules() if r.keywords == k) for k in kinds}


@cache
def _prefilter() -> ahocorasick.Automaton:
    """Finds all keywords in one pass. It reads each byte as one character."""
    found = ahocorasick.Automaton()
    for keyword in frozenset().union(*_by_keywords()):
        found.add_word(keyword.decode("latin-1"), keyword)
    found.make_automaton()
    return found


def _keywords_in(text: bytes) -> set[bytes]:
    """The keywords that stand in the text as whole words."""
    present = set()
    for last, keyword in _prefilter().iter(text.decode("latin-1")):
        first = last + 1 - len(keyword)
        if keyword in present or first and text[first - 1] in _WORD_BYTES:
            continue
        if last + 1 == len(text) or text[last + 1] not in _WORD_BYTES:
            present.add(keyword)
    return present


@cache
def _base_patterns() -> tuple[tuple[bytes, str, re.Pattern], ...]:
    gap = _OUT + rb"+"
    spelled = lambda phrase: gap.join(re.escape(w.encode()) for w in phrase.split())
    return tuple((max(p.split(), key=len).encode(), label, _whole(spelled(p))) for p, label in BASE)


def _word_starts(text: bytes) -> np.ndarray:
    inside = _TABLE[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))


def detect(text: bytes) -> list[tuple[int, int, Rule]]:
    """The detections in a lower-case text that stand: start, end and rule, by priority, then longest, then first."""
    present = _keywords_in(text)
    hits = [
        (m.start(), m.end(), rule)
        for needed, of in _by_keywords().items() if needed <= present
        for rule in of for m in rule.pattern.finditer(text)
    ]
    hits.sort(key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].name))
    stand: list[tuple[int, int, Rule]] = []
    inside = _Cover()
    for start, end, rule in hits:
        if not inside.holds(start, end):
            stand.append((start, end, rule))
            inside.add(start, end)
    return stand


class _Cover:
    """Intervals none of which lies in another, and whether one of them holds a given interval."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def _at(self, start: int) -> int:
        return bisect.bisect_right(self.starts, start)

    def holds(self, start: int, end: int) -> bool:
        at = self._at(start)
        return at > 0 and self.ends[at - 1] >= end

    def add(self, start: int, end: int) -> None:
        at = self._at(start)
        low, high = at, at
        while high < len(self.ends) and self.ends[high] <= end:
            high += 1
        if low and self.starts[low - 1] == start:
            low -= 1
        self.starts[low:high], self.ends[low:high] = [start], [end]


_DETECTION = pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])
_SCAN = pa.struct(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.list_(pa.string())), ("detections", pa.list_(_DETECTION))]
)
SCAN_TYPE = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "detections array<struct<label string, rule string, start long, end long, confidence double>>"
)


def scan_text(text: bytes) -> dict:
    """One text's words, base phrases (places counted in words) and detections (places in bytes)."""
    text = text.lower()
    starts = _word_starts(text)
    at, labels = [], []
    for keyword, label, pattern in _base_patterns():
        if keyword in text and (found := [m.start() for m in pattern.finditer(text)]):
            at += found
            labels.append(label)
    places = np.searchsorted(starts, at) if at else []
    stand = detect(text)
    return {
        "n_words": len(starts), "n_base": len(at),
        "first_word": int(min(places)) if at else None, "last_word": int(max(places)) if at else None,
        "base_labels": sorted(labels),
        "detections": [
            {"label": r.label, "rule": r.name, "start": s, "end": e, "confidence": r.confidence} for s, e, r in stand
        ],
    }


def scan_licenses(documents: DataFrame, text: str = "text", into: str = "scan") -> DataFrame:
    """All columns of ``documents`` and a struct ``into`` of ``SCAN_TYPE`` for each whole text.

    A null or empty text has no words and no detections. ``into`` replaces a column of that name. Rows are scanned
    one by one, so repeated rows have equal results and an empty table gives none.
    """
    small_batches(documents.sparkSession)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([scan_text(t) for t in as_bytes(batch)], _SCAN)

    scanned = F.arrow_udf(scan, f"struct<{_colons(SCAN_TYPE)}>", F.ArrowUDFType.SCALAR_ITER)
    return documents.withColumn(into, scanned(F.col(f"`{text}`")))


def _colons(fields: str) -> str:
    return re.sub(r"(\w+) (?=long|double|string|array)", r"\1:", fields)


def labels_of(scan: str = "scan") -> Column:
    """Base labels and detected ones, distinct and sorted."""
    return F.array_sort(F.array_union(F.col(f"{scan}.base_labels"), F.col(f"{scan}.detections.label")))


def confidence_of(scan: str = "scan") -> Column:
    """The confidence of the surest detection; 0.5 where there is a base label alone; 0 without labels."""
    surest = F.array_max(F.col(f"{scan}.detections.confidence"))
    return F.coalesce(surest, F.when(F.col(f"{scan}.n_base") > 0, 0.5).otherwise(0.0))
