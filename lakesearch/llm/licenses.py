"""License scan by ordered signature rules.

A text becomes its words: A-Z in lower case, longest runs of ASCII letters, digits and
characters beyond ASCII, joined by single blanks. A rule is a regex over whole words
with a label, a priority and a confidence. The rules are written as a table of licenses
(names, versions) and a table of the forms in which a license is named: an SPDX tag, an
address, a sentence that grants it, name and version, the bare name, a sentence of its text.
All keywords are searched first; a rule is tried only on texts that hold one of its own.

Detections that overlap are resolved by interval containment: one that lies within a detection
of a better priority, or within a longer one of the same priority, or that shares its interval
with an earlier rule, goes. The three base phrases are rules as well, but their places are
counted by themselves and their labels always stay.

`score` is 1 - prod(1 - confidence) over the labels that stay, each with its best rule.

Defined results: null text is empty; a text without words, or without a detection, has empty
labels, score 0 and null places; every input row gives a row; an empty table gives no rows.
Long texts are scanned whole; a rule repeats without bound only within one word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesearch.llm.bpe import in_slices
from lakesearch.llm.common import whole_text

# ---- fixed values: the base phrases and their labels ----
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# ---------------------------------------------------------

#: Letters to lower case and all that is in no word to a blank, for the bytes of a text.
WORDS = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

LICENSE = "licen[cs]e"

#: (label, name as regex, keywords, versions, SPDX stem); a name is tried only with one of its keywords.
LICENSES = [
    ("apache", f"apache(?: software)?(?: {LICENSE})?", ["apache"], ["1.0", "1.1", "2.0"], "apache"),
    ("gpl", f"(?:gnu )?general public {LICENSE}|gnu gpl|gpl", ["general public", "gpl"], ["1.0", "2.0", "3.0"], "gpl"),
    ("lgpl", f"(?:gnu )?(?:lesser|library) general public {LICENSE}|(?:gnu )?lgpl", ["lesser general public", "library general public", "lgpl"], ["2.0", "2.1", "3.0"], "lgpl"),
    ("agpl", f"(?:gnu )?affero general public {LICENSE}|(?:gnu )?agpl", ["affero", "agpl"], ["1.0", "3.0"], "agpl"),
    ("gfdl", f"(?:gnu )?free documentation {LICENSE}|gfdl", ["free documentation", "gfdl"], ["1.1", "1.2", "1.3"], "gfdl"),
    ("mpl", f"mozilla public {LICENSE}|mpl", ["mozilla public", "mpl"], ["1.0", "1.1", "2.0"], "mpl"),
    ("epl", f"eclipse public {LICENSE}|epl", ["eclipse public", "epl"], ["1.0", "2.0"], "epl"),
    ("cddl", f"common development and distribution {LICENSE}|cddl", ["common development", "cddl"], ["1.0", "1.1"], "cddl"),
    ("cpl", f"common public {LICENSE}", ["common public"], ["1.0"], "cpl"),
    ("eupl", f"european union public {LICENSE}|eupl", ["european union public", "eupl"], ["1.0", "1.1", "1.2"], "eupl"),
    ("osl", f"open software {LICENSE}", ["open software"], ["1.0", "2.0", "2.1", "3.0"], "osl"),
    ("afl", f"academic free {LICENSE}", ["academic free"], ["1.1", "1.2", "2.0", "2.1", "3.0"], "afl"),
    ("artistic", f"artistic {LICENSE}", ["artistic"], ["1.0", "2.0"], "artistic"),
    ("bsl", f"boost software {LICENSE}", ["boost software"], ["1.0"], "bsl"),
    ("busl", f"business source {LICENSE}", ["business source"], ["1.1"], "busl"),
    ("sspl", f"server side public {LICENSE}|sspl", ["server side public", "sspl"], ["1"], "sspl"),
    ("ofl", f"(?:sil )?open font {LICENSE}", ["open font"], ["1.0", "1.1"], "ofl"),
    ("odbl", f"open (?:data commons open )?database {LICENSE}|odbl", ["database license", "database licence", "odbl"], ["1.0"], "odbl"),
    ("odc-by", f"open data commons attribution {LICENSE}", ["open data commons"], ["1.0"], "odc by"),
    ("pddl", "(?:open data commons )?public domain dedication and license|pddl", ["public domain dedication", "pddl"], ["1.0"], "pddl"),
    ("ms-pl", f"microsoft public {LICENSE}|ms pl", ["microsoft public", "ms pl"], [], "ms pl"),
    ("ms-rl", f"microsoft reciprocal {LICENSE}|ms rl", ["microsoft reciprocal", "ms rl"], [], "ms rl"),
    ("mit", f"mit(?: x11)? {LICENSE}|expat {LICENSE}", ["mit licen", "mit x11", "expat"], [], "mit"),
    ("isc", f"isc {LICENSE}", ["isc"], [], "isc"),
    ("zlib", f"zlib(?: libpng)? {LICENSE}", ["zlib"], [], "zlib"),
    ("unlicense", "the unlicense", ["unlicense"], [], "unlicense"),
    ("wtfpl", f"wtfpl|do what the f\\w+ you want to public {LICENSE}", ["wtfpl", "you want to public"], ["2"], "wtfpl"),
    ("psf", f"python software foundation {LICENSE}|psf {LICENSE}", ["python software foundation", "psf"], ["2"], "psf"),
    ("php", f"php {LICENSE}", ["php"], ["3.0", "3.01"], "php"),
    ("ruby", f"ruby {LICENSE}", ["ruby"], [], "ruby"),
    ("openssl", f"openssl {LICENSE}", ["openssl"], [], "openssl"),
    ("w3c", f"w3c software(?: notice)?(?: and)? {LICENSE}", ["w3c"], [], "w3c"),
    ("ncsa", f"(?:university of illinois )?ncsa(?: open source)? {LICENSE}", ["ncsa"], [], "ncsa"),
    ("upl", f"universal permissive {LICENSE}", ["universal permissive"], ["1.0"], "upl"),
    ("zpl", f"zope public {LICENSE}", ["zope"], ["1.1", "2.0", "2.1"], "zpl"),
    ("lppl", f"latex project public {LICENSE}|lppl", ["latex project", "lppl"], ["1.0", "1.1", "1.2", "1.3a", "1.3c"], "lppl"),
    ("cecill", f"cecill(?: free software)?(?: {LICENSE})?", ["cecill"], ["1.0", "1.1", "2.0", "2.1"], "cecill"),
    ("bsd-0-clause", f"(?:0|zero) clause bsd(?: {LICENSE})?", ["clause bsd"], [], "0bsd"),
    ("bsd-2-clause", f"(?:2|two) clause bsd(?: {LICENSE})?|simplified bsd {LICENSE}|bsd 2 clause(?: {LICENSE})?|freebsd {LICENSE}", ["clause", "simplified bsd", "freebsd"], [], "bsd 2 clause"),
    ("bsd-3-clause", f"(?:3|three) clause bsd(?: {LICENSE})?|(?:new|revised|modified) bsd {LICENSE}|bsd 3 clause(?: {LICENSE})?", ["clause", "new bsd", "revised bsd", "modified bsd"], [], "bsd 3 clause"),
    ("bsd-4-clause", f"(?:4|four) clause bsd(?: {LICENSE})?|original bsd {LICENSE}|bsd 4 clause(?: {LICENSE})?", ["clause", "original bsd"], [], "bsd 4 clause"),
    ("bsd", f"bsd(?: style)? {LICENSE}", ["bsd"], [], "bsd"),
    ("cc0", "cc0|cc zero|creative commons zero", ["cc0", "cc zero", "commons zero"], ["1.0"], "cc0"),
]

#: Creative Commons: parts in short and in full, and versions.
CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s(?: works)?", "nc": "non ?commercial"}
CC_KINDS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: Sentences of license texts, and notices: (label, regex, keyword, priority, confidence).
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 1, 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "and or distribute", 1, 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary forms", 1, 0.9),
    ("bsd-3-clause", "neither the name of(?: \\w+){1,12} nor the names of its contributors", "nor the names", 1, 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "advertising materials", 1, 0.9),
    ("zlib", "this software is provided as is without any express or implied warranty", "express or implied", 1, 0.6),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 1, 0.95),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software you can", 1, 0.9),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "free software you can", 1, 0.9),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "source code form", 0, 0.95),
    ("apache", "you may not use this file except in compliance with the license", "except in compliance", 1, 0.9),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary", 3, 0.7),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori", 3, 0.6),
    ("public-domain", "(?:in|into|to) the public domain", "public domain", 3, 0.6),
    ("copyright", "copyright (?:c )?(?:19|20)\\d\\d", "copyright", 4, 0.4),
    ("open-source", f"open source {LICENSE}", "open source", 5, 0.3),
]


def _version(v: str) -> str:
    """A version as words: `2.0` is also named `2`, glued to a `v` or after the word."""
    major, _, minor = v.partition(".")
    return f"(?:(?:version|v) )?v?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}" if minor else "")


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[bytes, ...]  # each from the start of a word
    priority: int  # smaller wins
    confidence: float


GRANT = "(?:licensed|released|distributed|published|available|provided|offered|covered|redistributed|shared|governed)(?: \\w+){0,3} (?:under|by)(?: \\w+){0,4}"


def rules() -> list[Rule]:
    """All rules, in the order that breaks ties."""
    found: list[Rule] = []

    def add(label: str, pattern: str, keywords: list[str], priority: int, confidence: float) -> None:
        found.append(Rule(label, pattern, tuple(b" " + k.encode() for k in keywords), priority, confidence))

    def forms(label: str, name: str, keywords: list[str], versions: list[str], spdx: str) -> None:
        for v in versions:
            own, number = f"{label}-{v}", _version(v)
            later = "(?: only| or(?: at your option)?(?: any)? (?:later|newer)(?: version)?)?"
            add(own, f"spdx license identifier {spdx} {v.replace('.', ' ')}{later}", ["spdx"], 0, 1.0)
            add(own, f"{GRANT} (?:{name}) {number}{later}", keywords, 1, 0.95)
            add(own, f"(?:{name}) {number}{later}", keywords, 2, 0.9)
        add(label, f"spdx license identifier {spdx}", ["spdx"], 1, 0.95)
        add(label, f"{GRANT} (?:{name})", keywords, 3, 0.85)
        add(label, f"(?:{name})", keywords, 4, 0.6)
        add(label, f"(?:opensource org licenses?|spdx org licenses|choosealicense com licenses) {spdx}(?: \\d{{1,4}}){{0,2}}", ["opensource org", "spdx org", "choosealicense"], 1, 0.9)

    for row in LICENSES:
        forms(*row)
    for kind in CC_KINDS:
        parts = kind.split()
        name = f"cc {kind}|(?:creative commons|cc) {' '.join(CC_PARTS[p] for p in parts)}"
        forms(f"cc-{kind.replace(' ', '-')}", name, ["cc", "creative commons"], CC_VERSIONS, f"cc {kind}")
        add(f"cc-{kind.replace(' ', '-')}", f"creativecommons org licenses {kind}(?: \\d \\d)?", ["creativecommons"], 1, 0.95)
    add("cc0", "creativecommons org publicdomain zero", ["creativecommons"], 1, 0.95)
    add("apache", "apache org licenses(?: license 2 0)?", ["apache org"], 1, 0.9)
    add("gpl", "gnu org (?:licenses|copyleft)(?: gpl)?", ["gnu org"], 1, 0.8)
    for label, pattern, keyword, priority, confidence in SENTENCES:
        add(label, pattern, [keyword], priority, confidence)
    for phrase, label in BASE.items():
        add(label, phrase, [phrase], 5, 0.3 if label == "reserved" else 0.6)
    return found


@cache
def compiled() -> tuple[list[tuple[Rule, re.Pattern]], list[bytes]]:
    """The rules compiled over whole words, and their distinct keywords."""
    own = [(r, re.compile(b"(?<= )(?:%s)(?= )" % r.pattern.encode())) for r in rules()]
    return own, sorted({k for r, _ in own for k in r.keywords})


def words_of(text: bytes) -> bytes:
    """The words with a blank before and after each."""
    return b" " + b" ".join(text.translate(WORDS).split()) + b" "


def base_places(words: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase, in order."""
    found = [(m.start(), label) for phrase, label in BASE.items() if b" " + phrase.encode() + b" " in words for m in re.finditer(b"(?<= )%s(?= )" % phrase.encode(), words)]
    out, at, n = [], 0, 0
    for start, label in sorted(found):
        n += words.count(b" ", at, start)
        at = start
        out.append((n - 1, label))
    return out


def resolve(found: list[tuple[int, int, int, int]]) -> list[int]:
    """Rules of the (start, end, priority, rule) detections that no better one contains.

    Better: a smaller priority, then the longer interval, then the earlier rule. Detections come
    by start, the longest first, so one that contains another comes before it or shares its start;
    of those before, the farthest end for each priority is kept.
    """
    best = lambda d: (d[2], d[0] - d[1], d[3])
    kept: list[int] = []
    reach: dict[int, int] = {}  # priority: farthest end of any detection so far
    ordered = sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3]))
    i = 0
    while i < len(ordered):
        j = i
        while j < len(ordered) and ordered[j][0] == ordered[i][0]:
            j += 1
        same = ordered[i:j]
        for d in same:
            inside = any(end >= d[1] for p, end in reach.items() if p <= d[2])
            if not inside and not any(e[1] >= d[1] and best(e) < best(d) for e in same if e is not d):
                kept.append(d[3])
        for d in same:
            reach[d[2]] = max(reach.get(d[2], -1), d[1])
        i = j
    return kept


def detect(words: bytes) -> tuple[list[str], float]:
    """(labels that stay, score) of the rules on a text's words."""
    own, keywords = compiled()
    there = {k for k in keywords if k in words}
    if not there:
        return [], 0.0
    found = [
        (m.start(), m.end(), rule.priority, i)
        for i, (rule, pattern) in enumerate(own)
        if not there.isdisjoint(rule.keywords)
        for m in pattern.finditer(words)
    ]
    best: dict[str, float] = {}
    for i in resolve(found):
        best[own[i][0].label] = max(best.get(own[i][0].label, 0.0), own[i][0].confidence)
    return sorted(best), round(1.0 - math.prod(1.0 - best[k] for k in sorted(best)), 9)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))

    def row(text: str) -> tuple:
        words = words_of(text.encode("utf-8", "surrogatepass"))
        places = base_places(words)
        base = {label for _, label in places}
        labels, score = detect(words)
        n_words = words.count(b" ") - 1 if len(words) > 2 else 0
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        return n_words, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base.union(labels))), score

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, 1):
                found = list(zip(*(row(t) for t in batch.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(found, types))], names=["key", *names])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
