"""Filter audit, license scan and conversation repair against brute force, odd rows included."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from lakesearch.llm import licenses, repair, wordmatrix
from lakesearch.llm.bpe import BATCH_CHARS

DOCS = "doc_id long, text string, lang string, source string, word string, shard long, n long, part string"
ODD = (None, "clash", 7, 1, "clash")  # columns whose names the operators use themselves


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


TEXTS = [
    (1, words(120), "en"),
    (2, words(120), "en"),  # copy of 1
    (3, None, "en"),
    (4, "", None),
    (4, "", None),  # repeated row
    (5, "one two " * 80, "de"),
    (6, "LOUD WORDS " + words(150), "de"),
    (7, "a\tb\nc\x0bd\x0ce\rf  g h " + words(99) + " $", ""),
    (None, words(120), "en"),
    (8, "Ü ö " * 70 + "| x", "fr"),
    (9, words(30_000) + " " + words(10_000), "fr"),
    (0, words(130), "en"),
    (10, words(130), "xx"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (5, 1, None), (10, 1, 1), (None, 1, 1), (77, 1, 1)]


def brute_audit():
    least = {}
    for i, t, _ in TEXTS:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in TEXTS:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        fails["E"] = i is not None and least[t] < i
        labels = [x for x in LABELS if x[0] == i and i is not None]
        docs.append((lang or "", fails, any(x[1] == 1 for x in labels), any(x[2] == 1 for x in labels)))
    rows, removed_by = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for p in permutations("ABCDE"):
            left, gone = list(own), []
            for step, f in enumerate(p, 1):
                out = [d for d in left if d[1][f]]
                redundant = sum(d[1][f] for d in gone)
                left = [d for d in left if not d[1][f]]
                unique = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                rows.append([part, "".join(p), step, len(left), len(out), redundant, unique, sum(d[2] for d in out), sum(d[3] for d in out)])
                removed_by[part, f] += len(out)
                gone += out
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in rows)


@pytest.mark.parametrize("shard_bytes", [1, 8 << 20])
def test_filter_audit(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(wordmatrix, "SHARD_BYTES", shard_bytes)
    docs = spark.createDataFrame([(*t, *ODD) for t in TEXTS], DOCS)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = wordmatrix.audit(wordmatrix.histogram(wordmatrix.failures(docs), labels)).collect()
    columns = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert sorted(tuple(r[c] for c in columns) for r in rows) == brute_audit()
    nothing = wordmatrix.failures(docs.limit(0))
    assert wordmatrix.audit(wordmatrix.histogram(nothing, labels)).isEmpty()
    assert wordmatrix.histogram(wordmatrix.failures(docs), labels.limit(0)).agg(F.sum("n")).first()[0] == len(TEXTS)


def test_matrix_holds_every_word(spark):
    docs = spark.createDataFrame([(*t, *ODD) for t in TEXTS], DOCS).repartition(4).select("doc_id", "lang", "text")
    shards = wordmatrix.local_shards(docs)
    numbered = wordmatrix.numbered_words(shards)
    ids = {r.word: r.id for r in wordmatrix.dictionary(numbered).collect()}
    assert sorted(ids.values()) == list(range(len(ids)))
    found = []
    for r in wordmatrix.csr_shards(shards, numbered).collect():
        assert r.columns == sorted(r.columns)
        found.append((str(r.doc_id), list(zip(r.columns, r.counts))))
    wanted = [(str(i), sorted((ids[w], n) for w, n in Counter(re.findall("[^\x20\x09-\x0d]+", t or "")).items())) for i, t, _ in TEXTS]
    assert sorted(found) == sorted(wanted)


def test_words_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(wordmatrix.F, "xxhash64", lambda c: F.length(c).cast("long"))
    docs = spark.createDataFrame([(i, f"aa bb {i:04d} cc aa {i % 7} long{i}") for i in range(3000)], "doc_id long, text string").repartition(5)
    numbered = wordmatrix.numbered_words(wordmatrix.local_shards(docs))
    ids = {r.word: r.id for r in wordmatrix.dictionary(numbered).collect()}
    assert len(ids) == 3 + 3000 + 7 + 3000 and sorted(ids.values()) == list(range(len(ids)))


def test_least_of_hot_and_rare_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1700).alias("k"), (F.lit(9000) - F.col("id")).alias("v"))
    found = wordmatrix.with_least(rows, "k", "v", "least")
    assert found.count() == 5000
    wanted = rows.groupBy("k").agg(F.min("v").alias("least"))
    assert found.select("k", "least").distinct().exceptAll(wanted).isEmpty()


LICENSED = [
    ("Licensed under CC BY-NC 4.0.", "cc-by", "cc-by,cc-by-nc-4.0"),
    ("Licensed under the Apache License, Version 2.0.", "", "apache-2.0"),
    ("All rights\n\nreserved. ALL RIGHTS RESERVED", "reserved", "reserved"),
    ("Released under the MIT License.", "", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"),
    ("the GNU Lesser General Public License v2.1 or later", "gpl", "gpl,lgpl-2.1"),
    ("SPDX-License-Identifier: BSD-3-Clause", "", "bsd-3-clause"),
    ("see https://creativecommons.org/licenses/by-sa/4.0/ and cc by", "cc-by", "cc-by,cc-by-sa"),
    ("mit der Firma, an accident by the general public", "", ""),
    ("cc by cc by", "cc-by", "cc-by"),
    ("ÄCC by, cc byé", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("... --- !!!", "", ""),
]


def brute_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark):
    long_ = "lorem ipsum " * (BATCH_CHARS // 8) + "all rights reserved " + "dolor " * 1000 + "cc\tby"
    rng = random.Random(5)
    vocabulary = "all rights reserved general public license cc by mit the of ALL Rights, é 7".split()
    noise = [" ".join(rng.choices(vocabulary, k=rng.randrange(40))) for _ in range(300)]
    texts = [t for t, _, _ in LICENSED] + [long_, *noise, noise[0]]
    docs = spark.createDataFrame([(i, t, *ODD[:1], *ODD) for i, t in enumerate(texts)], "doc_id long, " + DOCS.split(", ", 1)[1])
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score == 0) == (r.labels == "")
    for i, (_, base, labels) in enumerate(LICENSED):
        assert (found[i].base_labels, found[i].labels) == (base, labels)
    assert licenses.scan(docs.limit(0)).isEmpty()


def test_license_containment_against_all_pairs():
    rng = random.Random(3)
    for _ in range(500):
        found = [(a := rng.randrange(12), a + 1 + rng.randrange(6), rng.randrange(3), i) for i in range(rng.randrange(9))]
        rank = lambda d: (d[2], d[0] - d[1], d[3])
        wanted = [d[3] for d in found if not any(e[0] <= d[0] and d[1] <= e[1] and rank(e) < rank(d) for e in found if e is not d)]
        assert sorted(licenses.resolve(found)) == sorted(wanted)


def test_every_license_rule_is_gated_and_linear():
    rules, keywords = licenses.compiled()
    assert len(rules) > 300 and all(r.keywords for r, _ in rules)
    patterns = "".join(r.pattern for r, _ in rules).replace("\\w+", "")
    assert "*" not in patterns and "+" not in patterns  # open repetition only within a word
    assert all(k.startswith(b" ") for k in keywords)


def brute_repair(rows):
    """Least cost and audit by all ways, row by row, audits held in full."""
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if k:
            t = "" if k == 1 else re.sub("[.!?]", "", blank(text)) if k == 2 else blank(text)
            out += [(turn, "user" if k == 4 else blank(role), t)] * (2 if k == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][: repair.PREFIX].encode(), hashlib.md5(r[2].encode()).digest()))
    turns = {r[0] for r in out if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, faults = set(), []
    ways = {0: (0, "", ())}
    for _, role, text in out:
        fault = "blank" if not text.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "" if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        found = []
        once = [(3 if p == 2 else 2, (c + 2, a + "I", w + ("assistant:" if p == 2 else "user:",))) for p, (c, a, w) in ways.items()]
        twice = [(3 if p == 2 else 2, (c + 2, a + "I", w + ("assistant:" if p == 2 else "user:",))) for p, (c, a, w) in once]
        for p, (c, a, w) in [*ways.items(), *once, *twice]:
            found.append((p, (c + 3, a + "D", w)))
            if fault not in ("blank", "duplicate"):
                c += fault == "truncated"
                q = {"s": 1 if p == 0 else None, "u": 2 if p != 2 else None, "a": 3 if p == 2 else None}.get(role[:1])
                if q:
                    found.append((q, (c, a + "K", w + (f"{role}:{text}",))))
                found.append((3 if p == 2 else 2, (c + 2, a + "R", w + (("assistant:" if p == 2 else "user:") + text,))))
        ways = {}
        for p, way in found:
            ways[p] = min(way, ways.get(p, way))
    ends = [ways.get(0), ways.get(3)]
    if 2 in ways:
        c, a, w = ways[2]
        ends.append((c + 2, a + "I", w + ("assistant:",)))
    if 1 in ways:
        c, a, w = ways[1]
        ends.append((c + 4, a + "II", w + ("user:", "assistant:")))
    cost, audit, written = min(e for e in ends if e)
    f = [r[1][:1] for r in out]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(f, f[1:]))
    n = Counter(faults)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest()


def conversations():
    rng = random.Random(11)
    rows = [(1, t, r, f"text {t}.") for t, r in enumerate(["system", "user", "assistant"] * 2)]
    rows += [(2, None, "user", "no turn."), (2, None, None, "no role"), (2, 3, "assistant", None), (2, 3, "assistant", None)]
    rows += [(None, 0, "user", "no id."), (None, None, "tool", "neither."), (3, 0, "", "no initial."), (3, 1, "unknown", "kept as it is")]
    rows += [(4, t, "user", "always the same.") for t in range(400)]  # one text on many rows
    rows += [(5, 0, "user", "equal rows") for _ in range(300)]
    rows += [(6, 7, "user", f"one turn {i % 50}." * 20) for i in range(300)]
    for conv in range(10, 150):
        for t in range(rng.randrange(1, 30)):
            rows.append((conv, t + rng.randrange(2), rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["Hi.", "ok", " ", "Yes!\n", "a longer text?", "x"])))
    rows += [(200, t, ("user", "assistant")[t % 2 if rng.random() < 0.9 else 0], f"turn {t}" + rng.choice([".", ""])) for t in range(4000)]
    return rows


@pytest.mark.parametrize("range_bytes", [2000, 32 << 20])
def test_conversation_repair(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(repair, "RANGE_BYTES", range_bytes)
    rows = conversations()
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "conv_id long, turn long, role string, text string, kind string, part long")
    columns = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    found = {r.conv_id: tuple(r[c] for c in columns) for r in repair.repaired(df).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    assert set(found) == set(groups)
    for conv, own in groups.items():
        assert found[conv] == brute_repair(own), conv
    assert repair.repaired(df.limit(0)).isEmpty()


def test_a_conversation_that_loses_all_rows(spark):
    lost = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repaired(spark.createDataFrame([(lost, 0, "user", "gone.")], "conv_id long, turn long, role string, text string")).first()
    assert row.asDict() == {"conv_id": lost, **dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0), "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
