"""License scans against plain recomputation."""
import random
import re

import pyarrow as pa
import pytest

from forecastlake.llm import licenses
from forecastlake.llm.license_rules import BASE, Rule, rules

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text):
    w, places = words(text), []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return w, places


def brute_suppress(found):
    kept = []
    for k, a, z in sorted(found, key=lambda x: (x[0], x[1] - x[2], x[1])):
        if not any(b <= a and z <= y for _, b, y in kept):
            kept.append((k, a, z))
    return kept


def ungated(text):
    """All rules on all words, without keywords, automaton or staircase."""
    w = words(text)
    norm = " " + "".join(x + " " for x in w)
    found = [(k, norm.count(" ", 0, m.start()) - 1, norm.count(" ", 0, m.end()) - 1)
             for k, r in enumerate(RULES) for m in r.pattern.finditer(norm)]
    return sorted([(RULES[k].label, a, z) for k, a, z in brute_suppress(found)]
                  + [(label, i, i + len(phrase.split()) - 1) for phrase, label in BASE.items()
                     for i, _ in [x for x in brute_base(text)[1] if x[1] == label]])


RULES = rules()
SNIPPETS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "cc by nc", "CC BY-NC-SA 4.0",
    "This work is licensed under the GNU General Public License, version 3.", "GPLv3", "LGPL v2.1",
    "GNU Lesser General Public License version 2.1 or later", "SPDX-License-Identifier: GPL-2.0-or-later",
    "SPDX-License-Identifier: MIT", "BSD 3-Clause License", "the Mozilla Public License, v. 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files", "Creative Commons Attribution-NonCommercial 4.0", "released into the public domain",
    "under the mit\nlicense", "ISC License", "misc licence", "mit", "license", "under the", "version 2 0", "Öffentliche"]


def test_rules_are_sound():
    assert len(RULES) > 300
    for r in RULES:
        assert isinstance(r, Rule) and 0 < r.confidence < 1 and "," not in r.label and r.keyword.strip() == r.keyword


def test_every_match_holds_a_keyword():
    """Names and identifiers, as far as their regexes can be spelt out, pass their own gate."""
    s = licenses.scanner()
    for text, label in [
            ("Licensed under the Apache License, Version 2.0", "apache-2"), ("the Expat license", "mit"),
            ("GNU Affero General Public License version 3", "agpl-3"), ("(c) ISC License", "isc"),
            ("Eclipse Public License 2.0", "epl-2"), ("Boost Software License, Version 1.0", "boost-1"),
            ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"), ("CC BY-SA 4.0", "cc-by-sa-4.0"),
            ("Creative Commons Attribution-ShareAlike 3.0", "cc-by-sa-3.0"), ("the Unlicense", "unlicense"),
            ("GPL v2", "gpl-2"), ("distributed under the terms of the GNU GPL version 3", "gpl-3")]:
        (_, norm), = licenses.normalised(pa.array([text]))
        assert label in {x[0] for x in s.scan(norm)}, text


def test_longer_and_higher_rules_suppress():
    s = licenses.scanner()
    (_, norm), = licenses.normalised(pa.array(["GNU General Public License version 3 or later"]))
    assert {x[0] for x in s.scan(norm)} == {"gpl-3-or-later"}
    (_, norm), = licenses.normalised(pa.array(["under the MIT License"]))
    assert [(x[0], x[4]) for x in s.scan(norm)] == [("mit", True), ("mit", False)]


def test_suppression_matches_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        found = [(rng.randrange(5), a, a + rng.randrange(6)) for a in [rng.randrange(20) for _ in range(rng.randrange(15))]]
        assert licenses.suppress(found) == brute_suppress(found)


def test_normalised_words():
    rng = random.Random(3)
    texts = [None, "", " ", "a", "A-B", "ÄÖ ÿ x", "\x7f\x00Z9", "x" * 9_000_000]
    texts += ["".join(rng.choice("aB9 .-\nÉ€") for _ in range(rng.randrange(30))) for _ in range(200)]
    for typed in (pa.string(), pa.large_string()):
        got = list(licenses.normalised(pa.array(texts, typed).slice(0)))
        assert got == [(len(words(t)), " " + "".join(w + " " for w in words(t))) for t in texts]
    assert list(licenses.normalised(pa.array(texts).slice(3, 3))) == got[3:6]


def test_scan_matches_recomputation(spark):
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (None, "cc by nc"), (None, "cc by nc"), (3, "license " * 20_000 + "cc, BY: nc")]
    for i in range(10, 160):
        rows.append((i, " ".join(rng.choice(SNIPPETS + ["word", "und,"]) for _ in range(rng.randrange(1, 12)))))
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_words int, label string")
    scanned = licenses.scan_licenses(df)
    assert scanned.columns == ["doc_id", "text", "label", "n_words", "licenses"]
    for r in licenses.license_digest(scanned).collect():
        w, places = brute_base(r.text)
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        want = ungated(r.text)
        assert sorted((x.label, x.first_word, x.last_word) for x in r.licenses) == want
        assert r.labels == ",".join(sorted({x[0] for x in want}))
        miss, by = 1.0, {}
        for x in r.licenses:
            by[x.label] = max(by.get(x.label, 0), x.confidence)
        for c in by.values():
            miss *= 1 - c
        assert r.score == pytest.approx(1 - miss) and 0 <= r.score <= 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.license_digest(licenses.scan_licenses(df)).collect() == []
