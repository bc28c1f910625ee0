"""Phrase collocations against brute force."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from forecastlake.llm import collocations as co
from forecastlake.llm.double_array import build


def brute(rows, least=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", low):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for (lang, *p), a in cand.items():
        if any(len(q) > len(p) + 1 and q[0] == lang and tuple(p) in zip(q[1:], q[2:]) and 100 * b >= share * a
               for q, b in cand.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(x)[:top]))


def texts(rng, docs, size):
    voc = ["the", "of", "new", "York", "city", "é", "ÜBER", "a-b", "x", "y", "z", " ", "(w)", "to", "be"]
    return [(rng.choice(["en", "fr", None, "und"]), "".join(
        rng.choice(voc) + rng.choice([" ", " ", " ", "\t ", ". ", ", ", "\n", "\x0b", "!"]) for _ in range(size)))
        for _ in range(docs)]


@pytest.mark.parametrize("options", [{}, {"trie_phrases": 20, "trie_bytes": 1 << 15}, {"top": 7, "least": 3, "share": 90}])
def test_matches_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(co, "HELD", 50)
    rng = random.Random(len(options))
    rows = texts(rng, 25, 120) + [("en", None), (None, ""), ("en", " . , "), ("de", "alone")] + [("en", "new york city " * 40)] * 3
    df = spark.createDataFrame([(i, t, lang, "p", 1) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n int")
    got = co.collocations(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in got.dtypes if t != "string"} == {"bigint"}
    plain = {k: v for k, v in options.items() if not k.startswith("trie")}
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **plain)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(co, "CHUNK", 64)
    rng = random.Random(9)
    rows = texts(rng, 10, 60) + [("en", "one " * 100 + ". two three"), ("en", "unbroken " * 50)]
    batch = pa.RecordBatch.from_pydict({"lang": [a or "und" for a, _ in rows], "text": [t for _, t in rows]})
    got = Counter()
    for t in co.texts_of([batch], 0):
        low = t.low.tobytes()
        for i in np.flatnonzero(t.pair).tolist():
            got[t.langs[t.lang[i]], low[t.start[i]:t.end[i]], low[t.start[i + 1]:t.end[i + 1]]] += 1
    want = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            w = re.findall("[^\\x20\\x09]+", piece)
            want.update((lang or "und", a.encode(), b.encode()) for a, b in zip(w, w[1:]))
    assert got == want


def test_scores_beyond_64_bits(spark):
    assert co.collocations(spark.createDataFrame([("a b",)] * 12, "text string").selectExpr("text", "'en' as lang")) \
        .first()["score"] == 1_000_000
    big = spark.sql("SELECT cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) "
                    "div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) AS s FROM "
                    "VALUES (99999999999990L, 99999999999999L, 99999999999995L) t(a, l, r)")
    assert big.first()["s"] == 1000000 * 99999999999990**2 // (99999999999999 * 99999999999995)


def test_a_word_hash_that_collides_is_drawn_anew(spark, monkeypatch):
    real = co._words

    def once(rows, seed):
        out = real(rows, seed)
        return out.selectExpr("lang", "word", "0L AS h", "f") if seed == 0 else out

    monkeypatch.setattr(co, "_words", once)
    rows = [("en", "new york " * 12)]
    got = co.collocations(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_ranks_by_parts_are_ranks(spark):
    """Many hash parts, ties in score and count: the same rows and ranks as one sort."""
    rng = random.Random(21)
    rows = [(rng.choice(["en", "en", "fr"]), f"p{i:05d}", rng.randrange(3), rng.randrange(4)) for i in range(3000)]
    got = co._best(spark.createDataFrame(rows, "lang string, phrase string, score long, a long"), 2).collect()
    want = []
    for lang in ("en", "fr"):
        own = sorted((-s, -a, p) for x, p, s, a in rows if x == lang)[:2]
        want += [(lang, p, -s, -a, i + 1) for i, (s, a, p) in enumerate(own)]
    assert sorted((r["lang"], r["phrase"], r["score"], r["a"], r["rank"]) for r in got) == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(df).collect() == []


def test_double_array():
    rng = np.random.default_rng(4)
    for size, count in ((4, 9), (300, 900), (70_000, 20_000)):
        voc = rng.integers(0, 2**63, size, dtype=np.uint64)

        def some(k):
            return np.unique(voc[(size * rng.random((count, k)) ** 3).astype(int)], axis=0)

        sets = [some(2), some(3)]
        trie = build(sets)
        members = {tuple(x): i for i, x in enumerate(x for s in sets for x in s.tolist())}
        for probe in (*sets, some(2), some(3), rng.integers(0, 2**63, (50, 2), dtype=np.uint64)):
            state, at = trie.start(len(probe)), np.arange(len(probe))
            for j in range(probe.shape[1]):
                alive, state = trie.advance(state, probe[at, j])
                at = at[alive]
            got = {tuple(probe[i].tolist()): int(trie.accept[s]) for i, s in zip(at, state) if trie.accept[s] >= 0}
            assert got == {t: members[t] for t in map(tuple, probe.tolist()) if t in members}


def test_bloom_filters_hold_their_keys(spark):
    rng = np.random.default_rng(5)
    keys, other = rng.integers(-2**63, 2**63, 20_000), rng.integers(-2**63, 2**63, 20_000)
    lang = np.arange(20_000, dtype=np.uint64) % 3
    bloom = co.bloom_of(spark.createDataFrame(list(zip(lang.tolist(), keys.tolist())), "lang_key long, key long"))
    assert bloom.holds(co.fingerprint(lang, keys.view(np.uint64))).all()
    assert bloom.holds(co.fingerprint(lang, other.view(np.uint64))).mean() < 0.02
    assert bloom.holds(co.fingerprint(lang + np.uint64(1), keys.view(np.uint64))).mean() < 0.02
    assert not co.bloom_of(spark.createDataFrame([], "lang_key long, key long")).holds(keys.view(np.uint64)).any()


@pytest.mark.parametrize("bits", [1, 4])
def test_short_hashes_that_are_alike_lose_nothing(spark, bits):
    """Words with two or 16 short hashes in all: every combination is a candidate, the counts stay exact."""
    rows = texts(random.Random(11), 20, 100)
    got = co.collocations(spark.createDataFrame(rows, "lang string, text string"), short_bits=bits)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
