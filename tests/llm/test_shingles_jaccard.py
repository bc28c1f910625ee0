"""Shingles, components and the Jaccard join against brute force."""
import random
import re

import pyarrow as pa
import pytest

from forecastlake.llm import jaccard
from forecastlake.llm.components import connected_components
from forecastlake.llm.shingles import sets_of


def brute_set(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w)} if len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute_components(ids, sets, percent):
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b, key=lambda x: ids[x])] = min(a, b, key=lambda x: ids[x])
    return [ids[find(i)] for i in range(len(ids))]


def test_sets_match_brute_force():
    rng = random.Random(1)
    texts = ["", None, " ", "one", "One two", "A b C", "ÄÖ ß\u00a0x y\x0bz\x1cq", "a a a a a", "x" * 100_000]
    texts += ["".join(rng.choice("ab \t\nÉ") for _ in range(rng.randrange(60))) for _ in range(300)]
    for n in (1, 3, 5):
        for typed in (pa.string(), pa.large_string()):
            got = sets_of(pa.array(texts, typed), n)
            seen = {}
            for text, s in zip(texts, got):
                want = brute_set(text, n)
                assert len(s) == len(want)
                assert seen.setdefault(frozenset(want), s.tobytes()) == s.tobytes()
        sliced = sets_of(pa.array(texts).slice(4, 6), n)
        assert [x.tolist() for x in sliced] == [x.tolist() for x in got[4:10]]


@pytest.mark.parametrize("kind", ["chain", "random", "empty"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(60)], "empty": [],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(None, 1), (7, 7)]}[kind]
    real = [(a, b) for a, b in edges if a is not None and a != b]
    label = {x: x for e in real for x in e}
    for _ in range(len(label)):
        for a, b in real:
            label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in got} == label and len(got) == len(label)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocab) for _ in range(60)]
    rows, k = [(0, None), (1, ""), (2, "  \n"), (3, "Solo"), (4, "solo"), (5, "two Words"), (6, "words two")], 7
    for _ in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(3, 90))]
        if rng.random() < 0.3:
            words += shared
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((k, " ".join(copy)))
            k += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_join_matches_brute_force(spark, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard, "BLOCK_CHARS", 4_000)
    monkeypatch.setattr(jaccard, "BUCKET_CHARS", 9_000)
    monkeypatch.setattr(jaccard, "UNIT", 5)      # lists of more than five sets are taken in blocks
    rows = corpus(words)
    sets = [brute_set(t, words) for _, t in rows]
    want = dict(zip([i for i, _ in rows], zip(map(len, sets), brute_components([i for i, _ in rows], sets, percent))))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, component_id string")
    got = jaccard.similar_groups(df, words=words, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows)


def test_join_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_groups(empty).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (2, None)],
                                  "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard.similar_groups(nulls).collect())
    assert got == [(-1, -1), (-1, -1), (2, 2), (2, 2), (4, 2)]


def test_stage_keeps_one_row_of_repeated_rows_and_ids(spark):
    a, b, c = ("one two three four five six seven", "red green blue black white grey pink", "cat dog cow hen pig fox owl")
    rows = [(1, a, "en"), (1, a, "en"), (1, a, "en"), (1, a, "fr"),     # repeated rows of the smallest id
            (2, a, "en"), (3, b, "en"), (3, a, "en"),                   # 3 is kept because of b, not with a
            (None, c, "en"), (None, c, "en"), (None, c, None), (None, b, "en"), (None, None, "en"), (5, None, "en"), (6, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard.jaccard_stage(spark, df, "").collect()), key=str)
    assert got == sorted([(1, a), (3, b), (None, c), (None, None), (5, None), (6, None)], key=str)


def test_stage_keeps_one_of_each_group(spark):
    rows = corpus(9, 25)
    sets = [brute_set(t, 5) for _, t in rows]
    comp = brute_components([i for i, _ in rows], sets, 80)
    df = spark.createDataFrame([(i, t, "en") for i, t in rows] + [(None, "lost", None)], "doc_id long, text string, lang string")
    got = jaccard.jaccard_stage(spark, df, "")
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == sorted(set(comp))
    assert got.filter("doc_id is null").count() == 1
