"""Families of near copies: what is posted grows with the family, and nothing is lost."""
import random

import pytest

from forecastlake.llm import jaccard
from tests.llm.test_shingles_jaccard import brute_components, brute_set


def _family(n, seed, words=60):
    """Texts that differ from one text in one word each: all near one another, none equal."""
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for k in range(n):
        t = list(base)
        t[rng.randrange(words)] = f"own{k}"
        out.append(" ".join(t))
    return out


def _posted(spark, texts, monkeypatch):
    """(component by id, rows that are compared in units)."""
    rows = []
    real = jaccard._pairs

    def counting(postings, *args):
        rows.append(postings.count())
        return real(postings, *args)

    monkeypatch.setattr(jaccard, "_pairs", counting)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(df, words=3, percent=80).collect()}
    monkeypatch.undo()
    return got, sum(rows)


def test_postings_of_a_family_grow_with_its_size(spark, monkeypatch):
    small, few = _posted(spark, _family(500, 1), monkeypatch)
    large, many = _posted(spark, _family(2000, 1), monkeypatch)
    assert set(small.values()) == {0} and set(large.values()) == {0}
    assert many <= 4.5 * few


@pytest.mark.parametrize("unit", [8, 384])
def test_families_match_brute_force(spark, monkeypatch, unit):
    """Several families, chains of drifting texts and texts that are nearly near, in blocks of eight entries."""
    monkeypatch.setattr(jaccard, "UNIT", unit)
    rng = random.Random(3)
    texts = _family(60, 1, 40) + _family(40, 2, 30) + _family(25, 3, 12)
    chain = [f"c{i}" for i in range(50)]
    for k in range(40):                                     # each near the one before, far from the first
        chain[k] = f"d{k}"
        texts.append(" ".join(chain))
    shared = [f"s{i}" for i in range(30)]
    for k in range(40):                                     # a common passage, not enough to link
        texts.append(" ".join(shared + [f"t{k}y{i}" for i in range(rng.choice([4, 9, 12, 20]))]))
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(df, words=3, percent=80).collect()}
    want = brute_components(list(range(len(texts))), [brute_set(t, 3) for t in texts], 80)
    assert [got[i] for i in range(len(texts))] == want
