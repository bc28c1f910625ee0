"""Spelling variants against brute force."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from forecastlake.llm import spelling
from forecastlake.llm.fm_index import Index, rotation_order


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    near = {w: [x for x in counts if is_near(w, x)] for w in counts}
    best = {w: min(near[w], key=lambda x: (-counts[x], x)) if near[w] else None for w in counts}
    form = {w: b if b and counts[b] >= ratio * counts[w] else None for w, b in best.items()}
    rows = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def test_rotations_are_sorted():
    for text in ([0], [0, 1, 0], [0] + [1] * 200 + [0], [0, 2, 1, 0, 2, 1, 1, 0]):
        t = np.array(text)
        want = sorted(range(len(t)), key=lambda i: np.roll(t, -i).tolist())
        assert rotation_order(t).tolist() == want
    with pytest.raises(ValueError):
        rotation_order(np.array([0, 1] * 70))


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\xe9", b"a"])
def test_search_scheme_finds_each_half(alphabet):
    rng = random.Random(5)
    for size in (1, 4, 150):
        words = sorted({bytes(rng.choice(alphabet) for _ in range(rng.randrange(2, 10))) for _ in range(size)})
        index = Index(words)
        for mirrored in (False, True):
            h = [len(w) - len(w) // 2 if mirrored else len(w) // 2 for w in words]
            got = {(i, j) for q, w in index.one_error(words, np.array(h), mirrored) for i, j in zip(q.tolist(), w.tolist())}
            same = (lambda a, b, k: b.endswith(a[len(a) - k:])) if mirrored else (lambda a, b, k: b.startswith(a[:k]))
            assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words)
                           if is_near(a, b) and same(a, b, h[i])}


def test_symbols_that_the_index_lacks():
    got = list(Index([b"abcd", b"abce"]).one_error([b"abzd", b"zzzz", b"abcdz"], np.array([2, 2, 2])))
    assert {(int(i), int(j)) for q, w in got for i, j in zip(q, w)} == {(0, 0), (2, 0)}


@pytest.mark.parametrize("block_chars,piece_queries", [(200_000, 50_000), (300, 7)])
def test_variants_match_brute_force(spark, block_chars, piece_queries):
    rng = random.Random(8)
    base = ["wordlike", "wordlikes", "öffnungen", "maisonné", "aaaaaaa", "aaaaaaaa", "abababab"]
    words = set(base)
    for w in base:
        for _ in range(25):
            i, c = rng.randrange(len(w)), rng.choice("abelö")
            words.add(rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]]))
    words |= {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(150)} | {"q" * 3000, "q" * 3001}
    counts = {w: rng.choice([2, 3, 30, 400, 5000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.spelling_variants(df, block_chars=block_chars, piece_queries=piece_queries)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == brute(counts)


def test_roots_follow_long_chains(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("w11", None), ("x", "w3")],
                               "word string, form string")
    assert {r.word: r.root for r in spelling.roots(df).collect()} == {**{f"w{i}": "w11" for i in range(11)}, "x": "w11"}


def brute_count(rows):
    n = Counter()
    for doc, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def test_words_are_counted(spark):
    rng = random.Random(4)
    rows = [(None, "Überall wordlike WORDLIKE"), (None, "Überall wordlike WORDLIKE"), (1, None), (2, ""),
            (3, "z" * 40_000 + " " + "z" * 40_000), (4, "ÉCOLIERS écoliers Écoliers ÉCOLIERS İstanbul ÿÿÿÿÿÿÿ×÷")]
    rows += [(i, " ".join("".join(rng.choice("Abé") for _ in range(rng.randrange(5, 9))) for _ in range(300)))
             for i in range(10, 40)]
    df = spark.createDataFrame([(*r, "w", 1, "i") for r in rows], "doc_id long, text string, word string, n int, id string")
    got = spelling.count_words(df)
    assert {r.word: r.n for r in got.collect()} == brute_count(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(spelling.count_words(df)).collect() == []
