"""Language ID, toxicity, permutation search, near vectors and the pipeline."""
import zlib

import numpy as np
import pytest

import corpus_pipeline
from forecastlake.llm import ann, language, near_vectors, toxicity
from forecastlake.llm.queries import QUERIES
from tests.llm.test_shingles_jaccard import brute_components, brute_set

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_language_accuracy_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_language_id"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(truth) and all(0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert all(held(r["doc_id"]) for r in out)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) >= 0.98
    assert np.mean([r["accepted"] for r in out]) >= 0.98


def plain_subwords(text):
    """Byte n-grams of words with a mark at both ends, but those of both marks, as buckets, in plain Python."""
    def mix(x):
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> shift)) * by % 2**64
        return x ^ (x >> 31)

    out, word = [], []
    for b in text.lower().encode() + b" ":
        if 97 <= b <= 122 or b >= 128:
            word.append(b + 1)
            continue
        if word:
            w = [1, *word, 1]
            for n in language.SIZES:
                for i in range(len(w) - n + 1):
                    g = w[i:i + n]
                    if g[0] == g[-1] == 1:
                        continue
                    h = g[0]
                    for c in g[1:]:
                        h = (h * 0x100000001B3 + c) % 2**64
                    out.append(mix((h + n) % 2**64) >> 50)
        word = []
    return sorted(out)


def test_language_model_matches_plain_recomputation():
    texts = ["", "a", "The cat", "Ça va, l'été?", "x1y2 z", "日本 ok", "  tabs\tand\nlines "]
    for text in texts:
        assert sorted(language.subwords(text).tolist()) == plain_subwords(text)
    rng = np.random.default_rng(3)
    rows = [(lang, *language.features(text), len(language.subwords(text)))
            for lang, words in (("en", ["the", "and", "of"]), ("fr", ["le", "une", "très"]))
            for text in (" ".join(rng.choice(words, 30)) for _ in range(60))]
    m = language.fit(rows)
    for text in ("the une and", "très le", "of"):
        found = plain_subwords(text)
        z = [sum(float(m.scores[b, k]) for b in found) / len(found) + float(m.bias[k]) for k in range(2)]
        e = np.exp((np.array(z) - max(z)) / m.temperature)
        p = e / e.sum()
        lang, score, accepted = m.predict(text)
        k = int(p.argmax())
        assert lang == m.langs[k] and score == pytest.approx(p[k], abs=1e-4)
        average = sum(float(m.known.log_p[b, k]) for b in found) / len(found)
        near = (average - m.known.mean[k]) / np.sqrt(m.known.between[k] + m.known.within[k] / len(found))
        assert accepted == (p[k] >= m.reject_below and near >= m.least_deviation)


def test_language_rejects_what_no_language_explains(spark):
    """Noise, code and languages left out go nine times in ten; 99 % of right predictions stay."""
    import random

    rng = random.Random(1)
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect() if r["text"] and r["lang"]]

    def rows(some):
        return [(d["lang"], *language.features(d["text"]), len(language.subwords(d["text"]))) for d in some]

    use, apart = [d for d in docs if not held(d["doc_id"])][:2500], [d for d in docs if held(d["doc_id"])][:1200]
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") + " " * (rng.random() < 0.2) for _ in range(rng.randrange(40, 600)))
             for _ in range(50)]
    noise += ["".join(rng.sample(d["text"][:1500], min(1500, len(d["text"])))) for d in apart[:50] if len(d["text"]) > 200]
    code = ["for (int i = 0; i < n; ++i) { buf[i] = fgetc(fp); if (buf[i] == EOF) return NULL; }\n",
            "def __init__(self, x):\n    self.x = np.zeros((3, 4), dtype=np.float32)\n",
            "SELECT a.id, count(*) FROM t1 a LEFT JOIN t2 b ON a.id = b.id WHERE b.x IS NULL GROUP BY 1;\n"]
    noise += [" ".join(rng.choices(code, k=4)) for _ in range(30)] + ["日本語の文章です。今日は天気がいいですね。" * 3]
    m = language.fit(rows(use))
    assert np.mean([m.predict(x)[2] for x in noise]) <= 0.1
    right = [a for d in apart for l, _, a in [m.predict(d["text"])] if l == d["lang"]]
    assert len(right) >= 0.98 * len(apart) and np.mean(right) >= 0.99
    for out in ("es", "de", "fr"):
        m = language.fit(rows([d for d in use if d["lang"] != out]))
        assert np.mean([m.predict(d["text"])[2] for d in apart if d["lang"] == out]) <= 0.1


def test_language_edges(spark):
    rows = [(1, "the the and", "en", 1.0), (2, "le la les", "fr", 1.0), (3, None, "en", 1.0), (4, "", None, 1.0), (5, "123 !?", "en", 1.0),
            (6, "é" * 100_000, None, 1.0), (7, "日本", None, 1.0), (None, "the the and", None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = language.train(df)
    got = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    assert len(got) == len(rows) and list(language.identify(df, model).columns) == ["doc_id", "text", "lang", "lang_pred", "score", "accepted"]
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["en", "fr", "und", "und", "und"]
    assert got[6]["lang_pred"] in ("en", "fr") and got[7]["lang_pred"] in ("en", "fr")
    assert language.train(df.limit(0)) is None
    assert {r["lang_pred"] for r in language.identify(df, None).collect()} == {"und"}
    assert language.identify(df.limit(0), model).collect() == []


def brute_segments(scores):
    """Maximal scoring segments by the recursive definition: the best one, then left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i:j + 1])
            if s > 1e-9 and (best is None or s > best[2] + 1e-9):
                best = (i, j, s)
    if best is None:
        return []
    i, j, _ = best
    left, right = brute_segments(scores[:i]), brute_segments(scores[j + 1:])
    return left + [best] + [(a + j + 1, b + j + 1, s) for a, b, s in right]


def test_segments_match_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = [float(x) + 0.001 * k if x > 0 else -1.0 for k, x in enumerate(rng.choice([-1, -1, -1, 0.6, 1.7, 2.9], 18))]
        got = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0], 1.0)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxicity_on_held_out_rows(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").collect()
    out = [r for r in rows if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    bad, good = [r for r in out if toxic[r["doc_id"]]], [r for r in out if not toxic[r["doc_id"]]]
    assert np.mean([r["predicted"] for r in bad]) >= 0.8
    assert np.mean([r["predicted"] for r in good]) <= 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, "fine words"), (2, None), (3, ""), (None, "fine words"), (1, "fine words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.words == {}
    got = toxicity.score_texts(docs.selectExpr("*", "'x' as score"), model).collect()
    assert len(got) == 5 and all(r["score"] < 0.7 and r["toxic_passages"] == [] for r in got)
    assert toxicity.score_texts(docs.limit(0), model).collect() == []
    model = toxicity.Model({"bad": 5.0}, 1.0, 2.0, -5.0, 4.0, -8.0)
    text = "clean " * 50_000 + "bad bad BAD " + "clean " * 10
    df = spark.createDataFrame([(text,)], "text string")
    r = toxicity.score_texts(df, model).first()
    assert r["score"] > 0.7 and [(p["first"], p["last"]) for p in r["toxic_passages"]] == [(50_000, 50_002)]


def test_toxicity_keeps_every_word_with_a_score(spark):
    def words(first, n=20_050):
        return " ".join(first + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(n))

    bad, good = words("x"), words("y")
    docs = spark.createDataFrame([(i, f"{good if i % 2 else bad} z{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(100)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id long, toxic int")
    assert len(toxicity.train(docs, labels).words) >= 20_050


def vectors(seed, n=700, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, 300, 3):                      # near copies and a large group of them
        x[k + 1] = x[k] + 0.03 * rng.normal(size=dim)
    x[400:520] = x[400] + 0.05 * rng.normal(size=(120, dim))
    x[600:620] = x[600]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(n, None), (n + 1, [0.0] * dim), (n + 2, [float("nan")] * dim), (n + 3, [None] * dim), (n + 4, []), (n + 5, [1.0, 2.0]),
           (n + 6, [float("inf")] + [1.0] * (dim - 1))]
    return x, rows + odd


def test_permutation_search_recall(spark):
    x, rows = vectors(4, 2_500)
    df = spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = ann.search(df, df.filter("vec_id % 100 = 0"), block=900, query_block=9, least=250, share=0.1).collect()
    hit = total = 0
    for q in range(0, 2_500, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = set(np.lexsort((np.arange(len(x)), d))[:10].tolist())
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, *_ in own] == list(range(1, 11)) and np.allclose([s for *_, s in own], d[[v for _, v, _ in own]])
        hit, total = hit + len(want & {v for _, v, _ in own}), total + 10
    assert hit / total >= 0.9
    copies = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 600), key=lambda r: r["rank"])]
    assert copies == list(range(601, 611))
    few = ann.search(df.filter("vec_id in (0, 100, 2500, 2501)"), df.filter("vec_id in (0, 2500)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 100)]
    assert ann.search(df.limit(0), df).collect() == []


def test_permutation_search_takes_the_most_common_length(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 8))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(60 + i, [1.0] * 12) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id in (0, 60)"), k=5).collect()
    d = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    d[0] = np.inf
    assert [(r["query_id"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(0, i) for i in np.argsort(d)[:5].tolist()]


@pytest.mark.parametrize("neighbours", [8, 3])
def test_near_vectors_match_brute_force(spark, neighbours):
    x, rows = vectors(5)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, kept long")
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df, neighbours=neighbours).collect()}
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    for _ in range(50):
        label = np.array([min(label[i], *label[linked[i]]) if linked[i].any() else label[i] for i in range(len(x))])
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= linked.sum(axis=1)).all() and found.sum() >= 0.99 * linked.sum()
    same = np.mean([got[i]["component_id"] == label[i] for i in range(len(x))])
    assert same >= 0.99
    for i, _ in rows[len(x):]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert near_vectors.near_duplicates(df.limit(0)).collect() == []


def check_near_vectors(spark, x):
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    for _ in range(50):
        label = np.array([min(label[i], *label[linked[i]]) if linked[i].any() else label[i] for i in range(len(x))])
    assert [got[i]["n_links"] for i in range(len(x))] == linked.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == label.tolist()


@pytest.mark.parametrize("noise", [0.0, 0.001])
def test_near_vectors_between_saturated_groups(spark, noise):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 24))
    a, b = x[0] / np.linalg.norm(x[0]), x[1] - x[1] @ x[0] / (x[0] @ x[0]) * x[0]
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b / np.linalg.norm(b)
    x[20:34], x[40:54] = a, b                       # more near (or exact) copies than a list holds, cosine 0.93 across
    x[20:54] += noise * rng.normal(size=(34, 24))
    check_near_vectors(spark, x)


def test_near_vectors_audit_counts_groups_once(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(240, 24))
    x[:80] = x[0] + 0.05 * rng.normal(size=(80, 24))   # a third in one group, found; then lone pairs, all lost
    x[80::2] = x[81::2] + 0.03 * rng.normal(size=(80, 24))
    rows = [(i, 1, 0 if i < 80 else i, [float(c) for c in v]) for i, v in enumerate(x)]
    placed = spark.createDataFrame(rows, "vec_id long, weight long, component long, vec array<double>")
    assert near_vectors.audit(placed, 0.9) < 0.05
    whole = placed.selectExpr("vec_id", "weight", "vec", "if(vec_id < 80, 0, vec_id - vec_id % 2) as component")
    assert near_vectors.audit(whole, 0.9) == 1.0
    found = {(min(r), max(r)) for r in near_vectors._all_bridges(placed, 0.9).collect()}
    assert found == {(i, i + 1) for i in range(80, 240, 2)}


def test_near_vectors_below_the_target_are_compared_all(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 24))
    x[::2] = x[1::2] + 0.08 * rng.normal(size=(150, 24))
    monkeypatch.setattr(near_vectors, "ROUNDS", 1)
    monkeypatch.setattr(near_vectors, "BLOCK", 2)       # a start that loses pairs
    monkeypatch.setattr(near_vectors, "EXACT_BLOCK", 128)
    check_near_vectors(spark, x)


def test_near_vectors_see_rare_links(spark):
    """Ten lone near pairs among 6,000 vectors: an audit of a result that lost nine is low, and none is lost."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(6_000, 16))
    x = x[(x / np.linalg.norm(x, axis=1, keepdims=True)).argsort(axis=0)[:, 0]]
    x[0:20:2] = x[1:20:2] + 0.02 * rng.normal(size=(10, 16))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = np.argwhere(np.triu(u @ u.T >= 0.96, 1))
    assert linked.tolist() == [[i, i + 1] for i in range(0, 20, 2)]
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    placed = spark.createDataFrame([(i, 1, 0 if i < 2 else i, v) for i, v in vectors],
                                   "vec_id long, weight long, component long, vec array<double>")
    assert near_vectors.audit(placed, 0.96) < 0.2
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = near_vectors.near_duplicates(df, threshold=0.96).filter("n_links > 0").collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(i, 1, i - i % 2) for i in range(20)]


def test_planted_partners_tell_a_search_that_finds_nothing(spark):
    rng = np.random.default_rng(13)
    placed = spark.createDataFrame([(i, 1, i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(80, 12)))],
                                   "vec_id long, weight long, component long, vec array<double>")
    planted = near_vectors.plant(placed, 0.9, 1 << 62, sample=40)
    by = {r["vec_id"]: np.array(r["vec"]) for r in placed.collect()}
    rows = planted.collect()
    for r in rows:
        cosine = by[r["origin"]] @ np.array(r["vec"]) / np.linalg.norm(by[r["origin"]]) / np.linalg.norm(r["vec"])
        assert 0.9 <= cosine <= 0.951
    none = spark.createDataFrame([], "vec_id long, id long")
    half = spark.createDataFrame([(r["vec_id"], r["origin"]) for r in rows[::2]], "vec_id long, id long")
    assert near_vectors.planted_recall(placed, planted, none) == 0.0
    assert near_vectors.planted_recall(placed, planted, half) == 0.5


def test_near_vectors_with_repeated_ids(spark):
    """Id 0 has two vectors, one equal to id 1's and one near id 2's; repeated rows change nothing."""
    rng = np.random.default_rng(14)
    a, b, c = rng.normal(size=(3, 12))
    rows = [(0, a), (0, b), (1, b), (2, a + 0.01 * rng.normal(size=12)), (3, c), (3, c), (4, np.zeros(12)), (0, a)]
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in rows], "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_duplicates(df).collect())
    assert got == [(0, 2, 0, True)] * 3 + [(1, 1, 0, False), (2, 1, 0, False), (3, 0, 3, True), (3, 0, 3, True), (4, 0, 4, True)]


def test_permutation_search_with_repeated_rows(spark):
    """Repeated query and candidate rows change nothing; vectors of one id are one candidate and one query."""
    rng = np.random.default_rng(15)
    x = rng.normal(size=(120, 8))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.filter("vec_id < 3")
    want = sorted(map(tuple, ann.search(df, asked, k=5).collect()))
    assert len(want) == 15
    assert sorted(map(tuple, ann.search(df.union(df.filter("vec_id < 60")), asked.union(asked), k=5).collect())) == want
    near = spark.createDataFrame([(50, [float(c) for c in x[0] + 1e-3])], df.schema)
    got = [r["vec_id"] for r in ann.search(df.union(near), df.filter("vec_id = 0"), k=5).orderBy("rank").collect()]
    assert got[0] == 50 and len(set(got)) == 5


def test_permutation_search_recall_at_its_defaults(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = {}
    for r in QUERIES["op8_permutation_search"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        recall.append(len(set(ids[np.lexsort((ids, d))[:10]].tolist()) & found[int(ids[q])]) / 10)
    assert len(found) == len(recall) and np.mean(recall) >= 0.99


def test_pipeline_run_matches_plain_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(texts) == docs.count()
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, toxicity.learn(spark, docs, SF)).collect()}
    clean = {i for i in texts if scores[i] < 0.7}
    left = docs.filter(docs["doc_id"].isin(sorted(clean)))
    accepted = {r["doc_id"]: r["accepted"] for r in language.identify(left, language.learn(left)).collect()}
    ids = sorted(i for i in clean if accepted[i])
    component = brute_components(ids, [brute_set(texts[i], 5) for i in ids], 80)
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert got == set(component)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in left.select("doc_id").collect()}
        out = stage(spark, left, SF)
        assert out.columns == docs.columns
        after = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert after <= before and len(after) >= 0.8 * len(before), name
        left = out
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "ngram_jaccard", "packing"]
