"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords: byte n-grams inside words
(a word is a run of ASCII letters and bytes above 127, lower-cased, with a mark at
both ends), hashed into buckets. Embeddings and the softmax layer are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows. Part of
the sample is kept apart to fit the softmax temperature and what is rejected: a
prediction that is too uncertain, and one whose text the language doesn't explain. A softmax
is sure of any text, so the latter is judged by the text's average log-probability among
the subwords of the predicted language, in standard deviations from what that
language's texts have at the text's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, column, held_out, ship
from .shingles import U, mix

BUCKETS, DIM, SIZES = 1 << 14, 16, (2, 3, 4)
#: Labelled rows that the model is fitted on, at most; taken by the smallest hash of the id.
SAMPLE_ROWS = 4_000
#: Share of right predictions that each rule may reject; rows kept apart that a rule needs.
LOSS, LEAST_APART = 0.001, 20
#: Share of wrong labels that the temperature reckons with.
DOUBT = 0.002

_MAP = np.zeros(256, dtype=np.uint8)
_MAP[97:123] = np.arange(97, 123)
_MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def subwords(text: str) -> np.ndarray:
    """Bucket of every subword of the whole text."""
    b = _MAP[np.frombuffer(b" " + text.lower().encode() + b" ", dtype=np.uint8)]
    space = b == 0
    b = b.astype(np.uint64) + U(1)
    out, h, gap = [], b, space
    inner = np.zeros(len(b), dtype=bool)       # a mark inside the n-gram
    for n in range(2, max(SIZES) + 1):
        h = h[:-1] * U(0x100000001B3) + b[n - 1:]
        both = space[:len(h)] & space[n - 1:]
        if n > 2:
            inner = inner[:len(h)] | space[n - 2:n - 2 + len(h)]
        else:
            inner = inner[:len(h)]
        if n in SIZES:
            out.append(h[~inner & ~both] + U(n))
    found = np.concatenate(out)
    return (mix(found) >> U(64 - 14)).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares of all subwords)."""
    counts = np.bincount(subwords(text), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, (counts[at] / max(1, counts.sum())).astype(np.float32)


@dataclass
class Familiarity:
    """How well each language explains a text's subwords."""

    log_p: np.ndarray        # buckets x languages
    mean: np.ndarray         # of texts' averages, by language
    within: np.ndarray       # variance of one subword
    between: np.ndarray      # variance of texts' averages, past what their length explains

    def deviations(self, average: np.ndarray, lang: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Standard deviations above the language's mean of texts with ``n`` subwords."""
        return (average - self.mean[lang]) / np.sqrt(self.between[lang] + self.within[lang] / np.maximum(n, 1))


def familiarity(rows, y: np.ndarray, langs: int) -> Familiarity:
    """From training rows (language, buckets, shares, subwords)."""
    counts = np.zeros((BUCKETS, langs))
    for (_, at, share, n), k in zip(rows, y):
        counts[at, k] += share * n
    # What a language never has is as likely as half a subword.
    p = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)
    log_p = np.log(p)
    within = (p * log_p ** 2).sum(axis=0) - (p * log_p).sum(axis=0) ** 2
    mean, between = np.zeros(langs), np.full(langs, 1e-4)
    for k in range(langs):
        own = [i for i in np.flatnonzero(y == k) if rows[i][3]]
        if own:
            average = np.array([rows[i][2] @ log_p[rows[i][1], k] for i in own])
            mean[k] = np.median(average)
            noise = np.mean([within[k] / rows[i][3] for i in own])
            between[k] = max(1e-4, average.var() - noise)
    return Familiarity(log_p.astype(np.float32), mean, within, between)


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray        # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    reject_below: float
    known: Familiarity
    least_deviation: float

    def predict(self, text: str) -> tuple[str, float, bool]:
        """(language, probability, accepted)."""
        idx = subwords(text)
        counts = np.bincount(idx, minlength=BUCKETS).astype(np.float32)
        z = (counts @ self.scores / max(1, len(idx)) + self.bias) / self.temperature
        p = softmax(z[None, :])[0]
        k = int(p.argmax())
        average = float(counts @ self.known.log_p[:, k]) / max(1, len(idx))
        near = self.known.deviations(np.array([average]), np.array([k]), np.array([len(idx)]))[0]
        return self.langs[k], float(p[k]), bool(p[k] >= self.reject_below and near >= self.least_deviation)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, int]], *, epochs: int = 30, rate: float = 20.0,
        batch: int = 32, seed: int = 5) -> Model | None:
    """``rows``: (language, buckets, shares, subwords). None without rows."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    langs = sorted({r[0] for r in rows})
    y = np.array([langs.index(r[0]) for r in rows])
    order = rng.permutation(len(rows))
    apart = order[:len(rows) // 5] if len(rows) >= 50 else order
    use = order[len(rows) // 5:] if len(rows) >= 50 else order
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)

    def hidden(k):
        return np.stack([rows[i][2] @ emb[rows[i][1]] for i in k])

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        use = rng.permutation(use)
        for a in range(0, len(use), batch):
            k = use[a:a + batch]
            x = hidden(k)
            g = softmax(x @ w + bias)
            g[np.arange(len(k)), y[k]] -= 1
            g /= len(k)
            back = g @ w.T
            w -= step * 0.05 * x.T @ g
            bias -= step * 0.05 * g.sum(axis=0)
            for i, gi in zip(k, back):
                emb[rows[i][1]] -= step * rows[i][2][:, None] * gi
    z, truth = hidden(apart) @ w + bias, y[apart]
    grid = np.geomspace(0.005, 20, 100)
    # Smoothed labels: where every row is right, the best temperature is still a finite one.
    soft = np.full(z.shape, DOUBT / len(langs))
    soft[np.arange(len(z)), truth] += 1 - DOUBT
    loss = [-(soft * np.log(softmax(z / t) + 1e-12)).sum(axis=1).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(z / t)
    hit = p.argmax(axis=1) == truth
    known = familiarity([rows[i] for i in use], y[use], len(langs))
    average = np.array([rows[i][2] @ known.log_p[rows[i][1], k] for i, k in zip(apart, truth)])
    near = known.deviations(average, truth, np.array([rows[i][3] for i in apart]))
    # Each rule rejects ``LOSS`` of the right predictions at most; few rows settle neither.
    enough = hit.sum() >= LEAST_APART and len(rows) >= 50
    at = int(LOSS * hit.sum())
    sure = np.sort(p.max(axis=1)[hit])
    reject = min(0.5, float(sure[at])) if enough else 0.0
    least = float(np.sort(near[hit])[at]) - 1.0 if enough else -np.inf
    return Model(langs, emb @ w, bias, t, reject, known, least)


def train(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most ``sample_rows`` rows whose language and text aren't null."""
    ship(labelled.sparkSession)
    rows = labelled.select(column(id_col).alias("id"), column(text_col).alias("text"), column(lang_col).alias("lang")) \
        .filter("text is not null and lang is not null")
    sample = bounded_sample(rows, "id", sample_rows, "text", "lang")

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                texts = part.column("text").to_pylist()
                found = [features(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()),
                     pa.array([f[1].tobytes() for f in found], pa.binary()),
                     pa.array([len(subwords(t)) for t in texts], pa.int64())], names=["lang", "at", "share", "n"])

    got = sample.repartition(8).mapInArrow(run, "lang string, at binary, share binary, n long").collect()
    rows = [(r["lang"], np.frombuffer(r["at"], "<i4"), np.frombuffer(r["share"], np.float32), r["n"]) for r in got]
    return fit(sorted(rows, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes())))


def identify(df: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows with lang_pred, score and accepted.

    ``und`` with score 0: a null text, one without a letter, or no model (nothing to
    learn from). ``accepted`` is false for a text without a letter, below the calibrated
    score, and where the predicted language doesn't explain the text's subwords; without
    a model, or with one of fewer than 50 rows, only texts without a letter are rejected.
    Repeated rows are predicted each; an empty table gives an empty result. Input
    columns of these names are replaced, others are kept.
    """
    ship(df.sparkSession)
    keep = [c for c in df.columns if c not in ("lang_pred", "score", "accepted")]
    shared = df.sparkSession.sparkContext.broadcast(model)
    text_at = keep.index(text_col)

    def run(batches):
        import regex

        letter, m = regex.compile(r"\p{L}"), shared.value
        for batch in batches:
            for at in range(0, len(batch), 512):      # few texts are Python objects at once
                b = batch.slice(at, 512)
                texts = b.column(text_at).to_pylist()
                known = [bool(t and letter.search(t)) for t in texts]
                found = [m.predict(t) if m and k else ("und", 0.0, k) for t, k in zip(texts, known)]
                langs, scores, accepted = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                    names=[*b.schema.names, "lang_pred", "score", "accepted"])

    rows = df.select(*[column(c) for c in keep])
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame) -> Model | None:
    """From rows that aren't held out."""
    return train(docs.filter(~held_out("doc_id")))


def op4_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the columns of ``docs``.

    Null texts and texts without a letter go; repeated rows and rows without an id are judged
    each; an empty table gives an empty result.
    """
    return identify(docs, learn(docs)).filter("accepted").select(*[column(c) for c in docs.columns])
