"""Toxic passages: maximum-scoring segments over word log-odds.

A word's score is the lower confidence bound of its log-odds between toxic and
clean texts under a Dirichlet prior proportional to the counts of the labelled sample
(not of all documents); every word with a score is kept, every other word costs ``drift``. One linear scan finds all maximal scoring segments of a text. For
segments of independent words of a clean text, the highest score follows an extreme
value law, P(S >= x) = 1 - exp(-K n e^(-lambda x)): lambda solves
sum p e^(lambda s) = 1, K is fitted on clean texts kept apart. A text's evidence is
the sum of lambda S - ln(K n) over its segments where that is positive; a logistic
curve fitted on the rows kept apart turns it into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, column, held_out, materialise, ship

#: Labelled rows that are learned from, at most; taken by the smallest hash of the id.
SAMPLE_ROWS = 40_000
#: Prior texts for each text; standard deviations taken off a word's log-odds, of
#: which the rows kept apart choose: few labels need a bold lexicon, many a strict one.
PRIOR, DEVIATIONS = 0.5, (2.0, 3.0, 4.0)
SIGNIFICANT = 0.05

_WORD = re.compile(r"[^\W\d_]+")


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in linear time.

    ``hits``: positions and scores above zero, in order; every word between costs ``drift``.
    """
    found: list[list] = []     # first, last, sum before, sum at the end, link to an earlier one
    total, last = 0.0, -1
    for at, score in hits:
        total -= drift * (at - last - 1)
        last = at
        now = [at, at, total, total + score]
        total += score
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= now[2]:
                k = found[k][4]
            if k < 0 or found[k][3] >= now[3]:
                found.append([*now, k])
                break
            now = [found[k][0], now[1], found[k][2], now[3]]
            del found[k:]
    return [(a, b, r - l) for a, b, l, r, _ in found]


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    drift: float = 1.0
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    level: float = -20.0

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of words, maximal segments)."""
        tokens = _WORD.findall(text.lower())
        if self.words.keys().isdisjoint(tokens):
            return len(tokens), []
        get = self.words.get
        return len(tokens), segments([(i, s) for i, w in enumerate(tokens) if (s := get(w))], self.drift)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        floor = self.log_k + math.log(max(1, n))
        return sum(max(0.0, self.lam * s - floor) for _, _, s in found)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The probability of label 1, and the significant passages (first word, last word, E-value)."""
        n, found = self.scan(text)
        z = self.level + self.slope * math.log1p(self.evidence(n, found))
        e = [(a, b, math.exp(min(50.0, self.log_k + math.log(max(1, n)) - self.lam * s))) for a, b, s in found]
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z)))), [x for x in e if x[2] <= SIGNIFICANT]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, toxic, clean): texts of each label that hold the word, counted before the shuffle."""
    def run(batches):
        counts = (Counter(), Counter())

        def flush():
            words = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())]
                + [pa.array([counts[y][w] for w in words], pa.int64()) for y in (1, 0)],
                names=["word", "toxic", "clean"])
            counts[0].clear()
            counts[1].clear()
            return out

        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                counts[y].update(set(_WORD.findall(text.lower())))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield flush()
        yield flush()

    return texts.mapInArrow(run, "word string, toxic long, clean long") \
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled documents; equal texts count once.

    Without labelled rows of both classes nothing is toxic: the lexicon is empty.
    """
    ship(docs.sparkSession)
    ids = labels.select(column(id_col).alias("id"), F.col("toxic")).filter("id is not null and toxic is not null") \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    ids = bounded_sample(ids, "id", sample_rows)
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).filter("text is not null")
    # The sample is bounded by sample_rows, 16 bytes each.
    texts = rows.join(F.broadcast(ids), "id").groupBy("text").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    texts = materialise(texts, "toxicity-texts").withColumn("apart", F.pmod(F.xxhash64("text"), F.lit(5)) == 0)
    counts = materialise(word_counts(texts.filter("not apart")), "toxicity-words")
    n1, n0 = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n1 or not n0:
        return Model()
    n = n1 + n0
    scored = counts.withColumn("prior", PRIOR * (F.col("toxic") + F.col("clean")))
    a, b = F.col("toxic") + F.col("prior"), F.col("clean") + F.col("prior")
    odds = F.log(a / (n1 + PRIOR * n - a)) - F.log(b / (n0 + PRIOR * n - b))
    error = F.sqrt(1 / a + 1 / b)
    scored = scored.select("word", odds.alias("odds"), error.alias("error"), (b / (n0 + PRIOR * n)).alias("share"),
                           (odds - min(DEVIATIONS) * error).alias("score")).filter("score > 0")
    lexicon = scored.orderBy(F.desc("score"), "word").collect()
    models = [_model(lexicon, d) for d in DEVIATIONS]
    return _calibrate([m for m in models if m.words], texts.filter("apart"))


def _model(lexicon, deviations: float) -> Model:
    kept = [(r["word"], r["odds"] - deviations * r["error"], r["share"]) for r in lexicon
            if r["odds"] > deviations * r["error"]]
    model = Model({w: s for w, s, _ in kept})
    if kept:
        s, p = np.array([x[1] for x in kept]), np.array([x[2] for x in kept])
        p = p * min(1.0, 0.5 / p.sum())
        model.drift = max(1.0, 2 * float(s @ p) / (1 - float(p.sum())))
        model.lam = _root(lambda x: float(p @ np.exp(x * s)) + (1 - p.sum()) * math.exp(-x * model.drift) - 1)
    return model


def _root(f) -> float:
    """The positive root of a convex function that falls from 0 at 0 first."""
    hi = 1e-3
    while f(hi) < 0 and hi < 64:
        hi *= 2
    lo = hi / 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _calibrate(models: list[Model], texts: DataFrame) -> Model:
    """The model that fits the rows kept apart best, with its K and logistic curve."""
    shared = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for b in batches:
            rows = []
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                for k, m in enumerate(shared.value):
                    n, found = m.scan(text)
                    rows.append((k, y, n, [s for _, _, s in found]))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())))],
                names=["model", "toxic", "n", "scores"])

    rows = texts.select("text", "toxic").mapInArrow(run, "model int, toxic int, n long, scores array<double>").collect()
    rows.sort(key=lambda r: (r["model"], r["toxic"], r["n"], r["scores"]))
    best, lowest = Model(), math.inf
    for k, model in enumerate(models):
        own = [r for r in rows if r["model"] == k]
        clean = [r for r in own if not r["toxic"]]
        # Maximum likelihood of K for exp(-K n e^(-lambda S)), S the highest score of a clean text.
        mass = sum(max(1, r["n"]) * math.exp(-model.lam * max(r["scores"], default=0.0)) for r in clean)
        model.log_k = math.log(max(1, len(clean)) / max(mass, 1e-9))
        x = np.log1p([model.evidence(r["n"], [(0, 0, s) for s in r["scores"]]) for r in own])
        y = np.array([r["toxic"] for r in own], dtype=float)
        model.slope, model.level = _logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.level, -30, 30)))
        loss = -np.log(np.where(y > 0, p, 1 - p) + 1e-12).mean() if len(y) else 0.0
        if loss < lowest:
            best, lowest = model, loss
    return best


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and level by Newton steps; the ridge keeps separable classes finite."""
    d = np.stack([x, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
        h = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(2)
        step = np.linalg.solve(h, d.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def score_texts(df: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """All rows with score, toxic_passages (first and last word, E-value) of the whole text.

    A null or empty text has no words and gets the score of no evidence. Repeated
    rows are scored each; an empty table gives an empty result. Input columns of
    these names are replaced, others are kept.
    """
    ship(df.sparkSession)
    keep = [c for c in df.columns if c not in ("score", "toxic_passages")]
    shared = df.sparkSession.sparkContext.broadcast(model)
    text_at = keep.index(text_col)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("e_value", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [shared.value.score(t or "") for t in b.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([s for s, _ in found], pa.float64()),
                 pa.array([[dict(zip(("first", "last", "e_value"), x)) for x in p] for _, p in found], kind)],
                names=[*b.schema.names, "score", "toxic_passages"])

    rows = df.select(*[column(c) for c in keep])
    passage = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
                            T.StructField("e_value", T.DoubleType())])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("toxic_passages", T.ArrayType(passage))])
    return rows.mapInArrow(run, schema)


def learn(spark, docs: DataFrame, sf_dir: str) -> Model:
    """From labelled rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id"))
    return train(docs, labels)


def op10_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_texts(docs, learn(spark, docs, sf_dir))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         F.size("toxic_passages").alias("passages"))


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; the columns of ``docs``."""
    scored = score_texts(docs, learn(spark, docs, sf_dir))
    return scored.filter("score < 0.7").select(*[column(c) for c in docs.columns])
