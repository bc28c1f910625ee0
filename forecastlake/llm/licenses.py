"""License scans: ordered signature rules behind a keyword automaton.

Texts are normalised in numpy (words in lower case, one space between them). One
Aho-Corasick pass finds which keywords a text holds; only their rules' regexes run.
Detections are taken in order of the rules, longer ones first: one whose interval of
words lies inside the interval of a detection taken before is suppressed. Base phrases
are found by the same pass and always stay.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, ship
from .license_rules import BASE, BASE_CONFIDENCE, Rule, _rule, rules

#: Bytes of text normalised at once.
CHUNK = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True

DETECTION = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("confidence", T.DoubleType()),
    T.StructField("base", T.BooleanType())])
_ARROW = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                             ("confidence", pa.float64()), ("base", pa.bool_())]))


def normalised(texts: pa.Array):
    """(words, text) of each text: `` w1 w2 ... wn ``; nulls are empty."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = i + 1
        while j < len(texts) and off[j + 1] - off[i] <= CHUNK:
            j += 1
        parts = []
        for k in range(i, j):
            parts += [data[off[k]:off[k + 1]], np.array([32], np.uint8)]
        low = _LOWER[np.concatenate(parts)]
        word = _WORD[low]
        before = np.concatenate([[False], word[:-1]])
        space = before & ~word
        keep = np.flatnonzero(word | space)
        out = np.where(word[keep], low[keep], 32).astype(np.uint8).tobytes()
        ends = off[i + 1:j + 1] - off[i] + np.arange(1, j - i + 1)
        to = np.searchsorted(keep, ends)
        count = np.searchsorted(np.flatnonzero(space), ends)
        for a, z, m, n in zip([0, *to[:-1].tolist()], to.tolist(), [0, *count[:-1].tolist()], count.tolist()):
            yield n - m, " " + out[a:z].decode()
        i = j


class Scanner:
    """All rules behind one automaton of their keywords."""

    def __init__(self, ordered: list[Rule], base: dict[str, str]):
        import ahocorasick

        self.rules = [_rule(label, BASE_CONFIDENCE, phrase, phrase) for phrase, label in base.items()] + ordered
        self.base = len(base)
        wanted: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for word in rule.keyword.split("/"):
                wanted.setdefault(word, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for word, ids in wanted.items():
            self.automaton.add_word(word, ids)
        self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[str, int, int, float, bool]]:
        """Detections (label, first word, last word, confidence, base) of a normalised text, by first word."""
        gated = {id(ids): ids for _, ids in self.automaton.iter(text)}
        if not gated:
            return []
        spaces = None
        found = []
        for k in sorted({k for ids in gated.values() for k in ids}):
            for m in self.rules[k].pattern.finditer(text):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 32)
                first, last = np.searchsorted(spaces, [m.start(), m.end()]) - 1
                found.append((k, int(first), int(last)))
        base = [x for x in found if x[0] < self.base]
        kept = base + suppress([x for x in found if x[0] >= self.base])
        return sorted((self.rules[k].label, a, z, self.rules[k].confidence, k < self.base) for k, a, z in kept)


def suppress(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections (rule, first, last) that lie inside none of a rule before theirs, or a longer one of theirs.

    Taken in order of the rules, longer ones first. Kept intervals none of which holds
    another are in one order by both ends, so each test looks at two neighbours.
    """
    import bisect

    kept, firsts, lasts = [], [], []
    for k, a, z in sorted(found, key=lambda x: (x[0], x[1] - x[2], x[1])):
        at = bisect.bisect_right(firsts, a)
        if at and lasts[at - 1] >= z:        # the greatest end among intervals that begin at or before a
            continue
        kept.append((k, a, z))
        # Intervals inside the new one can hold nothing that it doesn't: they leave the staircase.
        to = at
        while to < len(firsts) and lasts[to] <= z:
            to += 1
        if at and firsts[at - 1] == a:
            at -= 1
        firsts[at:to], lasts[at:to] = [a], [z]
    return kept


@functools.lru_cache(1)
def scanner() -> Scanner:
    return Scanner(rules(), BASE)


def scan_licenses(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All rows with n_words and licenses (label, first and last word, confidence, base) of the whole text.

    A null or empty text has no words and no licenses. Repeated rows are scanned each;
    an empty table gives an empty result. Input columns of these names are replaced,
    others are kept.
    """
    ship(df.sparkSession)
    keep = [c for c in df.columns if c not in ("n_words", "licenses")]
    text_at = keep.index(text_col)

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                count, found = [], []
                for n, text in normalised(part.column(text_at)):
                    count.append(n)
                    found.append([dict(zip(DETECTION.names, x)) for x in scanner().scan(text)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(count, pa.int64()), pa.array(found, _ARROW)],
                                                 names=[*part.schema.names, "n_words", "licenses"])

    rows = df.select(*[column(c) for c in keep])
    schema = T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("licenses", T.ArrayType(DETECTION))])
    return rows.mapInArrow(run, schema)


def license_digest(scanned: DataFrame) -> DataFrame:
    """The rows of ``scan_licenses`` with n_base, first_word, last_word, base_labels, labels and score.

    The score is 1 - product of (1 - confidence) over labels, each by its best detection.
    """
    base = F.filter("licenses", lambda x: x["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    best = F.transform(F.array_distinct(F.transform("licenses", lambda x: x["label"])), lambda name: F.array_max(F.transform(
        F.filter("licenses", lambda x: x["label"] == name), lambda x: x["confidence"])))
    return scanned.select(
        "*", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels("licenses").alias("labels"),
        F.aggregate(best, F.lit(0.0), lambda acc, c: acc + c - acc * c).alias("score"))


def op12_license_scans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_digest(scan_licenses(docs)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
