"""N-gram Jaccard join: grouped prefix join, down to connected components.

Order all shingles by how many texts hold them, rare ones first. Two sets that are
similar enough share a shingle of their prefixes, the first
n - ceil(t n) + 1 in that order; a shingle that one text alone holds can't be it.

1. Texts are dealt into blocks, which count their distinct shingles before the
   shuffle; buckets of the hash range add the counts up and answer each block
   (about six bytes for each distinct shingle of a block, one byte back).
2. Blocks cut the prefixes. Texts whose prefix has no shared shingle are done.
3. Equal sets become one; sets with an identical prefix and size form a group.
   For each prefix shingle, pairs of groups that can reach the overlap by size and
   position are kept, then expanded to members, whose binned counts bound the
   overlap from above.
4. Members are verified by their exact sets, along a spanning forest of the candidates
   of each block of a shingle's list, then along one of a few members of each component
   that a list still holds, and at last all candidates that still lie in different
   components, for pairs of blocks of those lists only. Pairs that links connect
   anyway aren't compared, so a family of near copies costs its size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, hashable, materialise, ship
from .components import connected_components
from .shingles import U, mix, sets_of

BLOCK_CHARS, BUCKET_CHARS = 4_000_000, 8_000_000
BINS, UNIT = 256, 384
#: Members of a component that stand for it in a shingle's list.
PICKS = 4


def needed(n1, n2, percent: int):
    """Least overlap of two sets that are similar enough."""
    return -(-percent * (n1 + n2) // (100 + percent))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash, in its order."""
    return ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _block_sets(table: pa.Table, words: int):
    """Sets of a block's texts, its distinct shingles, and each one's place among them."""
    sets = sets_of(table.column("text").combine_chunks(), words) if len(table) else []
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    distinct, place, count = np.unique(every, return_inverse=True, return_counts=True)
    return sets, distinct, place, count


def _counts(words: int, buckets: int):
    def run(key, table):
        _, distinct, _, count = _block_sets(table, words)
        cut = np.searchsorted(_bucket(distinct, buckets), np.arange(buckets + 1))
        # Six of the eight bytes: the order needs no more, and a clash only blurs it.
        short = (distinct >> U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        count = np.minimum(count, 255).astype(np.uint8)
        used = [k for k in range(buckets) if cut[k] < cut[k + 1]]
        return pa.table({
            "block": pa.array([key[0].as_py()] * len(used), pa.int64()), "bucket": pa.array(used, pa.int64()),
            "keys": pa.array([short[cut[k]:cut[k + 1]].tobytes() for k in used], pa.binary()),
            "counts": pa.array([count[cut[k]:cut[k + 1]].tobytes() for k in used], pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each block's shingles of a bucket: 0 if one text alone holds it, else a rising code of the count."""
    raw = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in table.column("keys").to_pylist()]
    keys = np.zeros((sum(map(len, raw)), 8), np.uint8)
    keys[:, :6] = np.concatenate(raw)
    count = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()])
    _, place = np.unique(keys.view("<u8").ravel(), return_inverse=True)
    total = np.bincount(place, weights=count)
    code = np.minimum(255, np.floor(8 * np.log2(total))).astype(np.uint8)[place]
    ends = np.cumsum([len(x) for x in raw])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "codes": pa.array([code[b - len(x):b].tobytes() for b, x in zip(ends, raw)], pa.binary())})


_PREFIX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                     ("lead", pa.int64()), ("prefix", pa.list_(pa.int64())), ("bins", pa.binary()),
                     ("shingles", pa.list_(pa.int64()))])


def _prefixes(words: int, percent: int):
    def run(texts, answers):
        sets, distinct, place, _ = _block_sets(texts, words)
        order = np.argsort(answers.column("bucket").to_numpy()) if len(answers) else []
        codes = answers.column("codes").to_pylist() if len(answers) else []
        code = np.frombuffer(b"".join(codes[k] for k in order), np.uint8)[place] if len(place) else place
        out, at = [], 0
        for doc, s in zip(texts.column("doc_id").to_pylist(), sets):
            own, n, at = code[at:at + len(s)], len(s), at + len(s)
            size = n - -(-percent * n // 100) + 1
            lead = int((own == 0).sum())
            k1 = int(s.sum(dtype=np.uint64).view(np.int64)) if n else 0
            k2 = int(np.bitwise_xor.reduce(s * U(0x9E3779B97F4A7C15) ^ (s >> U(29))).view(np.int64)) if n else 0
            if n == 0 or lead >= size or doc is None:
                out.append((doc, n, k1, k2, lead, [], None, None))
                continue
            shared = np.flatnonzero(own)
            first = shared[np.lexsort((s[shared], own[shared]))[:size - lead]]
            bins = np.minimum(np.bincount((s & U(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)
            out.append((doc, n, k1, k2, lead, s[first].view(np.int64), bins.tobytes(), s.view(np.int64)))
        cols = list(zip(*out)) if out else [()] * len(_PREFIX)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PREFIX)], schema=_PREFIX)

    return run


class Unit:
    """The sets that have one shingle in their prefixes (or two blocks of them)."""

    def __init__(self, pdf, percent: int):
        self.rep = pdf["rep"].to_numpy()
        self.n = pdf["n"].to_numpy()
        self.at = pdf["at"].to_numpy()
        self.group = pdf["grp"].to_numpy()
        self.block = pdf["block"].to_numpy()
        self.bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), BINS).astype(np.int16)
        self.percent = percent

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """(may they be similar, how far apart their bins are) for all pairs of the unit."""
        # Pairs of groups: size and position.
        _, one, of = np.unique(self.group, return_index=True, return_inverse=True)
        n, at = self.n[one], self.at[one]
        need = needed(n[:, None], n[None, :], self.percent)
        reach = np.minimum(at[:, None], at[None, :]) + 1 + np.minimum((n - at)[:, None], (n - at)[None, :]) - 1
        fits = (100 * np.minimum(n[:, None], n[None, :]) >= self.percent * np.maximum(n[:, None], n[None, :])) & (reach >= need)
        # Members: the bins' distance is at most the number of shingles that only one of two has.
        far = np.full((len(self.n), len(self.n)), 1 << 30, dtype=np.int64)
        most = (n[:, None] + n[None, :] - 2 * need)[of][:, of]
        open_ = fits[of][:, of]
        for i in range(len(self.n)):
            j = np.flatnonzero(open_[i, i + 1:]) + i + 1
            if len(j):
                far[i, j] = far[j, i] = np.abs(self.bins[j] - self.bins[i]).sum(axis=1)
        ok = far <= most
        if self.block.min() != self.block.max():
            ok &= self.block[:, None] != self.block[None, :]
        return ok, far

    def forest(self) -> list[tuple[int, int]]:
        """Edges of the least spanning forest of the candidates (Prim).

        Equal distances are told apart by a hash of the pair, so there is one least
        forest, and units that hold the same sets name the same pairs.
        """
        ok, far = self.candidates()
        none = np.int64(2**62)
        one, two = self.rep[:, None].astype(np.uint64), self.rep[None, :].astype(np.uint64)
        tie = mix(np.minimum(one, two) * U(0x9FB21C651E98DF25) + np.maximum(one, two)) >> U(33)
        cost = np.where(ok, (far << 31) + tie.astype(np.int64), none)
        left, best, parent = np.ones(len(self.n), bool), np.full(len(self.n), none), np.full(len(self.n), -1)
        out = []
        while left.any():
            i = int(np.where(left, best, np.int64(2**63 - 1)).argmin())
            left[i] = False
            if best[i] < none:
                out.append((self.rep[i], self.rep[parent[i]]))
            nearer = left & (cost[i] < best)
            best[nearer], parent[nearer] = cost[i][nearer], i
        return out

    def across(self, component: np.ndarray) -> list[tuple[int, int]]:
        """All candidates whose components differ."""
        ok, _ = self.candidates()
        i, j = np.nonzero(np.triu(ok & (component[:, None] != component[None, :])))
        return list(zip(self.rep[i], self.rep[j]))


def _pairs(postings: DataFrame, bundles: int, percent: int, rest: bool) -> DataFrame:
    """Distinct candidate pairs (a < b): along a forest, or the rest across components."""
    import pandas as pd

    def run(pdf):
        a, b = [], []
        for _, g in pdf.groupby(["token", "lo", "hi"], sort=False):
            if len(g) < 2 or rest and g["component"].nunique() < 2:
                continue
            unit = Unit(g, percent)
            for x, y in unit.across(g["component"].to_numpy()) if rest else unit.forest():
                a.append(min(x, y))
                b.append(max(x, y))
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)}).drop_duplicates()

    unit = F.struct("token", "lo", "hi")
    return postings.withColumn("bundle", F.pmod(F.xxhash64(unit), F.lit(bundles))) \
        .groupBy("bundle").applyInPandas(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar by their exact sets."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _bundles(postings: DataFrame) -> int:
    return 1 + math.ceil(postings.count() / 4_000)


def _edges(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("id").alias("a"), F.col("component").alias("b"))


def _components_of(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of each ``rep``, its own where nothing links it."""
    return rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))


def _picked(listed: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of a few members of each component of several members, in lists of several blocks
    that hold two such components at least."""
    own = _components_of(listed.filter("blocks > 1").select("token", "rep"), labels)
    picks = [F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(PICKS)]
    few = own.groupBy("token", "component").agg(F.count("*").alias("members"), F.array_distinct(F.array(*picks)).alias("reps")) \
        .filter("members > 1")
    wanted = few.groupBy("token").agg(F.count("*").alias("components"), F.sum(F.size("reps")).alias("size")).filter("components > 1") \
        .select("token", F.ceil(F.col("size") / float(UNIT)).cast("int").alias("blocks"))
    reps = few.join(wanted, "token").select("token", "blocks", F.explode("reps").alias("rep"))
    rows = listed.drop("block", "blocks").join(reps, ["token", "rep"]) \
        .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(PICKS)), F.col("blocks")).cast("int"))
    return materialise(rows.withColumns({"lo": F.col("block"), "hi": F.col("block")}), "picked")


def similar_groups(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                   percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each input row.

    Two texts link when 100 * intersection >= percent * union of their sets of
    distinct word shingles; component_id is the smallest id that links reach. A null
    text or one without words has an empty set and links with nothing; so does a row
    with a null id, whose component is null. Rows of one id share a component. Equal
    texts link; an empty table gives no rows; other input columns are left out.
    """
    spark = df.sparkSession
    ship(spark)
    docs = df.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks, buckets = 1 + chars // BLOCK_CHARS, 1 + chars // BUCKET_CHARS
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.char_length("text")), F.lit(blocks)))
    counts = dealt.groupBy("block").applyInArrow(
        _counts(words, buckets), "block long, bucket long, keys binary, counts binary")
    answers = counts.groupBy("bucket").applyInArrow(_answer, "block long, bucket long, codes binary")
    cut = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _prefixes(words, percent), "doc_id long, n long, k1 long, k2 long, lead long, "
                                   "prefix array<long>, bins binary, shingles array<long>")
    cut = materialise(cut, "prefixes", "zstd")

    open_ = cut.filter(F.size("prefix") > 0)
    sets = materialise(open_.groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("lead", "prefix", "bins", "shingles")]), "sets", "zstd")
    # Entries stay narrow; the bins join them by set where they are compared.
    entries = sets.select("rep", "n", F.xxhash64("n", "prefix").alias("grp"), "lead", F.posexplode("prefix").alias("pos", "token"))
    entries = entries.select("rep", "n", "grp", "token", (F.col("lead") + F.col("pos")).alias("at"))
    bins = sets.select("rep", "bins")
    # A shingle's list is taken in blocks.
    lists = entries.groupBy("token").agg(F.ceil(F.count("*") / float(UNIT)).cast("int").alias("blocks"), F.count("*").alias("entries")) \
        .filter("entries > 1").drop("entries")
    listed = materialise(entries.join(lists, "token")
                         .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "postings")
    inside = listed.withColumns({"lo": F.col("block"), "hi": F.col("block")})
    bundles = _bundles(listed)
    first = materialise(_verify(_pairs(inside.join(bins, "rep"), bundles, percent, False), sets, percent), "links")
    labels = materialise(connected_components(first), "labels")

    picked = _picked(listed, labels)
    second = materialise(_verify(_pairs(picked.join(bins, "rep"), _bundles(picked), percent, False), sets, percent), "links")
    labels = materialise(connected_components(_edges(labels).union(second)), "labels")

    open_lists = _components_of(listed.select("token", "rep"), labels).groupBy("token") \
        .agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("token")
    # Each pair of blocks of a list that holds several components is a unit of its own.
    across = listed.join(open_lists, "token").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")
    rest = _pairs(_components_of(across, labels).join(bins, "rep"), bundles, percent, True)
    rest = materialise(_verify(rest, sets, percent), "links")
    labels = connected_components(_edges(labels).union(rest))

    of_set = sets.select("k1", "k2", "n", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    linked = open_.select("doc_id", "n", "k1", "k2").join(of_set, ["k1", "k2", "n"]) \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = cut.filter(F.size("prefix") == 0).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def op1_ngram_jaccard(spark, sf_dir):
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=90)


def _row_key(docs: DataFrame):
    """A hash of the whole row; nulls count, so equal keys mean equal rows."""
    cols = hashable(docs)
    return F.xxhash64(*[column(c) for c in cols], *[column(c).isNull() for c in cols])


def jaccard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the smallest id (null ids last), ties by a
    hash of the row; of identical rows one. The columns of ``docs``.

    Five-word shingles, similarity of 0.8 or more. Groups are of rows, whatever their
    ids: a row without an id or with another row's id stays if its text is like no other's.
    """
    key = _row_key(docs)
    groups = similar_groups(docs.select(key.alias("doc_id"), column("text").alias("text"))) \
        .select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    rows = docs.select(key.alias("row_key"), "doc_id").groupBy("row_key") \
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "copies")).alias("first")
    kept = materialise(groups.join(rows, "row_key").groupBy("component_id").agg(first)
                       .select(F.col("first.row_key").alias("kept_key"), F.col("first.copies").alias("kept_copies")), "kept")

    def joined(which: str) -> DataFrame:
        return docs.join(kept.filter(which), key == F.col("kept_key"))

    out = joined("kept_copies = 1")
    if not kept.filter("kept_copies > 1").isEmpty():
        out = out.unionByName(joined("kept_copies > 1").dropDuplicates(["kept_key"]))
    return out.select(*[column(c) for c in docs.columns])
