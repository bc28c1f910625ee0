"""Near-duplicate vectors by NN-descent on a neighbour graph.

Equal vectors are one vector with a weight first. Then, in rounds:

1. Random hyperplanes, new ones each round: vectors with the same signs form blocks,
   large blocks are split, and every vector takes the nearest of its block. The more
   signs, the more tables, so that a lone pair at the threshold still meets.
2. Descent: the neighbours of a vector (both ways) are compared with one another,
   and lists keep the nearest found.
3. Links give components. A list holds the nearest vectors and, past them, the
   nearest of other components, so a list full of the vector's own group is enlarged
   by what may link that group to others. Rounds go on until one adds no link.
4. Everything that links connect is compared pair by pair in blocks, so a group of
   any size gets all its links.
5. Recall is audited in two ways. A bounded sample is compared with all vectors: the share
   of linked groups, each counted once, that hold all links of a vector of theirs. And
   partners are planted: for a sample of vectors, copies at cosines from the threshold to
   halfway to 1 go through the same tables and descent, and the share that is joined to
   their vector's group is taken, which doesn't depend on how rare links are. Planted
   vectors join no groups. Below the target of either, rounds go on with more tables
   and longer lists; if the last round still misses it, all blocks of vectors are
   compared and nothing is missed.
Links below the threshold are never kept: every cosine is computed in doubles.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship
from .components import connected_components
from .vectors import matrix, unit, usable_vectors

NEIGHBOURS, TABLES, BLOCK = 8, 4, 192
#: Chance that a lone pair at the threshold meets in some table, as far as MOST_TABLES allow.
MEET, MOST_TABLES = 0.9, 64
#: Components of several vectors, and of one, that recall is audited on, at most (by the smallest hash);
#: vectors that a partner is planted for.
AUDIT, AUDIT_ALONE, PLANTED = 256, 4096, 512
#: Share of the groups that an audit must find whole, and of planted partners (the least that a round of
#: tables is made for, one round after another).
TARGET, ROUNDS = 0.99, 5
#: Vectors in a block of the exact pass.
EXACT_BLOCK = 4_096
_LISTS = "vec_id long, component long, near array<struct<sim:double,id:bigint,component:bigint>>"


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Marks each row's k largest."""
    marks = np.zeros(sims.shape, dtype=bool)
    k = min(k, len(sims) - 1)
    if k > 0:
        np.put_along_axis(marks, np.argpartition(-sims, k - 1, axis=1)[:, :k], True, axis=1)
    return marks


def _nearest(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each member's k nearest of its group that are nearer than ``floor``, and its k
    nearest of other components that are nearer than ``apart``."""
    x, ids, component = unit(matrix(pdf["vec"])), pdf["vec_id"].to_numpy(), pdf["component"].to_numpy()
    sims = x @ x.T
    np.fill_diagonal(sims, -2.0)
    others = np.where(component[:, None] == component[None, :], -2.0, sims)
    keep = _top(sims, k) & (sims > pdf["floor"].to_numpy()[:, None])
    keep |= _top(others, k) & (others > pdf["apart"].to_numpy()[:, None])
    out = []
    for i in np.flatnonzero(keep.any(axis=1)):
        found = [{"sim": float(sims[i, j]), "id": int(ids[j]), "component": int(component[j])} for j in np.flatnonzero(keep[i])]
        out.append((int(ids[i]), int(component[i]), found))
    return pd.DataFrame(out, columns=["vec_id", "component", "near"])


def _merge(lists: DataFrame, k: int) -> DataFrame:
    """(vec_id, component, near): of all lists of a vector the k nearest, then the k nearest of
    other components that aren't among them. A vector has a few lists at most."""
    every = lists.select("vec_id", "component", F.explode("near").alias("e")) \
        .groupBy("vec_id", "component", "e.id").agg(F.max("e.sim").alias("sim"), F.first("e.component").alias("of"))
    found = F.sort_array(F.collect_list(F.struct("sim", "id", F.col("of").alias("component"))), asc=False)
    near = F.array_union(F.slice("found", 1, k), F.slice(_others("found"), 1, k))
    return every.groupBy("vec_id", "component").agg(found.alias("found")).select("vec_id", "component", near.alias("near"))


def _others(near: str):
    """Entries of other components than the vector's."""
    return F.filter(near, lambda e: e["component"] != F.col("component"))


def _moved(graph: DataFrame, placed: DataFrame) -> DataFrame:
    """The lists with the components of ``placed``."""
    own, of = placed.select("vec_id", "component"), placed.select(F.col("vec_id").alias("id"), F.col("component").alias("of"))
    entries = graph.select("vec_id", F.explode("near").alias("e")).select("vec_id", "e.sim", "e.id").join(of, "id").join(own, "vec_id")
    return entries.select("vec_id", "component", F.array(F.struct("sim", "id", F.col("of").alias("component"))).alias("near"))


def _tables(bits: int, threshold: float) -> int:
    """Tables in which a pair at the threshold has the same signs at least once, with chance ``MEET``."""
    same = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    if same <= 0 or same >= 1:
        return TABLES
    return max(TABLES, min(MOST_TABLES, math.ceil(math.log(1 - MEET) / math.log1p(-same))))


def _start(rows: DataFrame, n: int, dim: int, k: int, seed: int, threshold: float, times: int = 1) -> DataFrame:
    """Lists from sets of random hyperplanes, ``times`` as many as ``_tables`` says."""
    bits = max(0, math.ceil(math.log2(max(1, n / BLOCK))))
    tables = times * _tables(bits, threshold)
    planes = np.random.default_rng(seed).normal(size=(dim, tables * max(bits, 1)))

    def code(batches):
        for pdf in batches:
            if len(pdf):
                signs = (unit(matrix(pdf["vec"])) @ planes > 0).reshape(len(pdf), tables, -1)[:, :, :bits]
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "codes": list((signs << np.arange(bits)).sum(axis=2))})

    codes = rows.select("vec_id", "vec").mapInPandas(code, "vec_id long, codes array<long>") \
        .select("vec_id", F.posexplode("codes").alias("table", "code"))
    codes = materialise(codes, "codes")
    parts = codes.groupBy("table", "code").agg(F.ceil(F.count("*") / (2.0 * BLOCK)).alias("parts"))
    dealt = codes.join(parts, ["table", "code"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "table"), F.col("parts"))) \
        .join(rows.select("vec_id", "component", "vec", F.lit(-2.0).alias("floor"), F.lit(-2.0).alias("apart")), "vec_id")
    return dealt.groupBy("table", "code", "part").applyInPandas(lambda pdf: _nearest(pdf, k), _LISTS)


def _descend(rows: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """One round: the neighbours of each vector, both ways, are compared with one another."""
    arcs = graph.select("vec_id", F.explode("near.id").alias("id"))
    around = arcs.select(F.col("vec_id").alias("centre"), F.col("id").alias("vec_id")) \
        .union(arcs.select(F.col("id").alias("centre"), "vec_id")) \
        .union(graph.select(F.col("vec_id").alias("centre"), "vec_id")).distinct()
    # A vector that many lists name has its surroundings split.
    parts = around.groupBy("centre").agg(F.ceil(F.count("*") / 96.0).alias("parts"))

    def last(near):
        return F.when(F.size(near) >= k, F.element_at(near, k)["sim"]).otherwise(F.lit(-2.0))

    members = rows.join(graph.select("vec_id", last(F.col("near")).alias("floor"), last(_others("near")).alias("apart")), "vec_id")
    dealt = around.join(parts, "centre").join(members, "vec_id") \
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    # Many centres go to a task at once; each is compared by itself inside it.
    groups = dealt.withColumn("bundle", F.pmod(F.xxhash64("centre"), F.lit(_bundles(rows))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [_nearest(g, k) for _, g in pdf.groupby(["centre", "part"], sort=False) if len(g) > 2]
        return pd.concat(found) if found else pd.DataFrame({"vec_id": [], "component": [], "near": []})

    better = groups.groupBy("bundle", "part").applyInPandas(run, _LISTS)
    return _merge(graph.unionByName(better), k)


def _bundles(rows: DataFrame) -> int:
    return max(1, math.ceil(rows.count() / 256))


def _count_links(placed: DataFrame, threshold: float) -> DataFrame:
    """(vec_id, n_links): exact, over all pairs of a component, block against block; copies not counted."""
    sizes = placed.groupBy("component").agg(F.count("*").alias("n")).filter("n > 1") \
        .select("component", F.ceil(F.col("n") / 512.0).cast("int").alias("blocks"))
    dealt = placed.join(sizes, "component") \
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other) \
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    # Small components share a group; a large one has a group for each pair of blocks.
    bundle = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(_bundles(placed)))).otherwise(F.col("component"))
    pairs = pairs.withColumn("bundle", bundle)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby("component", sort=False):
            x, ids, block = unit(matrix(g["vec"])), g["vec_id"].to_numpy(), g["block"].to_numpy()
            lo, hi = int(g["lo"].iloc[0]), int(g["hi"].iloc[0])
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if lo != hi:
                linked &= block[:, None] != block[None, :]
            out.append(pd.DataFrame({"vec_id": ids, "n_links": linked @ g["weight"].to_numpy()}))
        return pd.concat(out)

    return pairs.groupBy("bundle", "blocks", "lo", "hi").applyInPandas(run, "vec_id long, n_links long") \
        .groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))


def audit(placed: DataFrame, threshold: float, sample: int = AUDIT, alone_sample: int = AUDIT_ALONE) -> float:
    """Macro recall: the share of groups with links that hold all of a vector's, each group counted once.

    Links inside a component are all found, so a vector misses those to other
    components. One vector is taken of each of ``sample`` components of several
    vectors and of ``alone_sample`` components of one (lost links are rare among them);
    a vector alone that has a link stands for as many lost groups as it is a sample of.
    """
    mark = F.xxhash64("vec_id", F.lit(9))
    groups = materialise(placed.groupBy("component").agg(
        F.count("*").alias("n"), F.min(F.struct(mark.alias("mark"), "vec_id")).alias("one")), "groups")
    picked, totals = [], []
    for kind in ("n > 1", "n = 1"):
        of = groups.filter(kind)
        totals.append(of.count())
        size = alone_sample if kind == "n = 1" else sample
        chosen = of.orderBy("one.mark", "one.vec_id").limit(size).select("one.vec_id", F.lit(kind == "n = 1").alias("alone"))
        picked += placed.join(F.broadcast(chosen), "vec_id").select("vec", "component", "alone").collect()
    component, alone = np.array([r["component"] for r in picked]), np.array([r["alone"] for r in picked], dtype=bool)
    x = unit(np.array([r["vec"] for r in picked], dtype=np.float64))

    def run(batches):
        lost = np.zeros(len(x), dtype=np.int64)
        for pdf in batches:
            if len(pdf):
                linked = x @ unit(matrix(pdf["vec"])).T >= threshold
                lost += (linked & (component[:, None] != pdf["component"].to_numpy()[None, :])).sum(axis=1)
        yield pd.DataFrame({"i": np.arange(len(x)), "lost": lost})

    lost = np.zeros(len(x), dtype=np.int64)
    for r in placed.select("vec", "component").mapInPandas(run, "i long, lost long").groupBy("i").agg(F.sum("lost").alias("lost")).collect():
        lost[r["i"]] = r["lost"]
    whole = totals[0] * float((lost[~alone] == 0).mean()) if totals[0] else 0.0
    missed = totals[1] * float((lost[alone] > 0).mean()) if totals[1] else 0.0
    every = totals[0] + missed
    return whole / every if every else 1.0


def plant(placed: DataFrame, threshold: float, first_id: int, sample: int = PLANTED, seed: int = 3) -> DataFrame:
    """(vec_id, weight, component, vec, origin): partners of sampled vectors, under ids from ``first_id`` on.

    Each has a cosine drawn between the threshold and halfway to 1, in a random direction.
    """
    picked = placed.orderBy(F.xxhash64("vec_id", F.lit(13)), "vec_id").limit(sample).select("vec_id", "vec").collect()
    rng, rows = np.random.default_rng(seed), []
    for k, r in enumerate(picked):
        x = unit(np.array([r["vec"]], dtype=np.float64))[0]
        off = rng.normal(size=len(x))
        off -= (off @ x) * x
        # Vectors of one component have no other direction; their partner is a multiple.
        off = off / np.linalg.norm(off) if np.linalg.norm(off) > 1e-9 else 0 * off
        cosine = rng.uniform(threshold, (1 + threshold) / 2) + 1e-9
        rows.append((first_id + k, 1, first_id + k, (cosine * x + math.sqrt(1 - cosine ** 2) * off).tolist(), r["vec_id"]))
    return placed.sparkSession.createDataFrame(rows, "vec_id long, weight long, component long, vec array<double>, origin long")


def planted_recall(placed: DataFrame, planted: DataFrame, links: DataFrame) -> float:
    """Share of planted partners that ``links`` (vec_id, id, both ways) tie to their vector's group."""
    total = planted.count()
    if not total:
        return 1.0
    own = placed.select(F.col("vec_id").alias("origin"), "component")
    wanted = planted.select("vec_id", "origin").join(own, "origin").select("vec_id", F.col("component").alias("wanted"))
    ends = links.join(F.broadcast(wanted), "vec_id").select("vec_id", "wanted", "id") \
        .join(placed.select(F.col("vec_id").alias("id"), "component"), "id").filter("component = wanted")
    return ends.select("vec_id").distinct().count() / total


def _all_bridges(placed: DataFrame, threshold: float) -> DataFrame:
    """(a, b): components with a link between them, by comparing all blocks of vectors.

    A pair of blocks names a spanning forest of the components that it links.
    """
    n = max(1, math.ceil(placed.count() / EXACT_BLOCK))
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(n)).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) \
        .select("vec", "component", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf[pdf["block"] == pdf["lo"]], pdf[pdf["block"] == pdf["hi"]]
        out, root = [], {}

        def find(c):
            while root.get(c, c) != c:
                root[c] = c = root.get(root[c], root[c])
            return c

        if len(lo) and len(hi):
            right, of = unit(matrix(hi["vec"])), hi["component"].to_numpy()
            for at in range(0, len(lo), 512):
                own = lo["component"].to_numpy()[at:at + 512]
                i, j = np.nonzero((unit(matrix(lo["vec"].iloc[at:at + 512])) @ right.T >= threshold) & (own[:, None] != of[None, :]))
                for a, b in np.unique(np.stack([own[i], of[j]], axis=1), axis=0).tolist():
                    if find(a) != find(b):
                        root[find(a)] = find(b)
                        out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("lo", "hi").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                    neighbours: int = NEIGHBOURS, target: float = TARGET, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each input row.

    Linked: cosine of at least ``threshold``. Vectors that are null, zero, hold
    null or non-finite components, or differ in length from the most common one are
    linked with nothing. Repeated vectors under different ids are linked like others.
    Repeated rows count once; different vectors under one id are of one component, and
    the id's n_links is the sum over them. An empty table gives no rows; other input
    columns are left out.
    """
    ship(df.sparkSession)
    rows = usable_vectors(df, id_col, vec_col).dropDuplicates()
    dims = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    every = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"))
    if dims is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    dim = dims["dim"]
    rows = materialise(rows.filter(F.size("vec") == dim), "vectors")
    # Inside, a vector goes by a number of its own: one id may have several.
    distinct = materialise(rows.groupBy("vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight")), "vectors")
    distinct = materialise(distinct.withColumn("vec_id", F.monotonically_increasing_id()), "vectors")
    copies = rows.join(distinct.filter("weight > 1").select("vec", F.col("vec_id").alias("number")), "vec").select("vec_id", "number")
    members = materialise(copies.unionByName(distinct.filter("weight = 1").select(
        F.col("first").alias("vec_id"), F.col("vec_id").alias("number"))), "members")
    n = distinct.count()
    placed, graph = distinct.select("vec_id", "weight", "vec", F.col("vec_id").alias("component")), None
    # Ids of the planted are above those of any partition's rows.
    planted = materialise(plant(placed, threshold, 1 << 62), "planted")
    times, enough = 1, False
    for r in range(ROUNDS):
        searched = placed.select("vec_id", "weight", "component", "vec").unionByName(planted.drop("origin"))
        lists = _start(searched, n, dim, neighbours, seed + r, threshold, times)
        if graph is not None:
            lists = lists.unionByName(_moved(graph, searched))
        graph = materialise(_merge(lists, neighbours), "graph")
        graph = materialise(_descend(searched, graph, neighbours), "graph")
        links = graph.select("vec_id", F.col("component").alias("a"), F.explode("near").alias("e")) \
            .filter(F.col("e.sim") >= threshold).select("vec_id", "a", F.col("e.id").alias("id"), F.col("e.component").alias("b"))
        real = links.filter((F.col("vec_id") < 1 << 62) & (F.col("id") < 1 << 62))
        bridges = materialise(real.select("a", "b").filter("a <> b").distinct(), "bridges")
        if bridges.count():
            placed = _joined(placed, bridges)
            if r + 1 < ROUNDS:
                continue
        both = links.select("vec_id", "id").unionByName(links.select(F.col("id").alias("vec_id"), F.col("vec_id").alias("id")))
        enough = planted_recall(placed, planted, both) >= target and audit(placed, threshold) >= target
        if enough:
            break
        times, neighbours = 2 * times, 2 * neighbours
    if not enough:
        placed = _joined(placed, materialise(_all_bridges(placed, threshold), "bridges"))
    counted = _count_links(placed, threshold)
    found = placed.join(counted, "vec_id", "left").select(
        F.col("vec_id").alias("number"), "component", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    owned = materialise(members.join(found, "number").select("vec_id", "component", "n_links"), "members")
    # Vectors under one id belong together, whatever lies between them.
    same = owned.groupBy("vec_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    same = owned.join(same.select("vec_id", "a"), "vec_id").select("a", F.col("component").alias("b")).filter("a <> b").distinct()
    same = materialise(same, "bridges")
    if not same.isEmpty():
        owned = _joined(owned, same)
    least = owned.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    each = owned.groupBy("vec_id").agg(F.min("component").alias("component"), F.sum("n_links").alias("n_links")).join(least, "component")
    joined = every.join(each, "vec_id", "left")
    comp = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), comp.alias("component_id"),
                         F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))


def _joined(placed: DataFrame, bridges: DataFrame) -> DataFrame:
    """``placed`` with the components that ``bridges`` (a, b) connect made one."""
    to = connected_components(bridges).select(F.col("id").alias("component"), F.col("component").alias("to"))
    return materialise(placed.join(to, "component", "left").withColumn("component", F.coalesce("to", "component"))
                       .select(*placed.columns), "placed")


def op6_near_vectors(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
