"""Spelling variants: near words by search schemes on blocks of FM-indexes.

Words that differ by one inserted, deleted or replaced code point share a half: the
query's first half as a prefix, or its second half as a suffix. So the vocabulary is
cut twice into blocks of bounded size, once in the order of its words and once in the
order of its reversed words; a word queries only those blocks whose range can hold its
half. Each block is indexed by a bidirectional FM-index in the task that searches it.
Queries of a block that many words visit are dealt out to several pieces of it.

The first cut finds the near words that begin with the query's first half, the second
one those that don't, so no pair is found twice and nothing has to be made distinct.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialise, ship
from .fm_index import Index

#: Characters of a block of the vocabulary; queries of one piece of a block; queries that advance together.
BLOCK_CHARS, PIECE_QUERIES, BATCH = 200_000, 50_000, 4_096
#: Code points that a block's bounds keep; above every code point of a word.
BOUND, TOP = 64, "Ā"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7,
                least_count: int = 2, noise: int = 31) -> DataFrame:
    """(word, n): runs of letters of all texts, one code point taken out of every ``noise``-th (id, run).

    A null text has no runs; a null id counts as an empty one. Words of fewer code points
    or occurrences are left out. ``noise`` 0 takes nothing out. Repeated rows count each.
    """
    runs = docs.select(
        F.coalesce(column(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(column(text_col), _UPPER, _LOWER),
                                       F.lit(f"[A-Za-zÀ-ÿ]{{{max(1, least_length)},}}"), F.lit(0))).alias("run"))
    word = F.col("run")
    if noise:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = (h % F.char_length("run")).cast("int")
        less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(h % noise == 0, less).otherwise(word)
    words = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.filter((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def _half(word: str) -> int:
    return len(word) // 2


def _blocks(words: DataFrame, parts: int, side: int) -> DataFrame:
    key = F.col("word") if side == 0 else F.reverse("word")
    return materialise(words.repartitionByRange(parts, key)
                       .select("word", "n", F.spark_partition_id().alias("block")), f"spelling-blocks-{side}")


def _bounds(blocks: DataFrame, side: int) -> tuple[list[int], list[str], list[str]]:
    """Blocks in order with the least and greatest keys they hold: at most 130 characters a block."""
    key = F.col("word") if side == 0 else F.reverse("word")
    rows = blocks.groupBy("block").agg(F.substring(F.min(key), 1, BOUND).alias("least"),
                                       F.substring(F.max(key), 1, BOUND).alias("most")).collect()
    rows.sort(key=lambda r: r["least"])
    return [r["block"] for r in rows], [r["least"] for r in rows], [r["most"] + TOP for r in rows]


def _route(words: DataFrame, bounds) -> DataFrame:
    """(side, block, word): the blocks that can hold near words of each word."""
    shared = words.sparkSession.sparkContext.broadcast(bounds)

    def run(batches):
        for b in batches:
            sides, blocks, out = [], [], []
            for word in b.column("word").to_pylist():
                h = _half(word)
                for side, part in ((0, word[:h]), (1, word[h:][::-1])):
                    ids, least, most = shared.value[side]
                    a, z = bisect.bisect_left(most, part), bisect.bisect_right(least, part + TOP)
                    sides += [side] * (z - a)
                    blocks += ids[a:z]
                    out += [word] * (z - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sides, pa.int32()), pa.array(blocks, pa.int32()), pa.array(out, pa.string())],
                names=["side", "block", "word"])

    return words.select("word").mapInArrow(run, "side int, block int, word string")


class _Block:
    """One block's words and, once a query comes, its index."""

    def __init__(self, side: int):
        self.side, self.words, self.counts, self.index = side, [], [], None

    def add(self, words: list[str], counts: list[int]):
        self.words += [w.encode("latin-1") for w in words]
        self.counts += counts

    def search(self, words: list[str]):
        """Arrays of (query, near words, greatest count, its word) for queries with near words."""
        if self.index is None:
            order = sorted(range(len(self.words)), key=self.words.__getitem__)
            self.words = [self.words[i] for i in order]
            self.counts = np.array([self.counts[i] for i in order], dtype=np.int64)
            self.index = Index(self.words)
        queries = [w.encode("latin-1") for w in words]
        halves = np.array([_half(w) if self.side == 0 else len(w) - _half(w) for w in words], dtype=np.int64)
        pairs = [q * len(self.words) + w for q, w in self.index.one_error(queries, halves, self.side == 1)]
        q, w = np.divmod(np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64), len(self.words))
        if self.side == 1:
            own = [not self.words[j].startswith(queries[i][:len(queries[i]) // 2]) for i, j in zip(q.tolist(), w.tolist())]
            q, w = q[np.array(own, dtype=bool)], w[np.array(own, dtype=bool)]
        n = self.counts[w]
        order = np.lexsort((w, -n, q))
        q, w, n = q[order], w[order], n[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        return (q[first], np.diff(np.append(first, len(q))), n[first],
                [self.words[j].decode("latin-1") for j in w[first].tolist()])


def _search(batches):
    """Sorted rows: a block's words first, then the words that query it."""
    now, block = None, None
    for b in batches:
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("side", "block", "piece", "kind")], axis=1)
        if not len(keys):
            continue
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            side, at, piece, kind = keys[a].tolist()
            if (side, at, piece) != now:
                now, block = (side, at, piece), _Block(side)
            part = b.slice(a, z - a)
            if kind == 0:
                block.add(part.column("word").to_pylist(), part.column("n").to_pylist())
                continue
            for k in range(0, z - a, BATCH):
                words = part.slice(k, BATCH).column("word").to_pylist()
                q, count, n, form = block.search(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in q.tolist()], pa.string()), pa.array(count, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(form, pa.string())], names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, *, block_chars: int = BLOCK_CHARS, piece_queries: int = PIECE_QUERIES) -> DataFrame:
    """(word, n, n_near, form, form_n): near words of each word, and the one of largest count.

    ``words``: (word, n), words distinct, not null, of two or more code points below
    U+0100. Ties go to the smallest word in code-point order. A word without near words
    has n_near 0 and nulls. An empty table gives an empty result.
    """
    spark = words.sparkSession
    ship(spark)
    words = materialise(words.select("word", "n"), "spelling-words")
    chars = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    parts = max(1, -(-chars // block_chars))
    sides = [_blocks(words, parts, side) for side in (0, 1)]
    routed = materialise(_route(words, [_bounds(s, i) for i, s in enumerate(sides)]), "spelling-queries")
    pieces = routed.groupBy("side", "block").agg(F.ceil(F.count("*") / piece_queries).cast("int").alias("pieces"))
    pieces = materialise(pieces, "spelling-pieces")
    groups = pieces.agg(F.sum("pieces")).first()[0] or 1
    held = sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1)))
    held = held.join(pieces, ["side", "block"]).select(
        "side", "block", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("kind"),
        "word", "n")
    asked = routed.join(pieces, ["side", "block"]).select(
        "side", "block", F.pmod(F.xxhash64("word"), "pieces").cast("int").alias("piece"), F.lit(1).alias("kind"),
        "word", F.lit(0).cast("long").alias("n"))
    dealt = held.unionByName(asked).repartition(int(groups), "side", "block", "piece") \
        .sortWithinPartitions("side", "block", "piece", "kind")
    found = dealt.mapInArrow(_search, "word string, n_near long, form_n long, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("w"))).alias("best"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.w").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows with a form: the last word when forms are followed.

    Pointers are doubled, so a chain takes a logarithmic number of joins; a form's
    count is a multiple of its word's, so there are no circles.
    """
    links = materialise(forms.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        nxt = links.select(F.col("word").alias("root"), F.col("root").alias("after"))
        step = materialise(links.join(nxt, "root", "left").select(
            "word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved")), "spelling-links")
        links = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return links


def spelling_variants(words: DataFrame, *, ratio: int = 10, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n): variants grouped under their frequent forms.

    ``words`` as for ``near_words``. The form is the near word of largest count, if that
    is at least ``ratio`` times the word's own; else form and form_n are null. The root of
    a word without a form is the word itself.
    """
    near = materialise(near_words(words, **options), "spelling-near")
    formed = F.col("form_n") >= ratio * F.col("n")
    forms = near.select("word", "n", "n_near", F.when(formed, F.col("form")).alias("form"),
                        F.when(formed, F.col("form_n")).alias("form_n"))
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(count_words(docs))


ORACLE_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS c FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run
    FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
crc AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(i))),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
      lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
                ELSE [192 + (unicode(s) >> 6), 128 + (unicode(s) & 63)]::BIGINT[] END))),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(c) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING sum(c) >= 2 AND length(word) >= 7),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM v, unnest(range(1, length(word) + 1)) r(i)),
less AS (SELECT DISTINCT cut.word AS longer, v.word AS shorter FROM cut JOIN v ON cut.rest = v.word),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT longer, shorter FROM less UNION ALL SELECT shorter, longer FROM less),
best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS form_n, arg_max(other, (o.n, -rank)) AS form
  FROM near JOIN (SELECT word, n, row_number() OVER (ORDER BY word) AS rank FROM v) o ON near.other = o.word GROUP BY 1),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
    CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON chain.at = formed.word WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed last ON last.word = c.at AND last.form IS NULL
"""
