"""Phrase collocations: tries of Apriori-safe candidates count all places of whole texts.

Phrases of two and three words are counted in passes over the texts, each vectorised
over some hundred kilobytes of bytes in numpy. What can't be frequent is pruned first, with
no frequent phrase lost. Words are counted. Then pairs of frequent words are counted by
their words' short hashes (32 bits each), and triples whose two pairs may be frequent.
Short hashes that are alike only add counts up, so a frequent phrase always passes; the
words behind them are looked up among the frequent words, and every combination is a
candidate. What tasks prune by is a Bloom filter of bounded size: past that size it lets
more through, which costs time only. Candidates are dealt into tries by their first pair;
tries are broadcast, as many at once as a fixed budget of bytes holds, and each pass
advances all text positions' states symbol by symbol, bincounts accepting states and
sums the shards' counts. In tries words are told apart by 64-bit hashes, which are checked
to differ for different words and drawn anew where they don't.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialise, ship, small_batches
from .double_array import DoubleArray, build
from .shingles import _powers, mix

U = np.uint64
#: Bytes of text that are in numpy arrays at once; candidates of a trie; bytes of tries broadcast at once.
CHUNK, TRIE_PHRASES, TRIE_BYTES = 1 << 19, 200_000, 48 << 20
#: A Bloom filter: bits of a segment, segments at most (64 MB), bits wanted for a key, probes.
SEGMENT_BITS, SEGMENTS, KEY_BITS, PROBES = 1 << 20, 512, 16, 4
#: Phrases that a task counts before it emits them, and words.
HELD, WORDS = 400_000, 150_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)                   # 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2


@functools.lru_cache(2)
def _tables(seed: int, n: int):
    base = int.from_bytes(hashlib.blake2b(b"%d" % seed, digest_size=8).digest(), "little") | 1
    return _powers(base, n), _powers(pow(base, -1, 2**64), n)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Text:
    """Words of some bytes of text: start, end, hash, piece, language."""

    def __init__(self, data: np.ndarray, langs: list[str], lang_ends: list[int], seed: int, bits: int = 32):
        self.low = _LOWER[data]
        kind = _KIND[data]
        edge = np.flatnonzero(np.diff(kind == 0, prepend=False, append=False))
        self.start, self.end = edge[0::2], edge[1::2]
        length = (self.end - self.start).astype(np.uint64)
        power, inverse = _tables(seed, 1 << max(20, len(data).bit_length()))
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.low.astype(np.uint64) + U(1)) * power[:len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + length * U(0xD6E8FEB86659FD93))
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        same = piece[1:] == piece[:-1]
        self.pair = np.append(same, False) if len(piece) else np.zeros(0, bool)       # a next word in the piece
        self.triple = np.zeros(len(piece), dtype=bool)
        if len(piece) > 2:
            self.triple[:-2] = same[:-1] & same[1:]
        self.langs = langs
        self.lang = np.repeat(np.arange(len(langs)), np.diff(np.searchsorted(self.start, lang_ends), prepend=0))
        self.lang_hash = np.array([_lang_hash(x) for x in langs], dtype=np.uint64)
        self.lang_key = np.array([zlib.crc32(x.encode()) for x in langs], dtype=np.uint64)[self.lang]
        self.key = mix(self.lang_hash[self.lang] * U(0x9FB21C651E98DF25) + self.hash) if len(piece) else self.hash
        self.short = self.hash >> U(64 - bits)

    def pairs(self) -> np.ndarray:
        """Two short hashes at each word that has a next one in its piece, else junk."""
        out = self.short << U(32)
        out[:-1] |= self.short[1:]
        return out


def fingerprint(lang_key: np.ndarray, key: np.ndarray) -> np.ndarray:
    return mix(key * U(0x9FB21C651E98DF25) + mix(lang_key))


def _cut(data: np.ndarray, at: int, end: int) -> int:
    """Where to cut a text that is too long: behind the last piece end in reach, or the first one beyond."""
    if end - at <= CHUNK:
        return end
    cut = np.flatnonzero(_KIND[data[at:at + CHUNK]] == 2)
    if len(cut):
        return at + int(cut[-1]) + 1
    for far in range(at + CHUNK, end, CHUNK):
        cut = np.flatnonzero(_KIND[data[far:min(end, far + CHUNK)]] == 2)
        if len(cut):
            return far + int(cut[0]) + 1
    return end


def texts_of(batches, seed: int, bits: int = 32):
    """``Text`` objects over all rows (lang, text), some megabytes each, cut between pieces only."""
    for b in batches:
        texts, langs = b.column("text"), b.column("lang")
        if pa.types.is_string(texts.type):
            texts = texts.cast(pa.large_string())
        off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
        parts, names, ends, size = [], [], [], 0
        for k, lang in enumerate(langs.to_pylist()):
            at = int(off[k])
            while at < off[k + 1]:
                to = _cut(data, at, int(off[k + 1]))
                if parts and size + to - at > CHUNK:
                    yield Text(np.concatenate(parts), names, ends, seed, bits)
                    parts, names, ends, size = [], [], [], 0
                parts += [data[at:to], np.array([10], np.uint8)]
                size += to - at + 1
                if names and names[-1] == lang:
                    ends[-1] = size
                else:
                    names.append(lang)
                    ends.append(size)
                at = to
        if parts:
            yield Text(np.concatenate(parts), names, ends, seed, bits)


def _unsigned(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


class Bloom:
    """Which 64-bit keys may be members; a key's probes lie in one segment."""

    def __init__(self, segments: list[bytes], count: int):
        self.count = count
        self.bits = np.frombuffer(b"".join(segments), dtype=np.uint8)

    @staticmethod
    def probes(key: np.ndarray, segments: int):
        x = mix(key ^ U(0xA24BAED4963EE407))
        segment = (x >> U(44)).astype(np.int64) % segments
        y = mix(x)
        bits = [((y >> U(16 * j)) ^ (x << U(4 * j + 3))) & U(SEGMENT_BITS - 1) for j in range(PROBES)]
        return segment, [b.astype(np.int64) for b in bits]

    def holds(self, key: np.ndarray) -> np.ndarray:
        if not self.count:
            return np.zeros(len(key), dtype=bool)
        segment, probes = self.probes(key, self.count)
        ok = np.ones(len(key), dtype=bool)
        for p in probes:
            ok &= (self.bits[segment * (SEGMENT_BITS // 8) + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1 == 1
        return ok


def bloom_of(keys: DataFrame) -> Bloom:
    """A filter of all (lang_key, key) rows, made a segment at a time, 64 MB at most."""
    total = keys.count()
    if not total:
        return Bloom([], 0)
    segments = min(SEGMENTS, max(1, -(-total * KEY_BITS // SEGMENT_BITS)))

    def place(batches):
        for b in batches:
            lang, key = (b.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (0, 1))
            segment, probes = Bloom.probes(fingerprint(lang, key), segments)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(segment, PROBES), pa.int32()), pa.array(np.concatenate(probes) >> 6, pa.int32()),
                 pa.array((U(1) << (np.concatenate(probes) & 63).astype(np.uint64)).view(np.int64))],
                names=["segment", "word", "bits"])

    words = keys.select("lang_key", "key").mapInArrow(place, "segment int, word int, bits long") \
        .groupBy("segment", "word").agg(F.bit_or("bits").alias("bits"))

    def join(key, table):
        out = np.zeros(SEGMENT_BITS // 64, dtype=np.uint64)
        out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bytes": pa.array([out.tobytes()], pa.binary())})

    rows = words.groupBy("segment").applyInArrow(join, "segment int, bytes binary").collect()
    found = {r["segment"]: bytes(r["bytes"]) for r in rows}
    return Bloom([found.get(s, bytes(SEGMENT_BITS // 8)) for s in range(segments)], segments)


class _Held:
    """Words and counts that a task adds up before it emits them."""

    def __init__(self):
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.counts, self.hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
        self.words, self.langs = [], []

    def add(self, t: Text):
        key, first, count = np.unique(t.key, return_index=True, return_counts=True)
        at = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == key[inside]
        self.counts[self.slots[at[known]]] += count[known]
        new = ~known
        low, first = t.low.tobytes(), first[new]
        self.words += [low[a:z] for a, z in zip(t.start[first].tolist(), t.end[first].tolist())]
        self.langs += [t.langs[k] for k in t.lang[first].tolist()]
        self.slots = np.insert(self.slots, at[new], len(self.counts) + np.arange(len(first)))
        self.keys = np.insert(self.keys, at[new], key[new])
        self.counts = np.concatenate([self.counts, count[new]])
        self.hashes = np.concatenate([self.hashes, t.hash[first]])

    def batches(self):
        for k in range(0, len(self.words), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.langs[k:k + 50_000], pa.string()),
                 pa.array(self.words[k:k + 50_000], pa.binary()).cast(pa.string()),
                 _unsigned(self.hashes[k:k + 50_000]), pa.array(self.counts[k:k + 50_000], pa.int64())],
                names=["lang", "word", "h", "f"])


def _words(rows: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, f): all words with their counts."""
    def run(batches):
        held = _Held()
        for t in texts_of(batches, seed):
            held.add(t)
            if len(held.words) > WORDS:
                yield from held.batches()
                held = _Held()
        yield from held.batches()

    return rows.mapInArrow(run, "lang string, word string, h long, f long") \
        .groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


def _counted(held: list, triple: bool):
    """Batches of (lang_key, key, third, f) from lists of (lang_key, key, third) arrays, equal rows added up."""
    lang, key = (np.concatenate([x[k] for x in held]) for k in (0, 1))
    for one in np.unique(lang):
        own = lang == one
        pair, third = key[own], None
        if triple:
            # Exact: the pair's rank and the third short hash share 64 bits.
            pairs, rank = np.unique(pair, return_inverse=True)
            both, count = np.unique((rank.astype(np.uint64) << U(32)) | np.concatenate([x[2] for x in held])[own],
                                    return_counts=True)
            pair, third = pairs[(both >> U(32)).astype(np.int64)], both & U(0xFFFFFFFF)
        else:
            pair, count = np.unique(pair, return_counts=True)
        columns = [pa.array(np.full(len(pair), one, dtype=np.int64)), _unsigned(pair), pa.array(count, pa.int64())]
        names = ["lang_key", "key", "f"]
        if triple:
            columns.insert(2, pa.array(third.astype(np.int64)))
            names.insert(2, "third")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _phrases(rows: DataFrame, seed: int, bits: int, shared, words: int, least: int) -> DataFrame:
    """(lang_key, key[, third]): short hashes of phrases that are counted often enough and whose parts may be frequent.

    The broadcast filter holds frequent words for two words, and what came out for two words for three.
    """
    def run(batches):
        held, size = [], 0
        for t in texts_of(batches, seed, bits):
            if not len(t.hash):
                continue
            if words == 2:
                may = shared.value.holds(fingerprint(t.lang_key, t.short))
                good = t.pair & may & np.append(may[1:], False)
            else:
                may, key = np.zeros(len(t.hash), dtype=bool), t.pairs()
                may[t.pair] = shared.value.holds(fingerprint(t.lang_key[t.pair], key[t.pair]))
                good = t.triple & may & np.append(may[1:], False)      # its second pair begins one word on
            at = np.flatnonzero(good)
            held.append((t.lang_key[at], t.pairs()[at], t.short[np.minimum(at + 2, len(t.short) - 1)]))
            size += len(at)
            if size > HELD:
                yield from _counted(held, words == 3)
                held, size = [], 0
        if held:
            yield from _counted(held, words == 3)

    keys = ["lang_key", "key"] + ["third"] * (words == 3)
    counts = rows.mapInArrow(run, ", ".join(f"{k} long" for k in [*keys, "f"])).groupBy(*keys).agg(F.sum("f").alias("f"))
    return counts.filter(F.col("f") >= least).drop("f")


def _candidates(frequent: DataFrame, twos: DataFrame, threes: DataFrame) -> DataFrame:
    """(lang, h1, h2, h3, pair): all frequent words behind the short hashes; h3 null for two words."""
    def named(df, k):
        word = frequent.select("lang", "lang_key", F.col("short").alias(f"s{k}"), F.col("h").alias(f"h{k}"))
        return df.join(word if k == 1 else word.drop("lang_key"), ["lang_key", "s1"] if k == 1 else ["lang", f"s{k}"])

    low = F.lit(0xFFFFFFFF)
    first, second = F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND(low)
    # Sums of two short hashes deal candidates to tries; no product can overflow.
    out = ["lang", "h1", "h2", "h3", (F.col("s1") + 7 * F.col("s2")).alias("pair")]
    two = named(named(twos.select("lang_key", first.alias("s1"), second.alias("s2")), 1), 2)
    three = named(named(named(threes.select("lang_key", first.alias("s1"), second.alias("s2"),
                                            F.col("third").alias("s3")), 1), 2), 3)
    return two.withColumn("h3", F.lit(None).cast("long")).select(*out).unionByName(three.select(*out))


def _unpack(blobs: dict[int, tuple[int, bytes]]) -> dict[int, DoubleArray]:
    return {k: pickle.loads(pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True))
            for k, (size, blob) in blobs.items()}


class PackedTries:
    """Tries on their way through the driver: compressed there, ``DoubleArray`` objects by slice where they are unpickled."""

    def __init__(self, rows):
        self.blobs = {r["slice"]: (r["size"], bytes(r["trie"])) for r in rows}

    def __reduce__(self):
        return _unpack, (self.blobs,)


@contextlib.contextmanager
def _shared(spark, value):
    """A broadcast value that goes when the actions inside have ended."""
    out = spark.sparkContext.broadcast(value)
    try:
        yield out
    finally:
        out.destroy()


def _tries(candidates: DataFrame, slices: int) -> tuple[DataFrame, DataFrame]:
    """Candidates with their slice and number in it, and (slice, size, trie): bytes of the trie, and these compressed."""
    order = Window.partitionBy("slice").orderBy(F.col("h3").isNotNull(), "lang", "h1", "h2", "h3")
    numbered = materialise(
        candidates.withColumn("slice", F.pmod("pair", F.lit(slices)).cast("int")).drop("pair")
        .withColumn("number", F.row_number().over(order) - 1), "phrase-numbered")

    def make(key, table):
        table = table.sort_by("number")
        lang = np.array([_lang_hash(x) for x in table.column("lang").to_pylist()], dtype=np.uint64)
        h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        three = table.column("h3").is_valid().to_numpy()
        h3 = table.column("h3").fill_null(0).to_numpy().view(np.uint64)
        sets = [np.stack([lang, h1, h2], axis=1)[~three], np.stack([lang, h1, h2, h3], axis=1)[three]]
        blob = build([s for s in sets if len(s)]).dump()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "size": pa.array([len(blob)], pa.int64()),
                         "trie": pa.array([pa.compress(blob, codec="zstd", asbytes=True)], pa.binary())})

    built = numbered.groupBy("slice").applyInArrow(make, "slice int, size long, trie binary")
    return numbered, materialise(built, "phrase-tries")


def _count(rows: DataFrame, seed: int, bits: int, slices: int, shared) -> DataFrame:
    """(slice, number, a): places of the candidates of some slices (broadcast tries), summed over all shards."""
    def run(batches):
        loaded = shared.value
        held = np.zeros(slices, dtype=bool)
        held[list(loaded)] = True
        counts = {k: np.zeros(t.sequences, dtype=np.int64) for k, t in loaded.items()}
        for t in texts_of(batches, seed, bits):
            at = np.flatnonzero(t.pair)
            part = ((t.short[at] + U(7) * t.short[at + 1]) % U(slices)).astype(np.int64)
            at, part = at[held[part]], part[held[part]]
            order = np.argsort(part, kind="stable")
            at, part = at[order], part[order]
            edge = np.flatnonzero(np.diff(part, prepend=-1, append=slices))
            for a, z in zip(edge[:-1], edge[1:]):
                trie, here = loaded[int(part[a])], at[a:z]
                state = trie.start(len(here))
                for step in range(4):
                    if step == 3:
                        more = t.triple[here]
                        here, state = here[more], state[more]
                    symbol = t.lang_hash[t.lang[here]] if step == 0 else t.hash[here + step - 1]
                    alive, state = trie.advance(state, symbol)
                    here = here[alive]
                    if step > 1:
                        end = trie.accept[state]
                        counts[int(part[a])] += np.bincount(end[end >= 0], minlength=trie.sequences)
        for k, count in counts.items():
            number = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(number), k), pa.int32()), pa.array(number, pa.int32()),
                                              pa.array(count[number], pa.int64())], names=["slice", "number", "a"])

    return rows.mapInArrow(run, "slice int, number int, a long").groupBy("slice", "number").agg(F.sum("a").alias("a"))


def _batches(sizes: list[tuple[int, int]], budget: int) -> list[list[int]]:
    out, held = [], 0
    for k, size in sizes:
        if not out or held + size > budget:
            out.append([])
            held = 0
        out[-1].append(k)
        held += size
    return out


def phrase_counts(docs: DataFrame, *, least: int = 10, text_col: str = "text", lang_col: str = "lang",
                  trie_phrases: int = TRIE_PHRASES, trie_bytes: int = TRIE_BYTES, short_bits: int = 32):
    """(words, phrases): exact counts (lang, word, h, f) of all words and (lang, h1, h2, h3, a) of
    phrases of two words (h3 null) and three words with ``a >= least``.

    A null text is empty, a null language is ``und``; repeated rows count each; an empty
    table gives empty results. Other columns are left out. Fewer ``short_bits`` (32 at
    most) give more candidates and the same counts.
    """
    ship(docs.sparkSession)
    with small_batches(docs.sparkSession):
        return _phrase_counts(docs, least, text_col, lang_col, trie_phrases, trie_bytes, short_bits)


def _phrase_counts(docs, least, text_col, lang_col, trie_phrases, trie_bytes, short_bits):
    rows = docs.select(F.coalesce(column(lang_col), F.lit("und")).alias("lang"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"))
    for seed in range(16):
        words = materialise(_words(rows, seed), "phrase-words")
        other = words.select("h", F.xxhash64("word").alias("x"))       # another hash of the same words
        if other.groupBy("h").agg(F.min("x").alias("a"), F.max("x").alias("b")).filter("a <> b").isEmpty():
            break
    frequent = materialise(words.filter(F.col("f") >= least).select(
        "lang", "h", F.crc32("lang").alias("lang_key"), F.shiftrightunsigned("h", 64 - short_bits).alias("short")),
        "phrase-frequent")
    with _shared(docs.sparkSession, bloom_of(frequent.select("lang_key", F.col("short").alias("key")))) as single:
        twos = materialise(_phrases(rows, seed, short_bits, single, 2, least), "phrase-pairs")
    with _shared(docs.sparkSession, bloom_of(twos)) as pairs:
        threes = materialise(_phrases(rows, seed, short_bits, pairs, 3, least), "phrase-triples")
    candidates = materialise(_candidates(frequent, twos, threes), "phrase-candidates")
    slices = max(1, -(-candidates.count() // trie_phrases))
    numbered, tries = _tries(candidates, slices)
    sizes = sorted((r["slice"], r["size"]) for r in tries.select("slice", "size").collect())
    counted = None
    for part in _batches(sizes, trie_bytes):
        # At most trie_bytes of tries, or one trie of about trie_phrases phrases, are collected at once, compressed.
        with _shared(docs.sparkSession, PackedTries(tries.filter(F.col("slice").isin(part)).toLocalIterator())) as held:
            now = materialise(_count(rows, seed, short_bits, slices, held), "phrase-counts")
        counted = now if counted is None else counted.unionByName(now)
    phrases = numbered.drop("slice", "number").withColumn("a", F.lit(0).cast("long")) if counted is None else \
        numbered.join(counted, ["slice", "number"]).drop("slice", "number")
    return words, materialise(phrases.filter(F.col("a") >= least), "phrases")


def _best(rows: DataFrame, top: int) -> DataFrame:
    """Each language's ``top`` rows with their rank.

    Hash parts of a language, some tens of ``top`` rows each, keep their own best first,
    part of parts by part, so that no task ranks all phrases of a language.
    """
    fan = 32
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = -(-rows.count() // (fan * max(1, top)))
    while parts > 1:
        rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
            .filter(F.col("rank") <= top).drop("rank", "part")
        parts = -(-parts // fan)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, *, least: int = 10, top: int = 2000, share: int = 50, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    Cutting a phrase in two gives l and r, the counts of its parts, and the score
    floor(10**6 * a * a / (l * r)) in exact decimals; the lowest-scoring cut counts, ties to
    the first one. A phrase inside a longer one that has at least ``share`` per cent of its
    count is left out. Order: score and a descending, phrase ascending by bytes. n is the
    number of words of the language. Null and empty cases as for ``phrase_counts``.
    """
    words, phrases = phrase_counts(docs, least=least, **options)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    names = words.filter(F.col("f") >= least)
    two, three = phrases.filter("h3 is null").drop("h3"), phrases.filter("h3 is not null")

    def named(df, k):
        return df.join(names.select("lang", F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"),
                                    F.col("f").alias(f"f{k}")), ["lang", f"h{k}"])

    def score(l, r):
        return F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) "
                      f"div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")

    longer = three.select("lang", "h1", "h2", "a").unionAll(three.select("lang", "h2", "h3", "a").toDF("lang", "h1", "h2", "a")) \
        .groupBy("lang", "h1", "h2").agg(F.max("a").alias("longest"))
    two_left = two.join(longer, ["lang", "h1", "h2"], "left").filter(f"coalesce(100 * longest < {int(share)} * a, true)")
    pairs = named(named(two_left, 1), 2).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        score("f1", "f2").alias("score"))
    left = two.select("lang", "h1", "h2", F.col("a").alias("f12"))
    right = two.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    whole = named(named(named(three, 1), 2), 3).join(left, ["lang", "h1", "h2"]).join(right, ["lang", "h2", "h3"])
    cuts = whole.withColumn("s1", score("f1", "f23")).withColumn("s2", score("f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                          F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                          F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                          F.least("s1", "s2").alias("score"))
    best = _best(materialise(pairs.unionByName(triples), "phrase-scores"), top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            "n", "score")


def op13_phrase_collocations(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return collocations(docs)


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents WHERE text IS NOT NULL))),
grams AS (
  SELECT lang, k, words[i:i + k - 1] AS p FROM pieces, unnest(range(1, 4)) a(k), unnest(range(1, len(words) - k + 2)) b(i)),
f AS (SELECT lang, k, p, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.p, c.f AS a, cut.k AS cut_at, l.f AS l, r.f AS r, 1000000 * c.f * c.f // (l.f * r.f) AS score
  FROM c, unnest(range(1, c.k)) cut(k)
  JOIN f l ON l.lang = c.lang AND l.p = c.p[1:cut.k] JOIN f r ON r.lang = c.lang AND r.p = c.p[cut.k + 1:c.k]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut_at) = 1),
inner2 AS (
  SELECT lang, p, max(f) AS longest FROM (
    SELECT lang, p[1:2] AS p, f FROM c WHERE k = 3 UNION ALL SELECT lang, p[2:3], f FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT lowest.*, array_to_string(lowest.p, ' ') AS phrase FROM lowest LEFT JOIN inner2 USING (lang, p)
  WHERE lowest.k = 3 OR longest IS NULL OR 100 * longest < 50 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
  CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
"""
