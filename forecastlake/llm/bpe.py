"""Byte-level BPE by overlapping chunks.

A text longer than a chunk is cut into chunks that overlap. Chunks are dealt out
and pre-tokenised in parallel. Two neighbours are stitched at the first pre-token
boundary that both have in their overlap. A chunk may begin inside a pre-token, so
its boundaries only count from its first sure one on: a place after which white
space follows something else, which is a boundary whatever stands before. From a
shared boundary on both sides continue alike, as the pattern never looks back; it
may look ahead past white space, so no stitch follows white space. The pieces
between stitches are encoded in parallel; where an overlap holds no shared
boundary, the piece goes on through the next chunk. Decoding concatenates the ids'
raw bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, ship

CHUNK, OVERLAP = 32_768, 1_024
#: Fixed value: the pattern whose boundaries the stitching rules hold for. Texts are one piece under any other.
CHUNKED = frozenset({
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
})
#: Characters before a chunk's end whose boundaries may depend on what follows.
MARGIN = 8
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@functools.lru_cache(2)
def encoding(path: str, pattern: str):
    """The tiktoken encoder and the bytes of each id."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    table = {b: a for a, b in ranks.items()}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), table


@functools.lru_cache(2)
def splitter(pattern: str):
    """The pattern with white space as Unicode's White_Space property has it."""
    import regex

    inside = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\S", f"[^{_WHITE}]")
    return (regex.compile(inside.replace(r"\s", f"[{_WHITE}]")), regex.compile(f"(?<=[^{_WHITE}])[{_WHITE}]"),
            regex.compile(f"[{_WHITE}]"))


def boundaries(text: str, pattern: str, final: bool) -> tuple[list[int], int | None]:
    """Starts of pre-tokens that don't depend on what follows, and the first sure one."""
    split, sure, _ = splitter(pattern)
    starts = [m.start() for m in split.finditer(text)]
    if not final:
        starts = [s for s in starts if s <= len(text) - MARGIN]
    first = sure.search(text)
    return starts, first.start() if first else None


def _small(batches, rows: int = 256):
    """The same rows in small batches, so that few texts are Python objects at once."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def encode(df: DataFrame, ranks: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row_id, doc_id, piece, last, ids): the pieces of each text, in order within one partition.

    ``ids`` are little-endian unsigned 32-bit ids. A null text is empty and has one
    empty piece. Rows are told apart by ``row_id``, so repeated or null ids do no
    harm; an empty table gives no rows. Other input columns are left out. The input
    must give the same rows again if a task is repeated (a table does). Texts are cut
    under the patterns of ``CHUNKED`` only; under any other a text is one piece.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.monotonically_increasing_id().alias("row_id"), column(id_col).cast("long").alias("doc_id"),
                     F.coalesce(column(text_col), F.lit("")).alias("text"))
    if pattern not in CHUNKED:
        chunk = (1 << 31) - 1        # longer than any string
    short = rows.filter(F.char_length("text") <= chunk)
    long = rows.filter(F.char_length("text") > chunk)
    out = "row_id long, doc_id long, piece int, last boolean, ids binary"

    def whole(batches):
        enc, _ = encoding(ranks, pattern)
        for b in _small(batches):
            ids = [np.array(enc.encode_ordinary(t), dtype="<u4").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), b.column("doc_id"), pa.array([0] * len(b), pa.int32()),
                 pa.array([True] * len(b)), pa.array(ids, pa.binary())],
                names=["row_id", "doc_id", "piece", "last", "ids"])

    chunks = _chunks(long, chunk, overlap).repartition("row_id", "chunk")
    cuts = _stitch(chunks, pattern, chunk, overlap)
    pieces = _encode_pieces(chunks.join(cuts, ["row_id", "chunk"]), ranks, pattern, chunk)
    return short.mapInArrow(whole, out).unionByName(_join_pieces(pieces, ranks, pattern))


def _chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row_id, doc_id, chunk, final, text): chunk k starts at character k * chunk."""
    def run(batches):
        for b in _small(batches, 16):
            for row, doc, text in zip(*(b.column(c).to_pylist() for c in ("row_id", "doc_id", "text"))):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k0 in range(0, n, 64):
                    k = range(k0, min(n, k0 + 64))
                    yield pa.RecordBatch.from_pydict({
                        "row_id": pa.array([row] * len(k), pa.int64()), "doc_id": pa.array([doc] * len(k), pa.int64()),
                        "chunk": pa.array(k, pa.int32()), "final": [i == n - 1 for i in k],
                        "text": [text[i * chunk:] if i == n - 1 else text[i * chunk:(i + 1) * chunk + overlap] for i in k]})

    return rows.mapInArrow(run, "row_id long, doc_id long, chunk int, final boolean, text string")


def _stitch(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row_id, chunk, begin, end): offsets into the chunk; null where no stitch was found."""
    def run(batches):
        white = splitter(pattern)[2]
        for b in _small(batches, 64):
            heads, tails = [], []
            for k, final, text in zip(*(b.column(c).to_pylist() for c in ("chunk", "final", "text"))):
                starts, sure = boundaries(text, pattern, final)
                sure = 0 if k == 0 else sure
                heads.append([k * chunk + s for s in starts if s <= overlap])
                tails.append([] if final or sure is None else
                             [k * chunk + s for s in starts if s >= max(chunk, sure) and not white.match(text[s - 1])])
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), b.column("chunk"), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))], names=["row_id", "chunk", "head", "tail"])

    marks = chunks.mapInArrow(run, "row_id long, chunk int, head array<long>, tail array<long>")
    order = Window.partitionBy("row_id").orderBy("chunk")
    met = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    marks = marks.withColumn("met", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(met))
    start = F.col("chunk").cast("long") * chunk
    return marks.select("row_id", "chunk", (F.col("met") - start).cast("int").alias("begin"),
                        (F.lead("met").over(order) - start).cast("int").alias("end"))


def _encode_pieces(chunks: DataFrame, ranks: str, pattern: str, chunk: int) -> DataFrame:
    """Pieces stitched on both sides become ids; the others keep their text."""
    def run(batches):
        enc, _ = encoding(ranks, pattern)
        for b in _small(batches, 64):
            ids, texts, opened = [], [], []
            for text, begin, end, final in zip(*(b.column(c).to_pylist() for c in ("text", "begin", "end", "final"))):
                closed = final or end is not None
                part = text[begin or 0:len(text) if final else end if closed else chunk]
                whole = begin is not None and closed
                ids.append(np.array(enc.encode_ordinary(part), dtype="<u4").tobytes() if whole else None)
                texts.append(None if whole else part)
                opened.append(not closed)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("row_id", "doc_id", "chunk", "final")]
                + [pa.array(opened), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                names=["row_id", "doc_id", "chunk", "final", "open", "ids", "text"])

    return chunks.mapInArrow(run, "row_id long, doc_id long, chunk int, final boolean, "
                                  "open boolean, ids binary, text string")


def _join_pieces(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The pieces in order; runs of chunks without a stitch are encoded as one piece."""
    def run(batches):
        held: list[str] = []
        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("row_id", "doc_id", "chunk", "final", "open", "ids", "text")]
            for row, doc, k, final, opened, ids, text in zip(*cols):
                if ids is None:
                    held.append(text)
                    if opened:
                        continue
                    enc, _ = encoding(ranks, pattern)
                    ids, held = np.array(enc.encode_ordinary("".join(held)), dtype="<u4").tobytes(), []
                out.append((row, doc, k, final, ids))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                names=["row_id", "doc_id", "piece", "last", "ids"])

    ordered = pieces.repartition("row_id").sortWithinPartitions("row_id", "chunk")
    return ordered.mapInArrow(run, "row_id long, doc_id long, piece int, last boolean, ids binary")


def digests(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), streaming over ``encode``'s pieces."""
    def run(batches):
        _, table = encoding(ranks, pattern)
        names = {i: str(i) for i in table}
        n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        for b in _small(batches):
            out = []
            for doc, last, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "last", "ids"))):
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                if ids:
                    ids_hash.update(((" " if n else "") + " ".join(map(names.__getitem__, ids))).encode())
                    text_hash.update(b"".join(map(table.__getitem__, ids)))
                    n += len(ids)
                if last:
                    out.append((doc, n, ids_hash.hexdigest(), text_hash.hexdigest()))
                    n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pieces.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = P.path("byte_bpe_50k.tiktoken")
    return digests(encode(docs, ranks, P.PATTERN), ranks, P.PATTERN)
