"""Sum-of-squares online packing of tokenised documents into windows.

Each task packs the stream of its own partition. ``count[h]`` is the number of
open windows filled to level h. A document goes to the level that leaves the sum
of squared counts of partially filled windows smallest (a new window is level 0);
full windows leave. What is still open at the end is closed up: the emptiest
windows' documents, cut where needed, fill the fullest ones, so a task pads one
window at most. Open windows hold at most ``max_open`` windows of ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, ship
from .word_tokens import word_tokenizer

END_ID = 2


#: Windows that a task holds open; beyond them the fullest half is closed up by cutting.
MAX_OPEN = 2048


class Packer:
    """Windows of ``size`` ids. Closed windows are lists of (doc, start, ids) in order."""

    def __init__(self, size: int, max_open: int = MAX_OPEN):
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size + 1)
        self.count[size] = -0.5      # a full window leaves: it adds 1 - 2 count[h]
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.closed: list[list] = []

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for a in range(0, whole, self.size):
            self.closed.append([(doc, a, ids[a:a + self.size])])
        if whole < len(ids):
            self._place((doc, whole, ids[whole:]))
            if self.n_open > self.max_open:
                self.flush(self.max_open // 2)

    def _place(self, piece) -> None:
        s, n = len(piece[2]), self.count
        here = n[1:self.size - s + 1]
        change = np.where(here > 0, n[1 + s:] - here, np.inf)
        best = int(change[::-1].argmin()) if len(change) else 0
        level = len(change) - best           # ties: the fullest window
        if not len(change) or 2 * change[level - 1] + 2 > 2 * n[s] + 1:
            level = 0
        window = self.open[level].pop() if level else []
        if level:
            n[level] -= 1
            self.n_open -= 1
        window.append(piece)
        if level + s == self.size:
            self.closed.append(window)
        else:
            n[level + s] += 1
            self.n_open += 1
            self.open.setdefault(level + s, []).append(window)

    def flush(self, keep: int = 0) -> None:
        """Close the fullest windows but ``keep`` by cutting the emptiest of them into the others.

        One that isn't full is left at most: it stays open if others do, else it is closed.
        """
        windows = []
        for level in sorted(self.open, reverse=True):
            while self.open[level] and self.n_open > keep:
                windows.append(self.open[level].pop(0))
                self.count[level] -= 1
                self.n_open -= 1
        room = [self.size - sum(len(p[2]) for p in w) for w in windows]
        a, b = 0, len(windows) - 1
        while a < b:
            if not room[a]:
                a += 1
                continue
            if not windows[b]:
                b -= 1
                continue
            doc, start, ids = windows[b].pop()
            fit = min(len(ids), room[a])
            windows[a].append((doc, start, ids[:fit]))
            room[a] -= fit
            room[b] += len(ids)
            if fit < len(ids):
                windows[b].append((doc, start + fit, ids[fit:]))
                room[b] -= len(ids) - fit
        for w in windows:
            level = sum(len(p[2]) for p in w)
            if keep and 0 < level < self.size:
                self.open.setdefault(level, []).append(w)
                self.count[level] += 1
                self.n_open += 1
            elif w:
                self.closed.append(w)


def pack(df: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
         size: int = 4096, max_open: int = MAX_OPEN) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row for each piece.

    ``ids`` are little-endian unsigned 32-bit ids; every document ends with id 2, so
    a null or empty text is that id alone. Repeated rows are packed each; rows with a
    null id too; documents longer than a window are cut at its multiples; an empty
    table gives no rows. Other input columns are left out. A task holds ``max_open``
    windows open at most; past that it closes the fullest half, cutting documents to fill
    them, and goes on with the others.
    """
    ship(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.large_binary()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        tok, packer = word_tokenizer(tokenizer), Packer(size, max_open)
        next_id = TaskContext.get().partitionId() << 32

        def rows():
            nonlocal next_id
            out = []
            for window in packer.closed:
                offset = 0
                for (doc, total), start, ids in window:
                    out.append((doc, start, len(ids), ids.tobytes(), total, next_id, offset))
                    offset += len(ids)
                next_id += 1
            packer.closed = []
            cols = list(zip(*out)) if out else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(tok.encode(text or ""), np.uint32(END_ID))
                    packer.add((doc, len(ids)), ids)
                yield rows()
        packer.flush()
        yield rows()

    return df.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, start long, length long, ids binary, "
                         "doc_tokens long, sequence_id long, offset long")


def op7_packing(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as packed sequences, ids included; the columns of ``pack`` and ids_crc32.

    Null and empty texts are the end id alone, repeated rows and rows without an id are
    packed each, an empty table gives no rows.
    """
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))
