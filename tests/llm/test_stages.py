"""Pipeline stages on awkward tables: empty ones, repeated rows, rows without ids or texts, extra columns."""
import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, accepted string, toxic string"
LABELS = "doc_id long, quality int, toxic int"


def _rows():
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    base = [(1, text), (1, text), (2, text + " again"), (None, text), (None, "another text without an id at all here"),
            (3, None), (4, ""), (5, "..."), (6, "word " * 9_000), (7, "seven words are needed to make shingles here")]
    return [(i, t, "en", "s", 0, "x", "y", "z") for i, t in base]


def _folder(spark, path, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("kind", ["rows", "empty"])
def test_every_stage_takes_awkward_tables(spark, tmp_dir, kind):
    rows = _rows() if kind == "rows" else []
    sf = _folder(spark, f"{tmp_dir}/{kind}", rows, [(1, 1, 0), (None, None, 1), (9, 0, None)] if rows else [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns, name
        got[name] = sorted(((r["doc_id"], r["text"]) if name != "packing" else (r["doc_id"],) for r in out.collect()), key=str)
    if not rows:
        assert set(map(len, got.values())) == {0}
        assert corpus_pipeline.run(spark, sf).count() == 0
        return
    every = sorted(((r[0], r[1]) for r in rows), key=str)
    assert got["toxicity"] == every                       # too few labels: nothing is toxic
    # No model either (fewer than 50 rows reject nothing but texts without a letter).
    assert got["language_id"] == sorted((x for x in every if x[1] and any(c.isalpha() for c in x[1])), key=str)
    # One row of each group of near copies, the least id first; the others stay.
    kept = got["ngram_jaccard"]
    assert kept.count((1, rows[0][1])) == 1 and (2, rows[2][1]) not in kept and (None, rows[0][1]) not in kept
    assert {x for x in every if x[0] in (3, 4, 5, 6, 7)} <= set(kept)
    assert {x[0] for x in got["packing"]} == {r[0] for r in rows}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} <= {1, 2, None, 6, 7}
