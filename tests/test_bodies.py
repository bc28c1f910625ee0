"""Bodies landed as files of their own."""
import hashlib
import os

import pytest

from forecastlake.plans import queries
from forecastlake.session import scratch_path
from forecastlake.sinks import bodies as bo
from forecastlake.sources.responses import read_bodies


def test_raw_bodies_makes_no_folder_for_each_file(spark, tmp_dir, monkeypatch):
    made = []

    def noted(spark, name):
        made.append(scratch_path(spark, name))
        return made[-1]

    monkeypatch.setattr(queries, "scratch_path", noted)
    texts = {i: None if i % 50 == 0 else "" if i % 50 == 1 else f"text é {i}\nmore" for i in range(700)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.q_raw_bodies(spark, tmp_dir)
    want = {(i, len(b), hashlib.md5(b).hexdigest()) for i, b in ((i, ((t or "") + "\n").encode()) for i, t in texts.items())}
    assert {tuple(r) for r in got.collect()} == want and got.count() == 700
    folders = [x for path in made for x, _, _ in os.walk(path)]
    files = [x for path in made for _, _, names in os.walk(path) for x in names if x.startswith(("doc_id=", "part-"))]
    assert len([x for x in files if x.endswith(".txt")]) == 700
    assert len(folders) < 20


@pytest.mark.parametrize("mounted", [True, False])
def test_repeated_and_null_keys_and_groups(spark, tmp_dir, monkeypatch, mounted):
    monkeypatch.setattr(bo, "FOLDER_FILES", 4)
    monkeypatch.setattr(bo, "GROUP_FILES", 8)
    if not mounted:
        monkeypatch.setattr(bo, "_local_path", lambda spark, path: None)
    rows = [(i, f"body {i}") for i in range(40)] + [(7, "body 7"), (7, "body 7"), (None, "no key"), (50, None), (51, "")]
    df = spark.createDataFrame(rows, "id long, body string")
    paths = bo.write_bodies(df, f"{tmp_dir}/land", key="id")
    assert len(paths) == (6 if mounted else 1)
    got = {r["path"].split("id=")[1].split("/")[0].removesuffix(".txt"): (r["body"], r["body_bytes"])
           for p in paths for r in read_bodies(spark, p, glob="*.txt").collect()}
    want = {str(i): f"body {i}\n" * (3 if i == 7 else 1) for i in range(40)}
    want |= {bo.NO_KEY: "no key\n", "50": "\n", "51": "\n"}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_no_bodies(spark, tmp_dir):
    paths = bo.write_bodies(spark.createDataFrame([], "id long, body string"), f"{tmp_dir}/land", key="id")
    assert [r for p in paths for r in read_bodies(spark, p, glob="*.txt").collect()] == []
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert queries.q_raw_bodies(spark, tmp_dir).collect() == []
