"""What passes through the driver on the way to the counts."""
import pickle

from forecastlake.llm import collocations as co
from forecastlake.llm.double_array import DoubleArray


def candidates(spark, n):
    return spark.range(n).selectExpr("'en' AS lang", "xxhash64(id % 300) AS h1", "xxhash64(id, 1) AS h2",
                                     "cast(null AS long) AS h3", "id AS pair")


def test_the_driver_holds_compressed_tries_only(spark, monkeypatch):
    seen = []
    real = co._count

    def noted(rows, seed, bits, slices, shared):
        seen.append(shared)
        return real(rows, seed, bits, slices, shared)

    def refuse(blob):
        raise AssertionError("a trie is opened in the driver")

    monkeypatch.setattr(co, "_count", noted)
    monkeypatch.setattr(co.pickle, "loads", refuse)
    rows = [("en", "new york city. " * 12), ("fr", "une ville, une ville. " * 11)]
    words, phrases = co.phrase_counts(spark.createDataFrame(rows, "lang string, text string"))
    monkeypatch.undo()
    assert {r["a"] for r in phrases.collect()} == {12, 22} and phrases.count() == 4
    assert len(seen) == 1


def test_packed_tries_are_smaller_and_come_back_whole(spark):
    _, tries = co._tries(candidates(spark, 5000), 2)
    rows = tries.collect()
    assert len(rows) == 2 and all(2 * len(r["trie"]) < r["size"] for r in rows)
    back = pickle.loads(pickle.dumps(co.PackedTries(rows)))
    assert sorted(back) == [0, 1] and all(isinstance(t, DoubleArray) for t in back.values())
    assert sum(t.sequences for t in back.values()) == 5000
