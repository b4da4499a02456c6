from pyspark.sql import functions as F

from varloom.operators import store
from varloom.streaming.increment import annotate_stream

CALLS = "variant_key string"


def annotated(keys):
    return keys.withColumn("af", F.length("variant_key") / 100.0)


def test_versions_and_merge(spark, tmp_path):
    versions = store.VersionedStore(spark, str(tmp_path / "s"))
    assert versions.current() is None
    versions.commit(spark.createDataFrame([("a", 0.1, "r1"), ("b", 0.2, None)], "variant_key string, af double, pop_release string"))
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], CALLS)
    todo = store.increment(keys, versions.current(), "pop_release", "r1")
    assert sorted(r[0] for r in todo.collect()) == ["b", "c"]
    versions.commit(store.merge(versions.current(), annotated(todo), "pop_release", "r1"))
    rows = {r.variant_key: (r.af, r.pop_release) for r in versions.current().collect()}
    assert rows == {"a": (0.1, "r1"), "b": (0.01, "r1"), "c": (0.01, "r1")}


def test_stream_annotates_each_key_once(spark, tmp_path):
    inbox, deltas, asked = tmp_path / "in", store.DeltaStore(spark, str(tmp_path / "s")), []

    def annotate(keys):
        asked.append(sorted(r[0] for r in keys.collect()))
        return annotated(keys)

    for keys in (["k1", "k2", "k1", None], ["k2", "k33"], ["k1"]):
        spark.createDataFrame([(k,) for k in keys], CALLS).coalesce(1).write.mode("append").parquet(str(inbox))
        calls = spark.readStream.schema(CALLS).parquet(str(inbox))
        annotate_stream(calls, deltas, annotate, "pop", "r1", str(tmp_path / "cp")).awaitTermination()
    assert asked == [["k1", "k2"], ["k33"]]
    assert {r.variant_key: r.pop_release for r in deltas.current().collect()} == {"k1": "r1", "k2": "r1", "k33": "r1"}
    assert [r.kind for r in deltas.log().orderBy("seq").collect()] == ["delta", "delta"]


def test_deltas_merge_repeat_and_compact(spark, tmp_path):
    deltas = store.DeltaStore(spark, str(tmp_path / "s"), parts=2)
    assert deltas.current() is None
    one = spark.createDataFrame([("a", 0.1, None), ("b", None, "x")], "variant_key string, af double, note string")
    two = spark.createDataFrame([("b", 0.5), ("c", None)], "variant_key string, af double")
    assert deltas.commit(one, "b1", "pop_release", "r1") and deltas.commit(two, "b2", "pop_release", "r2")
    want = {"a": (0.1, None, "r1"), "b": (0.5, "x", "r2"), "c": (None, None, "r2")}
    read = lambda: {r.variant_key: (r.af, r.note, r.pop_release) for r in deltas.current().collect()}
    assert read() == want
    files = lambda: sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "s" / "data").rglob("part-*"))
    before = files()
    assert not deltas.commit(one.withColumn("af", F.lit(9.0)), "b1", "pop_release", "r1")
    assert files() == before and read() == want
    deltas.compact("base1")
    assert read() == want and not deltas.commit(one, "b1")
    deltas.commit(spark.createDataFrame([("a", "y")], "variant_key string, other string"), "b3")
    assert {r.variant_key: (r.af, r.other) for r in deltas.current().collect()} == {"a": (0.1, "y"), "b": (0.5, None), "c": (None, None)}
    # a read after a compaction looks at the base and what came since
    assert not any("/data/b1/" in f for f in deltas.current().inputFiles())
