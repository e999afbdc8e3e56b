"""Upsert family (traps T6-T9) and persistence."""

import pytest
from pyspark.sql import functions as F

from ledger.operators.upsert import (
    DuplicateSourceKeyError, replace_table, table_exists, update_where, upsert, upsert_columns, with_dense_ids, with_new_ids, write_upsert,
)

S = "k string, p string, v int"


def test_t9_unmatched_target_rows_are_kept_and_matches_replaced(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], S)
    s = spark.createDataFrame([("a", "x", 10), ("c", "x", 3)], S)
    got = sorted(tuple(r) for r in upsert(t, s, ["k", "p"]).collect())
    assert got == [("a", "x", 10), ("b", "x", 2), ("c", "x", 3)]


def test_t6_key_without_cloud_lets_a_second_cloud_replace(spark):
    sch = "k string, cloud string, v int"
    t = spark.createDataFrame([("a", "GCP", 1)], sch)
    s = spark.createDataFrame([("a", "AWS", 2)], sch)
    assert [tuple(r) for r in upsert(t, s, ["k"]).collect()] == [("a", "AWS", 2)]


def test_t7_null_keys_never_match_unless_null_safe(spark):
    t = spark.createDataFrame([("a", None, 1)], S)
    s = spark.createDataFrame([("a", None, 2)], S)
    assert upsert(t, s, ["k", "p"]).count() == 2
    assert [tuple(r) for r in upsert(t, s, ["k", "p"], null_safe=True).collect()] == [("a", None, 2)]


def test_t8_duplicate_source_keys_raise(spark):
    t = spark.createDataFrame([("a", "x", 1)], S)
    s = spark.createDataFrame([("a", "x", 2), ("a", "x", 3)], S)
    with pytest.raises(DuplicateSourceKeyError):
        upsert(t, s, ["k", "p"])


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], S)
    s = spark.createDataFrame([("a", "x", 10), ("c", "x", 3)], S)
    once = upsert(t, s, ["k", "p"])
    twice = upsert(once, s, ["k", "p"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_upsert_columns_keeps_created_and_reactivates(spark):
    sch = "config_id int, thr int, is_active boolean, created_at string, updated_at string"
    t = spark.createDataFrame([(1, 100, False, "c0", "u0"), (2, 5, True, "c2", "u2")], sch)
    s = spark.createDataFrame([(1, 300, False, "c9", "u9"), (3, 7, True, "c3", "u3")], sch)
    out = {r.config_id: tuple(r) for r in upsert_columns(
        t, s, ["config_id"], {"thr": "thr", "is_active": F.lit(True), "updated_at": "updated_at"}).collect()}
    assert out == {1: (1, 300, True, "c0", "u9"), 2: (2, 5, True, "c2", "u2"), 3: (3, 7, True, "c3", "u3")}


def test_update_where(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], S)
    out = sorted(tuple(r) for r in update_where(t, F.col("k") == "a", {"v": F.lit(0)}).collect())
    assert out == [("a", "x", 0), ("b", "x", 2)]


def test_new_ids_continue_after_max(spark):
    h = spark.createDataFrame([(7, "2000-01-01", 25)], "id long, d string, pct int")
    n = spark.createDataFrame([("2000-01-02", 50), ("2000-01-02", 25)], "d string, pct int")
    got = sorted((r.id, r.d, r.pct) for r in with_new_ids(h, n, "id", ["d", "pct"]).collect())
    assert got == [(8, "2000-01-02", 25), (9, "2000-01-02", 50)]


def test_dense_ids_equal_a_single_numbering_for_a_million_rows(spark):
    """A third of the rows tie, NULLs come first; no window without a partition in the plan."""
    old = spark.createDataFrame([(41,)], "id long")
    k = F.when(F.col("n") % 3 == 0, 5).when(F.col("n") % 1000 != 1, F.pmod(F.xxhash64("n"), F.lit(10**9))).cast("long")
    new = spark.range(1_000_000).withColumnRenamed("id", "n").withColumn("k", k)
    got = with_dense_ids(old, new, "id", ["k", "n"], parts=16)
    assert "__range" in (text := got._jdf.queryExecution().optimizedPlan().toString()) and "Window [row_number()" in text
    assert all("__range" in line for line in text.splitlines() if "Window [" in line)
    place = got.toPandas().sort_values("id").reset_index(drop=True)
    assert list(place["id"]) == list(range(42, 1_000_042)) and got.columns == ["n", "k", "id"]
    want = new.toPandas().sort_values(["k", "n"], na_position="first").reset_index(drop=True)
    assert list(place["n"]) == list(want["n"])


def test_dense_ids_without_rows_ties_and_repeats(spark):
    old = spark.createDataFrame([], "id long")
    assert with_dense_ids(old, spark.createDataFrame([], "k int"), "id", ["k"]).collect() == []
    new = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (1, "a")], "k int, v string")
    got = with_dense_ids(old, new, "id", ["k"], parts=3).orderBy("id").collect()
    assert [r.id for r in got] == [1, 2, 3, 4] and (got[0].k, got[0].v) == (None, "y")
    assert sorted(map(str, with_dense_ids(old, new.repartition(4), "id", ["k"], parts=3).collect())) == sorted(map(str, got))


def test_dense_ids_spread_a_value_that_a_third_of_all_rows_share(spark):
    new = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).withColumnRenamed("id", "n")
    plan = with_dense_ids(spark.createDataFrame([], "id long"), new, "id", ["k"], parts=10)
    sizes = {}
    for r in plan.where("k = 7").withColumn("part", F.spark_partition_id()).groupBy("part").count().collect():
        sizes[r.part] = r["count"]
    assert [r.id for r in plan.orderBy("id").collect()] == list(range(1, 30_001)) and sum(sizes.values()) >= 10_000


def test_write_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    sch = "m string, k string, v int"
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    write_upsert(spark, path, spark.createDataFrame([("m1", "a", 1), ("m2", "b", 2)], sch), ["m", "k"], "m", stage)
    write_upsert(spark, path, spark.createDataFrame([("m2", "b", 20), ("m2", "c", 3)], sch), ["m", "k"], "m", stage)
    got = sorted((r.m, r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("m1", "a", 1), ("m2", "b", 20), ("m2", "c", 3)]
    m1_files = list((tmp_path / "t" / "m=m1").iterdir())
    assert m1_files                                  # untouched partition still there


def test_stored_upsert_keeps_rows_of_the_null_partition(spark, tmp_path):
    """The stored table equals the lazy upsert, NULL partition included (T7, T9)."""
    sch = "m string, k string, v int"
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    old = spark.createDataFrame([(None, "a", 1), ("m1", "b", 2), ("m2", "d", 5)], sch)
    new = spark.createDataFrame([(None, "c", 3), ("m1", "b", 20)], sch)
    write_upsert(spark, path, old, ["m", "k"], "m", stage)
    write_upsert(spark, path, new, ["m", "k"], "m", stage)
    got = sorted(((r.m or "", r.k, r.v) for r in spark.read.schema(sch).parquet(path).collect()))
    want = sorted(((r.m or "", r.k, r.v) for r in upsert(old, new, ["m", "k"]).collect()))
    assert got == want == [("", "a", 1), ("", "c", 3), ("m1", "b", 20), ("m2", "d", 5)]


def _failing(spark):
    return spark.range(3).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise("r1").cast("string").alias("r"))


def test_a_failed_write_leaves_the_unpartitioned_table(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    write_upsert(spark, path, spark.createDataFrame([("a", "r1"), ("b", "r2")], "k string, r string"), ["k"], None, stage)
    for broken in (lambda: replace_table(_failing(spark), path), lambda: write_upsert(spark, path, _failing(spark), ["k"], None, stage)):
        with pytest.raises(Exception, match="broken"):
            broken()
        assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "b"]
    write_upsert(spark, path, spark.createDataFrame([("a", "r3")], "k string, r string"), ["k"], None, stage)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", "r3"), ("b", "r2")]
    assert [x.name for x in tmp_path.iterdir() if x.name.startswith("t.")] == []


def test_an_interrupted_replacement_is_finished(spark, tmp_path):
    path = tmp_path / "t"
    spark.createDataFrame([("a",)], "k string").write.parquet(str(path))
    path.rename(tmp_path / "t.replaced-1")
    assert table_exists(spark, str(path)) and spark.read.parquet(str(path)).count() == 1
    assert not table_exists(spark, str(tmp_path / "other"))


def test_a_damaged_file_is_an_error_and_not_a_missing_table(spark, tmp_path):
    path, stage = tmp_path / "t", str(tmp_path / "stage")
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"PAR1 damaged PAR1")
    assert table_exists(spark, str(path))
    with pytest.raises(Exception):
        write_upsert(spark, str(path), spark.createDataFrame([("a", 1)], "k string, v int"), ["k"], None, stage)
    assert (path / "part-0.parquet").read_bytes() == b"PAR1 damaged PAR1"


def test_duplicate_check_reads_the_source_alone(spark, tmp_path):
    """Without duplicates the target is not read before the merge."""
    missing = spark.range(2).select(F.raise_error(F.lit("target was read")).cast("string").alias("k"), F.lit(1).alias("v"))
    upsert(missing, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), ["k"])
