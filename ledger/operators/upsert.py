"""Upsert / update / append on plain Parquet, composed from joins and unions.

Open-source Spark has no ``MERGE``/``UPDATE``/identity columns on Parquet, so the
reference's DML is rebuilt from DataFrame operations:

* ``upsert``          MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *
* ``upsert_columns``  MERGE with a per-column update list (keeps e.g. ``created_at``)
* ``update_where``    UPDATE t SET a = x WHERE cond
* ``with_new_ids``    an identity-like dense surrogate key for rows to append
* ``with_dense_ids``  the same for batches of any size, numbered by ranges
* ``write_upsert``    persist an upsert, rewriting only the touched partitions
* ``replace_table``   replace an unpartitioned table without a moment in which it is gone
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class DuplicateSourceKeyError(ValueError):
    """Two source rows would update the same target row (MERGE refuses this too)."""


def _key_cond(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        lc, rc = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        c = lc.eqNullSafe(rc) if null_safe else (lc == rc)
        cond = c if cond is None else cond & c
    return cond


def duplicate_source_keys(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None,
                          null_safe: bool = False) -> DataFrame:
    """Source key values that occur more than once (and, given a target, hit a target row).

    A grouped count — partial aggregation before the shuffle — so a hot key costs one
    row per map task, not one row per record.
    """
    dup = source.groupBy(*keys).count().where(F.col("count") > 1).drop("count")
    if target is None:
        return dup
    return dup.alias("d").join(target.select(*keys).alias("t"), _key_cond("d", "t", keys, null_safe), "left_semi")


def assert_unique_keys(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None,
                       null_safe: bool = False) -> None:
    """Raise if two source rows share a key (that the target has, where one is given).

    The source is checked alone; the target is only read where it holds duplicates."""
    if duplicate_source_keys(source, keys).isEmpty():
        return
    if target is None or not duplicate_source_keys(source, keys, target, null_safe).isEmpty():
        raise DuplicateSourceKeyError(f"source has duplicate rows for merge key {list(keys)}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False,
           check: bool = True) -> DataFrame:
    """Rows of ``target`` whose key has no match in ``source``, plus every ``source`` row.

    With ``null_safe=False`` keys compare with ``=`` like the reference, so a NULL key
    never matches and a re-run inserts that row again; ``null_safe=True`` uses ``<=>``.
    Target rows missing from the source are kept (MERGE never deletes).

    Plan: one anti join + union.  The planner broadcasts the source's keys where their
    size is known to be small and shuffles both sides on the keys where it is not.
    ``check`` runs one grouped count over the source at once; it is not needed for a
    source that is grouped by its keys.
    """
    if check:
        assert_unique_keys(source, keys, target, null_safe)
    src = source.select(*target.columns) if set(source.columns) >= set(target.columns) else source
    kept = target.alias("t").join(src.select(*keys).alias("s"), _key_cond("t", "s", keys, null_safe), "left_anti")
    return kept.select(*target.columns).unionByName(src, allowMissingColumns=True)


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   update: Mapping[str, Column | str], check: bool = True) -> DataFrame:
    """MERGE with an explicit update list.

    ``update`` maps a target column to its new value on a match: a source column name,
    or a Column over ``s.<col>`` / ``t.<col>`` / literals.  Unlisted columns keep the
    target's value; unmatched source rows are inserted as they are.
    """
    if check:
        assert_unique_keys(source, keys, target)
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    s = source.select(*target.columns).withColumn("__in_s", F.lit(True)).alias("s")
    j = t.join(s, _key_cond("t", "s", keys, False), "full_outer")
    both = F.col("t.__in_t").isNotNull() & F.col("s.__in_s").isNotNull()
    out = []
    for c in target.columns:
        if c in update:
            new = update[c]
            new = F.col(f"s.{new}") if isinstance(new, str) else new
            val = F.when(both, new).when(F.col("t.__in_t").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        else:
            val = F.when(F.col("t.__in_t").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        out.append(val.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def update_where(df: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET k = v ... WHERE cond`` as a single projection."""
    return df.select(
        *[
            F.when(cond, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def with_new_ids(existing: DataFrame, new: DataFrame, id_col: str, order_by: Sequence[str]) -> DataFrame:
    """``new`` with ids ``max(existing id) + 1, + 2, ...`` in ``order_by`` order.

    The window runs over ``new`` only and in one task: it is for callers whose batch is
    bounded (one row per alert tier; ``with_dense_ids`` takes any number).
    ``max(id)`` over the existing table is a distributed aggregate used as a
    scalar subquery.
    """
    base = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long"))
    w = Window.orderBy(*order_by)
    return new.withColumn("__base", base.scalar()).withColumn(
        id_col, (F.col("__base") + F.row_number().over(w)).cast("long")
    ).drop("__base")


def with_dense_ids(existing: DataFrame, new: DataFrame, id_col: str, order_by: Sequence[str], parts: int | None = None) -> DataFrame:
    """``with_new_ids`` for any number of new rows: the same ids, without one task for all rows.

    The rows are cut into ``parts`` ranges of the order (default: the session's shuffle
    partitions), counted by range, and numbered within their range on top of the counts of
    the ranges before.  The cuts are rows of ``new`` picked by a hash of their values, eight
    for each range, so they depend on the rows alone and every pass over them finds the same
    ranges, also after a lost executor.  Rows that tie in ``order_by`` are ordered by a hash
    of all their values, so a value that a third of all rows share is cut like any other;
    only rows equal in every column stay together.  NULLs come first, as in ``ORDER BY``.
    What is held as one value has an entry for each range."""
    spark = new.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = new.withColumn("__tie", F.xxhash64(*new.columns))
    place = F.struct(*order_by, "__tie")
    picked = (
        rows.select(place.alias("at"), F.xxhash64(F.col("__tie"), F.lit(1)).alias("draw"))
        .groupBy(F.pmod("draw", F.lit(8 * parts)).alias("cell")).agg(F.min(F.struct("draw", "at"))["at"].alias("at"))
        .agg(F.sort_array(F.collect_list("at")).alias("at"))
        .select(F.filter("at", lambda x, i: i % 8 == 4).alias("cuts"))
    )
    ranged = rows.withColumn("__cuts", picked.scalar()).withColumn("__place", place)
    ranged = ranged.withColumn("__range", F.size(F.filter("__cuts", lambda cut: cut <= F.col("__place")))).drop("__cuts", "__place")
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).agg(F.collect_list(F.struct("__range", "n")).alias("all"))
    before = counts.select(F.transform(F.sequence(F.lit(0), F.lit(parts)), lambda k: F.aggregate(
        F.filter("all", lambda x: x["__range"] < k), F.lit(0).cast("long"), lambda total, x: total + x["n"])).alias("before"))
    base = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order_by, "__tie"))
    numbered = ranged.withColumn("__n", within).withColumn("__before", before.scalar()).withColumn("__base", base.scalar())
    new_id = F.col("__base") + F.get("__before", F.col("__range")) + F.col("__n")
    return numbered.withColumn(id_col, new_id.cast("long")).drop("__n", "__before", "__base", "__range", "__tie")


# ----------------------------------------------------------------------- persistence


def _files(spark: SparkSession, path: str):
    """The Hadoop path and the file system that holds it (local, HDFS or an object store)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``: asked of the file system alone, so a damaged
    file or a refused access is an error, never "no table".

    Finishes a ``replace_table`` that was interrupted between its two renames."""
    at, fs = _files(spark, path)
    if fs.exists(at):
        return True
    if at.getParent() is not None and fs.exists(at.getParent()):
        kept = sorted(str(f.getPath()) for f in fs.listStatus(at.getParent()) if f.getPath().getName().startswith(at.getName() + OLD))
        if kept:
            return bool(fs.rename(spark._jvm.org.apache.hadoop.fs.Path(kept[-1]), at))
    return False


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job of this run staged."""
    at, fs = _files(spark, path)
    fs.delete(at, True)


# Marks the table that ``replace_table`` has moved aside.
OLD = ".replaced-"


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the unpartitioned table at ``path`` by ``df``, which may read it.

    The new files are written beside the table first; only then the table is moved aside
    and the new folder takes its name.  A run that fails while writing leaves the table
    as it was; one that fails between the renames is finished by ``table_exists``."""
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.fresh-{uuid.uuid4().hex}"
    try:
        df.write.parquet(fresh)
    except Exception:
        remove(spark, fresh)
        raise
    at, fs = _files(spark, path)
    old, _ = _files(spark, f"{path.rstrip('/')}{OLD}{uuid.uuid4().hex}")
    new, _ = _files(spark, fresh)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        raise OSError(f"cannot put the new files at {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_snapshot(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Overwrite ``path``; a partitioned write is first rebalanced on the partition column.

    ``REBALANCE`` lets AQE aim at one file per partition value, split a skewed value over
    several tasks and merge small ones — without it every task writes a file for every
    date it holds (tasks x dates small files).
    """
    if partition_col:
        df.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def touched_rows(target: DataFrame, src: DataFrame, col: str) -> DataFrame:
    """The target's rows of the partitions that ``src`` writes to, NULL being one of them.

    The smallest and the largest value become literals, so the scan lists and reads those
    partitions only; the semi join keeps exactly the touched ones."""
    lo, hi, nulls = src.agg(F.min(col), F.max(col), F.count(F.when(F.col(col).isNull(), 1))).first()
    inside = F.lit(False) if lo is None else F.col(col).between(F.lit(lo), F.lit(hi))
    if nulls:
        inside = inside | F.col(col).isNull()
    touched = src.select(F.col(col).alias("__touched")).distinct()
    return target.where(inside).join(touched, F.col(col).eqNullSafe(F.col("__touched")), "left_semi")


def changed_partitions(target: DataFrame, src: DataFrame, col: str, keys: Sequence[str], null_safe: bool = False,
                       aside: Sequence[str] = ()) -> list:
    """The values of ``col`` whose partitions the upsert of ``src`` really changes: those with a
    source row that the target does not hold already, columns in ``aside`` left out of account.

    Rows meet by a hash of all their values, then the values themselves decide, so nothing
    rests on the hash.  Where keys compare with ``=`` a row with a NULL key matches nothing,
    so it always counts as new.  The list has one value a partition of the batch."""
    content = [c for c in target.columns if c not in aside]
    name = F.xxhash64(*content)
    a = src.select(*content, name.alias("__row")).alias("a")
    b = touched_rows(target, src, col).select(*content, name.alias("__row")).alias("b")
    same = F.col("a.__row") == F.col("b.__row")
    for c in content:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        same = same & ((x == y) if c in keys and not null_safe else x.eqNullSafe(y))
    return [r[0] for r in a.join(b, same, "left_anti").select(f"a.{col}").distinct().collect()]


def write_upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 partition_col: str | None, staging_root: str, null_safe: bool = False,
                 unique_source: bool = False, target_schema=None, aside: Sequence[str] = ()) -> None:
    """Persist ``upsert(existing, source)`` into the Parquet table at ``path``.

    * The source batch is computed once and staged under ``staging_root`` (shared
      storage); the key check, the partition list and the merge all read the staged copy,
      which is removed when the upsert has succeeded.  ``unique_source=True`` skips the
      key check for a batch that is a GROUP BY on the merge keys (unique by
      construction).  ``target_schema`` reads the target with its declared schema, so
      columns absent from older files come back as NULL.
    * A partitioned table is merged by one dynamic partition overwrite of the touched
      partitions (NULL is a partition like any other).  It may read the table it writes:
      Spark writes aside and moves the finished partitions in when the job commits, one
      partition after the other - a failed write changes nothing, a failure during the
      commit can leave some partitions new and some old, and running again mends that.
    * Only partitions that really change are rewritten (``changed_partitions``); a batch
      that repeats what is stored, columns in ``aside`` (audit) not counted, writes nothing.
    * An unpartitioned table is replaced as a whole (``replace_table``).
    """
    exists = table_exists(spark, path)
    if unique_source and not exists:
        write_snapshot(source, path, partition_col)          # first load: nothing to merge or check
        return
    root = f"{staging_root.rstrip('/')}/upsert-{uuid.uuid4().hex}"
    source.write.parquet(root)
    src = spark.read.schema(source.schema).parquet(root)
    if not exists:
        if not unique_source:
            assert_unique_keys(src, keys)
        write_snapshot(src, path, partition_col)
        remove(spark, root)
        return
    target = (spark.read.schema(target_schema) if target_schema is not None else spark.read).parquet(path)
    src = src.select(*target.columns)
    if not unique_source:
        assert_unique_keys(src, keys, target, null_safe)
    if partition_col:
        values = changed_partitions(target, src, partition_col, keys, null_safe, aside)
        if not values:
            remove(spark, root)
            return
        known, column = [v for v in values if v is not None], F.col(partition_col)
        src = src.where(column.isin(known) | column.isNull() if len(known) < len(values) else column.isin(known))
        merged = upsert(touched_rows(target, src, partition_col), src, keys, null_safe=null_safe, check=False)
        (merged.select(*target.columns).hint("rebalance", partition_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
        spark.catalog.refreshByPath(path)
    else:
        replace_table(upsert(target, src, keys, null_safe=null_safe, check=False), path)
    remove(spark, root)
