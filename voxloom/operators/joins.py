"""Joins and set operations: lookups, positions, resuming, upserts.

Where order matters it is a column, never the order of a file.  Sides are left
to the optimiser, which broadcasts by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.session import input_bytes, split_bytes, stage


def last_by(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of each key by ``order``; aggregated map-side, so a hot key is no burden."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: Column, defaults: dict | None = None) -> DataFrame:
    """Left join to a lookup of which the last row of a key counts.

    Columns of the right side whose names clash get the prefix ``r_``.
    ``defaults`` fills columns of rows that found no partner; a null of a row
    that did stays null.
    """
    keyed = last_by(right, [right_key], order)
    names = {c: f"r_{c}" if c in left.columns else c for c in keyed.columns}
    renamed = keyed.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).withColumn("_hit", F.lit(True))
    joined = left.join(renamed, left[left_key] == renamed[names[right_key]], "left")
    for c, value in (defaults or {}).items():
        at = names[c]
        joined = joined.withColumn(at, F.when(F.col("_hit").isNull(), F.lit(value)).otherwise(F.col(at)))
    return joined.drop("_hit", names[right_key]) if names[right_key] != left_key else joined.drop("_hit")


def stem_join(left: DataFrame, right: DataFrame, left_id: Column, right_id: Column) -> DataFrame:
    """Inner join on cleaned ids; clashing names of the right side get the prefix ``r_``."""
    r = right.select(right_id.alias("_id"), *[F.col(f"`{c}`").alias(f"r_{c}" if c in left.columns else c) for c in right.columns])
    return left.withColumn("_id", left_id).join(r, "_id", "inner").drop("_id")


def numbered(df: DataFrame, order: list[Column], name: str = "position", by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Rows numbered from 0 in a given order, without one task that holds them all.

    The rows are range-partitioned by the order, numbered in each range, and
    moved by the ranges' sizes, of which there is one row each.  Within groups
    of ``by`` they are ordered by group first, and numbered from the group's
    first row, so a hot group spreads over many ranges.
    """
    spark = df.sparkSession
    # Ranges of about one split, from what the plan reads; a core has one at least.
    n = parts or max(spark.sparkContext.defaultParallelism, input_bytes(df) // split_bytes(spark))
    full = [*[F.col(c) for c in by or []], *order]
    # Staged, since the readings below must see the same ranges.
    ranged = stage(df.repartitionByRange(int(n), *full).withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_part").orderBy(*full)
    local = ranged.withColumn("_in", (F.row_number().over(inside) - 1).cast("long"))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_before"))
    # One row per range.
    placed = local.join(F.broadcast(before), "_part").withColumn(name, F.col("_in") + F.col("_before")).drop("_part", "_in", "_before")
    if not by:
        return placed
    group = F.struct(*by)
    firsts = placed.groupBy(group.alias("_g")).agg(F.min(name).alias("_first"))
    return placed.withColumn("_g", group).join(firsts, "_g").withColumn(name, F.col(name) - F.col("_first")).drop("_g", "_first")


def at_ranks(df: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """``group, share, quantile``: interpolated quantiles of each group, exact, without one task that holds a group.

    Values are numbered within their group over all ranges, and only the two
    neighbours of each share's place are read; nulls do not count.
    """
    kept = df.where(F.col(value).isNotNull()).select(group, value)
    placed = stage(numbered(kept, [F.col(value)], "_p", by=[group]), "ranks")
    sizes = placed.groupBy(group).agg((F.max("_p") + 1).alias("_n"))
    wanted = sizes.select(group, F.explode(F.array(*[F.lit(x) for x in shares])).alias("share"), "_n").withColumn("_at", F.col("share") * (F.col("_n") - 1))
    ends = wanted.select(group, "share", "_at", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_p"))
    low, high = F.min(value), F.max(value)
    return ends.join(placed, [group, "_p"]).groupBy(group, "share").agg((low + (high - low) * (F.first("_at") - F.floor(F.first("_at")))).alias("quantile"))


def zip_join(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], position: str = "position") -> DataFrame:
    """Rows of the same position, as many as the shorter side has; clashing names of the right side get ``r_``."""
    r = numbered(right, right_order, position)
    r = r.select(position, *[F.col(f"`{c}`").alias(f"r_{c}" if c in left.columns else c) for c in right.columns])
    return numbered(left, left_order, position).join(r, position, "inner")


def unfinished(todo: DataFrame, done: DataFrame, key: str, complete: Column | None = None) -> DataFrame:
    """Rows not done yet, or done without a result."""
    finished = done.where(complete) if complete is not None else done
    return todo.join(finished.select(key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows replaced by new ones of the same key; columns that one side lacks are null."""
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def prefix_counts(groups: DataFrame, rows: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """For each group the number of rows whose value starts with it.

    Values are first counted, and each is joined to its own beginnings, so the
    join is an equi-join at any size; a null value starts with nothing.
    """
    counted = rows.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(F.count("*").alias("_n"))
    lengths = F.sequence(F.lit(0), F.length(value_col))
    starts = counted.select("_n", F.explode(F.transform(lengths, lambda n: F.substring(F.col(value_col), F.lit(1), n))).alias("_start"))
    summed = starts.groupBy("_start").agg(F.sum("_n").alias("n_rows"))
    return groups.select(group_col).distinct().join(summed, F.col(group_col) == F.col("_start"), "left").select(group_col, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def with_constants(df: DataFrame, **values) -> DataFrame:
    """One context for all rows, as literal columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def existing_files(rows: DataFrame, files: DataFrame, path_col: str, file_col: str = "path") -> DataFrame:
    """Rows whose file is in a listing; null and empty paths are not."""
    return rows.where(F.coalesce(F.col(path_col) != "", F.lit(False))).join(files.select(F.col(file_col).alias(path_col)).distinct(), path_col, "left_semi")


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def round_robin(df: DataFrame, key: str, workers: int) -> DataFrame:
    """The worker of each row: the remainder of its number."""
    return df.withColumn("worker", F.pmod(F.col(key), F.lit(workers)).cast("int"))


def head(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first rows in a given order."""
    return df.orderBy(*order).limit(n)


def batches(df: DataFrame, position: str, size: int) -> DataFrame:
    """The batch of each row by its position."""
    return df.withColumn("batch", F.floor(F.col(position) / size).cast("long"))


def unfinished_batches(todo: DataFrame, done: DataFrame, key: str, position: str, size: int, complete: Column | None = None) -> DataFrame:
    """All rows of the batches of which not every row is done; a batch that is partly done is done again whole."""
    numbered_ = batches(todo, position, size)
    open_ = unfinished(numbered_, done, key, complete).select("batch").distinct()
    return numbered_.join(open_, "batch", "left_semi")


def constant_or_per_row(df: DataFrame, name: str, values: str | list | None, position: str) -> DataFrame:
    """One value for all rows, or one for each row by its position from 0; a list of another length than the rows is refused."""
    if values is None or isinstance(values, str):
        return df.withColumn(name, F.lit(values))
    n = df.count()
    if len(values) != n:
        raise ValueError(f"{name} has {len(values)} values for {n} rows")
    spark = df.sparkSession
    return df.join(spark.createDataFrame(list(enumerate(values)), f"{position} long, {name} string"), position, "left")


def row_at(df: DataFrame, position: str, n: int) -> DataFrame:
    """The row of one position; none where there is no such row."""
    return df.where(F.col(position) == n)


def with_key(df: DataFrame, key: str, value: Column) -> DataFrame:
    """A key column written over by another value."""
    return df.withColumn(key, value)
