"""Reports: counts with totals, verdicts, lists of ids, most frequent labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOTAL = "TOTAL"


def share_report(df: DataFrame, group: str, hit: Column, places: int = 2) -> DataFrame:
    """Rows, hits and their percentage for each group and for all together; 0 percent of nothing.

    Hits are counted map-side, so a hot group is no burden.  An empty table
    gives no row; a null group is named ``none``.
    """
    named = df.select(F.coalesce(F.col(group).cast("string"), F.lit("none")).alias(group), F.coalesce(hit, F.lit(False)).alias("_hit"))
    rolled = named.rollup(group).agg(F.count("_hit").alias("n_rows"), F.count_if("_hit").alias("n_hits"))
    return rolled.select(
        F.coalesce(group, F.lit(TOTAL)).alias(group), "n_rows", "n_hits",
        F.when(F.col("n_rows") > 0, F.round(F.col("n_hits") / F.col("n_rows") * 100, places)).otherwise(0.0).alias("hit_pct"),
    )


def verdict_report(df: DataFrame, group: str, verdict: Column) -> DataFrame:
    """Kept, discarded and unclear answers and the rate kept, for each group and in total."""
    named = df.select(F.coalesce(F.col(group).cast("string"), F.lit("none")).alias(group), F.coalesce(verdict, F.lit("ERROR")).alias("_v"))
    rolled = named.rollup(group).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("_v") == "KEEP").alias("n_keep"), F.count_if(F.col("_v") == "DISCARD").alias("n_discard"),
        F.count_if(~F.col("_v").isin("KEEP", "DISCARD")).alias("n_error"),
    )
    return rolled.withColumn(group, F.coalesce(group, F.lit(TOTAL))).withColumn(
        "keep_pct", F.when(F.col("n_rows") > 0, F.round(F.col("n_keep") / F.col("n_rows") * 100, 1)).otherwise(0.0)
    )


def id_lists(df: DataFrame, group: str, chosen: Column, id_col: str, empty: str = "None.", block: int = 10_000) -> DataFrame:
    """The chosen ids of each group in order, joined by commas, in blocks of at most ``block`` ids.

    A group without any gives one row that says so.  Blocks keep a hot group
    from becoming one value; their number stands in ``block``.
    """
    hits = df.where(F.coalesce(chosen, F.lit(False))).select(group, id_col)
    spread = hits.withColumn("_bucket", F.floor(F.col(id_col) / block).cast("long"))
    lists = spread.groupBy(group, "_bucket").agg(F.array_sort(F.collect_list(id_col)).alias("_ids"))
    by = Window.partitionBy(group).orderBy("_bucket")
    named = lists.select(group, (F.row_number().over(by) - 1).cast("long").alias("block"), F.array_join(F.transform("_ids", lambda x: x.cast("string")), ", ").alias("ids"))
    groups = df.select(group).distinct()
    return groups.join(named, group, "left").select(group, F.coalesce("block", F.lit(0)).cast("long").alias("block"), F.coalesce("ids", F.lit(empty)).alias("ids"))


def top_labels(df: DataFrame, group: str, label: str, order: Column, k: int = 3, exclude: tuple[str, ...] = ("neutral",)) -> DataFrame:
    """The ``k`` most frequent labels of each group; of equally frequent ones the one seen first by ``order``.

    Counts are aggregated before they are ranked, so a window holds one row per label.
    """
    kept = df.where(F.col(label).isNotNull() & ~F.col(label).isin(*exclude)) if exclude else df.where(F.col(label).isNotNull())
    counts = kept.groupBy(group, label).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), F.asc("_first"), F.asc(label)))
    return counts.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).drop("_first")


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Values with their counts, the most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))


def processed_counts(df: DataFrame, ok: Column) -> DataFrame:
    """Rows processed and skipped."""
    return df.agg(F.count_if(F.coalesce(ok, F.lit(False))).alias("processed"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("skipped"))


def latest_checkpoint(paths: DataFrame, path: str = "path") -> DataFrame:
    """The path with the highest number behind ``checkpoint-``."""
    step = F.regexp_extract(path, r"checkpoint-(\d+)/?$", 1).try_cast("long")
    return paths.where(step.isNotNull()).agg(F.max_by(F.col(path), step).alias(path))


def speaker_samples(manifest: DataFrame, speaker: str, position: str, per_block: int = 1000) -> DataFrame:
    """Samples of each speaker in order of position, in blocks of at most ``per_block``."""
    keyed = manifest.withColumn("_b", F.floor(F.col(position) / per_block).cast("long"))
    rest = [c for c in manifest.columns if c != speaker]
    return keyed.groupBy(speaker, F.col("_b").alias("block")).agg(F.array_sort(F.collect_list(F.struct(position, *[c for c in rest if c != position]))).alias("samples"))
