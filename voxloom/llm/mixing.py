"""Problem 9: mixing sources to target weights.

Method: Sainte-Laguë apportionment.  The tokens of the mix are cut into equal
blocks; each block goes to the source with the highest quotient of its target
share by 2k+1, where k blocks are its own already, until a source has reached
the cap that its size and ``max_repeats`` set.  The blocks of a source are
apportioned in the same way to groups of shards, and those of a group to its
shards, by their tokens; in each shard documents are taken in a seeded order
until the shard's quota is full: whole rounds first, then the last one as far as
it goes.  A shard holds about ``SHARD_TOKENS``, however large its source is.

Documents with a null or unlisted source, or without a token, are not mixed.
A source without documents gets nothing, and its share goes to the others.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.tokens import count_tokens
from voxloom.session import stage

#: Tokens of a block and tokens that a shard should hold, at every size of the corpus.
BLOCK_TOKENS = 16
SHARD_TOKENS = 2_000_000
#: Shards whose quotas are set in one task; the driver holds one row per source and so many shards of it.
GROUP_SHARDS = 4096


def sainte_lague(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotients w/(2k+1); ties go to the earlier one; ``caps`` bound the seats of each.

    Rounding w/d to whole seats gives the highest quotients for a divisor d.
    The smallest divisor that does not give too many seats is found by
    bisection; seats that a slightly larger one gives are sure, and those that
    are left, at most about one for each party, go one by one.
    """
    caps = [seats] * len(weights) if caps is None else caps
    live = [i for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    if sum(caps[i] for i in live) <= seats:
        return [c if w > 0 else 0 for w, c in zip(weights, caps)]

    def rounded(divisor: float) -> list[int]:
        return [min(caps[i], int(weights[i] / divisor + 0.5)) for i in live]

    low, high = 0.0, 4 * max((weights[i] for i in live), default=1.0)
    while low < (middle := (low + high) / 2) < high:
        if sum(rounded(middle)) > seats:
            low = middle
        else:
            high = middle
    got = [0] * len(weights)
    for i, k in zip(live, rounded(high * (1 + 1e-12))):
        got[i] = k
    left = seats - sum(got)
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in live if got[i] < caps[i]]
    heapq.heapify(heap)
    while heap and left > 0:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def sized_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens`` of every document, computed once and staged."""
    listed = docs.where(F.col("source").isNotNull())
    return stage(count_tokens(listed, "doc_id", "text", ("source",), path), "tokens")


QUOTAS = "source string, shard long, n_shards long, quota_tokens long, shard_tokens long, max_repeats long"


def plan_quotas(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, block: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Quotas of shards (``source, shard, n_shards, quota_tokens, shard_tokens``) and the sources' plan.

    The driver gets one row per listed source, and one for each group of
    ``GROUP_SHARDS`` shards, which is one for some eight thousand million tokens.
    """
    spark = sized.sparkSession
    listed = targets.where("source is not null and target_share > 0 and max_repeats > 0")
    want = [(r.source, float(r.target_share), int(r.max_repeats)) for r in listed.orderBy("source").collect()]
    sizes = {r.source: r.t for r in sized.join(listed.select("source"), "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    have = [int(sizes.get(s) or 0) for s, _, _ in want]
    total = sum(have) if total_tokens is None else total_tokens
    caps = [t * m // block for t, (_, _, m) in zip(have, want)]
    seats = sainte_lague([w for _, w, _ in want], total // block, caps)
    counts = spark.createDataFrame(
        [(s, max(1, -(-t // shard_tokens)), m) for (s, _, m), t in zip(want, have)], "source string, n_shards long, max_repeats long"
    )
    per = _with_shard(sized, counts).groupBy("source", "shard", "n_shards", "max_repeats").agg(F.sum("n_tokens").alias("shard_tokens"))
    per = stage(per.withColumn("group", F.floor(F.col("shard") / GROUP_SHARDS)), "shards")
    whole = F.ceil(F.col("shard_tokens") * F.col("max_repeats") / block).cast("long")
    groups = per.groupBy("source", "group").agg(F.sum("shard_tokens").alias("t"), F.sum(whole).alias("cap")).collect()
    given = []
    for (source, _, _), n in zip(want, seats):
        own = sorted((r.group, r.t, r.cap) for r in groups if r.source == source)
        given += [(source, g, k) for (g, _, _), k in zip(own, sainte_lague([float(t) for _, t, _ in own], n, [c for _, _, c in own]))]

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        tokens, most = pdf["shard_tokens"], pdf["shard_tokens"] * pdf["max_repeats"]
        blocks = sainte_lague(tokens.astype(float).tolist(), int(pdf["seats"].iloc[0]), (-(-most // block)).tolist())
        quota = pd.concat([pd.Series(blocks, index=pdf.index) * block, most], axis=1).min(axis=1)
        return pdf.assign(quota_tokens=quota)[[f.split()[0] for f in QUOTAS.split(", ")]]

    blocks = spark.createDataFrame(given, "source string, group long, seats long")
    quotas = stage(per.join(blocks, ["source", "group"]).groupBy("source", "group").applyInPandas(split, QUOTAS), "quotas")
    plan = spark.createDataFrame(
        [(s, share, m, t, n * block) for (s, share, m), t, n in zip(want, have, seats)],
        "source string, target_share double, max_repeats long, source_tokens long, quota_tokens long",
    )
    return quotas, plan


def _with_shard(sized: DataFrame, counts: DataFrame) -> DataFrame:
    """Each document's shard, by hash of its id."""
    joined = sized.where("n_tokens > 0").join(counts, "source")
    return joined.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.col("n_shards")))


def choose(sized: DataFrame, quotas: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id, source, n_tokens, repeats`` of the chosen documents.

    A document is in the last round when the middle of its tokens lies inside
    what remains of the quota, so that shards miss their quota by half a
    document at most.  The window holds one shard, whose size does not grow
    with the source.
    """
    counts = quotas.select("source", "n_shards").distinct()
    placed = _with_shard(sized, counts)
    joined = placed.join(quotas.drop("n_shards"), ["source", "shard"])
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    rounds = F.floor(F.col("quota_tokens") / F.col("shard_tokens")).cast("long")
    rest = F.col("quota_tokens") - rounds * F.col("shard_tokens")
    before = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    last = F.when((before + F.col("n_tokens") / 2 <= rest) & (rounds < F.col("max_repeats")), 1).otherwise(0)
    return joined.select("doc_id", "source", "n_tokens", (rounds + last).cast("long").alias("repeats")).where("repeats > 0")


def share_report(chosen: DataFrame, plan: DataFrame) -> DataFrame:
    """Target and actual share of each source, its tokens, documents and most repeats."""
    got = chosen.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("most_repeats")
    )
    joined = plan.join(got, "source", "left")
    mixed = F.coalesce("mixed_tokens", F.lit(0))
    # The window runs over one row per source.
    total = F.sum(mixed).over(Window.partitionBy())
    return joined.select(
        "source", "target_share", "max_repeats", "source_tokens", "quota_tokens",
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"), mixed.alias("mixed_tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.when(total > 0, mixed / total).otherwise(F.lit(0.0)).alias("actual_share"),
    )


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen documents with their repeats, and the report of shares."""
    sized = sized_documents(docs, path)
    quotas, plan = plan_quotas(sized, targets, total_tokens)
    chosen = choose(sized, quotas, seed)
    return chosen, share_report(chosen, plan)
