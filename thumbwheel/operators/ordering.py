"""Global order without a global sort in one task.

Positions come from counts (or sums) per slice of the key space: only those
per-slice totals meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thumbwheel.functions.tokens import attention_mask, pad_to
from thumbwheel.session import remove_path, scratch_path


def shuffle_batches(
    df: DataFrame,
    key: str,
    seed: int,
    batch: int,
    micro_batch: int,
    epochs: int = 1,
    within: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """A fresh permutation per epoch, cut into contiguous mini- and micro-batches.

    Rows are ordered by a digest of (seed, epoch, key). The digest's first
    digits cut the order into evenly filled buckets, so each row's position is
    its rank in its bucket plus the rows of the buckets before. ``within``
    permutes inside each group (an update) instead of over the table. ``key`` is
    unique (within its group).

    ``buckets`` (per epoch and group) follows ``spark.sql.shuffle.partitions``
    unless given: a bucket is ranked by one task, so it should hold about as
    many rows as a shuffle partition, and 1 serves groups that fit into a task.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Eight digits scaled to the number of buckets: later digests never lie in earlier buckets.
    first_digits = F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long")
    groups = ["ppo_epoch", *within]
    hashed = (
        df.withColumn("ppo_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn(
            "__digest",
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("ppo_epoch"), F.col(key))),
        )
        .withColumn("__bucket", F.shiftright(first_digits * buckets, 32).cast("int"))
    )
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        hashed.groupBy(*groups, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *groups, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
        )
    )
    rank = F.row_number().over(Window.partitionBy(*groups, "__bucket").orderBy("__digest", key))
    return (
        hashed.withColumn("__rank", rank)
        .join(offsets, [*groups, "__bucket"])
        .withColumn("position", F.col("__before") + F.col("__rank") - 1)
        .withColumn("minibatch", F.floor(F.col("position") / batch).cast("long"))
        .withColumn(
            "microbatch", F.floor(F.pmod(F.col("position"), F.lit(batch)) / micro_batch).cast("long")
        )
        .drop("__digest", "__bucket", "__rank", "__before")
    )


def running_offsets(
    spark: SparkSession, df: DataFrame, order: Sequence[str], length: str
) -> DataFrame:
    """Each key with the sum of all lengths before it (``start``) and overall (``grand_total``).

    ``order`` must be a total order. Keys and lengths are written to the shared
    work folder first: sorting into ranges reads its input twice (sample, then
    shuffle), and the texts behind the lengths should be read once. The ranges
    are written too, because their totals and their rows are read separately
    and must agree on which range a row belongs to. The lengths are deleted
    again; the ranges stay in the work folder as long as the result is in use.
    """
    sizes = scratch_path(spark, "lengths")
    df.select(*order, length).write.parquet(sizes)
    path = scratch_path(spark, "ranges")
    (
        spark.read.parquet(sizes)
        .repartitionByRange(*order)
        .withColumn("__range", F.spark_partition_id())
        .write.parquet(path)
    )
    remove_path(spark, sizes)
    ranges = spark.read.parquet(path)
    totals = ranges.groupBy("__range").agg(F.sum(length).alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("__range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # One row per range of the shuffle, never per input row.
    offsets = F.broadcast(
        totals.select(
            "__range",
            F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"),
            F.sum("__sum").over(whole).alias("grand_total"),
        )
    )
    inside = (
        Window.partitionBy("__range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranges.withColumn("__upto", F.sum(length).over(inside))
        .join(offsets, "__range")
        .withColumn("start", F.col("__before") + F.col("__upto") - F.col(length))
        .drop("__range", "__upto", "__before")
    )


def previous_in_group(spark: SparkSession, df: DataFrame, group: str, key: str) -> DataFrame:
    """``group, key, previous``: the key before each row's own in its group; the first row gets the last one's.

    ``key`` is unique. Groups and keys are sorted into ranges, which are written because
    their edges and their rows must agree; a group may lie in any number of ranges. Inside a range
    a window looks back one row; of every (range, group) one edge row goes on to find the
    key before its first.
    """
    path = scratch_path(spark, "key-ranges")
    (
        df.select(group, key)
        .repartitionByRange(group, key)
        .withColumn("__range", F.spark_partition_id())
        .write.parquet(path)
    )
    ranges = spark.read.parquet(path)
    inside = Window.partitionBy("__range", group).orderBy(key)
    rows = ranges.withColumn("__before", F.lag(key).over(inside)).withColumn(
        "__first", F.row_number().over(inside) == 1
    )
    # At most one row per range in a group.
    along = Window.partitionBy(group).orderBy("__range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = ranges.groupBy("__range", group).agg(F.max(key).alias("__last"))
    edges = edges.select(
        "__range",
        F.col(group).alias("__group"),
        F.coalesce(F.lag("__last").over(along), F.last("__last").over(whole)).alias("__edge"),
    )
    same = (rows["__range"] == edges["__range"]) & rows[group].eqNullSafe(edges["__group"])
    return rows.join(edges, same).select(
        group, key, F.when(F.col("__first"), F.col("__edge")).otherwise(F.col("__before")).alias("previous")
    )


def dense_ordinals(spark: SparkSession, df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``order`` columns and the row's place, 0 onwards without gaps, in their order."""
    placed = running_offsets(spark, df.select(*order, F.lit(1).cast("long").alias("__one")), order, "__one")
    return placed.select(*order, F.col("start").alias(name))


def pack_sequences(
    spark: SparkSession,
    df: DataFrame,
    order: Sequence[str],
    tokens: Column,
    block: int = 2048,
    separator: int = 1,
) -> DataFrame:
    """Fixed-size blocks cut from the concatenated token streams.

    Every document contributes its tokens and ``separator`` more; one row per
    (block, document) gives the half-open token range ``from_token, to_token``
    inside the document. The last block is dropped unless full.
    """
    sized = df.select(*order, (tokens + separator).cast("long").alias("n_stream"))
    placed = running_offsets(spark, sized, order, "n_stream")
    end = F.col("start") + F.col("n_stream")
    last_block = F.floor((end - 1) / F.lit(block))
    full_blocks = F.floor(F.col("grand_total") / F.lit(block))
    return (
        placed.withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("start") / F.lit(block)), last_block))
        )
        .where(F.col("block") < full_blocks)
        .select(
            "block",
            *order,
            F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("from_token"),
            F.least((F.col("block") + 1) * block - F.col("start"), F.col("n_stream")).alias(
                "to_token"
            ),
        )
    )


def block_tokens(
    starts: DataFrame, documents: DataFrame, order: Sequence[str], ids: str, block: int = 2048, eos: int = 1
) -> DataFrame:
    """The token array of every packed block; a block never holds more than its size.

    ``starts`` has a row per document (``start`` and ``grand_total`` of
    ``running_offsets``): a document's tokens meet their place once and are cut
    there, so the work grows with the tokens, not with tokens times blocks.
    """
    stream = F.concat(F.col(ids), F.array(F.lit(eos)))
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.size("__ids") - 1) / block)

    def cut(b: Column) -> Column:
        begin = F.greatest(b * block - F.col("start"), F.lit(0)).cast("int")
        end = F.least((b + 1) * block - F.col("start"), F.size("__ids").cast("long")).cast("int")
        return F.struct(b.alias("block"), F.slice("__ids", begin + 1, end - begin).alias("piece"))

    full = F.floor(F.col("grand_total") / block)
    return (
        documents.select(*order, stream.alias("__ids"))
        .join(starts.select(*order, "start", "grand_total"), list(order))
        .select(*order, "grand_total", F.inline(F.transform(F.sequence(first, last), cut)))
        .where(F.col("block") < full)
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct(*order, "piece"))).alias("pieces"))
        .select("block", F.flatten(F.transform("pieces", lambda p: p["piece"])).alias("input_ids"))
    )


def pad_batch(
    df: DataFrame, ids: str, ordinal: str, batch_size: int, pad: int = 0, side: str = "right"
) -> DataFrame:
    """Batches of consecutive rows padded to their longest row, with an attention mask.

    ``ordinal`` orders the rows and is unique; it may have gaps. Rows are numbered
    without gaps first, so every batch but the last is full and the window below
    never spans more than ``batch_size`` rows.
    """
    batch = Window.partitionBy("batch_id")
    width = F.max(F.size(ids)).over(batch)
    places = dense_ordinals(df.sparkSession, df, [ordinal], "__place")
    return (
        df.join(places, ordinal)
        .withColumn("batch_id", F.floor(F.col("__place") / F.lit(batch_size)).cast("long"))
        .drop("__place")
        .withColumn("width", width)
        .withColumn("attention_mask", attention_mask(F.col(ids), F.col("width"), side))
        .withColumn(ids, pad_to(F.col(ids), F.col("width"), pad, side))
    )
