"""Reproducible exact splits and folds.

Rows are ordered by a hash of their key, so a split depends on neither partitioning nor
read order.
"""

from pyspark.sql import DataFrame, Window, functions as F

from zonepulse import rules

KEY = ("zone_id", "hour_bucket")


def hash_positions(df: DataFrame, key: tuple[str, ...] = KEY, seed: int = rules.SEED,
                   within: str | None = None) -> DataFrame:
    """Add ``position`` (from 1) in hash order, and ``group_rows``, within each value of ``within``.

    Positions are counted per slice of the hash (4,096 slices per group) and shifted by the
    sizes of the earlier slices, so one dominant group still spreads over all tasks. ``df``
    is read twice; pass a stored frame.
    """
    digest = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in key), F.lit(str(seed))))
    group = [within] if within else []
    hashed = df.withColumn("_hash", digest).withColumn("_slice", F.substring("_hash", 1, 3))

    sizes = hashed.groupBy(*group, "_slice").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most 4,096 rows per group.
    offsets = sizes.select(
        *(F.col(g).alias("_group") for g in group), F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("group_rows"))

    in_slice = Window.partitionBy(*group, "_slice").orderBy("_hash")
    same = F.col("_slice") == F.col("_of")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col("_group"))
    return (hashed.withColumn("_position", F.row_number().over(in_slice))
                  .join(offsets, same)
                  .withColumn("position", F.col("_position") + F.col("_offset"))
                  .select(*df.columns, "position", "group_rows"))


def train_test(df: DataFrame, test_percent: int = 20, stratify: str | None = None,
               key: tuple[str, ...] = KEY, seed: int = rules.SEED) -> DataFrame:
    """Add ``is_train``. The test share is exact and rounded up, per class if stratified."""
    placed = hash_positions(df, key, seed, stratify)
    test_rows = F.ceil(F.col("group_rows") * test_percent / 100)
    return (placed.withColumn("is_train", F.col("position") > test_rows)
                  .drop("position", "group_rows"))


def stratified_folds(df: DataFrame, label: str, folds: int = 5,
                     key: tuple[str, ...] = KEY, seed: int = rules.SEED) -> DataFrame:
    """Add ``fold`` in 0..folds-1; every class is spread evenly over the folds."""
    placed = hash_positions(df, key, seed, label)
    return (placed.withColumn("fold", (F.col("position") % folds).cast("int"))
                  .drop("position", "group_rows"))
