"""Sharding by a keyed permutation of global row numbers.

A Feistel network permutes ``[0, a*b)`` with ``a*b`` just above the number of rows; results outside
the rows are permuted again (cycle walking) until they fall inside. The permuted number gives the
shard (remainder) and the slot (quotient), so counts per shard differ by one at most, slots are
gapless, and where any row goes, or which row sits in a slot, is computed without any table.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.llm.rows import number_rows
from zonepulse.llm.text import plain

ROUNDS = 6
WALK = 32       # enough for any N <= 1024; beyond, a longer walk has a chance below N * N**-16
SEED = 20240


def _halves(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _network(x: Column, rows: int, seed: int, forward: bool) -> Column:
    """One pass of the network: rounds add a hash of one half to the other, in turn."""
    a, b = _halves(rows)
    order = list(range(ROUNDS)) if forward else list(range(ROUNDS - 1, -1, -1))

    def step(state: Column, k: Column) -> Column:
        left, right = state["l"], state["r"]
        sign = 1 if forward else -1
        mixed_left = F.pmod(left + sign * F.pmod(F.xxhash64(right, k, F.lit(seed)), F.lit(a)), F.lit(a))
        mixed_right = F.pmod(right + sign * F.pmod(F.xxhash64(left, k, F.lit(seed)), F.lit(b)), F.lit(b))
        even = k % 2 == 0
        return F.struct(F.when(even, mixed_left).otherwise(left).cast("bigint").alias("l"),
                        F.when(even, right).otherwise(mixed_right).cast("bigint").alias("r"))

    start = F.struct(F.floor(x / F.lit(b)).cast("bigint").alias("l"), F.pmod(x, F.lit(b)).cast("bigint").alias("r"))
    return F.aggregate(F.array(*map(F.lit, order)), start, step, lambda s: s["l"] * b + s["r"])


def permuted(number: Column, rows: int, seed: int = SEED, forward: bool = True) -> Column:
    """The number's image in a permutation of ``0 .. rows - 1`` (``forward=False``: its preimage)."""
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), _network(number, rows, seed, forward),
        lambda y, _: F.when(y < rows, y).otherwise(_network(y, rows, seed, forward)))
    return F.when(walked < rows, walked).otherwise(
        F.raise_error(F.lit("cycle walk too long: take another seed")).cast("bigint"))


def shard_rows(df: DataFrame, shards: int, *order: str, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (bigint, gapless from 0 in each shard).

    The order of ``df``'s rows by ``order`` numbers them; rows equal there are interchangeable, so
    name enough columns to tell rows apart. Texts and other heavy columns are best joined or
    written afterwards by key: every column passed goes through one range shuffle. Null keys
    come first; repeated rows get slots of their own; an empty frame gives no rows.
    """
    numbered, total = number_rows(plain(df, "shard", "slot"), *order, into="_number")
    place = F.col("_place")
    return (numbered.withColumn("_place", permuted(F.col("_number"), total, seed))
            .withColumns({"shard": (place % shards).cast("int"),
                          "slot": F.floor(place / shards).cast("bigint")})
            .drop("_number", "_place"))


def row_at(shard: Column, slot: Column, shards: int, rows: int, seed: int = SEED) -> Column:
    """Number (from 0, in the order sharded by) of the row that sits in a slot of a shard."""
    return permuted(slot * shards + shard, rows, seed, forward=False)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, each sorted by slot."""
    (sharded.repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
