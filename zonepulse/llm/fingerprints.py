"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct shingle hashes of a text; the sketch
of a union is made from the sketches alone, so parts of a text or of a corpus can be sketched
apart. Null and empty texts, and texts without words, have the empty sketch. Texts of fewer than
five words are one shingle.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse.llm.text import plain, shingle_hashes, words
from zonepulse.llm.rows import number_rows

K = 128
HASHES = 1 << 64


def sketch(df: DataFrame, text: str = "text", into: str = "sketch", k: int = K) -> DataFrame:
    """``df`` with the sketch of column ``text``."""
    return (df.withColumn("_words", words(F.col(text)))
            .withColumn(into, F.slice(F.sort_array(F.array_distinct(shingle_hashes("_words"))), 1, k))
            .drop("_words"))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches describe."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, *keys: str, into: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of sketches: the k smallest distinct hashes of each group.

    Hashes are spread over salted parts of a group first, each cut to its k smallest, so a group
    with most of the rows isn't gathered in one task; a last step sees k hashes per part.
    """
    spread = df.select(*keys, F.explode(into).alias("_h")).distinct().withColumn("_part", F.pmod("_h", F.lit(64)))
    smallest = F.slice(F.sort_array(F.collect_list("_h")), 1, k)
    by_part = (spread.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*keys, "_part").orderBy("_h"))).where(F.col("_rank") <= k))
    return by_part.groupBy(*keys).agg(smallest.alias(into))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two empty sketches: 1, one: 0."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    largest = a[F.size(a) - 1].cast("double") + HASHES / 2
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (largest / HASHES))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; an empty a: 1."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as one string: 16 hex digits per hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each (key, text) with what its next one, by ascending key, contributes: ``next_start`` (its
    first code points, a quarter of this text's number) and ``next_sketch``; after the last comes
    the first.

    Only keys, lengths and text hashes are ordered. Each document then sends its start and sketch to its predecessor by
    a join on (key, text hash). Rows repeated in both are one document here and all get the same
    result; a document that is alone is its own next one.
    """
    # The lowest bit of the hash tells a null key from the zero that stands for it.
    df = plain(df, "next_start", "next_sketch")
    null = F.col(key).isNull().cast("bigint")
    docs = (df.withColumn(text, F.coalesce(text, F.lit("")))
            .withColumns({"_hash": F.xxhash64(text).bitwiseAND(-2) + null,
                          "_key": F.coalesce(F.col(key).cast("bigint"), F.lit(0))})
            .select("_key", "_hash", text, *(c for c in df.columns if c not in (key, text))))
    light = docs.select("_key", "_hash", F.length(text).alias("_length")).distinct()
    numbered, total = number_rows(light.withColumn("_real", F.col("_hash").bitwiseAND(1) == 0),
                                  "_real", "_key", "_hash", into="_n")
    before = numbered.select(F.col("_key").alias("to_key"), F.col("_hash").alias("to_hash"),
                             F.floor(F.col("_length") / 4).cast("int").alias("_wanted"),
                             ((F.col("_n") + 1) % F.lit(max(total, 1))).alias("_n"))
    sender = numbered.select("_key", "_hash", "_n").join(before, "_n").drop("_n")
    single = docs.select("_key", "_hash", text).join(sender, ["_key", "_hash"])
    if df.count() > total:
        single = single.dropDuplicates(["_key", "_hash"])
    sent = sketch(single, text, "next_sketch").select(
        F.col("to_key").alias("_key"), F.col("to_hash").alias("_hash"), "next_sketch",
        F.expr(f"substring({text}, 1, _wanted)").alias("next_start"))
    return (docs.join(sent, ["_key", "_hash"], "left")
            .withColumn(key, F.when(F.col("_hash").bitwiseAND(1) == 0, F.col("_key"))).drop("_key", "_hash"))
