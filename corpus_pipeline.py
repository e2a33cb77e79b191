"""A corpus from raw documents to token ids: five stages, each an operator of ``zonepulse.llm``.

Toxic and poor documents go, near copies are reduced to their least doc_id, sources are mixed to their weights (a
document taken twice is two rows, one not taken is none), and what remains becomes token ids.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.llm import bpe, jaccard_join, mixing, quality, toxicity
from zonepulse.llm.queries import BPE_RANKS, source_weights, vocabulary
from zonepulse.llm.text import words
from zonepulse.session import materialize, scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.5
ORACLE_SQL = None       # a language model's scores and seeded hashes can't be stated in SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the model learns from labelled documents that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.select(*COLUMNS), model, into="_score").where(F.col("_score") < TOXIC).drop("_score")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge(docs.select(*COLUMNS), keep_text=True).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, that of the least doc_id; those without a word or a doc_id stay."""
    return jaccard_join.keep_representatives(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; repeated rows are chosen, and counted, together."""
    keyed = docs.select(*COLUMNS).withColumn("digest", F.xxhash64("text", "lang", "source"))
    size = F.size(words(F.col("text"))).cast("bigint")
    light = materialize(keyed.select("doc_id", "digest", "source", size.alias("words"))
                        .groupBy("doc_id", "digest", "source").agg(F.sum("words").alias("size")), "sizes")
    mixed, _, _ = mixing.mix(light, F.array("source"), "size", source_weights)
    taken = mixed.where("repeats > 0").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_of"), "repeats")
    return (keyed.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_of")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and digests of them and of what they decode to."""
    ranks = vocabulary(BPE_RANKS)
    coded = bpe.encode(docs.select("doc_id", "source", "text"), ranks).withColumn("n_tokens", F.size("ids").cast("bigint"))
    return bpe.decode(coded, ranks, id_bytes="ids_bytes").select(
        "doc_id", "source", "n_tokens", F.col("ids_bytes").alias("ids"), F.sha2("ids_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("near copies", drop_near_copies),
    ("source mix", mix_sources),
    ("byte bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to shared storage and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
