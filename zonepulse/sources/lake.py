"""Parquet lake: raw trips in, cleaned trips and zone grid out and back."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse import schemas
from zonepulse.operators.cleaning import DEDUP_KEY
from zonepulse.session import materialize, path_exists


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw trips with canonical types for the columns the library uses.

    Each path is one Parquet folder with one physical schema (footers are not merged).
    Give several paths when the physical types changed over the years: each is cast on
    its own. Other columns pass through. A missing path raises.
    """
    def canonical(path: str) -> DataFrame:
        df = spark.read.option("mergeSchema", "false").parquet(path)
        return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in schemas.RAW_TRIP})

    frames = [canonical(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below the paths, from the file system's listing; nothing is opened."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    locations = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in locations)


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, newest modification) of a file or folder of files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(conf).listStatus(location)
    return sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)


def write_partitioned(df: DataFrame, path: str, by: str | tuple[str, ...], mode: str = "overwrite",
                      replace: str = "all", rebalance: bool = True) -> None:
    """Snappy Parquet partitioned by ``by``.

    ``replace="touched"`` overwrites only the partitions present in ``df``. ``rebalance``
    packs each partition into files of AQE's advisory size, splitting large ones. Without
    it every task writes a file per partition value it holds, a dozen small files each for
    months; the price is one more shuffle of what is written.
    """
    by = (by,) if isinstance(by, str) else by
    if rebalance:
        df = df.hint("rebalance", *map(F.col, by))
    (df.write.mode(mode)
       .option("compression", "snappy")
       .option("partitionOverwriteMode", "dynamic" if replace == "touched" else "static")
       .partitionBy(*by)
       .parquet(path))


MONTHS = ("year", "month")
FEW_MONTHS = 6          # up to so many are written without a shuffle that packs them


def in_months(months: list[tuple[int, int]]) -> Column:
    """A filter on the folders of a clean lake."""
    return (F.concat_ws("-", *MONTHS).isin([f"{y}-{m}" for y, m in months])
            & F.col("year").isin(sorted({y for y, _ in months})))


def stored_keys(spark: SparkSession, path: str, months: list[tuple[int, int]]) -> DataFrame | None:
    """Keys of the lake's trips in these months; nothing if there is no lake."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).where(in_months(months)).select(*DEDUP_KEY)


def append_trips(clean: DataFrame, path: str, months: int) -> None:
    """Append distinct trips that the lake doesn't have to its months' folders."""
    dated = clean.withColumn("year", F.year("tpep_pickup_datetime"))
    write_partitioned(dated, path, MONTHS, mode="append", rebalance=months > FEW_MONTHS)


def write_clean_trips(clean: DataFrame, path: str, replace: str = "touched", **options) -> None:
    """Merge distinct cleaned trips into the lake, by pickup year and month.

    Monthly files hold a few trips of neighbouring months, so nothing is replaced: trips whose key the touched months have
    already are left out, the others are appended. Of the lake only the keys of these months are read. A rerun changes
    nothing. ``replace="all"`` starts the lake anew.
    """
    spark = clean.sparkSession
    if replace == "all" or not path_exists(spark, path):
        dated = clean.withColumn("year", F.year("tpep_pickup_datetime"))
        write_partitioned(dated, path, MONTHS, replace="all", **options)
        return
    batch = materialize(clean, "clean-batch")
    months = months_of(batch)
    new = batch.join(stored_keys(spark, path, months), list(DEDUP_KEY), "left_anti")
    append_trips(new, path, len(months))


def months_of(trips: DataFrame) -> list[tuple[int, int]]:
    """Calendar months of the trips' pickups."""
    pickup = F.col("tpep_pickup_datetime")
    return sorted(tuple(r) for r in trips.select(F.year(pickup), F.month(pickup)).distinct().collect())


def read_clean_trips(spark: SparkSession, path: str) -> DataFrame:
    """Filter on ``year`` and ``month`` to read only those folders."""
    return spark.read.parquet(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Filter on ``hour_of_day`` or ``grid_month`` (first day of the month) to read only those folders."""
    return spark.read.parquet(path)
