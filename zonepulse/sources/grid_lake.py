"""The grid lake: cells by hour of the day and month, kept up to date cell by cell.

A cell's aggregates depend on its own trips alone, its previous-hour columns on the zone's cell before. So new trips change
their cells and, of each zone, the cell that follows. What lies outside the touched months enters through borders: a small table of
each zone's first and last cell in each month, beside the grid.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonepulse.operators.grid import add_previous_hour, by_zone_hour, label_congestion, zone_hour_aggregates
from zonepulse.session import materialize, path_exists
from zonepulse.sources import lake
from zonepulse.sources.lake import write_partitioned

FOLDERS = ("hour_of_day", "grid_month")
KEY = ("zone_id", "hour_bucket")
PREVIOUS = ("prev_hour_speed", "prev_hour_trips")


def borders_path(path: str) -> str:
    return f"{path.rstrip('/')}_borders"


def with_month(cells: DataFrame) -> DataFrame:
    return cells.withColumn("grid_month", F.date_trunc("month", "hour_bucket").cast("date"))


def borders(cells: DataFrame) -> DataFrame:
    """Each zone's first and last cell of each month, as far as neighbouring months need them."""
    last = F.max_by(F.struct("avg_speed", "trip_count"), "hour_bucket")
    first = F.min_by(F.struct(*PREVIOUS), "hour_bucket")
    return (with_month(cells).groupBy("zone_id", "grid_month")
            .agg(F.min("hour_bucket").alias("first_hour"), F.max("hour_bucket").alias("last_hour"), first.alias("first"), last.alias("last"))
            .select("zone_id", "first_hour", "last_hour", *(F.col(f"first.{c}").alias(c) for c in PREVIOUS), "last.avg_speed",
                    "last.trip_count", "grid_month"))


def write_grid(grid: DataFrame, path: str, **options) -> None:
    """The whole grid anew, and its borders."""
    write_partitioned(with_month(grid), path, FOLDERS, **options)
    write_partitioned(borders(grid.sparkSession.read.parquet(path)), borders_path(path), "grid_month")


def changed_cells(trips: DataFrame) -> DataFrame:
    """(zone_id, hour_bucket) of the trips."""
    return trips.select(F.col("PULocationID").alias("zone_id"),
                        F.date_trunc("hour", "tpep_pickup_datetime").alias("hour_bucket")).distinct()


def aggregated(clean: DataFrame, changed: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """The changed cells from all of the lake's trips in them; only these months are read."""
    of = changed.select(F.col("zone_id").alias("_zone"), F.col("hour_bucket").alias("_hour"))
    inside = clean.where(lake.in_months(months)).join(
        of, (F.col("PULocationID") == F.col("_zone")) & (F.date_trunc("hour", "tpep_pickup_datetime") == F.col("_hour")), "left_semi")
    return inside.transform(zone_hour_aggregates).transform(label_congestion)


def with_previous_hours(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """``cells`` with previous-hour columns, ``follows`` (the cell before is a changed one) and ``is_border``.

    ``edges``: borders of other months. Their first and last cells stand in the zones' order as well; the first ones are returned, with
    what they had before as ``had_*``.
    """
    both = F.col("first_hour") == F.col("last_hour")
    firsts = edges.select("zone_id", F.col("first_hour").alias("hour_bucket"), F.when(both, F.col("avg_speed")).alias("avg_speed"),
                          F.when(both, F.col("trip_count")).alias("trip_count"), *(F.col(c).alias(f"had_{c}") for c in PREVIOUS),
                          F.lit(True).alias("is_border"), F.lit(True).alias("is_first"))
    lasts = edges.where(~both).select("zone_id", F.col("last_hour").alias("hour_bucket"), "avg_speed", "trip_count",
                                      F.lit(True).alias("is_border"), F.lit(False).alias("is_first"))
    rows = cells.withColumns({"is_border": F.lit(False), "is_first": F.lit(True)})
    rows = rows.unionByName(firsts, allowMissingColumns=True).unionByName(lasts, allowMissingColumns=True)
    rows = rows.withColumn("follows", F.coalesce(F.lag("changed").over(by_zone_hour()), F.lit(False)))
    return add_previous_hour(rows).where("is_first").drop("is_first")


def update_grid(spark: SparkSession, clean_path: str, path: str, changed: DataFrame) -> DataFrame:
    """Bring the grid up to date with the lake's trips in the ``changed`` cells; returns these cells as they are now, or all of a new grid.

    Read are the touched months of lake and grid, and the borders; written are the folders (hour of the day, month) with a changed
    cell or one that follows such a cell. A repeated update changes nothing; one that failed is repaired by the next
    update with the same cells. Without a grid all of the lake is aggregated.
    """
    clean = lake.read_clean_trips(spark, clean_path)
    if not (path_exists(spark, path) and path_exists(spark, borders_path(path))):
        write_grid(clean.transform(zone_hour_aggregates).transform(label_congestion).transform(add_previous_hour), path)
        return lake.read_grid(spark, path)
    changed = materialize(changed, "changed-cells")
    month = F.date_trunc("month", "hour_bucket").cast("date")
    months = sorted(r[0] for r in changed.select(month).distinct().collect())               # calendar months
    if not months:
        return lake.read_grid(spark, path).limit(0)
    stored = lake.read_grid(spark, path)
    inside = stored.where(F.col("grid_month").isin(months))
    new = aggregated(clean, changed, [(m.year, m.month) for m in months]).withColumn("changed", F.lit(True))
    old = (inside.join(changed, list(KEY), "left_anti").withColumn("changed", F.lit(False)).select(*new.columns))
    edges = spark.read.parquet(borders_path(path))
    outside = edges.where(~F.col("grid_month").isin(months))
    now = materialize(with_month(with_previous_hours(new.unionByName(old), outside)), "grid-now")

    cells = now.where("NOT is_border")
    touched = cells.where("changed OR follows").select(*FOLDERS).distinct()
    columns = stored.columns
    rewritten = cells.join(F.broadcast(touched), list(FOLDERS), "left_semi").select(*columns)     # at most 24 folders a month
    # First cells of later months whose zone's cell before has changed.
    moved = now.where("is_border").where(~(F.col("prev_hour_speed").eqNullSafe(F.col("had_prev_hour_speed"))
                                           & F.col("prev_hour_trips").eqNullSafe(F.col("had_prev_hour_trips"))))
    moved = moved.select("zone_id", "hour_bucket", *(F.col(c).alias(f"now_{c}") for c in PREVIOUS), "grid_month",
                         F.hour("hour_bucket").alias("hour_of_day"))
    later = [tuple(r) for r in moved.select(*FOLDERS).distinct().collect()]                       # as many, a month
    updates, borders_now = rewritten, borders(cells)
    if later:       # what is overwritten is also read, so it is stored first
        beyond, seen = _moved_on(stored, edges, moved, later)
        updates = materialize(updates.unionByName(beyond.select(*columns)), "grid-updates")
        borders_now = materialize(borders_now.unionByName(seen.select(*borders_now.columns)), "borders")
    write_partitioned(updates, path, FOLDERS, replace="touched")
    write_partitioned(borders_now, borders_path(path), "grid_month", replace="touched")
    return cells.where("changed").select(*columns)


def _moved_on(stored: DataFrame, edges: DataFrame, moved: DataFrame, later: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """(grid rows of the folders in ``later``, borders of their months) with the ``moved`` cells' new previous hours."""
    months = sorted({m for _, m in later})
    values = [F.col(f"now_{c}") for c in PREVIOUS]

    def renewed(rows, key):
        joined = rows.join(moved.select(*key, *values, F.lit(True).alias("_moved")), key, "left")
        return joined.withColumns({c: F.when(F.col("_moved"), v).otherwise(F.col(c)) for c, v in zip(PREVIOUS, values)})

    folder = F.concat_ws(" ", *FOLDERS).isin([f"{h} {m}" for h, m in later])
    cells = renewed(stored.where(folder & F.col("grid_month").isin(months)), list(KEY))
    cells = cells.withColumn("speed_delta", F.col("avg_speed") - F.col("prev_hour_speed"))
    return cells, renewed(edges.where(F.col("grid_month").isin(months)), ["zone_id", "grid_month"])
