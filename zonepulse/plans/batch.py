"""Batch plan: a delivery of raw trips → clean lake → grid lake → serving table.

Every stage is computed once, the next one reads what was written, and the cost follows the delivery: of lake, grid and
serving table only touched months are read, only changed cells are aggregated and published.
"""

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from zonepulse.operators import cleaning, joins
from zonepulse.session import materialize, run_scratch, sized_for
from zonepulse.sources import grid_lake, lake, serving

log = logging.getLogger(__name__)


@dataclass
class BatchResult:
    """``clean_count``: valid, distinct trips of the delivery; ``added_count``: those the lake didn't have; ``rejected``: rows
    of the delivery by the first rule they fail."""

    grid: DataFrame
    raw_count: int
    clean_count: int
    added_count: int
    rejected: dict[str, int]

    @property
    def retention_pct(self) -> float:
        return 100.0 * self.clean_count / self.raw_count if self.raw_count else 0.0


def valid_rows(raw: DataFrame, keep: tuple[str, ...] | str) -> tuple[DataFrame, dict]:
    """(stored valid rows of the delivery with a unique ``_row``, raw and rejected rows by name and the valid rows' ``months``).

    The counts are taken while the rows are written. Each task of that write counts once, even if it was repeated.
    """
    extra = [c for c in (raw.columns if keep == "*" else keep) if c not in cleaning.TRIP_COLUMNS]
    counts = Observation("delivery")
    pickup = F.col("tpep_pickup_datetime")
    month = F.when(F.col("_rule").isNull(), F.struct(F.year(pickup).alias("year"), F.month(pickup).alias("month")))
    marked = raw.select(*cleaning.TRIP_COLUMNS, *extra).withColumn("_rule", cleaning.rejected_by()).observe(
        counts, F.count(F.lit(1)).alias("raw"), *(F.count_if(F.col("_rule") == name).alias(name) for name in cleaning.RULES),
        F.collect_set(month).alias("months"))        # bounded by the calendar
    valid = materialize(marked.where(F.col("_rule").isNull()).drop("_rule")
                        .withColumn("_row", F.monotonically_increasing_id()), "valid")
    return valid, dict(counts.get)


def run_batch(spark: SparkSession, raw_paths: list[str], clean_path: str, grid_path: str,
              serving_path: str | None = None, jdbc_table: str | None = None,
              keep: tuple[str, ...] | str = "*", weather: DataFrame | None = None) -> BatchResult:
    """Clean a delivery, merge it into the lake, update grid and serving table. ``keep``: raw columns carried into the lake;
    ``weather``: readings (timestamp, weather_condition, temperature), the last one at or before a cell is published with it.

    A rerun changes nothing and completes what a failed run left undone, as cells are updated whether or not their trips
    are in the lake already. Only changed cells are published. Scratch folders go when the run ends.
    """
    raw = lake.read_trips(spark, *raw_paths)
    with run_scratch(spark), sized_for(spark, lake.stored_bytes(spark, *raw_paths)):
        valid, counts = valid_rows(raw, keep)
        months = sorted(tuple(m) for m in counts["months"])
        surplus = materialize(cleaning.surplus_rows(valid, "_row", lake.stored_keys(spark, clean_path, months)), "surplus")
        kept, known = surplus.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)), F.count_if("stored")).first()
        clean_count = counts["raw"] - sum(counts[name] for name in cleaning.RULES) - kept
        new = cleaning.without_surplus(valid, "_row", surplus).transform(cleaning.add_derived)
        lake.append_trips(new, clean_path, len(months))

        changed = grid_lake.update_grid(spark, clean_path, grid_path, grid_lake.changed_cells(valid))
        published = serving.batch_projection(changed)
        if weather is not None:
            published = joins.attach_weather(materialize(published, "published"), weather)
        if serving_path:
            serving.write_zone_metrics(published, serving_path)
        if jdbc_table:
            serving.append_jdbc(published, jdbc_table)

    rejected = {name: counts[name] for name in cleaning.RULES}
    result = BatchResult(lake.read_grid(spark, grid_path), counts["raw"], clean_count, clean_count - known, rejected)
    log.info("raw %d, clean %d, added %d, retention %.1f %%, rejected %s", result.raw_count, result.clean_count,
             result.added_count, result.retention_pct, rejected)
    return result
