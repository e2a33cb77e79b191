"""Model features of a stream of trips: cells of closed hours, joined with what each zone's earlier hours left behind.

Two stateful steps follow each other. Hours are aggregated by Spark's own windows and closed by the watermark, partial sums before the
shuffle. The closed cells, few, go to a processor with one small state row per zone. As the watermark closes hours in order, a
zone's cells arrive in order, several of one batch are sorted; so state is zones x (open hours + 1) rows.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from zonepulse import rules
from zonepulse.operators import cleaning
from zonepulse.operators.features import add_clock_features, add_delay_target, add_density_features
from zonepulse.operators.grid import add_cell_clock, cell_measures, label_congestion

HISTORY = "lag1 double, lag2 double, trips double, total double, hours long, stddev double"
ADDED = ("lag1_speed", "lag2_speed", "lag1_trips", "speed_delta", "rolling_avg_speed_3h", "speed_to_zone_avg")


def distinct_trips(trips: DataFrame, watermark: str = rules.WATERMARK) -> DataFrame:
    """Valid trips, each key once, as long as copies arrive within the watermark; later ones are late rows and dropped.

    State is the keys of the watermark's span.
    """
    return (cleaning.valid_trips(trips).withWatermark("tpep_pickup_datetime", watermark)
            .dropDuplicatesWithinWatermark(list(cleaning.DEDUP_KEY)))


def closed_cells(trips: DataFrame) -> DataFrame:
    """Zone-hour cells of distinct trips that carry a watermark, once it has passed the hour."""
    timed = trips.transform(cleaning.add_duration).transform(cleaning.add_speed)
    hour = F.window("tpep_pickup_datetime", "1 hour").alias("window")
    cells = timed.groupBy(F.col("PULocationID").alias("zone_id"), hour).agg(*cell_measures())
    return (cells.withColumn("hour_bucket", F.col("window.start")).drop("window")
            .transform(add_cell_clock).transform(label_congestion))


class ZoneHistory(StatefulProcessor):
    """Adds to a zone's cells what earlier ones say: lags, mean of the last three rows, ratio to the mean so far.

    A cell without a deviation gets the zone's last one; what a first cell lacks is 0.
    """

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getValueState("history", HISTORY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.history.get()
        lag1, lag2, trips, total, hours, stddev = found if found is not None else (None, None, None, 0.0, 0, None)
        for row in sorted(rows, key=lambda r: r.hour_bucket):
            speed = row.avg_speed
            last = [s for s in (speed, lag1, lag2) if s is not None]
            total, hours = total + speed, hours + 1
            stddev = row.speed_stddev if row.speed_stddev is not None else stddev
            values = row.asDict() | {
                "speed_stddev": stddev or 0.0, "lag1_speed": lag1 or 0.0, "lag2_speed": lag2 or 0.0, "lag1_trips": trips or 0.0,
                "speed_delta": speed - lag1 if lag1 is not None else 0.0, "rolling_avg_speed_3h": sum(last) / len(last),
                "speed_to_zone_avg": speed / (total / hours + rules.EPSILON)}
            yield Row(**{c: values[c] for c in self.columns})
            lag1, lag2, trips = speed, lag1, float(row.trip_count)
        self.history.update((lag1, lag2, trips, total, hours, stddev))

    def close(self) -> None:
        pass


def live_features(trips: DataFrame, watermark: str = rules.WATERMARK) -> DataFrame:
    """Feature rows, one per closed cell, of a stream of raw trips. Equal to the batch
    ``feature_matrix(grid, fill="forward", scope="zone", history="running")`` on trips that aren't late.

    Needs the RocksDB state store (see ``sinks.start``).
    """
    cells = closed_cells(distinct_trips(trips, watermark))
    schema = T.StructType([*cells.schema, *(T.StructField(c, T.DoubleType()) for c in ADDED)])
    known = cells.groupBy("zone_id").transformWithState(
        statefulProcessor=ZoneHistory(schema.fieldNames()), outputStructType=schema, outputMode="Append", timeMode="None")
    full = known.transform(add_clock_features).transform(add_density_features).transform(add_delay_target)
    return full.select("zone_id", "hour_bucket", *rules.FEATURES, *rules.TARGETS)
