"""Streaming plan: broker rows → sliding windows per zone → replayable sink."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from zonepulse.sources import broker, serving
from zonepulse.streaming import sinks, windows


def stream_trip_windows(rows: DataFrame, path: str, checkpoint: str, once: bool = False,
                        state_partitions: int | None = None, jdbc_table: str | None = None, distinct: bool = False,
                        rocksdb: bool = False) -> StreamingQuery:
    """Windows over the trip topic of a broker stream (see ``broker.kafka_stream``).

    ``jdbc_table``: write to that table instead of to folders below ``path``. ``distinct``: a message sent again within the watermark
    counts once. ``rocksdb``: see ``sinks.start``.
    """
    trips = broker.decode_trips(rows)
    counted = windows.trip_windows(windows.distinct_messages(trips), None) if distinct else windows.trip_windows(trips)
    return sinks.start(counted, _sink(path, jdbc_table), checkpoint, once, state_partitions=state_partitions, rocksdb=rocksdb)


def stream_sensor_windows(rows: DataFrame, path: str, checkpoint: str, once: bool = False,
                          state_partitions: int | None = None, jdbc_table: str | None = None) -> StreamingQuery:
    """The same for the sensor topic."""
    counted = windows.sensor_windows(broker.decode_sensors(rows))
    return sinks.start(counted, _sink(path, jdbc_table), checkpoint, once, state_partitions=state_partitions)


BATCH_FILES = 8         # of a micro-batch's windows, for each of its dates


def _sink(path: str, jdbc_table: str | None):
    if jdbc_table:
        return sinks.jdbc_sink(jdbc_table)
    return sinks.batch_folder_sink(path, serving.with_created_at, BATCH_FILES, dated_by="window_start")
