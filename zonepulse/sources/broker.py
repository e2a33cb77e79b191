"""Broker sources and JSON decoding."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonepulse import rules, schemas


def kafka_options(servers: str, topics: tuple[str, ...] = (rules.TRIP_TOPIC, rules.SENSOR_TOPIC),
                  max_offsets: int | None = None, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """A new query starts at the newest offsets. By default a batch takes all there is and lost offsets fail the
    query: a cap below the topic's rate lets offsets expire unread. ``rules.MAX_OFFSETS`` and
    ``fail_on_data_loss=False`` are the settings of the original stream."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def kafka_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, **options)).load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType = schemas.BROKER_ROW,
                fmt: str = "parquet", files_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    """The same rows from files, e.g. a replay of archived messages."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def from_topic(rows: DataFrame, topic: str) -> DataFrame:
    return rows.filter(F.col("topic") == topic)


def _decoded(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw"))


def decode_trips(rows: DataFrame, schema: T.StructType = schemas.TRIP_MESSAGE) -> DataFrame:
    """Trip messages as flat columns plus ``kafka_timestamp`` and ``event_time``.

    Undecodable payloads become null rows and unreadable times null, never an error;
    ``undecodable_trips`` returns them for a rejects table.
    """
    flat = _decoded(from_topic(rows, rules.TRIP_TOPIC), schema).select("data.*", "kafka_timestamp")
    return flat.withColumn("event_time", F.try_to_timestamp(F.col("pickup_datetime")))


def undecodable_trips(rows: DataFrame) -> DataFrame:
    decoded = _decoded(from_topic(rows, rules.TRIP_TOPIC), schemas.TRIP_MESSAGE)
    return (decoded
            .filter(F.try_to_timestamp(F.col("data.pickup_datetime")).isNull())
            .select("raw", "kafka_timestamp"))


def decode_sensors(rows: DataFrame) -> DataFrame:
    """Sensor messages as flat columns, ``timestamp`` parsed into ``event_time``."""
    flat = (_decoded(from_topic(rows, rules.SENSOR_TOPIC), schemas.SENSOR_MESSAGE)
            .select("data.*", "kafka_timestamp"))
    return flat.withColumn("event_time", F.try_to_timestamp(F.col("timestamp"))).drop("timestamp")


def decode_weather(rows: DataFrame) -> DataFrame:
    """Weather messages as weather_time, weather_condition and temperature; unreadable ones become null rows."""
    flat = _decoded(from_topic(rows, rules.WEATHER_TOPIC), schemas.WEATHER_MESSAGE).select("data.*")
    return flat.select(F.try_to_timestamp(F.col("timestamp")).alias("weather_time"), "weather_condition", "temperature")
