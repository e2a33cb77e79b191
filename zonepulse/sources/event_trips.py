"""Adapters that present the ``events`` table as trips, messages and weather."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse import rules, schemas


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a trip; every 50th arrives twice, every 97th lacks its pickup time."""
    events = read_table(spark, sf_dir, "events")
    copies = F.sequence(F.lit(1), F.when(F.col("event_id") % 50 == 0, 2).otherwise(1))
    e = events.select("event_id", "ts", "user_id", "value", _k().alias("k"),
                      F.explode(copies).alias("copy"))
    pickup = F.when(F.col("event_id") % 97 != 0, F.col("ts"))
    dropoff = F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("k") * 45).cast("decimal(18,6)"))
    zone = F.when(F.col("user_id") == 149, 264).otherwise(F.col("user_id") % 6 + 1)
    return e.select(
        pickup.cast("timestamp").alias("tpep_pickup_datetime"),
        dropoff.cast("timestamp").alias("tpep_dropoff_datetime"),
        zone.cast("long").alias("PULocationID"),
        (F.col("k") * 3 % 266).cast("long").alias("DOLocationID"),
        (F.col("value") / F.lit(5.0)).alias("trip_distance"),
        (F.col("value") + F.lit(2.0)).alias("fare_amount"),
        (F.col("event_id") % 8).alias("passenger_count"),
    )


def stream_trips(events: DataFrame) -> DataFrame:
    """Events as already decoded trip messages, zone = user."""
    return events.select(
        F.col("user_id").cast("int").alias("pickup_zone"),
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.col("value") / F.lit(5.0)).alias("trip_distance"),
        (F.col("event_id") % 8).cast("int").alias("passenger_count"),
    )


def _iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def broker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as broker rows: sign-ups are sensor readings, errors are undecodable trips."""
    k = _k()
    trip = F.to_json(F.struct(
        F.concat(F.lit("T"), F.col("event_id")).alias("trip_id"),
        F.col("user_id").cast("int").alias("pickup_zone"),
        (k * 3 % 266).alias("dropoff_zone"),
        _iso("ts").alias("pickup_datetime"),
        (F.col("event_id") % 8).cast("int").alias("passenger_count"),
        (F.col("value") / F.lit(5.0)).alias("trip_distance"),
        (F.col("value") + F.lit(2.0)).alias("fare_amount"),
        F.col("event_type").alias("payment_type"),
    ))
    sensor = F.to_json(F.struct(
        F.format_string("SENS_%03d_1", F.col("user_id")).alias("sensor_id"),
        F.col("user_id").cast("int").alias("zone_id"),
        _iso("ts").alias("timestamp"),
        F.col("value").alias("avg_speed_mph"),
        k.alias("vehicle_count"),
    ))
    kind = F.col("event_type")
    payload = (F.when(kind == "signup", sensor)
                .when(kind == "error", F.concat(F.lit("unreadable "), F.col("event_id")))
                .otherwise(trip))
    topic = F.when(kind == "signup", rules.SENSOR_TOPIC).otherwise(rules.TRIP_TOPIC)
    rows = read_table(spark, sf_dir, "events").select(
        topic.alias("topic"),
        payload.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"))
    return rows.select(*schemas.BROKER_ROW.fieldNames())


def weather_of(events: DataFrame) -> DataFrame:
    """Error events as weather readings: the event's value is the temperature."""
    return (events
            .filter(F.col("event_type") == "error")
            .select(F.col("ts").cast("timestamp").alias("timestamp"),
                    F.concat(F.lit("W"), F.col("user_id") % 4).alias("weather_condition"),
                    F.col("value").alias("temperature")))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_of(read_table(spark, sf_dir, "events"))
