"""Schemas of the relations that cross a storage or broker boundary."""

from pyspark.sql import types as T

# Column names and types, in the order of the files, messages and tables.
RAW_TRIP = T.StructType([
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("passenger_count", T.LongType()),
])

TRIP_MESSAGE = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("pickup_zone", T.IntegerType()),
    T.StructField("dropoff_zone", T.IntegerType()),
    T.StructField("pickup_datetime", T.StringType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
])

# Producers send the payment type as well; decoding it is opt-in.
TRIP_MESSAGE_WITH_PAYMENT = T.StructType(
    TRIP_MESSAGE.fields + [T.StructField("payment_type", T.StringType())])

SENSOR_MESSAGE = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("avg_speed_mph", T.DoubleType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("occupancy_pct", T.DoubleType()),
])

WEATHER_MESSAGE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("weather_condition", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
])

# What a broker source yields, as far as the decoders use it.
BROKER_ROW = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

ZONE_METRICS = T.StructType([
    T.StructField("zone_id", T.IntegerType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("trip_count", T.IntegerType()),
    T.StructField("congestion_level", T.IntegerType()),
    T.StructField("predicted_delay_minutes", T.DoubleType()),
    T.StructField("is_hotspot", T.BooleanType()),
    T.StructField("weather_condition", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

MODEL_PERFORMANCE = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("training_date", T.TimestampType()),
    T.StructField("dataset_size", T.LongType()),
    T.StructField("notes", T.StringType()),
])
