"""Small frames and plan text for tests."""

from datetime import datetime, timedelta

from zonepulse import schemas

GOOD = {
    "tpep_pickup_datetime": datetime(2023, 1, 2, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 2, 8, 20, 0),
    "PULocationID": 1, "DOLocationID": 2, "trip_distance": 1.5, "fare_amount": 10.0,
    "passenger_count": 2,
}


def trip(minutes=None, **changes):
    row = GOOD | changes
    if minutes is not None:
        row["tpep_dropoff_datetime"] = row["tpep_pickup_datetime"] + timedelta(minutes=minutes)
    return row


def trips(spark, *rows):
    names = schemas.RAW_TRIP.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.RAW_TRIP)


def plan(df):
    """The executed physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_after_run(df):
    df.collect()
    return plan(df)
