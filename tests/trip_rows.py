"""Trip rows for tests: a clean trip and ways to break it."""

from datetime import datetime

SCHEMA = """
id INT, VendorID INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,
passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE, store_and_fwd_flag STRING,
PULocationID INT, DOLocationID INT, payment_type BIGINT, fare_amount DOUBLE, extra DOUBLE,
mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE,
total_amount DOUBLE, congestion_surcharge DOUBLE, Airport_fee DOUBLE
"""
NAMES = [c.split()[0] for c in SCHEMA.replace("\n", " ").split(",")]

CLEAN = {
    "id": 0, "VendorID": 1,
    "tpep_pickup_datetime": datetime(2025, 1, 8, 17, 15),
    "tpep_dropoff_datetime": datetime(2025, 1, 8, 17, 42),
    "passenger_count": 1.0, "trip_distance": 6.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N",
    "PULocationID": 48, "DOLocationID": 79, "payment_type": 2, "fare_amount": 24.0,
    "extra": 1.0, "mta_tax": 0.25, "tip_amount": 3.0, "tolls_amount": 1.5,
    "improvement_surcharge": 1.0, "total_amount": 33.25, "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
}

SHORT = {
    "pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime",
    "miles": "trip_distance", "fare": "fare_amount", "pay": "payment_type",
    "pu": "PULocationID", "do": "DOLocationID", "people": "passenger_count",
}


def at(text):
    return datetime.fromisoformat(text)


def trip(**changes):
    row = dict(CLEAN)
    row.update({SHORT.get(k, k): v for k, v in changes.items()})
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SCHEMA)


def zones(spark, ids=range(1, 264)):
    rows = [(i, f"Zone {i}", f"Borough {i % 3}") for i in ids]
    return spark.createDataFrame(rows, "location_id INT, zone_name STRING, borough STRING")
