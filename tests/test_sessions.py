from helpers import moment, rows

from pyspark.sql import functions as F

from tidemark.operators.sessions import sessionize

EVENTS = [
    (1, "2024-01-01 00:00:00"),
    (1, "2024-01-01 00:29:59"),  # 1799 s later
    (1, "2024-01-01 00:59:59"),  # 1800 s: same session
    (1, "2024-01-01 01:30:00"),  # 1801 s: new session
    (1, "2024-01-01 01:30:00"),  # same instant
    (2, "2024-01-01 12:00:00"),
    (3, "2024-01-01 00:00:00.200"),
    (3, "2024-01-01 00:30:00.700"),  # 1800.5 s, which is 1800 whole seconds
    (4, None),
    (4, None),
    (4, "2024-01-01 05:00:00"),
    (None, "2024-01-01 06:00:00"),
]
EXPECTED = [
    (None, 1, "2024-01-01 06:00:00", "2024-01-01 06:00:00", 1, 0.0),
    (1, 1, "2024-01-01 00:00:00", "2024-01-01 00:59:59", 3, 60.0),
    (1, 2, "2024-01-01 01:30:00", "2024-01-01 01:30:00", 2, 0.0),
    (2, 1, "2024-01-01 12:00:00", "2024-01-01 12:00:00", 1, 0.0),
    (3, 1, "2024-01-01 00:00:00.200", "2024-01-01 00:30:00.700", 2, 30.0),
    (4, 1, None, None, 1, None),
    (4, 2, None, None, 1, None),
    (4, 3, "2024-01-01 05:00:00", "2024-01-01 05:00:00", 1, 0.0),
]


def _expected():
    return [(c, s, moment(a), moment(b), n, minutes) for c, s, a, b, n, minutes in EXPECTED]


def test_gaps_at_the_limit(spark):
    df = spark.createDataFrame([(c, moment(t)) for c, t in EVENTS], "customer_id long, t timestamp_ntz")
    assert rows(sessionize(df, "customer_id", "t"), "customer_id", "session_id") == _expected()


def test_timestamps_with_a_zone(spark):
    df = spark.createDataFrame([(c, moment(t)) for c, t in EVENTS], "customer_id long, t timestamp_ntz")
    zoned = df.withColumn("t", F.col("t").cast("timestamp"))
    result = sessionize(zoned, "customer_id", "t")
    texts = result.withColumn("session_start", F.col("session_start").cast("timestamp_ntz")).withColumn(
        "session_end", F.col("session_end").cast("timestamp_ntz")
    )
    assert rows(texts, "customer_id", "session_id") == _expected()


def test_every_event_is_in_one_session_and_bounds_agree_with_session_window(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("user_id", "ts")
    ours = sessionize(events, "user_id", "ts")
    assert ours.agg(F.sum("events_in_session")).first()[0] == events.count()
    builtin = events.groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes")).count()
    assert ours.count() == builtin.count()
