"""Times do not depend on the session time zone."""

from datetime import datetime, timezone

from recspark.functions.times import micros


def test_zone_free_micros(spark):
    stamp = datetime(2024, 3, 10, 2, 30, 7, 179575)
    want = int(stamp.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000 + 179575
    early = datetime(1969, 12, 31, 23, 59, 59, 999999)
    df = spark.createDataFrame([(stamp,), (early,)], "ts timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in df.select(micros(df, "ts")).collect()] == [want, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
