"""Small bar fixtures built from the rules of the test data."""

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

NY = ZoneInfo("America/New_York")
TEXT = "timestamp string, open string, high string, low string, close string, volume string, created_ts string, date string"


def ny(text):
    return datetime.fromisoformat(text).replace(tzinfo=NY)


def minutes(day, first="09:30", last="15:59"):
    start, end = ny(f"{day} {first}:00"), ny(f"{day} {last}:00")
    return [start + timedelta(minutes=i) for i in range(int((end - start).total_seconds() // 60) + 1)]


def text_rows(day, utc=False, first="09:30", last="15:59", base=100.0):
    rows = []
    for i, ts in enumerate(minutes(day, first, last)):
        shown = ts.astimezone(ZoneInfo("UTC")) if utc else ts
        price = base + i * 0.01
        rows.append(
            (shown.isoformat(sep=" "), f"{price:.2f}", f"{price + 0.05:.2f}", f"{price - 0.05:.2f}", f"{price + 0.01:.2f}", str(1000 + i), "", day)
        )
    return rows


def text_frame(spark, rows, symbol="X"):
    from pyspark.sql import functions as F

    from candlewright.functions import times as T

    frame = spark.createDataFrame(rows, TEXT)
    return frame.withColumn("ts", T.instant(F.col("timestamp"))).withColumn("symbol", F.lit(symbol))


def calendar(spark, first, last, holidays=(), early=()):
    from candlewright.operators import calendar as C

    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema).selectExpr("cast(date as date) date", *(["close_time"] if "close" in schema else []))

    return C.sessions(
        spark, first, last, frame([(d,) for d in holidays], "date string"), frame(early, "date string, close_time string") if early else None
    )
