"""Scans as of a moment: the capture index."""

import datetime as dt

from pyspark.sql import functions as F

from dbtelemetry.sources import readers, sinks

START = dt.date(2021, 1, 1)


def test_scan_lists_only_the_days_it_needs(spark, scratch):
    """1,000 days of two servers, one of which stopped on day 900."""
    days = spark.range(1000).select(F.date_add(F.lit(START), F.col("id").cast("int")).alias("d"), F.col("id").alias("v"))
    rows = days.crossJoin(spark.createDataFrame([("a", 8), ("b", 9)], "server_name string, h int"))
    rows = rows.filter((F.col("server_name") == "a") | (F.col("v") < 900))
    rows = rows.select("server_name", F.expr("CAST(d AS TIMESTAMP_NTZ) + make_dt_interval(0, h)").alias("captured_at"), "v")
    sinks.append_captures(rows.coalesce(1), scratch + "/t")
    moment = dt.datetime.combine(START + dt.timedelta(days=950), dt.time(7))
    out = readers.scan(spark, scratch + "/t", as_of=str(moment))
    assert sorted((r.server_name, r.v) for r in out.collect()) == [("a", 949), ("b", 899)]
    plan = out._jdf.queryExecution().toString()
    assert f"captured_date#" in plan and str(START + dt.timedelta(days=949)) in plan and str(START + dt.timedelta(days=948)) not in plan
    pruned = [line for line in plan.splitlines() if "PartitionFilters" in line]
    # Long values are cut in the plan's text: the list begins with the earlier day.
    assert pruned and all(f" IN ({START + dt.timedelta(days=899):%Y-%m}" in line for line in pruned)
    only = readers.scan(spark, scratch + "/t", as_of=str(moment), servers=["a"])
    assert [r.v for r in only.collect()] == [949]
    assert str(START + dt.timedelta(days=899)) not in only._jdf.queryExecution().toString()
    assert readers.scan(spark, scratch + "/t", as_of="2020-01-01 00:00:00").count() == 0


def test_appends_of_one_day_and_tables_without_an_index(spark, scratch):
    def capture(hour, v):
        return spark.createDataFrame([("a", dt.datetime(2024, 1, 2, hour), v)], "server_name string, captured_at timestamp_ntz, v int")

    for hour in (6, 12, 18):
        sinks.append_captures(capture(hour, hour), scratch + "/t")
        sinks.append(capture(hour, hour).withColumn("captured_date", F.to_date("captured_at")), scratch + "/plain", ["captured_date"])
    for moment, want in (("2024-01-02 05:00:00", []), ("2024-01-02 13:00:00", [12]), ("2024-02-01 00:00:00", [18])):
        for table in ("/t", "/plain"):
            assert [r.v for r in readers.scan(spark, scratch + table, as_of=moment).collect()] == want
    assert spark.read.parquet(scratch + "/t").count() == 3  # the index is not part of the table
