"""Driver contract and shuffle invariance."""

import __spark_entry__ as entry

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_contract_shapes(spark):
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 70
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["server_name", "job_id", "job_name"]


def test_reports_are_shuffle_invariant(spark):
    names = ["root_blockers", "job_report", "tempdb_sessions", "blocking_incidents", "top_queries_by_cpu",
             "index_definitions", "failed_jobs_status"]
    qs = entry.queries()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = {n: rows(qs[n](spark, SF_SMALL)) for n in names}
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        b = {n: rows(qs[n](spark, SF_SMALL)) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for n in names:
        assert a[n] == b[n], n
