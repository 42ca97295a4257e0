"""T-SQL scalar semantics."""

from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators import jobs, tempdb


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return df.select(col.alias("v")).first()["v"]


def test_statement_text_end_minus_one(spark):
    # start offset 4 bytes = character 3; end -1 = to the end
    v = one(spark, tsql.statement_text(F.col("t"), F.lit(4), F.lit(-1)), [("abcdefgh",)], "t string")
    assert v == "cdefgh"


def test_statement_text_counts_utf16_units(spark):
    text = "\U0001F600abc def"  # the emoji is two UTF-16 units
    v = one(spark, tsql.statement_text(F.col("t"), F.lit(4), F.lit(10)), [(text,)], "t string")
    assert v == "abc "


def test_datediff_counts_boundaries(spark):
    v = one(spark, tsql.datediff_boundaries("minute", tsql.ts_literal("2024-01-01 00:00:59"),
                                            tsql.ts_literal("2024-01-01 00:01:01")))
    assert v == 1
    v = one(spark, tsql.datediff_boundaries("minute", tsql.ts_literal("1960-01-01 00:00:59.5"),
                                            tsql.ts_literal("1960-01-01 00:01:00")))
    assert v == 1
    assert one(spark, tsql.datediff_boundaries("day", tsql.ts_literal("2024-01-01 23:59:59"),
                                               tsql.ts_literal("2024-01-02 00:00:00"))) == 1


def test_substring_position_zero(spark):
    assert one(spark, tsql.tsql_substring(F.lit("abcdef"), F.lit(0), F.lit(3))) == "ab"
    assert one(spark, tsql.tsql_substring(F.lit("abcdef"), F.lit(-1), F.lit(2))) == ""
    assert one(spark, tsql.tsql_substring(F.lit("abcdef"), F.lit(2), F.lit(-1))) is None


def test_padding_and_times(spark):
    assert one(spark, tsql.zero_pad(F.lit(0))) == "000000"
    assert one(spark, tsql.zero_pad(F.lit(1234567))) is None
    assert one(spark, tsql.hhmmss_text(F.lit(123456))) == "12:34:56"
    assert one(spark, tsql.hhmmss_text(F.lit(1234567))) == "123:45:67"
    assert one(spark, tsql.hhmmss_text(F.lit(5))) == "00:00:05"


def test_agent_datetime_rolls_over(spark):
    v = one(spark, tsql.agent_datetime(F.lit(20240131), F.lit(236000)))  # 23:60:00 rolls to next day
    assert str(v) == "2024-02-01 00:00:00"
    assert one(spark, tsql.agent_datetime(F.lit(0), F.lit(0))) is None


def test_quotename_len_datalength(spark):
    assert one(spark, tsql.quotename(F.lit("a]b"))) == "[a]]b]"
    assert one(spark, tsql.tsql_len(F.lit("ab  "))) == 2
    assert one(spark, tsql.datalength_utf16(F.lit("a\U0001F600"))) == 6
    assert one(spark, tsql.nullif_blank(F.lit("   "))) is None


def test_mask_to_names(spark):
    assert one(spark, tsql.mask_to_names(F.lit(62), jobs.WEEKDAY_BITS)) == \
        "Monday, Tuesday, Wednesday, Thursday, Friday"
    assert one(spark, tsql.mask_to_names(F.lit(0), jobs.WEEKDAY_BITS)) is None


def test_like_is_case_insensitive_by_default(spark):
    assert one(spark, tsql.like(F.lit("RESTORE DATABASE"), "%restore%")) is True
    assert one(spark, tsql.like(F.lit("RESTORE DATABASE"), "%restore%", case_sensitive=True)) is False


def test_page_types(spark):
    rows = [(1, "PAGELATCH_UP", 1, None, "2:1:8088"), (2, "PAGELATCH_UP", 1, None, "2:1:511232"),
            (3, "PAGEIOLATCH_SH", 1, None, "2:1:511233"), (4, "PAGELATCH_EX", 1, None, "2:1:77"),
            (5, "PAGELATCH_EX", 1, None, "2:1:1"), (6, "PAGELATCH_EX", 1, None, "2:1:abc"),
            (7, "LCK_M_X", 1, None, "2:1:1"), (8, "PAGELATCH_UP", 1, None, "5:1:1")]
    df = spark.createDataFrame(rows, "session_id long, wait_type string, wait_duration_ms long, "
                                     "blocking_session_id long, resource_description string")
    got = {r.session_id: r.resource_type for r in tempdb.allocation_page_type(df).collect()}
    assert got == {1: "Is PFS Page", 2: "Is GAM Page", 3: "Is SGAM Page", 4: "Is Not PFS, GAM, or SGAM page",
                   5: "Is PFS Page", 6: "Is Not PFS, GAM, or SGAM page"}


def test_agent_datetime_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        v = one(spark, tsql.agent_datetime(F.lit(20240310), F.lit(23000)))  # 02:30, inside the spring-forward gap
        assert str(v) == "2024-03-10 02:30:00"
        assert one(spark, tsql.datediff_boundaries("minute", tsql.ts_literal("2024-03-10 01:59:59"),
                                                   tsql.ts_literal("2024-03-10 03:00:01"))) == 61
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_server_collations(spark):
    """'Abc ' and 'abc' are one under the case-blind collation and two under the other; trailing blanks never count."""
    from dbtelemetry.operators.common import except_rows

    a = spark.createDataFrame([("Abc ", 1), ("abc", 2), ("x", 3), (None, 4)], "s string, i int")
    b = spark.createDataFrame([("ABC", 10), ("x  ", 20), (None, 30)], "t string, j int")

    def joined(case):
        return sorted((r.i, r.j) for r in a.join(b, tsql.text("s", case) == tsql.text("t", case)).collect())

    assert joined(False) == [(1, 10), (2, 10), (3, 20)] and joined(True) == [(3, 20)]
    sizes = lambda case: sorted(r["count"] for r in a.groupBy(tsql.text("s", case)).count().collect())
    assert sizes(False) == [1, 1, 2] and sizes(True) == [1, 1, 1, 1]
    other = b.withColumnRenamed("t", "s")
    left = lambda case: sorted(r.s for r in except_rows(a, other, ["s"], case).collect())
    assert left(False) == [] and left(True) == ["Abc ", "abc"]
    twice = spark.createDataFrame([("abc", 1), ("Abc ", 1)], "s string, i int")
    out = except_rows(twice, other.withColumnRenamed("j", "i"), ["s", "i"])
    assert [r.s for r in out.collect()] == ["Abc "] and out.schema["s"].dataType.simpleString() == "string"
    hits = lambda pattern, case: [r.i for r in a.filter(tsql.like("s", pattern, case)).collect()]
    assert hits("ABC", False) == [1, 2] and hits("abc", True) == [2] and hits("Abc", True) == [1] and hits("abc ", False) == [1]
    assert [r.i for r in a.filter(tsql.same("s", "ABC")).collect()] == [1, 2]
    assert [r.i for r in a.filter(tsql.one_of("s", ["ABC", "X"])).collect()] == [1, 2, 3]
    assert [r.i for r in a.filter(tsql.one_of("s", ["Abc"], True)).collect()] == [1]
