"""T-SQL scalar semantics as Spark Column expressions.

Every helper returns a built-in Column expression, so it stays inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- text


def tsql_substring(s, start, length) -> Column:
    """``SUBSTRING(s, start, length)`` with T-SQL rules for ``start < 1``.

    T-SQL returns the characters from position 1 up to ``start + length - 1``
    when ``start`` is below 1; Spark treats position 0 as 1. A negative length
    is an error in T-SQL and gives NULL here.
    """
    s, start, length = _c(s), _c(start), _c(length)
    eff_len = F.when(start < 1, length + start - 1).otherwise(length)
    eff_start = F.greatest(start, F.lit(1))
    return (F.when(length < 0, F.lit(None).cast("string"))
            .when(eff_len <= 0, F.lit(""))
            .otherwise(s.substr(eff_start, eff_len)))


def datalength_utf16(s) -> Column:
    """``DATALENGTH`` of an nvarchar: bytes of its UTF-16 encoding."""
    return F.octet_length(F.encode(_c(s), "UTF-16LE"))


def utf16_substring(s, start, length) -> Column:
    """``SUBSTRING`` of an nvarchar: ``start`` and ``length`` count UTF-16 units, as the server does.

    Rules for ``start < 1`` and negative lengths as in :func:`tsql_substring`.
    """
    data, start, length = F.encode(_c(s), "UTF-16LE"), _c(start), _c(length)
    eff_len = F.when(start < 1, length + start - 1).otherwise(length)
    eff_start = F.greatest(start, F.lit(1))
    cut = data.substr((eff_start - 1) * 2 + 1, eff_len * 2)
    return (F.when(length < 0, F.lit(None).cast("string"))
            .when(eff_len <= 0, F.lit(""))
            .otherwise(F.decode(cut, "UTF-16LE")))


def statement_text(text, start_offset, end_offset, offset_base: int = 1) -> Column:
    """Current statement from byte offsets into the batch text (F1).

    ``SUBSTRING(text, start/2 + offset_base, ((end = -1 ? DATALENGTH : end) - start)/2 + 1)``.
    Offsets count UTF-16 bytes, so text outside the BMP is cut where the
    server cuts it. ``offset_base=0`` is the variant that starts one
    character early (SURVEY O48d).
    """
    so, eo = _c(start_offset), _c(end_offset)
    end_bytes = F.when(eo == -1, datalength_utf16(text)).otherwise(eo)
    return utf16_substring(text, int_div(so, 2) + offset_base, int_div(end_bytes - so, 2) + 1)


def tsql_len(s) -> Column:
    """``LEN``: length without trailing blanks (F8)."""
    return F.length(F.rtrim(_c(s)))


def charindex(sub: str, s, start: int = 1) -> Column:
    """``CHARINDEX(sub, s, start)``: 1-based position or 0 (F8)."""
    return F.locate(sub, _c(s), start)


def zero_pad(n, width: int = 6) -> Column:
    """``REPLICATE('0', width - LEN(n)) + CAST(n)`` (F9); NULL beyond ``width`` digits as in T-SQL."""
    txt = _c(n).cast("string")
    return F.when(F.length(txt) <= width, F.lpad(txt, width, "0"))


def quotename(x) -> Column:
    """``QUOTENAME``: bracket-quote, doubling closing brackets."""
    return F.concat(F.lit("["), F.replace(_c(x), F.lit("]"), F.lit("]]")), F.lit("]"))


def nullif_blank(x) -> Column:
    """``NULLIF(x, '')`` under T-SQL comparison, which ignores trailing blanks."""
    return F.when(F.rtrim(_c(x)) != "", _c(x))


def html_escape(x) -> Column:
    """Escape ``& < >`` as ``FOR XML PATH`` does for element text."""
    c = F.replace(_c(x).cast("string"), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


# Collations (F20): how the server compares text. Both ignore trailing blanks, as ``=``,
# joins, grouping and EXCEPT do there; the first ignores case as well and is the default.
CASE_BLIND = "UTF8_LCASE_RTRIM"
CASE_AWARE = "UTF8_BINARY_RTRIM"


def text(col, case_sensitive: bool = False) -> Column:
    """A string under a server collation: comparisons, joins, grouping and ``isin`` on it follow the collation."""
    return F.collate(_c(col), CASE_AWARE if case_sensitive else CASE_BLIND)


def same(col, value, case_sensitive: bool = False) -> Column:
    """``col = value`` under the collation."""
    return text(col, case_sensitive) == (text(value, case_sensitive) if isinstance(value, Column) else F.lit(value))


def one_of(col, values, case_sensitive: bool = False) -> Column:
    """``col IN (values)`` under the collation."""
    return text(col, case_sensitive).isin(*values)


def like(col, pattern: str, case_sensitive: bool = False) -> Column:
    """``LIKE`` under the collation: blanks at the end of the value need not match, those of the pattern must."""
    c = F.collate(_c(col), "UTF8_BINARY" if case_sensitive else "UTF8_LCASE")
    return c.like(pattern) | F.rtrim(c).like(pattern)


# ---------------------------------------------------------------- numbers


def int_div(a, b) -> Column:
    """T-SQL integer division, truncating toward zero (F16); ``div`` in Spark SQL."""
    b = _c(b) if isinstance(b, (str, Column)) else F.lit(b)
    return F.call_function("div", _c(a), b)


# ---------------------------------------------------------------- dates

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _micros(ts) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp, without time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts).cast("timestamp_ntz"))


_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def datediff_boundaries(unit: str, a, b) -> Column:
    """``DATEDIFF(unit, a, b)``: number of ``unit`` boundaries crossed (F2).

    T-SQL counts boundaries, so 00:00:59 to 00:01:01 is one minute, where
    Spark's ``timestampdiff`` counts whole elapsed units (0).
    """
    size = _UNIT_MICROS[unit.lower()]
    return (F.floor(_micros(b) / F.lit(size)) - F.floor(_micros(a) / F.lit(size))).cast("bigint")


def start_of_day(x) -> Column:
    """``DATEADD(DAY, 0, DATEDIFF(DAY, 0, x))``: midnight of ``x`` (F3), NTZ."""
    return F.to_timestamp_ntz(F.to_date(_c(x).cast("timestamp_ntz")).cast("string"))


def ts_literal(value: str) -> Column:
    """A fixed wall-clock time (the engine's ``as_of``), NTZ."""
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def as_ts(value) -> Column:
    """``as_of`` given as text (a fixed clock) or as a Column."""
    return ts_literal(value) if isinstance(value, str) else value


def agent_datetime(date_int, time_int) -> Column:
    """Job-history ``yyyymmdd`` date and ``hhmmss`` time integers to a timestamp.

    The time is added as seconds (``hh * 3600 + mm * 60 + ss``), as the
    reference's arithmetic does, so out-of-range minutes roll over rather
    than fail. An invalid date gives NULL.
    """
    t = _c(time_int).cast("bigint")
    d = _c(date_int).cast("bigint")
    secs = int_div(t, 10000) * 3600 + int_div(t % 10000, 100) * 60 + t % 100
    # Built from its parts as a wall-clock value: no session time zone enters.
    day = F.try_make_timestamp_ntz(int_div(d, 10000).cast("int"), (int_div(d, 100) % 100).cast("int"),
                                   (d % 100).cast("int"), F.lit(0), F.lit(0), F.lit(0))
    return day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def hhmmss_text(n) -> Column:
    """``hhmmss`` integer to ``hh:mm:ss`` text (F5); hours widen past 99."""
    v = _c(n).cast("bigint")
    h = int_div(v, 10000).cast("string")
    hours = F.when(F.length(h) < 2, F.lpad(h, 2, "0")).otherwise(h)  # lpad would cut 3+ digits
    return F.concat(hours, F.lit(":"), F.lpad((int_div(v, 100) % 100).cast("string"), 2, "0"),
                    F.lit(":"), F.lpad((v % 100).cast("string"), 2, "0"))


def format_113(d) -> Column:
    """``CONVERT(varchar(20), d, 113)``: ``dd mon yyyy hh:mi:ss``."""
    return F.date_format(_c(d), "dd MMM yyyy HH:mm:ss")


def mask_to_names(mask, bits_and_names: list[tuple[int, str]], sep: str = ", ") -> Column:
    """Bit mask to the joined names of its set bits, in list order.

    An empty result is NULL, as the XML concatenation of no rows is.
    """
    arr = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(n).alias("name")) for b, n in bits_and_names])
    m = _c(mask).cast("bigint")
    names = F.transform(F.filter(arr, lambda x: (m.bitwiseAND(x["bit"])) != 0), lambda x: x["name"])
    return F.when(F.size(names) > 0, F.array_join(names, sep))
