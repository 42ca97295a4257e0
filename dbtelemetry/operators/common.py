"""Helpers shared by the report operators.

Fleet columns: every snapshot relation may carry ``server_name`` and
``captured_at``; operators take ``keys`` naming them, and every join adds
them to its key so two servers (or two snapshots) never mix. The driver's
fixtures have none, so the default is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dbtelemetry.functions import tsql
from dbtelemetry.sources import sinks

Keys = Sequence[str]


def on(cols: Sequence[str], keys: Keys = ()) -> list[str]:
    """Join key list: fleet keys first, then the operator's own columns."""
    return list(keys) + [c for c in cols if c not in keys]


def _keyed_lookup(df: DataFrame, lookup: DataFrame, left_col: str, right_col: str, how: str,
                  keys: Keys) -> DataFrame:
    """Join ``df`` to a lookup on ``left_col = right_col`` plus the fleet keys.

    The lookup's key columns are renamed first, so no column name is
    ambiguous after the join; they are dropped by name afterwards.
    """
    renamed = lookup
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__lk_{k}")
    drop = [right_col, *[f"__lk_{k}" for k in keys]]
    if how == "left":
        spread = _spread(df, left_col)
        renamed = renamed.withColumn("__lk_salt", _no_salt(right_col))
        cond = [spread[left_col + "__key"] == renamed[right_col], spread["__salt"] == renamed["__lk_salt"]]
        cond += [spread[k] == renamed[f"__lk_{k}"] for k in keys]
        return spread.join(renamed, cond, how).drop(left_col + "__key", "__salt", "__lk_salt", *drop)
    cond = [df[left_col] == renamed[right_col]] + [df[k] == renamed[f"__lk_{k}"] for k in keys]
    return df.join(renamed, cond, how).drop(*drop)


NULL_SPREAD = 256


def _spread(df: DataFrame, col: str) -> DataFrame:
    """``df`` with the join key ``<col>__key`` and ``__salt``: rows whose ``col`` is NULL, which no lookup
    row matches, get a salt above 0 by their content and so do not meet in one partition."""
    kind = df.schema[col].dataType.simpleString()
    filler = F.lit("").cast(kind) if kind in ("string", "binary") else F.lit(0).cast(kind)
    salt = F.when(F.col(col).isNull(), F.pmod(F.hash(*[c for c in df.columns if c != col]), F.lit(NULL_SPREAD)) + 1)
    return df.withColumn("__salt", F.coalesce(salt, F.lit(0))).withColumn(col + "__key", F.coalesce(F.col(col), filler))


def _no_salt(col: str) -> Column:
    """The salt of a lookup row, 0, in a form that is no constant: a constant's equality is not
    a key of the join, and the rows with a NULL would meet after all."""
    return F.pmod(F.hash(col), F.lit(1))


def spread_left_join(df: DataFrame, lookup: DataFrame, cols: Sequence[str], nullable: str) -> DataFrame:
    """Left join on equally named ``cols``; rows with a NULL in ``nullable`` are spread over the partitions."""
    right = lookup.select(*[F.col(c).alias(f"__lk_{c}") for c in cols], *[c for c in lookup.columns if c not in cols],
                          _no_salt(nullable).alias("__lk_salt"))
    left = _spread(df, nullable)
    cond = [left[c + "__key" if c == nullable else c] == right[f"__lk_{c}"] for c in cols]
    out = left.join(right, [*cond, left["__salt"] == right["__lk_salt"]], "left")
    return out.drop("__salt", nullable + "__key", "__lk_salt", *[f"__lk_{c}" for c in cols])


def with_absent(df: DataFrame, kind: str, *cols: str) -> DataFrame:
    """``df`` with a NULL column of type ``kind`` for each of ``cols`` that it lacks, so a report's columns never vary."""
    return df.withColumns({c: F.lit(None).cast(kind) for c in cols if c not in df.columns})


def db_name(df: DataFrame, databases: DataFrame, id_col: str, out: str = "database_name",
            keys: Keys = ()) -> DataFrame:
    """``DB_NAME(id)``: left join to the database catalog (F21); unknown ids give NULL.

    The catalog holds one row per database per server, so it is small; AQE
    broadcasts it from its measured size rather than from a hint.
    """
    lookup = databases.select(*keys, F.col("database_id").alias("__dbid"), F.col("name").alias(out))
    return _keyed_lookup(df, lookup, id_col, "__dbid", "left", keys)


def lookup_text(df: DataFrame, sql_text: DataFrame, handle_col: str = "sql_handle", how: str = "left",
                keys: Keys = (), cols: Sequence[str] = ("text",), prefix: str = "") -> DataFrame:
    """``APPLY sys.dm_exec_sql_text(handle)``: ``how='left'`` is OUTER APPLY, ``'inner'`` CROSS APPLY."""
    lookup = sql_text.select(*keys, F.col("sql_handle").alias("__h"),
                             *[F.col(c).alias(prefix + c) for c in cols])
    return _keyed_lookup(df, lookup, handle_col, "__h", how, keys)


def lookup_plan(df: DataFrame, plans: DataFrame, handle_col: str = "plan_handle", how: str = "left",
                keys: Keys = ()) -> DataFrame:
    """``OUTER APPLY sys.dm_exec_query_plan(handle)``."""
    lookup = plans.select(*keys, F.col("plan_handle").alias("__p"), "query_plan")
    return _keyed_lookup(df, lookup, handle_col, "__p", how, keys)


#: Distinct handles that are broadcast: so many are some megabytes.
SENT_HANDLES = 131_072


def of_needed(lookup: DataFrame, need: DataFrame, handle: str, keys: Keys = ()) -> DataFrame:
    """``lookup`` without rows that an inner join to ``need`` on ``handle`` would drop, if the distinct handles are few.

    They are broadcast then, and only the rows of ``lookup`` that they name
    move in the join after it. With more handles ``lookup`` is returned as it is.
    """
    handles = sinks.materialize(need.select(*keys, handle).distinct(), columnar=True)
    if handles.count() > SENT_HANDLES:
        return lookup
    return lookup.join(F.broadcast(handles), on([handle], keys), "left_semi")


def except_rows(a: DataFrame, b: DataFrame, cols: Sequence[str], case_sensitive: bool = False) -> DataFrame:
    """``SELECT cols FROM a EXCEPT SELECT cols FROM b`` with the string columns under the collation; NULLs are equal.

    Of rows that the collation holds for equal, the smallest by code point is returned.
    """
    kinds = a.schema

    def keyed(df: DataFrame, mark: str) -> DataFrame:
        key = [(tsql.text(c, case_sensitive) if kinds[c].dataType == T.StringType() else F.col(c)).alias(f"{mark}{c}") for c in cols]
        return df.select(*cols, *key)

    left = keyed(a, "__l_").groupBy(*[f"__l_{c}" for c in cols]).agg(F.min(F.struct(*cols)).alias("__row"))
    right = keyed(b, "__r_").select(*[f"__r_{c}" for c in cols])
    same_row = [left[f"__l_{c}"].eqNullSafe(right[f"__r_{c}"]) for c in cols]
    return left.join(right, same_row, "left_anti").select(*[F.col("__row").getField(c).alias(c) for c in cols])
