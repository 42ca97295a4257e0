"""Indexes, tables and procedures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators.common import Keys, db_name, except_rows, lookup_plan, lookup_text, on, with_absent

# The twelve usage columns the reference tests for NULL.
USAGE_COLUMNS = ("user_seeks", "user_scans", "user_lookups", "last_user_seek", "last_user_scan",
                 "last_user_lookup", "system_seeks", "system_scans", "system_lookups", "last_system_seek",
                 "last_system_scan", "last_system_lookup")


# Catalog object types are char(2) ('U ', 'V ', 'P '); the tests below compare
# them under the server collation, which ignores trailing blanks.


def _owner_name(objects: DataFrame, owner: str) -> "F.Column":
    """``USER_NAME(uid) + '.' + name``: the owner column when present, else ``owner``."""
    own = F.col("schema_name") if "schema_name" in objects.columns else F.lit(owner)
    return F.concat(own, F.lit("."), F.col("name"))


def unused_indexes(indexes: DataFrame, usage: DataFrame, objects: DataFrame, database_name: str | None = None,
                   keys: Keys = (), databases: DataFrame | None = None) -> DataFrame:
    """Indexes of user tables with no usage row, or a usage row whose usage columns are all NULL.

    A left join and NULL tests, as in the reference: with nullable usage
    columns this is not an anti join. The database is the one that the
    rows were captured in: ``database_name``, or each row's
    ``database_id`` looked up in ``databases``.
    """
    usage = with_absent(usage, "timestamp_ntz", *[c for c in USAGE_COLUMNS if c.startswith("last_")])
    usage = with_absent(usage, "bigint", *USAGE_COLUMNS)
    u = usage.select(*keys, "object_id", "index_id", *(["database_id"] if "database_id" in usage.columns
                                                       and "database_id" in indexes.columns else []), *USAGE_COLUMNS)
    u = u.withColumn("__u", F.lit(1))
    join_cols = on(["object_id", "index_id"] + (["database_id"] if "database_id" in u.columns else []), keys)
    tables = objects.filter(tsql.same("type", "U")).select(*keys, "object_id", F.col("name").alias("table_name"))
    i = indexes.select(*keys, "object_id", "index_id", F.col("name").alias("index_name"), "type_desc",
                       "is_primary_key", *(["database_id"] if "database_id" in indexes.columns else []))
    j = i.join(tables, on(["object_id"], keys)).join(u, join_cols, "left")
    cond = F.lit(True)
    for c in USAGE_COLUMNS:
        cond = cond & F.col(c).isNull()
    j = j.filter(cond)
    if databases is not None and "database_id" in j.columns:
        j = db_name(j, databases, "database_id", out="db_name", keys=keys)
    else:
        j = j.withColumn("db_name", F.lit(database_name).cast("string"))
    return j.select(*keys, "db_name", "table_name", "index_name", "index_id", "type_desc", "is_primary_key")


def missing_index_details(df: DataFrame) -> DataFrame:
    """The missing-index catalog as it is (``SELECT *``)."""
    return df


def tables_without_primary_key(objects: DataFrame, indexes: DataFrame, owner: str = "dbo",
                               keys: Keys = ()) -> DataFrame:
    """User tables with no primary-key index (``left_anti``, exact here)."""
    t = objects.filter(tsql.same("type", "U"))
    pk = indexes.filter(F.col("is_primary_key") == 1).select(*keys, "object_id")
    return t.join(pk, on(["object_id"], keys), "left_anti").select(
        *keys, F.col("object_id").alias("id"), _owner_name(t, owner).alias("table_name"))


def table_row_counts(objects: DataFrame, indexes: DataFrame, owner: str = "dbo", keys: Keys = ()) -> DataFrame:
    """Row count per user table from its heap or clustered index.

    The legacy filter ``indid < 2`` means "heap or clustered index"; on the
    modern catalog that is ``type_desc IN ('HEAP', 'CLUSTERED')``.
    """
    t = objects.filter(tsql.same("type", "U"))
    t = t.select(*keys, "object_id", _owner_name(t, owner).alias("table_name"), "name")
    i = indexes.filter(F.col("type_desc").isin("HEAP", "CLUSTERED")).select(
        *keys, "object_id", F.col("row_count").alias("rows"))
    return t.join(i, on(["object_id"], keys)).select(*keys, F.col("object_id").alias("id"), "table_name", "rows")


def table_space(objects: DataFrame, space: DataFrame, keys: Keys = ()) -> DataFrame:
    """Reserved and data space per user table (``sp_spaceused`` for each table).

    Pages are summed per object before the join (partial aggregation on the
    map side), so only one row per table reaches the join.
    """
    per_obj = space.groupBy(*keys, "object_id").agg(
        (F.sum("reserved_pages") * 8).cast("bigint").alias("reserved_kb"),
        (F.sum("data_pages") * 8).cast("bigint").alias("data_kb"))
    t = objects.filter(tsql.same("type", "U")).select(*keys, "object_id", F.col("name").alias("table_name"))
    return t.join(per_obj, on(["object_id"], keys)).select(*keys, "table_name", "reserved_kb", "data_kb")


def drop_statistics_statements(objects: DataFrame, indexes: DataFrame, owner: str = "dbo",
                               keys: Keys = ()) -> DataFrame:
    """``drop statistics [owner].[table].[stat]`` text for statistics on tables and views (never run)."""
    o = objects.filter(tsql.one_of("type", ["U", "V"]))
    own = F.col("schema_name") if "schema_name" in o.columns else F.lit(owner)
    o = o.select(*keys, "object_id", own.alias("__owner"), F.col("name").alias("__obj"))
    i = indexes.filter(F.col("is_statistics") == 1).select(*keys, "object_id", F.col("name").alias("__ix"))
    stmt = F.concat(F.lit("drop statistics "), tsql.quotename("__owner"), F.lit("."), tsql.quotename("__obj"),
                    F.lit("."), tsql.quotename("__ix"))
    return o.join(i, on(["object_id"], keys)).select(*keys, stmt.alias("drop_statement"))


def requests_with_missing_indexes(requests: DataFrame, sql_text: DataFrame, plans: DataFrame,
                                  databases: DataFrame, as_of, case_sensitive: bool = False,
                                  keys: Keys = ()) -> DataFrame:
    """Running requests whose plan mentions a missing index.

    Both lookups are CROSS APPLY (inner). The pattern ``%<missing%`` is
    matched case-insensitively by default, since real plans say
    ``<MissingIndexes``. ``open_transaction_count`` is emitted once.
    """
    cols = ["session_id", "blocking_session_id", "start_time", "status", "database_id", "wait_type",
              "wait_time", "last_wait_type", "granted_query_memory", "reads", "logical_reads", "writes",
              "row_count", "total_elapsed_time", "cpu_time", "open_transaction_count"]
    requests = with_absent(with_absent(requests, "string", "wait_type", "last_wait_type"), "bigint", *cols)
    r = requests.select(*keys, *cols, "sql_handle", "plan_handle")
    r = lookup_plan(r, plans, how="inner", keys=keys).filter(tsql.like("query_plan", "%<missing%", case_sensitive))
    r = lookup_text(r, sql_text, how="inner", keys=keys)
    r = db_name(r, databases, "database_id", out="db_name", keys=keys)
    as_of_c = tsql.as_ts(as_of)
    out_cols = [c if c != "database_id" else "db_name" for c in cols]
    return r.select(*keys, *out_cols, "text", "query_plan", F.to_date(as_of_c).alias("log_date"),
                    F.date_format(as_of_c, "HH:mm:ss").alias("log_time"))


def index_definitions(indexes: DataFrame, objects: DataFrame, index_columns: DataFrame,
                      columns: DataFrame | None = None, index_name: str | None = None,
                      trailing_separator: bool = True, keys: Keys = ()) -> DataFrame:
    """Key and included column lists per index, in ``index_column_id`` order.

    The per-index lists are built by one aggregation over the column
    catalog (``listagg ... WITHIN GROUP``), then left-joined to the indexes:
    the correlated subqueries of the reference, decorrelated. Each name is
    followed by ``", "`` as in the reference; ``trailing_separator=False``
    drops the last one. An empty list is NULL.
    """
    ic = index_columns
    if columns is not None:
        c = columns.select(*keys, "object_id", "column_id", F.col("name").alias("column_name"))
        ic = ic.join(c, on(["object_id", "column_id"], keys))
    ic = ic.select(*keys, "object_id", "index_id", "index_column_id", "column_name", "is_included_column")
    agg = ic.groupBy(*keys, "object_id", "index_id").agg(
        F.expr("listagg(CASE WHEN is_included_column = 0 THEN column_name || ', ' END, '') "
               "WITHIN GROUP (ORDER BY index_column_id)").alias("key_columns"),
        F.expr("listagg(CASE WHEN is_included_column = 1 THEN column_name || ', ' END, '') "
               "WITHIN GROUP (ORDER BY index_column_id)").alias("included_columns"))
    for c in ("key_columns", "included_columns"):
        col = F.when(F.length(c) > 0, F.col(c))
        if not trailing_separator:
            col = F.regexp_replace(col, ", $", "")
        agg = agg.withColumn(c, col)
    o = objects.filter(F.col("is_ms_shipped") == 0).select(*keys, "object_id", F.col("name").alias("table_name"))
    i = indexes
    if index_name is not None:
        i = i.filter(F.col("name") == index_name)
    i = i.select(*keys, "object_id", "index_id", F.col("name").alias("index_name"),
                 F.col("type_desc").alias("index_type"), "is_unique", "is_primary_key")
    out = i.join(o, on(["object_id"], keys)).join(agg, on(["object_id", "index_id"], keys), "left")
    return out.select(*keys, "table_name", "index_name", "key_columns", "included_columns", "index_type",
                      "is_unique", "is_primary_key")


def join_index_sets(a: DataFrame, b: DataFrame, keys: Keys = ()) -> DataFrame:
    """Index definitions of two databases side by side.

    The reference joins on table name only, which pairs every index of a
    table with every index of the same table in the other database. We join
    on (table, index name) instead, one pair per index, and keep unmatched
    indexes of ``a`` (left join).
    """
    left = a.select(*keys, "table_name", "index_name", F.col("key_columns").alias("a_key_columns"))
    right = b.select(*keys, "table_name", "index_name", F.col("key_columns").alias("b_key_columns"),
                     F.lit(True).alias("in_b"))
    out = left.join(right, on(["table_name", "index_name"], keys), "left")
    return out.select(*keys, "table_name", "index_name", "a_key_columns", "b_key_columns",
                      F.coalesce("in_b", F.lit(False)).alias("in_b"))


def index_difference(a: DataFrame, b: DataFrame, index_name: str | None = None, keys: Keys = ()) -> DataFrame:
    """(table, index, key columns) rows of ``a`` not in ``b`` (``EXCEPT DISTINCT``; NULLs equal).

    The optional name filter applies to ``a`` only, as in the reference.
    Names compare under the server collation.
    """
    cols = [*keys, "table_name", "index_name", "key_columns"]
    left = a if index_name is None else a.filter(tsql.same("index_name", index_name))
    return except_rows(left, b, cols)


def unused_procedures(procedures: DataFrame, procedure_stats: DataFrame, keys: Keys = ()) -> DataFrame:
    """Names of user procedures with no cached statistics.

    A set difference **by name** (``EXCEPT``), so a name used in one schema
    hides the same name in another; duplicates collapse.
    """
    p = procedures.filter(F.col("is_ms_shipped") == 0)
    used = (p.join(procedure_stats.select(*keys, "object_id"), on(["object_id"], keys))
            .select(*keys, F.col("name").alias("sp_name")))
    return except_rows(p.select(*keys, F.col("name").alias("sp_name")), used, [*keys, "sp_name"])
