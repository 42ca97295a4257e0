"""Trace, principals and server inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.functions import tsql
from dbtelemetry.operators.common import Keys, on, with_absent

# Fixed values of the default-trace report: statistics objects and tempdb are skipped,
# and system sessions (spid 50 and below) are ignored.
STATISTICS_OBJECT_TYPE = 21587
SYSTEM_SPID_MAX = 50
SYSTEM_DATABASE_MAX_ID = 4


def default_trace_today(trace: DataFrame, subclasses: DataFrame, events: DataFrame, categories: DataFrame,
                        as_of, keys: Keys = ()) -> DataFrame:
    """Default-trace rows of the day of ``as_of`` (midnight to midnight) with event, category and object-type names.

    Event and category names are inner joins, the object-type name a left
    join on (event, subclass value). The ``<>`` tests drop rows with a NULL
    object type or database, as in the reference. The three lookups are
    the server's trace catalogs (a few hundred rows), which AQE broadcasts
    from their measured size; the trace rows are not shuffled then.
    """
    since = tsql.start_of_day(tsql.as_ts(as_of))
    trace = with_absent(trace, "string", "server_name", "object_name", "login_name", "application_name")
    gt = trace.filter((F.col("spid") > SYSTEM_SPID_MAX) & (F.col("object_type") != STATISTICS_OBJECT_TYPE)
                      & (F.col("database_name") != "tempdb") & (F.col("start_time") >= since)
                      & (F.col("start_time") < since + F.expr("INTERVAL 1 DAY")))
    sv = subclasses.select(F.col("trace_event_id").alias("__sv_ev"), F.col("subclass_value").alias("__sv_val"), "subclass_name")
    ev = events.select(F.col("trace_event_id").alias("__ev"), F.col("name").alias("event_name"), "category_id")
    cat = categories.select(F.col("category_id").alias("__cat"), F.col("name").alias("category"))
    j = gt.join(sv, (gt["event_class"] == sv["__sv_ev"]) & (sv["__sv_val"] == gt["object_type"]), "left")
    j = j.join(ev, j["event_class"] == ev["__ev"]).join(cat, F.col("category_id") == cat["__cat"])
    return j.select(*keys, *[c for c in ("server_name", "object_name", "login_name", "application_name")
                             if c not in keys], "database_name", "spid", "start_time",
                    F.col("object_type").alias("object_type_id"), F.col("subclass_name").alias("object_type"),
                    "category_id", "category", F.col("event_class").alias("event_id"), "event_name", "text_data")


def orphaned_users(db_principals: DataFrame, server_principals: DataFrame, keys: Keys = ()) -> DataFrame:
    """Database users of instance authentication with no server login of the same SID.

    The reference's left join with ``sp.sid IS NULL`` tests the join key,
    so it is exactly an anti join.
    """
    dp = db_principals.filter(F.col("authentication_type_desc") == "INSTANCE")
    sp = server_principals.select(*keys, "sid")
    return dp.join(sp, on(["sid"], keys), "left_anti").select(*keys, "type_desc", "sid",
                                                               F.col("name").alias("user_name"))


def database_overview(databases: DataFrame, helpdb: DataFrame, keys: Keys = ()) -> DataFrame:
    """User databases (id above 4) with size and owner from the help listing."""
    h = with_absent(helpdb, "string", "created").select(*keys, F.col("dbid").alias("database_id"), F.col("db_size").alias("size"), "owner", "created")
    d = with_absent(databases, "string", "state_desc", "recovery_model_desc", "collation_name", "snapshot_isolation_state_desc")
    d = with_absent(d, "int", "compatibility_level", "is_query_store_on", "is_read_committed_snapshot_on",
                    "target_recovery_time_in_seconds")
    d = d.filter(F.col("database_id") > SYSTEM_DATABASE_MAX_ID)
    j = d.join(h, on(["database_id"], keys))
    wanted = [("name", "database_name"), ("state_desc", "database_state"), ("size", "size"), ("owner", "owner"),
              ("compatibility_level", "compatibility"), ("recovery_model_desc", "recovery_model"),
              ("created", "create_date"), ("is_query_store_on", "query_store_on"),
              ("collation_name", "collation_name"), ("snapshot_isolation_state_desc", "snapshot_isolation_state"),
              ("is_read_committed_snapshot_on", "read_committed_snapshot"),
              ("target_recovery_time_in_seconds", "target_recovery_time_in_seconds")]
    return j.select(*keys, *[F.col(src).alias(dst) for src, dst in wanted])


def mail_profiles(profile: DataFrame, link: DataFrame, account: DataFrame, keys: Keys = ()) -> DataFrame:
    """Mail accounts with the profiles they belong to."""
    sp = profile.select(*keys, "profile_id", F.col("name").alias("profile_name"))
    spa = link.select(*keys, "profile_id", "account_id")
    sa = account.select(*keys, "account_id", "name", "email_address", "display_name")
    j = sp.join(spa, on(["profile_id"], keys)).join(sa, on(["account_id"], keys))
    return j.select(*keys, "account_id", "profile_id", "name", "email_address", "display_name", "profile_name")


def system_views(df: DataFrame) -> DataFrame:
    """Extended-events views: ``name LIKE '%dm_xe%' OR (name LIKE '%server_event_s%' AND shipped)``.

    AND binds before OR, so the shipped flag only qualifies the second
    pattern; ``_`` is a single-character wildcard in both.
    """
    cond = tsql.like("name", "%dm_xe%") | (tsql.like("name", "%server_event_s%") & (F.col("is_ms_shipped") == 1))
    extra = ["server_name"] if "server_name" in df.columns else []
    df = with_absent(df, "timestamp_ntz", "create_date")
    return df.filter(cond).select(*extra, "name", "create_date", "is_ms_shipped")


def alert_recipients(contacts: DataFrame, category: str = "DATABASE") -> DataFrame:
    """Primary contacts of a category (the reference keeps one arbitrary row; all are kept)."""
    return contacts.filter((F.col("category") == category) & (F.col("notify_primary") == 1)).select("email")


def pool_names(grid_servers: DataFrame) -> DataFrame:
    """Application-pool name per server, the last ``/`` segment of its URL.

    A URL without a slash makes the reference fail; here it is returned whole.
    """
    return grid_servers.select("server", F.substring_index("url", "/", -1).alias("pool_name"))


def drop_user_statements(users: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``sp_dropuser [name] GO`` text for every user not kept (never run).

    ``NOT IN`` a literal list: a NULL name yields no statement.
    """
    u = users
    if keep:
        u = u.filter(~F.col("name").isin(*keep))
    stmt = F.concat(F.lit("sp_dropuser "), F.lit("["), F.col("name"), F.lit("]"), F.lit(" GO "))
    return u.filter(F.col("name").isNotNull()).select(stmt.alias("drop_statement"))


def enabled_trace_flags(config: DataFrame) -> DataFrame:
    """Enabled trace flags per server (``DBCC TRACESTATUS`` captured as rows)."""
    return config.select("server_name", "trace_flag")


def cluster_nodes(config: DataFrame) -> DataFrame:
    """Cluster node names per server (``fn_virtualservernodes`` captured as rows)."""
    return config.select("server_name", "node_name")


def server_settings(config: DataFrame, name: str | None = None) -> DataFrame:
    """Configuration values per server (``sp_configure``), optionally one setting."""
    c = config if name is None else config.filter(F.col("name") == name)
    return c.select("server_name", "name", "value_in_use")
