"""Positions, two-phase order and HTML documents in parts."""

import json
import random

from pyspark.sql import functions as F

from dbtelemetry.operators.ordering import in_order, in_order_joined, in_order_with, positions
from dbtelemetry.sources import html, sinks


def test_positions_of_hot_and_rare_keys(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.randint(0, 9), i) for i in range(500)] + [(None, 1, 1000), (None, 0, 1001)]
    df = spark.createDataFrame(rows, "k string, o int, i int")
    for n in (1, 6):
        got = {}
        for r in positions(df, ["o", F.col("i").desc()], ["k"], num_partitions=n).collect():
            got.setdefault(r.k, []).append((r.position, r.o, -r.i))
        for k, found in got.items():
            want = sorted((o, -i) for kk, o, i in rows if kk == k)
            assert sorted(found) == [(p, *w) for p, w in enumerate(want)]
    assert [r.position for r in positions(df, ["o", "i"]).orderBy("o", "i").collect()] == list(range(len(rows)))
    assert positions(df.limit(0), ["o"]).count() == 0


def test_in_order_moves_no_text_through_the_range_exchange(spark):
    n = 3000
    narrow = spark.range(n).select(((F.col("id") * 7919) % 501).alias("o"), (F.col("id") % 100).alias("h"))
    texts = spark.range(100).select(F.col("id").alias("h"), F.repeat(F.lit("t"), 50).alias("text"))
    out = in_order(narrow, [F.col("o").desc()], lambda rows: rows.join(texts, "h"), within=["h"])
    got = [(r.o, r.h) for r in out.collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1])) and len(got) == n
    plan = out._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()  # the placement is a stored table by then


def lines(parts, keys=()):
    out = {}
    for r in sorted(parts.collect(), key=lambda r: ([str(r[k]) for k in keys], r.part)):
        out.setdefault(tuple(r[k] for k in keys), []).append((r.part, r.html))
    return out


def test_document_in_parts(spark, scratch):
    rows = spark.createDataFrame([("a" if i < 25 else "b", i, f"n<{i}>") for i in range(30)], "server string, o int, n string")
    frags = sinks.html_rows(rows, ["n"], ["o"], ["server"])
    parts = html.document_parts(frags, ["Name"], ["o"], ["server"], part_rows=10)
    got = lines(parts, ["server"])
    assert {k: [p for p, _ in v] for k, v in got.items()} == {("a",): [0, 1, 2, 3, 4], ("b",): [0, 1, 2]}
    whole = "".join(t for _, t in got["a",])
    assert whole == sinks.html_header(["Name"]) + "".join(f"<tr><td>n&lt;{i}&gt;</td></tr>" for i in range(25)) + "</table>"
    html.write_document(parts, scratch + "/doc", ["server"])
    listed = json.load(open(scratch + "/doc/" + html.MANIFEST))
    assert [(m["report"], m["part"]) for m in listed] == [("a", p) for p in range(5)] + [("b", p) for p in range(3)]
    assert "".join(open(f"{scratch}/doc/{m['file']}").read() for m in listed if m["report"] == "a") == whole


def test_document_of_no_rows(spark):
    rows = spark.createDataFrame([], "server string, o int, n string")
    one = lines(html.document_parts(sinks.html_rows(rows, ["n"], ["o"]), ["Name"], ["o"]))
    assert one == {(): [(0, sinks.html_header(["Name"])), (1, "</table>")]}
    assert html.document_parts(sinks.html_rows(rows, ["n"], ["o"], ["server"]), ["Name"], ["o"], ["server"]).count() == 0


def test_in_order_with_ships_a_blocks_texts_once(spark):
    n = 3000
    rows = [(i * 7919 % 501, None if i % 11 == 0 else i % 40, i % 3) for i in range(n)]
    narrow = spark.createDataFrame(rows, "o long, h long, p long")
    texts = [(h, f"text {h} " + "t" * 5000) for h in range(30)] + [(5, "a second text of 5"), (None, "of no handle")]
    texts = spark.createDataFrame(texts, "k long, text string")
    plans = spark.createDataFrame([(0, "<a/>"), (1, "<b/>")], "q long, plan string")
    finds = {"h": lambda need: need.join(texts, F.col("h") == F.col("k")).drop("k"),
             "p": lambda need: need.join(plans, F.col("p") == F.col("q")).drop("q")}
    for block_rows in (100, 10**6):
        out = in_order_with(narrow, [F.col("o").desc()], finds, block_rows=block_rows)
        got = out.collect()
        want = narrow.join(texts, F.col("h") == F.col("k"), "left").join(plans, F.col("p") == F.col("q"), "left").select("o", "h", "p", "text", "plan")
        key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
        assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want.collect()), key=key)
        assert [r.o for r in got] == sorted((r.o for r in got), reverse=True)
        # Neither the rows with their texts move, nor are they sorted.
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
        top = plan[:plan.index("ShuffledHashJoin")]
        assert plan.count("ShuffledHashJoin") >= 2 and "Exchange" not in top and "Sort" not in top and "SortMergeJoin" not in top
    deep = in_order_with(narrow, [F.col("o").desc()], finds, within=[F.col("text").desc()], block_rows=100).collect()
    assert len(deep) == len(got) and [(r.o, r.text or "") for r in deep] == sorted(((r.o, r.text or "") for r in deep), reverse=True)
    one = in_order_with(narrow, ["o"], finds, num_partitions=1).collect()
    assert len(one) == len(got) and [r.o for r in one] == sorted(r.o for r in one)
    assert in_order_with(narrow.limit(0), ["o"], finds).count() == 0


def test_ordered_waits_never_shuffle_their_texts(spark):
    """one text on every row; what is shuffled is less than the rows with their texts."""
    from dbtelemetry.operators import activity

    n, size = 2000, 4000
    waits = spark.range(n).select(F.lit(1).cast("long").alias("session_id"), F.col("id").alias("exec_context_id"), F.lit(5).alias("wait_duration_ms"),
                                  F.lit("w").alias("wait_type"), F.lit(None).cast("long").alias("blocking_session_id"), F.lit("r").alias("resource_description"))
    sessions = spark.createDataFrame([(1, "app", 1, 2, 1)], "session_id long, program_name string, cpu_time long, memory_usage long, is_user_process int")
    requests = spark.createDataFrame([(1, 7, 70)], "session_id long, sql_handle long, plan_handle long")
    text = spark.createDataFrame([(7, 3, "x" * size)], "sql_handle long, dbid long, text string")
    plans = spark.createDataFrame([(70, "<p/>")], "plan_handle long, query_plan string")
    named = spark.createDataFrame([("w", "waiting")], "wait_type string, wait_type_desc string")
    dbs = spark.createDataFrame([(3, "db")], "database_id long, name string")
    for out in (activity.current_waits(waits, sessions, requests, text, plans),
                activity.current_waits_described(waits, sessions, requests, text, named, dbs)):
        got = out.collect()
        assert len(got) == n and all(len(r.text) == size for r in got)
        wide = out._jdf.queryExecution().executedPlan().toString()
        wide = wide[:wide.index("Join")]
        assert "Exchange" not in wide and "Shuffle" not in wide.replace("ShuffledHash", "") and "Sort" not in wide
    assert {r.database_name for r in got} == {"db"}


def test_in_order_joined_is_the_join(spark):
    """a session with more rows than a block, repeated rows, NULLs, texts that are missing or come twice."""
    rng = random.Random(3)
    base = [(rng.choice(["a", "b", None]), rng.choice([1, 1, 2, 3, 4, None]), rng.randint(0, 5), i % 50) for i in range(400)]
    many = [("a", 1, i % 60, i % 4) for i in range(300)] + [(rng.choice(["a", "b", None]), rng.choice([2, 3, 5, None]), rng.choice([1, 2, 70, None]), None) for _ in range(80)]
    base = spark.createDataFrame(base, "server string, k long, o long, i long")
    many = spark.createDataFrame(many, "server string, k long, h long, p long")
    texts = spark.createDataFrame([(s, h, f"text {h}") for s in "ab" for h in range(40)] + [("a", 5, "a second text of 5"), ("a", None, "of none")], "s string, t long, text string")
    plans = spark.createDataFrame([("a", 0, "<a/>"), ("a", 1, "<b/>")], "s string, q long, plan string")
    finds = {"h": lambda need: need.join(texts, (F.col("h") == F.col("t")) & (F.col("server") == F.col("s"))).drop("t", "s"),
             "p": lambda need: need.join(plans, (F.col("p") == F.col("q")) & (F.col("server") == F.col("s"))).drop("q", "s")}
    order = ["server", "k", F.col("o").desc()]
    want = (base.join(many, ["server", "k"]).join(texts, (F.col("h") == F.col("t")) & (F.col("server") == F.col("s")), "left").drop("s", "t")
            .join(plans, (F.col("p") == F.col("q")) & (F.col("server") == F.col("s")), "left"))
    cols = ["server", "k", "o", "i", "h", "p", "text", "plan"]
    want = sorted(map(repr, want.select(*cols).collect()))
    for block_rows in (7, 100, 10**6):
        out = in_order_joined(base, many, ["k"], order, finds, ["server"], block_rows=block_rows).select(*cols)
        got = out.collect()
        assert sorted(map(repr, got)) == want
        assert [(r.server, r.k, -r.o) for r in got] == sorted((r.server, r.k, -r.o) for r in got)
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
        top = plan[:plan.index("ShuffledHashJoin")]
        assert plan.count("ShuffledHashJoin") >= 3 and "Exchange" not in top and "Sort" not in top
    assert in_order_joined(base, many.limit(0), ["k"], order, finds, ["server"]).count() == 0


def tables_stored(monkeypatch):
    """(columns, rows) of every table that operators store from now on."""
    found, store = [], sinks.materialize

    def stored(df, columnar=False):
        out = store(df, columnar)
        found.append((set(out.columns), out.count()))
        return out

    monkeypatch.setattr(sinks, "materialize", stored)
    return found


def activity_tables(spark, n_waits, n_requests):
    waits = spark.range(n_waits).select(F.lit(1).cast("long").alias("session_id"), (F.col("id") % 4).alias("exec_context_id"), F.col("id").alias("wait_duration_ms"),
                                        F.lit("w").alias("wait_type"), F.lit(None).cast("long").alias("blocking_session_id"), F.lit("r").alias("resource_description"))
    sessions = spark.createDataFrame([(1, "h", "l", "s", 3, "app", 1, 2, 1)], "session_id long, host_name string, login_name string, status string, "
                                     "database_id long, program_name string, cpu_time long, memory_usage long, is_user_process int")
    requests = spark.range(n_requests).select(F.lit(1).cast("long").alias("session_id"), (F.col("id") % 9).alias("sql_handle"), (F.col("id") % 5).alias("plan_handle"))
    text = spark.range(500).select(F.col("id").alias("sql_handle"), F.lit(3).cast("long").alias("dbid"), F.repeat(F.lit("x"), 2000).alias("text"))
    plans = spark.range(500).select(F.col("id").alias("plan_handle"), F.lit("<p/>").alias("query_plan"))
    return waits, sessions, requests, text, plans


def test_current_waits_never_store_their_product(spark, monkeypatch):
    """each wait goes with each request of its session; neither table is stored more than once a block (8 here)."""
    from dbtelemetry.operators import activity

    found = tables_stored(monkeypatch)
    waits, sessions, requests, text, plans = activity_tables(spark, 200, 300)
    named = spark.createDataFrame([("w", "waiting")], "wait_type string, wait_type_desc string")
    dbs = spark.createDataFrame([(3, "db")], "database_id long, name string")
    for out in (activity.current_waits(waits, sessions, requests, text, plans),
                activity.current_waits_described(waits, sessions, requests, text, named, dbs)):
        assert out.count() == 200 * 300
        # Of 500 texts 9 are needed: the others stay where they are.
        assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert found and max(n for _, n in found) <= 8 * 300


def test_lookup_keeps_all_rows_if_many_are_needed(spark, monkeypatch):
    from dbtelemetry.operators import common

    look = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "h long, text string")
    need = spark.createDataFrame([(0, 1), (1, 1), (1, None), (2, 9)], "b long, h long")
    assert sorted(r.text for r in common.of_needed(look, need, "h").collect()) == ["a", "b"]
    monkeypatch.setattr(common, "SENT_HANDLES", 2)
    assert common.of_needed(look, need, "h").count() == 4


def test_active_sessions_do_not_store_a_session_for_each_request(spark, monkeypatch):
    """of 500 texts 9 are needed, and a session's columns move once a block, not once a request."""
    from dbtelemetry.operators import activity

    found = tables_stored(monkeypatch)
    _, sessions, requests, text, plans = activity_tables(spark, 1, 300)
    dbs = spark.createDataFrame([(3, "db")], "database_id long, name string")
    out = activity.active_sessions(sessions, requests, text, plans, dbs)
    got = out.collect()
    assert len(got) == 300 and {(r.host_name, r.database_name, len(r.text), r.query_plan) for r in got} == {("h", "db", 2000, "<p/>")}
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert found and all(n <= 1 for columns, n in found if "host_name" in columns)
