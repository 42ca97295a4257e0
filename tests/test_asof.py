"""As-of lookups against a brute-force search."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from dbtelemetry.operators.asof import latest_covering

START = dt.datetime(2024, 1, 1)


def at(minute):
    return None if minute is None else START + dt.timedelta(minutes=minute)


def test_latest_covering_against_brute_force(spark):
    rng = random.Random(5)
    keys = ["a", "b", None]
    versions, rows = [], []
    for i in range(300):
        b = rng.choice([None] + [rng.randint(0, 100)] * 9)
        e = rng.choice([None] + [None if b is None else b + rng.randint(-3, 30)] * 9)
        versions.append((rng.choice(keys), rng.randint(0, 1), at(b), at(e), rng.choice([None, i % 7])))
    for i in range(200):
        rows.append((i, rng.choice(keys), rng.randint(0, 1), at(rng.choice([None] + [rng.randint(-5, 135)] * 9))))
    v = spark.createDataFrame(versions, "k string, s int, b timestamp_ntz, e timestamp_ntz, plan int")
    r = spark.createDataFrame(rows, "id int, k string, s int, t timestamp_ntz")
    want = {}
    for i, k, s, t in rows:
        hits = [(e, p is not None, p) for vk, vs, b, e, p in versions
                if None not in (k, t, b, e) and vk == k and vs == s and b <= t <= e]
        if hits:
            want[i] = max(hits)[2]
    for n in (1, 7):
        got = {x.id: x.plan for x in latest_covering(r, v, ["k", "s"], "id", "t", "b", "e", ["plan"], num_partitions=n).collect()}
        assert got == want and len(want) > 50
    assert latest_covering(r.limit(0), v, ["k", "s"], "id", "t", "b", "e", ["plan"]).count() == 0
    assert latest_covering(r, v.limit(0), ["k", "s"], "id", "t", "b", "e", ["plan"]).count() == 0


def test_hot_key_costs_the_sum(spark):
    """One handle, 100,000 versions and 100,000 moments: the product would be 10 billion pairs."""
    n = 100_000
    v = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("b"), (F.col("id") + n).alias("e"), F.col("id").alias("plan"))
    r = spark.range(n).select(F.lit(1).alias("k"), "id", (F.col("id") * 2).alias("t"))
    begin = time.time()
    got = latest_covering(r, v, ["k"], "id", "t", "b", "e", ["plan"], num_partitions=16)
    # The version begun last of those that cover the moment.
    assert got.filter(F.col("plan") == F.least(F.col("id") * 2, F.lit(n - 1))).count() == n
    assert time.time() - begin < 60
