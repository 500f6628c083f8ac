import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from outfall.operators import metrics, routing, selflogs
from outfall.operators.buffer import is_buffered, lost_messages, with_buffer_edges
from outfall.operators.selectors import with_kinds
from outfall.operators.skew import TASK_SHARES, fits_broadcast, skew_join
from outfall.schema import BINDING, ENVELOPE
from outfall.session import settle


def log(i, app, payload=b"x", ns=None):
    return (i, app, "1", i if ns is None else ns, {"source_type": "app"}, "log", (bytearray(payload), "OUT"), None, None)


def gauge(i, app, metrics_):
    return (i, app, "1", i, {}, "gauge", None, (metrics_,), None)


def routed(spark, envelopes, drains, **options):
    env = spark.createDataFrame(envelopes, ENVELOPE)
    bindings = with_kinds(spark.createDataFrame([(a, "h", d) for a, d in drains], BINDING), True)
    return routing.fan_out(routing.prerender(env), bindings, **options)


def test_every_binding_of_the_app_gets_a_copy(spark):
    pairs = routed(spark, [log(1, "a"), log(2, "b"), log(3, "none")], [("a", "d1"), ("a", "d2"), ("b", "d1")])
    got = sorted((r["env_id"], r["app_id"], r["drain"]) for r in pairs.collect())
    assert got == [(1, "a", "d1"), (1, "a", "d2"), (2, "b", "d1")]


def test_strays_are_dropped_but_counted(spark):
    env = spark.createDataFrame([log(1, "a"), log(2, "invalid-source-id")], ENVELOPE).withColumn("app_id", F.lit("a"))
    assert routing.own_envelopes(env).count() == 1
    assert metrics.ingress(env).first()["delta"] == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_gives_the_same_rows_both_ways(spark, how):
    rng = random.Random(1)
    keys = ["hot"] * 400 + [f"k{i % 40}" for i in range(300)] + [None] * 50
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    right = spark.createDataFrame(
        [("hot", j) for j in range(3)] + [(f"k{rng.randrange(60)}", j) for j in range(50)] + [(None, 9)], "k string, j int"
    )
    small = skew_join(left, right, ["k"], ["i"], how)
    salted = skew_join(left, right, ["k"], ["i"], how, max_broadcast_bytes=0, task_rows=50)
    plain = left.join(right, "k", how)
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, plain.collect()))
    assert "_lane" in salted._jdf.queryExecution().analyzed().toString()


def test_hot_keys_are_spread(spark):
    left = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    right = spark.createDataFrame([("hot", 1)], "k string, j int")
    joined = skew_join(left, right, ["k"], ["id"], max_broadcast_bytes=0, task_rows=300)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


@pytest.mark.parametrize("n_left, n_right", [(4, 4000), (4000, 4), (120, 130)])
def test_a_key_is_dealt_out_by_what_it_gives(spark, n_left, n_right):
    """An app with many drains and few envelopes is split as well as one with many envelopes and few drains."""
    left = spark.range(n_left).select(F.lit("hot").alias("k"), "id").unionByName(spark.createDataFrame([("cold", -1)], "k string, id long"))
    right = spark.range(n_right).select(F.lit("hot").alias("k"), F.col("id").alias("j"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    joined = skew_join(left, right, ["k"], ["id"], max_broadcast_bytes=0, task_rows=1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == n_left * n_right
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 0.6 * n_left * n_right
    assert joined.select("id", "j").distinct().count() == n_left * n_right


def test_a_small_settled_file_is_dealt_out_by_what_it_makes(spark):
    """Joined by broadcast, a single file of few rows that have many matches is not left to a single task."""
    left = settle(spark.range(300, numPartitions=1).select(F.lit("a").alias("k"), "id").unionByName(spark.createDataFrame([(None, -1), ("b", -2)], "k string, id long")))
    right = spark.range(200).select(F.lit("a").alias("k"), F.col("id").alias("j"))

    def sizes(**options):
        joined = skew_join(left.coalesce(1), right, ["k"], ["id"], **options)
        assert joined.select("id", "j").distinct().count() == joined.count() == 60_000
        return [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]

    dealt = sizes(task_rows=1000, is_settled=True)
    assert len(dealt) > 8 and max(dealt) < 60_000 / 4
    assert len(sizes(task_rows=60_000, is_settled=True)) == len(sizes(task_rows=1000)) == 1


def test_tasks_that_make_many_rows_are_not_merged(spark):
    left, right = (spark.range(2000).select(F.pmod("id", F.lit(20)).alias("k"), F.col("id").alias(name)) for name in ("i", "j"))
    joined = skew_join(left, right, ["k"], ["i"], max_broadcast_bytes=0, task_rows=1000)
    assert joined.rdd.getNumPartitions() == 2000 * 100 // (1000 * TASK_SHARES)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 200_000 and len(sizes) > 10


def test_ingress_is_counted_without_pairs(spark):
    rng = random.Random(3)
    envelopes = [log(i, rng.choice(["a", "b", "c"])) for i in range(40)] + [gauge(100 + i, "a", {}) for i in range(7)] + [log(7, "a"), log(8, None)]
    drains = [(rng.choice(["a", "b", None]), f"syslog://h{i % 5}{rng.choice(['', '?drain-type=all', '?drain-type=metrics'])}") for i in range(30)]
    bindings = with_kinds(spark.createDataFrame([(a, "h", d) for a, d in drains], BINDING), True)
    env = spark.createDataFrame(envelopes, ENVELOPE).select("env_id", "source_id", "kind")
    shared = bindings.withColumn("replicas", F.length("drain") % 2 + 1).withColumn("replica", F.col("replicas") - 1)
    for table in (bindings, shared, bindings.limit(0)):
        pairs = routing.own_share(routing.fan_out(env, table))
        counted = routing.own_share(routing.fan_out(env, routing.by_choice(table)))
        assert metrics.ingress(counted, "bindings").collect() == metrics.ingress(pairs).collect()
        assert counted.count() < pairs.count() or pairs.isEmpty()


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 1000)
    assert not fits_broadcast(spark.range(1000), 1000)


@pytest.mark.parametrize("broadcast", [0, 10**9])
def test_buffer_keeps_the_newest_envelopes(spark, broadcast):
    rng = random.Random(2)
    envelopes = [log(i, "busy", ns=rng.randrange(40)) for i in range(100)] + [log(i, "calm") for i in range(100, 110)]
    envelopes += [gauge(200 + i, "busy", {"a": ("u", 1.0), "b": ("u", 2.0)}) for i in range(5)]
    envelopes += [gauge(300, "busy", {})]
    drains = [("busy", "syslog://h?drain-type=all"), ("calm", "syslog://h?drain-type=all")]
    bindings = with_kinds(spark.createDataFrame([(a, "h", d) for a, d in drains], BINDING), True)
    env = spark.createDataFrame(envelopes, ENVELOPE)
    targets = with_buffer_edges(env, bindings, 20, broadcast)
    pairs = routing.fan_out(routing.prerender(env), targets, max_broadcast_bytes=broadcast)
    marked = pairs.withColumn("is_buffered", is_buffered()).collect()
    order = sorted(((e[3], e[0]) for e in envelopes if e[1] == "busy"), reverse=True)
    kept = {i for _, i in order[:20]} | set(range(100, 110))
    assert {r["env_id"] for r in marked if r["is_buffered"]} == kept
    assert len(marked) == 100 + 10 + 10 + 1
    lost = lost_messages(targets, 20)
    assert [(r["app_id"], r["missed"]) for r in lost.collect()] == [("busy", 86)]
    assert metrics.dropped(lost).first()["delta"] == 86
    logs = sorted(tuple(r) for r in selflogs.lost_message_logs(lost, "3").collect())
    text = "86 messages lost in user provided syslog drain"
    assert logs == [("busy", "LGR", "", text), ("busy", "SYS", "3", text)]


def test_selections_of_one_app_have_buffers_of_their_own(spark):
    envelopes = [log(i, "a") for i in range(12)] + [gauge(100 + i, "a", {"m": ("u", 1.0)}) for i in range(5)]
    drains = ["syslog://h", "https://h", "syslog://h?drain-type=metrics", "syslog://h?drain-type=all"]
    bindings = with_kinds(spark.createDataFrame([("a", "h", d) for d in drains], BINDING), True)
    env = spark.createDataFrame(envelopes, ENVELOPE)
    targets = with_buffer_edges(env, bindings, 10)
    assert {r["drain"]: r["missed"] for r in lost_messages(targets, 10).collect()} == {
        "syslog://h": 2, "https://h": 2, "syslog://h?drain-type=all": 7,
    }
    kept = routing.fan_out(routing.prerender(env), targets).filter(is_buffered()).groupBy("drain").count()
    assert {r["drain"]: r["count"] for r in kept.collect()} == dict(zip(drains, [10, 10, 5, 10]))
    full = with_buffer_edges(env, bindings, 0)
    assert routing.fan_out(routing.prerender(env), full).filter(is_buffered()).count() == 0


def test_self_logs_reach_the_drains_of_the_app(spark):
    lost = spark.createDataFrame([("a", "h", "syslog://h", 5)], "app_id string, hostname string, drain string, missed long")
    logs = selflogs.as_envelopes(selflogs.lost_message_logs(lost, "3"), F.lit(0), F.monotonically_increasing_id())
    together = selflogs.with_self_logs(spark.createDataFrame([log(7, "a")], ENVELOPE), logs)
    bindings = with_kinds(spark.createDataFrame([("a", "h", "https://h")], BINDING), True)
    frames = {r["frame"] for r in routing.render(routing.fan_out(routing.prerender(together), bindings)).collect()}
    text = "5 messages lost in user provided syslog drain\n"
    assert f"<11>1 1970-01-01T00:00:00.000000+00:00 h a [LGR] - - {text}" in frames
    assert f"<11>1 1970-01-01T00:00:00.000000+00:00 h a [SYS/3] - - {text}" in frames
    assert len(frames) == 3


def test_replicas_share_a_stream(spark):
    ids = spark.range(1000).withColumn("r", routing.replica(F.col("id"), 2))
    counts = {r["r"]: r["count"] for r in ids.groupBy("r").count().collect()}
    assert set(counts) == {0, 1} and sum(counts.values()) == 1000 and min(counts.values()) > 400


def test_rendering_stays_out_of_the_join(spark):
    """The projection that renders is a plan node of its own below the join, not fused into it."""
    plan = routed(spark, [log(1, "a")], [("a", "d")])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastHashJoin"):]
    assert "date_from_unix_date" in below and "date_from_unix_date" not in plan[: plan.index("BroadcastHashJoin")]
