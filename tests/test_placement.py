import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from outfall.operators import metrics, placement, selflogs
from outfall.operators.skew import group_edges, mark_first, running_start
from outfall.schema import BINDING, HELD, WORKER


def bindings(spark, *names):
    return spark.createDataFrame([(n, "h", "d") for n in names], BINDING)


def workers(spark, count, failing=()):
    return spark.createDataFrame([(f"w{i}", i not in failing) for i in range(count)], WORKER)


def moves(result):
    return sorted((r["worker"], r["app_id"], r["action"]) for r in result.collect())


def held(spark, *rows):
    return spark.createDataFrame([(w, a, "h", "d") for w, a in rows], HELD)


def test_three_bindings_on_three_workers(spark):
    result = moves(placement.rebalance(held(spark), bindings(spark, "a", "b", "c"), workers(spark, 3)))
    assert Counter(w for w, _, _ in result) == {"w0": 2, "w1": 2, "w2": 2}
    assert len({(w, a) for w, a, _ in result}) == 6
    current = held(spark, *[(w, a) for w, a, _ in result])
    again = moves(placement.rebalance(current, bindings(spark, "b", "c", "a"), workers(spark, 3)))
    assert {action for _, _, action in again} == {"kept"}


def test_removal_and_empty_snapshot(spark):
    current = held(spark, ("w0", "a"), ("w1", "a"), ("w2", "b"), ("w0", "b"))
    result = moves(placement.rebalance(current, bindings(spark, "a"), workers(spark, 3)))
    assert result == [("w0", "a", "kept"), ("w0", "b", "remove"), ("w1", "a", "kept"), ("w2", "b", "remove")]
    emptied = placement.rebalance(current, spark.createDataFrame([], BINDING), workers(spark, 3))
    assert Counter(a for _, _, a in moves(emptied)) == {"remove": 4}


def test_repeats_do_not_count(spark, monkeypatch):
    current = [("w0", "a"), ("w1", "a"), ("w2", "b"), ("w0", "b"), ("w1", "b"), ("w1", "c")]
    wanted = ["a", "b", "c", "d"]
    once = moves(placement.rebalance(held(spark, *current), bindings(spark, *wanted), workers(spark, 3)))
    numbered = []
    start = placement.running_start
    monkeypatch.setattr(placement, "running_start", lambda *a: numbered.append(start(*a)) or numbered[-1])
    twice = placement.rebalance(held(spark, *2 * current), bindings(spark, *2 * wanted), workers(spark, 3))
    assert moves(twice) == once and Counter(a for _, _, a in once) == {"kept": 5, "remove": 1, "add": 3}
    # Missing copies are numbered once, in a job of their own.
    plan = twice._jdf.queryExecution().optimizedPlan().toString()
    assert len(numbered) == 1 and "_weight" not in plan and "Window" not in plan


def test_failing_worker_is_left_out(spark):
    pool = workers(spark, 3, failing=[1])
    result = moves(placement.rebalance(held(spark), bindings(spark, "a", "b"), pool))
    assert {w for w, _, _ in result} == {"w0", "w2"}
    assert metrics.adapters(pool).first()["value"] == 2
    assert metrics.bad_connections(pool).first()["delta"] == 1
    nobody = placement.rebalance(held(spark, ("w0", "a")), bindings(spark, "a"), workers(spark, 3, failing=[0, 1, 2]))
    assert moves(nobody) == []


def test_one_worker_one_copy(spark):
    assert placement.place(bindings(spark, "a"), workers(spark, 1)).count() == 1
    assert placement.place_evenly(bindings(spark, "a"), workers(spark, 1)).count() == 1
    assert moves(placement.rebalance(held(spark), bindings(spark, "a"), workers(spark, 1))) == [("w0", "a", "add")]
    assert placement.place(bindings(spark, "a"), workers(spark, 3)).count() == 2


def test_new_worker_takes_only_what_it_wins(spark):
    names = [f"app-{i}" for i in range(200)]
    before = {(r["worker"], r["app_id"]) for r in placement.place(bindings(spark, *names), workers(spark, 5)).collect()}
    after = {(r["worker"], r["app_id"]) for r in placement.place(bindings(spark, *names), workers(spark, 6)).collect()}
    assert {w for w, _ in after - before} == {"w5"}


@pytest.mark.parametrize("seed", range(4))
def test_rebalance_properties(spark, seed):
    rng = random.Random(seed)
    count = rng.randrange(1, 7)
    failing = [i for i in range(count) if rng.random() < 0.2]
    current = {(f"w{rng.randrange(count)}", f"app-{rng.randrange(40)}") for _ in range(rng.randrange(90))}
    wanted = {f"app-{i}" for i in range(40) if rng.random() < 0.7}
    result = moves(
        placement.rebalance(held(spark, *current), bindings(spark, *wanted), workers(spark, count, failing))
    )
    healthy = {f"w{i}" for i in range(count) if i not in failing}
    after = {(w, a) for w, a, action in result if action != "remove"}
    copies = Counter(a for _, a in after)
    assert copies == {a: min(2, len(healthy)) for a in wanted if healthy}
    assert len(after) == sum(copies.values())
    visible = {(w, a) for w, a in current if w in healthy}
    assert {(w, a) for w, a, action in result if action != "add"} == visible
    for w, a in visible:  # what is wanted is only removed where there are two other held copies
        if a in wanted and (w, a) not in after:
            assert sum((v, a) in after and (v, a) in visible for v in healthy) == 2


def test_fresh_loads_differ_by_one_at_most(spark):
    names = [f"app-{i}" for i in range(101)]
    for result in (
        placement.place_evenly(bindings(spark, *names), workers(spark, 7)),
        placement.rebalance(held(spark), bindings(spark, *names), workers(spark, 7)),
    ):
        loads = Counter(r["worker"] for r in result.collect())
        assert sum(loads.values()) == 202 and max(loads.values()) - min(loads.values()) <= 1


def test_lighter_workers_are_filled_first(spark):
    current = held(spark, *[("w0", f"old-{i}") for i in range(10)], *[("w1", f"old-{i}") for i in range(10)])
    names = [f"old-{i}" for i in range(10)] + [f"new-{i}" for i in range(5)]
    result = placement.rebalance(current, bindings(spark, *names), workers(spark, 4))
    loads = Counter(r["worker"] for r in result.collect())
    assert loads == {"w0": 10, "w1": 10, "w2": 5, "w3": 5}


def test_cap(spark):
    rows = [("w0", f"app-{i}", "h", "d", i % 2 == 0, i) for i in range(10)] + [("w1", "app-0", "h", "d", True, 0)]
    schema = "worker string, app_id string, hostname string, drain string, is_new boolean, arrival int"
    assigned = spark.createDataFrame(rows, schema)
    capped = placement.cap_workers(assigned, 7)
    refused = capped.filter("not is_accepted")
    assert sorted(r["app_id"] for r in refused.collect()) == ["app-4", "app-6", "app-8"]
    assert metrics.rejected_bindings(capped).first()["delta"] == 3
    nothing = placement.cap_workers(assigned, 0)
    assert nothing.filter("is_accepted").count() == 0
    log = selflogs.not_scheduled_logs(nothing.filter("worker = 'w1'")).first()
    assert tuple(log) == ("app-0", "LGR", "w1", "Syslog adapter has failed to schedule your drain stream")


def test_running_start(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("n"))
    rows = running_start(df, F.col("id").cast("string"), F.col("n"), "start").collect()
    at = sorted((r["start"], r["start"] + r["n"]) for r in rows if r["n"])
    assert at[0][0] == 0 and all(a[1] == b[0] for a, b in zip(at, at[1:]))


@pytest.mark.parametrize("limit", [0, 1, 7, 500])
@pytest.mark.parametrize("broadcast", [0, 10**9])
def test_mark_first_against_brute_force(spark, limit, broadcast):
    rng = random.Random(limit)
    rows = [(rng.choice("aaaabc"), i, rng.random()) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, i int, r double")
    edges = group_edges(df, ["k"], F.col("r"), limit, ["i"], broadcast)
    marked = mark_first(df, edges, ["k"], F.col("r"), ["i"], broadcast).collect()
    first = {i for k in "abc" for i in [x[1] for x in sorted((r for r in rows if r[0] == k), key=lambda x: x[2])[:limit]]}
    assert len(marked) == len(rows)
    assert {r["i"] for r in marked if r["is_first"]} == first


def on_ring(names, pool, n, points):
    """The first ``n`` workers after each binding, by hand."""
    import hashlib

    def place(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    marks = sorted((place(f"{w}|{i}"), w) for w in pool for i in range(points))
    found = {}
    for name in names:
        at = place(f"{name}\x1fh\x1fd")
        order = [w for p, w in marks if p >= at] + [w for p, w in marks if p < at]
        found[name] = list(dict.fromkeys(order))[:n]
    return found


@pytest.mark.parametrize("count, points, bucket_points, n", [(1, 4, 1, 2), (2, 3, 1, 3), (5, 2, 1, 3), (30, 4, 2, 4), (30, 16, 64, 2), (3, 1, 1, 3)])
@pytest.mark.parametrize("broadcast", [0, 10**9])
def test_ring_against_brute_force(spark, count, points, bucket_points, n, broadcast):
    from outfall.operators.hash_ring import with_next_workers

    names = [f"app-{i}" for i in range(80)]
    found = with_next_workers(
        bindings(spark, *names), workers(spark, count), placement.binding_text(), n, "c", points, bucket_points, broadcast
    )
    assert {r["app_id"]: r["c"] for r in found.collect()} == on_ring(names, [f"w{i}" for i in range(count)], n, points)


@pytest.mark.parametrize("count", [1, 9])
def test_candidates_are_all_workers(spark, count):
    names = [f"app-{i}" for i in range(30)]
    found = placement.with_candidates(bindings(spark, *names), workers(spark, count), None)
    assert {r["app_id"]: r["candidates"] for r in found.collect()} == on_ring(names, [f"w{i}" for i in range(count)], count, 16)


def test_candidates_query_names_every_worker(spark, tmp_path):
    from outfall.plans.catalog import QUERIES

    spark.range(1, 9).selectExpr("id c_custkey", "'BUILDING' c_mktsegment", "1 c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, 20).selectExpr("id s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    rows = QUERIES["join6_worker_candidates"](spark, str(tmp_path)).collect()
    assert len(rows) == 8 and all(sorted(r["candidates"].split(",")) == [f"w{i}" for i in range(7)] for r in rows)


def test_ring_without_workers(spark):
    assert placement.place(bindings(spark, "a"), workers(spark, 0)).count() == 0
    assert placement.place_evenly(bindings(spark, "a"), workers(spark, 0)).count() == 0


def test_worker_that_leaves_moves_only_its_own(spark):
    names = [f"app-{i}" for i in range(200)]
    before = {(r["worker"], r["app_id"]) for r in placement.place(bindings(spark, *names), workers(spark, 6)).collect()}
    after = {(r["worker"], r["app_id"]) for r in placement.place(bindings(spark, *names), workers(spark, 5)).collect()}
    assert {w for w, _ in before - after} == {"w5"} and len(after - before) == len(before - after)


def test_a_million_workers(spark):
    pool = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("worker"), F.lit(True).alias("healthy"))
    names = [f"app-{i}" for i in range(50)]
    placed = placement.place(bindings(spark, *names), pool).collect()
    assert Counter(r["app_id"] for r in placed) == {n: 2 for n in names} and len({tuple(r) for r in placed}) == 100
    moved = placement.rebalance(held(spark, ("w7", "app-0")), bindings(spark, *names), pool)
    got = moves(moved)
    assert Counter(a for _, a, _ in got) == {n: 2 for n in names} and ("w7", "app-0", "kept") in got
    assert max(Counter(w for w, _, _ in got).values()) == 1


@pytest.mark.parametrize("broadcast", [0, 10**9])
def test_fill_against_one_by_one(spark, broadcast):
    rng = random.Random(7)
    for case in range(4):
        loads = {f"w{i}": rng.choice([0, 0, 1, 3, 4, 9]) for i in range(rng.randint(1, 12))}
        slots = rng.randint(1, 60)
        now, expected = dict(loads), []
        for _ in range(slots):  # level by level, in order of the first load and name
            least = min(now.values())
            worker = min((w for w in now if now[w] == least), key=lambda w: (loads[w], w))
            now[worker] += 1
            expected.append(worker)
        df = spark.createDataFrame(list(loads.items()), "worker string, load long")
        got = placement.fill(spark.range(slots).withColumnRenamed("id", "slot"), df, broadcast).collect()
        assert [r["worker"] for r in sorted(got, key=lambda r: r["slot"])] == expected


def test_ordered_start(spark):
    from outfall.operators.skew import ordered_start

    df = spark.createDataFrame([(i % 3, f"n{i}") for i in range(300)], "a int, b string").repartition(5)
    rows = ordered_start(df, ["a", "b"], F.lit(1), "n").collect()
    assert [r["n"] for r in sorted(rows, key=lambda r: (r["a"], r["b"]))] == list(range(300))
