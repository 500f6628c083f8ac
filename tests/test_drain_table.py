import json

import pytest
from pyspark.sql import functions as F

from outfall.functions.addresses import ip_bytes
from outfall.operators import metrics, selflogs
from outfall.operators.bindings import distinct_bindings, remove_bindings, snapshot_diff
from outfall.operators.selectors import shard_id, with_kinds
from outfall.operators.validation import kept_bindings, removed_count, validate_bindings
from outfall.schema import BINDING, DNS, LANDED_PAGE
from outfall.sources import drain_table as source

APP = "9be15160-4845-4f05-b089-40e827ba61f1"
PAGE = {"results": {APP: {"drains": ["syslog://some.url", "syslog://some.other.url"], "hostname": "org.space.logspinner"}}}


def pages(spark, *rows):
    return spark.createDataFrame([(i, s, b if isinstance(b, str) else json.dumps(b)) for i, s, b in rows], LANDED_PAGE)


def ranges(spark, text):
    return source.parse_ranges(spark.createDataFrame([(text,)], "ranges string"))


def test_pages_from_files(spark, tmp_path):
    landed = [
        {"requested_id": 0, "status": 200, "body": json.dumps({**PAGE, "next_id": 50})},
        {"requested_id": 50, "status": 200, "body": '{ "results": { }, "next_id": null }'},
    ]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, landed)))
    got = source.fetch_bindings(source.read_pages(spark, str(tmp_path))).collect()
    assert sorted(map(tuple, got)) == [
        (APP, "org.space.logspinner", "syslog://some.other.url"),
        (APP, "org.space.logspinner", "syslog://some.url"),
    ]


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(0, 200, "invalid")], "invalid API response body"),
        ([(0, 400, "{}")], "received 400 status code"),
        ([(0, 200, {**PAGE, "next_id": 50}), (50, 500, "{}")], "received 500 status code"),
        ([(0, 200, {**PAGE, "next_id": 50})], "no single first and last page"),
        ([(50, 200, PAGE)], "no single first and last page"),
        ([(0, 200, {"next_id": 50}), (60, 200, {})], "a page is missing"),
        ([(0, 200, {"next_id": 50}), (50, 200, {"next_id": 60}), (50, 200, {"next_id": 60}), (60, 200, {})], "doubled"),
        ([(0, 200, {}), (7, 200, {"next_id": 9}), (9, 200, {"next_id": 7})], "the pages run in a ring"),
    ],
)
def test_bad_snapshots(spark, rows, message):
    with pytest.raises(source.IncompleteSnapshot, match=message):
        source.fetch_bindings(pages(spark, *rows))


def test_good_snapshots(spark):
    assert source.fetch_bindings(pages(spark, (0, 200, {}))).count() == 0
    assert source.fetch_bindings(pages(spark, (0, 200, "null"))).count() == 0
    assert source.fetch_bindings(pages(spark, (0, 200, {"results": {"a": {"drains": []}}, "next_id": 0}))).count() == 0
    backwards = pages(spark, (0, 200, {"next_id": 90}), (90, 200, {**PAGE, "next_id": 7}), (7, 200, {}))
    assert source.fetch_bindings(backwards).count() == 2


def test_page_url(spark):
    url = spark.range(1).select(source.page_url("https://api", F.col("id") + 50)).first()[0]
    assert url == "https://api/internal/v4/syslog_drain_urls?batch_size=1000&next_id=50"


@pytest.mark.parametrize(
    "text, count",
    [("", 0), ("127.0.2.2-127.0.2.4", 1), ("127.0.2.2-127.0.2.2", 1), ("10.0.0.4-10.0.0.8,123.4.5.6-123.4.5.7", 2)],
)
def test_good_ranges(spark, text, count):
    assert ranges(spark, text).count() == count


@pytest.mark.parametrize(
    "text, message",
    [
        ("invalid", "invalid BlacklistRange: invalid"),
        ("10.244.0.32-10", "invalid IP Address for Blacklist IP Range: 10"),
        ("127.0.2.2.1-127.0.2.4", "invalid IP Address for Blacklist IP Range: 127.0.2.2.1"),
        ("10.10.10.10-10.8.10.12", "invalid Blacklist IP Range: Start 10.10.10.10 has to be before End 10.8.10.12"),
        ("x-y,1-2-3", "invalid BlacklistRange: 1-2-3"),
    ],
)
def test_bad_ranges(spark, text, message):
    with pytest.raises(Exception, match=message):
        ranges(spark, text).select("start16").collect()


def test_workers(spark):
    hosts = spark.createDataFrame([("a",), ("b",)], "host string")
    dns = spark.createDataFrame([("a", "10.0.0.1"), ("a", "10.0.0.2"), ("b", "10.0.0.1")], DNS)
    got = source.worker_addresses(hosts, dns, "4443").collect()
    assert sorted(r[0] for r in got) == ["10.0.0.1:4443", "10.0.0.2:4443"]
    with pytest.raises(Exception, match="lookup c: no such host"):
        source.worker_addresses(hosts.union(spark.createDataFrame([("c",)], "host string")), dns, "1").collect()


def validated(spark, drains, text="", dns=()):
    bindings = spark.createDataFrame([(f"app-{i}", "h", d) for i, d in enumerate(drains)], BINDING)
    return validate_bindings(bindings, spark.createDataFrame(list(dns), DNS), ranges(spark, text))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_pages_and_urls_are_parsed_once(spark):
    fetched = source.fetch_bindings(pages(spark, (0, 200, PAGE)))
    assert fetched.count() == 2 and "from_json" not in plan_of(fetched)
    checked = validated(spark, ["syslog://10.10.10.10"])
    assert checked.count() == 1 and "regexp_extract" not in plan_of(checked)


def test_validation_order_and_logs(spark):
    drains = [
        "syslog://10.10.10.10", "syslog-tls://10.10.10.10", "https://10.10.10.10", "bad-scheme://10.10.10.10",
        "blah://nowhere", "SYSLOG://10.10.10.10", "127.0.0.1:300/new", "syslog://nowhere/x", "syslog://14.15.16.18/",
        "syslog://blocked.name:514", "syslog://[::1]:514", "syslog://:514", "https://v6.name", "//10.10.10.10",
    ]
    dns = [("blocked.name", "14.15.16.20"), ("v6.name", "2001:db8::5"), ("v6.name", "10.0.0.9")]
    result = validated(spark, drains, "14.15.16.17-14.15.16.20,2001:db8::1-2001:db8::ff", dns)
    reasons = {r["drain"]: r["reject_reason"] for r in result.collect()}
    assert [reasons[d] for d in drains] == [
        None, None, None, "scheme", "scheme", None, "parse", "unresolved", "blocked",
        "blocked", "unresolved", None, None, "scheme",
    ]
    assert removed_count(result).first()["removed"] == 8
    assert kept_bindings(result).count() == 6
    logs = sorted((r["source_id"], r["payload"]) for r in selflogs.reject_logs(result).collect())
    assert logs == [
        ("app-10", "Failed to resolve syslog drain host: ["),
        ("app-6", "Invalid syslog drain URL: parse failure"),
        ("app-7", "Failed to resolve syslog drain host: nowhere"),
        ("app-8", "Syslog drain blacklisted: 14.15.16.18 (14.15.16.18)"),
        ("app-9", "Syslog drain blacklisted: blocked.name (14.15.16.20)"),
    ]
    health = metrics.health_json(metrics.health_counters(metrics.drain_health(result))).first()["health"]
    assert json.loads(health) == {"drainCount": 6, "blacklistedOrInvalidUrlCount": 8}


def test_range_join_against_brute_force(spark):
    import ipaddress
    import random

    rng = random.Random(11)
    starts = [rng.getrandbits(32) for _ in range(40)]
    ends = [min(s + rng.choice([0, 3, 300, 70_000, 2**25]), 2**32 - 1) for s in starts]
    ips = [rng.getrandbits(32) for _ in range(500)] + starts + ends + [max(s - 1, 0) for s in starts]
    text = ",".join(f"{ipaddress.IPv4Address(s)}-{ipaddress.IPv4Address(e)}" for s, e in zip(starts, ends))
    drains = [f"syslog://{ipaddress.IPv4Address(i)}" for i in ips]
    blocked = validated(spark, drains, text).filter("reject_reason = 'blocked'")
    got = {r["drain"] for r in blocked.collect()}
    assert got == {d for d, i in zip(drains, ips) if any(s <= i <= e for s, e in zip(starts, ends))}


def test_set_operations(spark):
    a, b, c = ("a", "h", "d"), ("a", "h2", "d"), ("b", "h", "d")
    held = spark.createDataFrame([a, a, c], BINDING)
    assert distinct_bindings(held).count() == 2
    removed = remove_bindings(held, spark.createDataFrame([c, b], BINDING))
    assert sorted(map(tuple, removed.collect())) == [a]
    diff = snapshot_diff(held, spark.createDataFrame([b, c], BINDING))
    assert sorted(map(tuple, diff.collect())) == [(*a, "remove"), (*b, "add"), (*c, "kept")]
    empty = spark.createDataFrame([], BINDING)
    assert {r["action"] for r in snapshot_diff(held, empty).collect()} == {"remove"}


def test_selectors(spark):
    queries = ["?drain-type=metrics", "", "?drain-type=logs", "?drain-type=all", "?drain-type=false-drain"]
    bindings = spark.createDataFrame([("a", "h", f"syslog://h/{q}") for q in queries], BINDING)
    on = {r["drain"]: (r["kinds"], r["drain_type_ok"]) for r in with_kinds(bindings, True).collect()}
    assert [on[f"syslog://h/{q}"] for q in queries] == [
        (["gauge", "counter"], True), (["log"], True), (["log"], True), (["log", "gauge", "counter"], True), (["log"], False),
    ]
    off = with_kinds(bindings, False).collect()
    assert all(r["kinds"] == ["log"] and r["drain_type_ok"] for r in off)
    logs = selflogs.drain_type_logs(with_kinds(bindings, True), "3").collect()
    assert [tuple(r) for r in logs] == [("a", "SYS", "3", "Invalid drain-type")]
    labels = spark.createDataFrame([("a", "bc", "d"), ("ab", "c", "d")], BINDING).select(
        shard_id(F.col("app_id"), F.col("hostname"), F.col("drain")).alias("s")
    )
    assert {r["s"] for r in labels.collect()} == {"abcd"}


def test_blocked_address_bytes(column):
    assert column(["127.0.2.2"], "string", lambda c: F.hex(ip_bytes(c))) == ["00000000000000000000FFFF7F000202"]


@pytest.mark.parametrize("broadcast", [0, 10**9])
def test_wide_ranges_and_many_hosts(spark, broadcast, monkeypatch):
    """A /7, a range that begins inside another one, and single addresses, against a comparison with every range."""
    from outfall.operators import skew, validation

    monkeypatch.setattr(validation, "skew_join", lambda a, b, on, by, how: skew.skew_join(a, b, on, by, how, broadcast, task_rows=5000))
    text = "10.0.0.0-11.255.255.255,11.5.0.9-12.0.0.77,200.1.2.3-200.1.2.3,2001:db8::1-2001:db8::ff,0.0.0.0-0.0.0.6"
    found = ranges(spark, text)
    part = F.pmod(F.xxhash64("id"), F.lit(256))
    hosts = spark.range(60_000).select(
        F.concat_ws(".", (F.col("id") % 14).cast("string"), *[F.pmod(F.shiftright(F.xxhash64("id"), 8 * k), F.lit(256)).cast("string") for k in (1, 2)], part.cast("string")).alias("host")
    ).dropDuplicates().unionByName(spark.createDataFrame([("200.1.2.3",), ("200.1.2.4",), ("2001:db8::fe",), ("2001:db8::100",), ("0.0.0.6",), ("0.0.0.7",)], "host string"))
    resolved = hosts.select("host", F.col("host").alias("ip"), ip_bytes(F.col("host")).alias("ip16"))
    got = {r["host"] for r in validation.blocked_hosts(resolved, found).collect()}
    held = [(bytes(r["start16"]), bytes(r["end16"])) for r in found.collect()]
    expected = {r["host"] for r in resolved.collect() if any(a <= bytes(r["ip16"]) <= b for a, b in held)}
    assert got == expected and len(got) > 8000 and {"200.1.2.3", "2001:db8::fe", "0.0.0.6"} <= got
