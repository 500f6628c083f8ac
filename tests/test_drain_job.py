import json

from outfall.plans import drain_job
from outfall.schema import BINDING_KEY, DNS, LANDED_PAGE, WORKER
from outfall.sources.drain_table import parse_ranges


def pages(spark, apps, status=200):
    body = json.dumps({"results": {a: {"drains": d, "hostname": h} for a, (h, d) in apps.items()}, "next_id": None})
    return spark.createDataFrame([(0, status, body)], LANDED_PAGE)


def term(spark, state, landed, count=2, failing=(), **options):
    dns = spark.createDataFrame([], DNS)
    ranges = parse_ranges(spark.createDataFrame([("14.15.16.17-14.15.16.20",)], "ranges string"))
    workers = spark.createDataFrame([(f"w{i}", i not in failing) for i in range(count)], WORKER)
    return drain_job.refresh(landed, dns, ranges, workers, state, **options)


def assigned(spark, state):
    rows = drain_job.read_state(spark, state, "assignment").collect()
    return sorted((r["worker"], *[r[c] for c in BINDING_KEY]) for r in rows)


def test_terms(spark, tmp_path):
    state = str(tmp_path)
    first = {"a": ("org.space.original", ["syslog://1.1.1.1/", "syslog://14.15.16.18/"])}
    assert drain_job.last_term(spark, state) == 0
    assert term(spark, state, pages(spark, first))
    before = [(w, "a", "org.space.original", "syslog://1.1.1.1/") for w in ("w0", "w1")]
    assert assigned(spark, state) == before
    health = json.loads(drain_job.read_state(spark, state, "health").first()["health"])
    assert health == {"drainCount": 1, "adapterCount": 2, "blacklistedOrInvalidUrlCount": 1}
    logs = drain_job.read_state(spark, state, "self_logs").collect()
    assert [r["payload"] for r in logs] == ["Syslog drain blacklisted: 14.15.16.18 (14.15.16.18)"]

    assert not term(spark, state, pages(spark, {}, status=500))  # a failed fetch changes nothing
    assert drain_job.last_term(spark, state) == 1 and assigned(spark, state) == before

    renamed = {"a": ("org.space.new", ["syslog://1.1.1.1/"])}
    assert term(spark, state, pages(spark, renamed))
    moves = drain_job.read_state(spark, state, "moves").collect()
    assert sorted((r["hostname"], r["action"]) for r in moves) == [
        ("org.space.new", "add"), ("org.space.new", "add"),
        ("org.space.original", "remove"), ("org.space.original", "remove"),
    ]
    assert term(spark, state, pages(spark, {}))  # a valid, empty one removes everything
    assert assigned(spark, state) == [] and drain_job.last_term(spark, state) == 3


def test_cap(spark, tmp_path):
    apps = {f"app-{i}": ("h", ["syslog://1.1.1.1/"]) for i in range(5)}
    assert term(spark, str(tmp_path), pages(spark, apps), count=1, max_bindings=3)
    assert len(assigned(spark, str(tmp_path))) == 3
    logs = drain_job.read_state(spark, str(tmp_path), "self_logs").collect()
    assert [r["payload"] for r in logs] == ["Syslog adapter has failed to schedule your drain stream"] * 2
    held = assigned(spark, str(tmp_path))
    assert term(spark, str(tmp_path), pages(spark, apps), count=1, max_bindings=3)
    assert assigned(spark, str(tmp_path)) == held


def test_worker_away_and_back(spark, tmp_path):
    state = str(tmp_path)
    apps = {f"app-{i}": ("h", ["syslog://1.1.1.1/"]) for i in range(6)}
    on_workers = set()
    for failing in ((), (1,), ()):
        assert term(spark, state, pages(spark, apps), count=3, failing=failing)
        for r in drain_job.read_state(spark, state, "moves").collect():
            copy = (r["worker"], r["app_id"])
            assert r["worker"] not in [f"w{i}" for i in failing]
            if r["action"] == "add":
                assert copy not in on_workers
                on_workers.add(copy)
            elif r["action"] == "remove":
                on_workers.remove(copy)
    held = sorted(app for _, app in on_workers)
    assert held == sorted(list(apps) * 2)
    assert sorted((w, a) for w, a, *_ in assigned(spark, state)) == sorted(on_workers)


def test_reason_of_a_refused_term_is_written(spark, tmp_path):
    assert not term(spark, str(tmp_path), pages(spark, {}, status=500))
    refused = spark.read.parquet(f"{tmp_path}/refused").collect()
    assert len(refused) == 1 and refused[0]["term"] == 1 and "500" in refused[0]["reason"]


def test_terms_feed_the_streams_and_the_pulse(spark, tmp_path):
    from outfall.operators import metrics

    state = str(tmp_path)
    read, share = drain_job.current_bindings(spark, state), drain_job.worker_shares(spark, state, "w1")
    assert read().count() == 0 and share().count() == 0
    apps = {f"app-{i}": ("h", ["syslog://1.1.1.1/"]) for i in range(4)}
    assert term(spark, state, pages(spark, apps), count=2)
    assert read().count() == 4
    assert {(r["replicas"], r["replica"]) for r in share().collect()} == {(2, 1)}
    assert term(spark, state, pages(spark, apps), count=2, failing=(0,))
    assert {(r["replicas"], r["replica"]) for r in share().collect()} == {(1, 0)}
    pulse = metrics.pulse_of(drain_job.read_state(spark, state, "metrics"), "1 hour").collect()
    values = {r["name"]: r["value"] for r in pulse}
    assert values == {"drains": 4, "adapters": 1, "bad_adapter_connections": 1, "rejected_bindings": 0, "drain_bindings.w1": 4}


def test_old_terms_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(drain_job, "KEEP_TERMS", 1)
    for _ in range(2):
        assert term(spark, str(tmp_path), pages(spark, {}))
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("term=")) == ["term=2"]
