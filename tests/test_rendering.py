import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from outfall.functions import rfc5424
from outfall.operators import routing
from outfall.operators.selectors import with_kinds
from outfall.schema import BINDING, ENVELOPE

P = "1970-01-01T00:00:00.012345+00:00 test-hostname test-app-id"


def envelope(kind="log", source_type="APP", instance="2", payload=b"just a test", log_type="OUT", **message):
    log = (bytearray(payload), log_type) if kind == "log" else None
    return (
        1,
        "test-app-id",
        instance,
        12345678,
        {"source_type": source_type} if source_type is not None else {},
        kind,
        log,
        message.get("gauge"),
        message.get("counter"),
    )


def frames(spark, envelopes, drain="syslog://1.1.1.1:514/?drain-type=all", app="test-app-id"):
    env = spark.createDataFrame(envelopes, ENVELOPE)
    bindings = with_kinds(spark.createDataFrame([(app, "test-hostname", drain)], BINDING), True)
    rendered = routing.render(routing.fan_out(routing.prerender(env), bindings))
    return sorted((r["frame"], r["is_valid"]) for r in rendered.collect())


@pytest.mark.parametrize(
    "args, expected",
    [
        (dict(), f"89 <14>1 {P} [APP/2] - - just a test\n"),
        (dict(log_type="ERR"), f"89 <11>1 {P} [APP/2] - - just a test\n"),
        (dict(log_type="-20"), f"89 <-1>1 {P} [APP/2] - - just a test\n"),
        (dict(source_type="app/foo/bar", instance="26"), f"98 <14>1 {P} [APP/FOO/BAR/26] - - just a test\n"),
        (dict(source_type="other", instance="1"), f"91 <14>1 {P} [OTHER/1] - - just a test\n"),
        (dict(source_type="MY TASK"), f"93 <14>1 {P} [MY-TASK/2] - - just a test\n"),
        (dict(source_type="CELL", instance="", log_type="ERR"), f"88 <11>1 {P} [CELL] - - just a test\n"),
        (dict(source_type=None, instance=None), f"84 <14>1 {P} [] - - just a test\n"),
        (
            dict(source_type="OTHER", instance="1", payload=b"no null `\x00` please"),
            f"97 <14>1 {P} [OTHER/1] - - no null `` please\n",
        ),
        (dict(payload=b"just a test\n"), f"89 <14>1 {P} [APP/2] - - just a test\n"),
        (dict(payload=b""), f"78 <14>1 {P} [APP/2] - - \n"),
    ],
)
def test_log_goldens(spark, args, expected):
    assert frames(spark, [envelope(**args)]) == [(expected, True)]


def test_space_without_instance_is_kept_and_invalid(spark):
    assert frames(spark, [envelope(source_type="MY TASK", instance="")]) == [
        (f"91 <14>1 {P} [MY TASK] - - just a test\n", False)
    ]


def test_gauge_goldens(spark):
    metrics = {
        "cpu": ("percentage", 0.23),
        "disk": ("bytes", 1234.0),
        "disk_quota": ("bytes", 1024.0),
        "memory": ("bytes", 5423.0),
        "memory_quota": ("bytes", 8000.0),
    }
    got = frames(spark, [envelope("gauge", instance="1", gauge=(metrics,))])
    sd = '[gauge@47450 name="{}" value="{}" unit="{}"]'
    expected = [
        (128, sd.format("cpu", "0.23", "percentage")),
        (124, sd.format("disk", "1234", "bytes")),
        (130, sd.format("disk_quota", "1024", "bytes")),
        (126, sd.format("memory", "5423", "bytes")),
        (132, sd.format("memory_quota", "8000", "bytes")),
    ]
    assert got == sorted((f"{n} <14>1 {P} [1] - {text} \n", True) for n, text in expected)


def test_counter_golden(spark):
    got = frames(spark, [envelope("counter", instance="1", counter=("some-counter", Decimal(99), Decimal(1)))])
    sd = '[counter@47450 name="some-counter" total="99" delta="1"]'
    assert got == [(f"129 <14>1 {P} [1] - {sd} \n", True)]


def test_large_counter_is_unsigned(spark):
    got = frames(spark, [envelope("counter", counter=("c", Decimal(2**64 - 1), Decimal(0)))])
    assert 'total="18446744073709551615"' in got[0][0]


def test_timer_and_empty_gauge_give_nothing(spark):
    assert frames(spark, [envelope("timer"), envelope("gauge", gauge=({},))]) == []


def test_https_is_not_framed(spark):
    got = frames(spark, [envelope()], drain="https://1.1.1.1/?drain-type=all")
    assert got == [(f"<14>1 {P} [APP/2] - - just a test\n", True)]


def test_long_app_name_is_invalid(column):
    names = ["test-app-id-" + "0123456789" * 3 + "012345678901", "a" * 48, "a" * 49, "a b", "a\n", "é", ""]
    assert column(names, "string", lambda c: rfc5424.is_valid_part(c, 48)) == [
        False, True, False, False, False, False, True,
    ]


def test_payload_that_is_not_utf8_passes_unchanged(column):
    raw = b"\xff\xfe\x00bad \xc3\x28"
    got = column([bytearray(raw)], "binary", lambda c: rfc5424.log_text(c).cast("binary"))
    assert bytes(got[0]) == raw.replace(b"\x00", b"") + b"\n"


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_timestamp(spark, column, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [12345678, 0, -1, 1704067207179575999, 1704067207000000000, 951782399999999999]
        assert column(values, "long", rfc5424.timestamp_text) == [
            "1970-01-01T00:00:00.012345+00:00",
            "1970-01-01T00:00:00.000000+00:00",
            "1969-12-31T23:59:59.999999+00:00",
            "2024-01-01T00:00:07.179575+00:00",
            "2024-01-01T00:00:07.000000+00:00",
            "2000-02-28T23:59:59.999999+00:00",
        ]
        trimmed = column(values[:2] + [1704067207100000000], "long", lambda c: rfc5424.timestamp_text(c, True))
        assert trimmed == [
            "1970-01-01T00:00:00.012345+00:00",
            "1970-01-01T00:00:00+00:00",
            "2024-01-01T00:00:07.1+00:00",
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def go_g(x: float) -> str:
    """Shortest text with an exponent below 1e-4 and from 1e6 on."""
    if x != x:
        return "NaN"
    if x in (float("inf"), float("-inf")):
        return "+Inf" if x > 0 else "-Inf"
    sign = "-" if struct.pack(">d", x)[0] & 0x80 else ""
    if x == 0:
        return sign + "0"
    digits, exponent = f"{float(repr(abs(x))):.17e}".split("e")
    for n in range(17):
        text = f"{abs(x):.{n}e}"
        if float(text) == abs(x):
            digits, exponent = text.split("e")
            break
    raw, e = digits.replace(".", ""), int(exponent)
    if e < -4 or e >= 6:
        return f"{sign}{raw[0]}{'.' + raw[1:] if len(raw) > 1 else ''}e{'-' if e < 0 else '+'}{abs(e):02d}"
    if e < 0:
        return f"{sign}0.{'0' * (-e - 1)}{raw}"
    whole = raw[: e + 1].ljust(e + 1, "0")
    return f"{sign}{whole}{'.' + raw[e + 1:] if len(raw) > e + 1 else ''}"


def test_float_text_follows_the_rule(column):
    rng = random.Random(7)
    values = [0.23, 1e6, 999999.5, 5.423e7, 1e-4, 1e-5, 2e23, 5e-324, 0.0, -0.0, 1e21, 1.5e300, 0.1 + 0.2]
    values += [float("inf"), float("-inf"), float("nan"), 2.2250738585072014e-308, 1.7976931348623157e308]
    values += [round(rng.uniform(-1e7, 1e7), rng.randrange(6)) for _ in range(500)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 12) for _ in range(500)]
    values += [float(rng.randrange(1, 10)) * 10.0 ** rng.randrange(-300, 300) for _ in range(300)]
    got = column(values, "double", rfc5424.float_text)
    # The JVM's 17-digit texts are not always the closest ones, so those are compared as numbers.
    for value, text in zip(values, got):
        expected = go_g(value)
        if len(expected.lstrip("-").split("e")[0].replace(".", "").strip("0")) == 17:
            assert float(text) == value
        else:
            assert text == expected, value


def test_escaping(column):
    got = column(['a"b', "a]b", "a\\b", '[x]"\\', "plain", None], "string", rfc5424.escape_sd)
    assert got == ['a\\"b', "a\\]b", "a\\\\b", '[x\\]\\"\\\\', "plain", ""]


def test_parse_reads_back_what_was_rendered(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice('ab "]\\[\n é=<>- ') for _ in range(rng.randrange(30))) for _ in range(100)]
    rows = [envelope(payload=t.encode()) for t in texts]
    rows += [envelope("gauge", gauge=({t or "x": (t, rng.random())},)) for t in texts]
    got = [f for f, _ in frames(spark, rows)]
    df = spark.createDataFrame([(g,) for g in got], "frame string")
    parsed = df.select("frame", rfc5424.parse(rfc5424.unframe(F.col("frame"))).alias("m")).select("frame", "m.*")
    parsed = parsed.withColumn("unit", rfc5424.sd_param(F.col("sd"), "unit")).collect()
    for r in parsed:
        assert (r["priority"], r["hostname"], r["app"], r["msgid"]) == (14, "test-hostname", "test-app-id", "-")
        body = f"<14>1 {r['ts']} {r['hostname']} {r['app']} {r['procid']} - {r['sd']} {r['msg']}"
        assert r["frame"] == f"{len(body.encode())} {body}"
    assert sorted(r["unit"] for r in parsed if r["sd"] != "-") == sorted(texts)


def test_parse_refuses_other_text(column):
    assert column(["", "no message", "<14>1 a b c", "<x>1 a b c d - - m"], "string", rfc5424.parse) == [None] * 4
