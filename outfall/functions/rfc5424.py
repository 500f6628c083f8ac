"""RFC 5424 messages and RFC 6587 octet-count frames as column expressions.

Text is carried as Spark strings, which hold raw bytes and are never re-encoded, so payloads
that are not valid UTF-8 pass through byte for byte. Lengths are counted in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the message format.
GAUGE_SD_ID = "gauge@47450"
COUNTER_SD_ID = "counter@47450"
PRIORITY_OUT = 14
PRIORITY_ERR = 11
PRIORITY_UNKNOWN = -1
MAX_HOSTNAME = 255
MAX_APP_NAME = 48
MAX_PROCESS_ID = 128

_NS_PER_DAY = 86_400_000_000_000
_NS_PER_SECOND = 1_000_000_000


def priority(log_type: Column) -> Column:
    """Log type to syslog priority; an unknown type is written as -1."""
    return (
        F.when(log_type == "OUT", PRIORITY_OUT)
        .when(log_type == "ERR", PRIORITY_ERR)
        .otherwise(PRIORITY_UNKNOWN)
    )


def log_process_id(source_type: Column, instance_id: Column) -> Column:
    """``[TYPE/instance]``; spaces become dashes only when there is an instance."""
    kind = F.upper(F.coalesce(source_type, F.lit("")))
    instance = F.coalesce(instance_id, F.lit(""))
    inner = F.when(
        instance != "", F.concat(F.replace(kind, F.lit(" "), F.lit("-")), F.lit("/"), instance)
    ).otherwise(kind)
    return F.concat(F.lit("["), inner, F.lit("]"))


def metric_process_id(instance_id: Column) -> Column:
    return F.concat(F.lit("["), F.coalesce(instance_id, F.lit("")), F.lit("]"))


def strip_nulls(payload: Column) -> Column:
    """Payload bytes as text without NUL bytes."""
    return F.replace(payload.cast("string"), F.char(F.lit(0)), F.lit(""))


def with_newline(text: Column) -> Column:
    return F.when(text.endswith("\n"), text).otherwise(F.concat(text, F.lit("\n")))


def log_text(payload: Column) -> Column:
    """The message part of a log envelope."""
    return with_newline(strip_nulls(F.coalesce(payload, F.lit(b""))))


def timestamp_text(timestamp_ns: Column, trim_fraction: bool = False) -> Column:
    """Nanoseconds since the epoch as UTC text, cut (not rounded) to microseconds.

    Integer arithmetic only, so the session time zone has no say. With ``trim_fraction`` the
    trailing zeros of the fraction are left out, and the point with them if none remains.
    """
    ns = F.coalesce(timestamp_ns, F.lit(0).cast("long"))
    in_day = F.pmod(ns, F.lit(_NS_PER_DAY))
    day = _whole(ns - in_day, _NS_PER_DAY).cast("int")
    micros = _whole(in_day % _NS_PER_SECOND, 1000)
    second = _whole(in_day - in_day % _NS_PER_SECOND, _NS_PER_SECOND)
    hms = (
        F.lit(1_000_000)
        + _whole(second - second % 3600, 3600) * 10_000
        + _whole(second % 3600 - second % 60, 60) * 100
        + second % 60
    ).cast("string")
    fraction = F.concat(
        F.lit("."), F.substring((F.lit(1_000_000) + micros).cast("string"), 2, 6)
    )
    if trim_fraction:
        fraction = F.regexp_replace(fraction, r"\.?0*$", "")
    return F.concat(
        F.date_from_unix_date(day).cast("string"),
        F.lit("T"),
        F.substring(hms, 2, 2),
        F.lit(":"),
        F.substring(hms, 4, 2),
        F.lit(":"),
        F.substring(hms, 6, 2),
        fraction,
        F.lit("+00:00"),
    )


def _whole(value: Column, divisor: int) -> Column:
    """Whole-number division; ``/`` would go through doubles and round."""
    return F.call_function("div", value, F.lit(divisor).cast("long"))


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double, with an exponent below 1e-4 and from 1e6 on.

    The JVM's own text supplies the digits. It may carry one or two more than needed to read
    the same double back, which only numbers of 16 or 17 digits and the very smallest ones can
    show, so the shorter candidates are tried first.
    """
    size = F.abs(value)
    plain = size.cast("string")
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("")
    candidates = F.array(
        F.when(size < 2.3e-308, F.format_string("%.0e", size)),
        *[F.format_string(f"%.{digits - 1}e", size) for digits in (15, 16, 17)],
    )
    scientific = F.get(F.filter(candidates, lambda text: text.try_cast("double") == size), F.lit(0))

    # From 1e-3 to 1e6 the JVM writes no exponent either; most metric values are short.
    short = F.when(plain.endswith(".0"), F.substr(plain, F.lit(1), F.length(plain) - 2)).otherwise(plain)
    long = F.regexp_replace(scientific.try_cast("decimal(38,20)").cast("string"), r"\.?0+$", "")
    small = F.concat(
        F.lit("0.000"), F.regexp_replace(F.replace(scientific, F.lit("."), F.lit("")), "0*e.*$", "")
    )
    return (
        F.when(F.isnan(value), "NaN")
        .when(size == float("inf"), F.when(value > 0, "+Inf").otherwise("-Inf"))
        .when(
            (size == 0) | ((size >= 1e-3) & (size < 1e6)),
            F.concat(sign, F.when(F.length(plain) <= 16, short).otherwise(long)),
        )
        .when((size >= 1e-4) & (size < 1e-3), F.concat(sign, small))
        .otherwise(F.concat(sign, F.regexp_replace(scientific, r"\.?0*e", "e")))
    )


def escape_sd(value: Column) -> Column:
    r"""Backslash before ``"``, ``\`` and ``]`` in a structured-data value."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r'(["\\\]])', r"\\$1")


def gauge_sd(name: Column, value: Column, unit: Column) -> Column:
    return _element(GAUGE_SD_ID, [("name", name), ("value", float_text(value)), ("unit", unit)])


def counter_sd(name: Column, total: Column, delta: Column) -> Column:
    zero = F.lit(0).cast("decimal(20,0)")
    return _element(
        COUNTER_SD_ID,
        [
            ("name", name),
            ("total", F.coalesce(total, zero).cast("string")),
            ("delta", F.coalesce(delta, zero).cast("string")),
        ],
    )


def _element(element_id: str, params: list[tuple[str, Column]]) -> Column:
    pieces = [F.lit(f"[{element_id}")]
    for key, value in params:
        pieces += [F.lit(f' {key}="'), escape_sd(value), F.lit('"')]
    return F.concat(*pieces, F.lit("]"))


def _or_dash(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", "-").otherwise(text)


def head(priority_number: Column, timestamp: Column) -> Column:
    """The part of a message before the hostname."""
    return F.concat(F.lit("<"), priority_number.cast("string"), F.lit(">1 "), timestamp, F.lit(" "))


def tail(app_name: Column, process_id: Column, structured_data: Column, text: Column) -> Column:
    """The part of a message after the hostname."""
    return F.concat(
        F.lit(" "),
        _or_dash(app_name),
        F.lit(" "),
        process_id,
        F.lit(" - "),
        _or_dash(structured_data),
        F.lit(" "),
        text,
    )


def message(head_text: Column, hostname: Column, tail_text: Column) -> Column:
    return F.concat(head_text, _or_dash(hostname), tail_text)


def frame(message_text: Column) -> Column:
    """Octet-count prefix for stream transports."""
    return F.concat(F.octet_length(message_text).cast("string"), F.lit(" "), message_text)


def is_valid_part(text: Column, limit: int) -> Column:
    """Printable ASCII without spaces and not too long; an empty part is written as a dash."""
    return F.coalesce(text, F.lit("")).rlike(r"^[!-~]{0,%d}\z" % limit)


def is_valid(hostname: Column, app_name: Column, process_id: Column) -> Column:
    """Whether the header can be written at all. The priority is not checked."""
    return (
        is_valid_part(hostname, MAX_HOSTNAME)
        & is_valid_part(app_name, MAX_APP_NAME)
        & is_valid_part(process_id, MAX_PROCESS_ID)
    )


_PRIORITY = r"^<(-?\d+)>1\z"
_SD = r'(?s)^(-|(?:\[[^ \]]+(?: [^ =]+="(?:[^"\\\]]|\\.)*")*\])+)(?: (.*))?\z'


def parse(message_text: Column) -> Column:
    """Fields of an unframed message; a null struct if the text is not one.

    Regular expressions see the header and the structured data only. What follows is cut off by
    its place, so bytes that are not UTF-8 come back as they are.
    """
    header = F.substring_index(message_text, " ", 6)
    fields = F.split(header, " ", -1)
    rest = _bytes_from(message_text, F.octet_length(header) + 2)
    sd = F.regexp_extract(rest, _SD, 1)
    names = ("ts", "hostname", "app", "procid", "msgid")
    header_ok = F.get(fields, F.lit(0)).rlike(_PRIORITY)
    for place in range(1, 6):
        header_ok = header_ok & (F.get(fields, F.lit(place)) != "")
    return F.when(
        header_ok & rest.rlike(_SD),
        F.struct(
            F.regexp_extract(F.get(fields, F.lit(0)), _PRIORITY, 1).cast("int").alias("priority"),
            *[F.get(fields, F.lit(place)).alias(name) for place, name in enumerate(names, 1)],
            sd.alias("sd"),
            _bytes_from(rest, F.octet_length(sd) + 2).alias("msg"),
        ),
    )


def unframe(frame_text: Column) -> Column:
    """The message of one framed text, or null when the count does not match its bytes."""
    declared = F.regexp_extract(_bytes_from(frame_text, F.lit(1), 12), r"^(\d+) ", 1)
    body = _bytes_from(frame_text, F.octet_length(declared) + 2)
    return F.when((declared != "") & (declared == F.octet_length(body).cast("string")), body)


def _bytes_from(text: Column, start: Column, length: int = 2**31 - 1) -> Column:
    """Bytes of a text from a place on, counted from 1, as text and without decoding them."""
    return F.substr(text.cast("binary"), start, F.lit(length)).cast("string")


def sd_param(structured_data: Column, name: str) -> Column:
    """One unescaped parameter of a structured-data element."""
    value = F.regexp_extract(structured_data, r' %s="((?:[^"\\]|\\.)*)"' % name, 1)
    return F.regexp_replace(value, r'\\(["\\\]])', "$1")
