"""IP addresses as 16-byte values, so that IPv4 and IPv6 compare in one order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_V4_PART = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_V4 = rf"{_V4_PART}(?:\.{_V4_PART}){{3}}"
_V4_ONLY = rf"^{_V4}\z"
_V4_TAIL = rf"^(.*:)({_V4})\z"
_V6_GROUP = r"^[0-9a-fA-F]{1,4}\z"


def _v4_hex(text: Column) -> Column:
    """Eight hex digits of a valid dotted address."""
    parts = F.split(text, r"\.")
    return F.array_join(F.transform(parts, lambda x: F.lpad(F.hex(x.try_cast("long")), 2, F.lit("0"))), "")


def _split_hex(text: Column) -> Column:
    """Eight hex digits as two IPv6 groups."""
    return F.regexp_replace(text, "^(....)", "$1:")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":", -1))


def _v6_bytes(text: Column) -> Column:
    tail = F.regexp_extract(text, _V4_TAIL, 2)
    plain = F.when(
        tail != "", F.concat(F.regexp_extract(text, _V4_TAIL, 1), _split_hex(_v4_hex(tail)))
    ).otherwise(text)
    halves = F.transform(F.split(plain, "::", -1), _groups)
    return _with(halves, _v6_from_halves)


def _v6_from_halves(halves: Column) -> Column:
    """Bytes from the groups before and after ``::``, or from all groups if there is none."""
    count = F.size(F.flatten(halves))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - count, F.lit(0)))
    groups = F.when(
        F.size(halves) == 2, F.flatten(F.array(F.get(halves, F.lit(0)), zeros, F.get(halves, F.lit(1))))
    ).otherwise(F.get(halves, F.lit(0)))
    fits = F.when(F.size(halves) == 2, count <= 7).otherwise((F.size(halves) == 1) & (count == 8))
    return F.when(
        fits,
        _with(
            groups,
            lambda g: F.when(
                F.forall(g, lambda x: x.rlike(_V6_GROUP)),
                F.unhex(F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), "")),
            ),
        ),
    )


def ip_bytes(text: Column) -> Column:
    """The 16 bytes of an IP literal, or null if it is none. IPv4 is mapped into IPv6."""
    return F.when(
        text.rlike(_V4_ONLY), F.unhex(F.concat(F.lit("0" * 20 + "FFFF"), _v4_hex(text)))
    ).otherwise(F.when(text.contains(":"), _v6_bytes(text)))


def ip_bits(value: Column) -> Column:
    """The 128 bits of a 16-byte value, as text."""
    digits = F.hex(value)
    return F.concat(*[F.lpad(F.conv(F.substring(digits, at, 16), 16, 2), 64, "0") for at in (1, 17)])


def prefix_blocks(start: Column, end: Column) -> Column:
    """The fewest prefixes that have all values from ``start`` to ``end``, both 128 bits as text, and no others.

    Behind the bits that the two ends share, every 0 of the start and every 1 of the end leaves a block beside it
    that lies inside, and each end is the corner of a last one.
    """
    shared = F.size(
        F.filter(F.sequence(F.lit(1), F.lit(128)), lambda n: F.substring(start, F.lit(1), n) == F.substring(end, F.lit(1), n))
    )
    return F.get(
        F.transform(F.array(shared), lambda p: F.when(_is_block(start, end, p), F.array(F.substring(start, F.lit(1), p))).otherwise(
            F.concat(_side(start, p, "0"), _side(end, p, "1"))
        )),
        F.lit(0),
    )


def _corner(bits: Column, last: str) -> Column:
    """How many bits are left without the ``last`` ones at the end."""
    return F.length(F.regexp_replace(bits, f"{last}+$", ""))


def _is_block(start: Column, end: Column, shared: Column) -> Column:
    return (_corner(start, "0") <= shared) & (_corner(end, "1") <= shared)


def _side(bits: Column, shared: Column, own: str) -> Column:
    corner = F.greatest(_corner(bits, own), shared + 1)
    beside = F.when(corner >= shared + 2, F.sequence(shared + 2, corner)).otherwise(F.array().cast("array<int>"))
    other = "1" if own == "0" else "0"
    blocks = F.transform(
        F.filter(beside, lambda i: F.substring(bits, i, F.lit(1)) == own),
        lambda i: F.concat(F.substring(bits, F.lit(1), i - 1), F.lit(other)),
    )
    return F.concat(F.array(F.substring(bits, F.lit(1), corner)), blocks)
