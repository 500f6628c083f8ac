"""Drain URLs as column expressions.

``parse_url`` does not fit: it has no host for names with an underscore, keeps upper-case
schemes and leaves query values encoded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme (may be missing), authority, path, query
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
# A colon first, or one in the first path segment of a text without a scheme.
_STRAY_COLON = r"(?s)^(?::|(?![A-Za-z][A-Za-z0-9+.\-]*:)[^/?#]*:)"
# Bytes a host may hold; anything beyond ASCII is let through.
_HOST_TEXT = r"""^[A-Za-z0-9\-_.~!$&'()*+,;=:\[\]<>"%\x{80}-\x{10FFFF}]+\z"""
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"

ALLOWED_SCHEMES = ("syslog", "syslog-tls", "https")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host_port(url: Column) -> Column:
    """The authority without user and password."""
    return F.regexp_replace(_part(url, 2), r"(?s)^.*@", "")


def host(url: Column) -> Column:
    """What stands before the first colon, so an address in brackets gives ``[``."""
    return F.split(host_port(url), ":")[0]


def is_readable(url: Column) -> Column:
    """Whether the text is a URL at all, with or without a host."""
    no_authority = ~url.rlike(_URL)
    return F.coalesce(
        ~url.rlike(_STRAY_COLON) & (no_authority | (host_port(url) == "") | is_parsable(url)),
        F.lit(False),
    )


def is_parsable(url: Column) -> Column:
    """Whether the URL can be read and names a host or port."""
    return F.coalesce(
        host_port(url).rlike(_HOST_TEXT) & ~_part(url, 3).rlike(_BAD_ESCAPE), F.lit(False)
    )


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def _user_info(url: Column) -> Column:
    return F.regexp_extract(_part(url, 2), r"(?s)^(.*)@", 1)


def _decode(text: Column) -> Column:
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def username(url: Column) -> Column:
    return _decode(F.regexp_extract(_user_info(url), r"^([^:]*)", 1))


def password(url: Column) -> Column:
    return _decode(F.regexp_extract(_user_info(url), r"(?s)^[^:]*:(.*)\z", 1))


def drain_type(url: Column) -> Column:
    """First ``drain-type`` of the query, decoded; empty if missing or not decodable."""
    value = F.regexp_extract(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), r"(?:^|&)drain-type=([^&]*)", 1)
    return F.coalesce(F.try_url_decode(value), F.lit(""))


def anonymous(url: Column) -> Column:
    """The URL without user and password."""
    return F.regexp_replace(url, r"://[^/?#]*@", "://")


def redact(text: Column, url: Column) -> Column:
    """``text`` with every occurrence of the URL's user and password hidden."""
    without_user = _hide(text, username(url))
    return _hide(without_user, password(url))


def _hide(text: Column, secret: Column) -> Column:
    return F.when(
        F.coalesce(secret, F.lit("")) != "", F.replace(text, secret, F.lit("<REDACTED>"))
    ).otherwise(text)
