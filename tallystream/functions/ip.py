"""IP addresses as numbers and as keys that sort and cut like them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"

_GROUP = "[0-9A-Fa-f]{1,4}"
_GROUPS = f"{_GROUP}(:{_GROUP})*"
_ALL_EIGHT = rf"\A{_GROUP}(:{_GROUP}){{7}}\z"
_SHORTENED = rf"\A({_GROUPS})?::({_GROUPS})?\z"
_MAPPED = "6" + "0" * 20 + "ffff"

# Bits of an address by the first character of its key.
FAMILIES = {"4": 32, "6": 128}


def ipv4_to_long(address: Column) -> Column:
    """The address as BIGINT; NULL for NULL, IPv6 and anything not dotted decimal."""
    parts = F.split(address, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return F.when(address.rlike(_DOTTED), number)


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without_dots(text: Column) -> Column:
    """Dotted decimal at the end as the two groups it stands for."""

    def two_groups(last: Column) -> Column:
        head = F.left(text, F.char_length(text) - F.char_length(last))
        groups = lambda n: F.concat(head, _hex(F.shiftright(n, 16), 4), F.lit(":"), _hex(n.bitwiseAND(F.lit(0xFFFF)), 4))
        return _bind(ipv4_to_long(last), groups)

    return F.when(text.contains("."), _bind(F.substring_index(text, ":", -1), two_groups)).otherwise(text)


def _digits(text: Column) -> Column:
    """All 32 digits of an address without dots."""
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    padded = lambda gs: F.array_join(F.transform(gs, lambda g: F.lpad(F.lower(g), 4, "0")), "")

    def filled(before: Column) -> Column:
        def around(after: Column) -> Column:
            left_out = F.lit(8) - F.size(before) - F.size(after)
            return F.when(left_out >= 1, F.concat(padded(before), F.repeat(F.lit("0000"), left_out), padded(after)))

        return _bind(groups(F.substring_index(text, "::", -1)), around)

    short = _bind(groups(F.substring_index(text, "::", 1)), filled)
    return F.when(text.rlike(_ALL_EIGHT), padded(groups(text))).when(text.rlike(_SHORTENED), short)


def _ipv6_key(address: Column) -> Column:
    text = F.regexp_replace(address, r"%[^%/]+\z", "")  # the zone is no part of the number
    key = _bind(_bind(text, _without_dots), lambda t: F.concat(F.lit("6"), _digits(t)))
    mapped = lambda k: F.when(k.startswith(_MAPPED), F.concat(F.lit("4"), F.right(k, F.lit(8)))).otherwise(k)
    return _bind(key, mapped)


def ip_key(address: Column) -> Column:
    """``4`` and eight or ``6`` and 32 hexadecimal digits; NULL for what is no address.

    IPv6 is read in all its forms: groups left out, dotted decimal at the end, a zone. An
    IPv4 address inside IPv6 (``::ffff:a.b.c.d``) is that IPv4 address.
    """
    four = F.concat(F.lit("4"), _hex(ipv4_to_long(address), 8))
    return F.when(address.contains(":"), _ipv6_key(address)).otherwise(four)


def key_prefix(key: Column, bits: Column) -> Column:
    """The first ``bits`` of an address key: whole digits, then the rest of a digit's bits."""
    whole, rest = F.floor(bits / 4).cast("int"), (bits % 4).cast("int")
    digit = F.conv(F.substring(key, whole + 2, F.lit(1)), 16, 10).cast("int")
    cut = F.lower(F.hex(F.floor(digit / F.pow(F.lit(2), 4 - rest)) * F.pow(F.lit(2), 4 - rest)))
    return F.concat(F.left(key, whole + 1), F.when(rest > 0, cut).otherwise(F.lit("")))
