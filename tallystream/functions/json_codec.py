"""JSON text <-> columns, with the accept and reject rules of a strict decoder."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark accepts single quotes by default, strict JSON does not.
_STRICT = {"allowSingleQuotes": "false"}

_MARK = "_mark"


def encode(*fields: str) -> Column:
    """One JSON object per row. NULL is written out: leaving it away would turn
    a field that is null into a field that is absent."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _mark(value: Column) -> Column:
    return F.xxhash64(value).cast("string")


def parse(value: Column, fields: Iterable[str]) -> Column:
    """The named fields as variants, from the one parse that all rules rest on.

    ``from_json`` stops after one value, so text after it would pass. The value is
    therefore read as the first of two elements of an array, the second being a mark
    that no text carries but by its own hash: whatever follows the value takes the
    mark's place, adds an element or breaks the array.
    """
    schema = ", ".join(f"`{f}` variant" for f in fields)
    marked = F.concat(F.lit("["), value, F.lit(f',{{"{_MARK}":"'), _mark(value), F.lit('"}]'))
    return F.from_json(marked, f"array<struct<{schema}, `{_MARK}` string>>", _STRICT)


def _record(parsed: Column) -> Column:
    return F.get(parsed, F.lit(0))


def text(parsed: Column, field: str) -> Column:
    """A field as text; NULL where it is null or absent."""
    return F.try_variant_get(_record(parsed)[field], "$", "string")


# The kinds of JSON values, by the types a variant names them with.
_KINDS = {"VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}


def kind(parsed: Column, field: str) -> Column:
    """``string``, ``number``, ``boolean``, ``array``, ``object`` or ``null``; NULL where it is absent."""
    name = F.regexp_extract(F.schema_of_variant(_record(parsed)[field]), "^[A-Z]+", 0)
    out = F.when(name.isNull(), None)
    for variant_type, json_kind in _KINDS.items():
        out = out.when(name == variant_type, json_kind)
    return out.otherwise("number")


def reject_reason(value: Column, parsed: Column, required: Iterable[str], texts: Iterable[str] = ()) -> Column:
    """NULL for a good message, else ``malformed``, ``missing:<field>`` or, for a field of ``texts``
    that is neither a string nor null, ``type:<field>``.

    A JSON null is a variant of its own, an absent field is none.
    """
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1))[_MARK] == _mark(value)) & _record(parsed).isNotNull()
    good = F.coalesce(whole, F.lit(False)) & F.is_valid_utf8(value)
    reason = F.when(~good, F.lit("malformed"))
    for field in required:
        reason = reason.when(_record(parsed)[field].isNull(), F.lit(f"missing:{field}"))
    for field in texts:
        reason = reason.when(~kind(parsed, field).isin("string", "null"), F.lit(f"type:{field}"))
    return reason
