"""JSON access with warehouse semantics: a scalar path yields text, never a subtree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scalar_text(value: Column) -> Column:
    """Text of a VARIANT scalar; NULL for objects and arrays."""
    # OBJECT<..> and ARRAY<..> are the only type names that start with these letters
    nested = F.substring(F.schema_of_variant(value), 1, 1).isin("O", "A")
    return F.when(~nested, F.try_variant_get(value, "$", "string"))


def json_scalar(raw: Column, name: str) -> Column:
    """Text of one top-level scalar of a JSON document.

    Reads a single field. To read several fields of the same document, parse it
    once with ``from_json`` instead (see ``operators.flatten``).
    """
    return scalar_text(F.try_variant_get(F.try_parse_json(raw), f"$['{name}']", "variant"))
