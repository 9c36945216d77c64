"""Type tests and access for VARIANT values, as Column expressions.

A missing key is SQL NULL, a JSON null is a variant that holds null; the two are told apart where it
matters. Booleans count as numbers, as in JSON readers that know no separate kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_TEXTS = "array<string>"


def parse(text: Column) -> Column:
    """VARIANT of a JSON text, NULL where it is broken."""
    return F.try_parse_json(text)


def kind(v: Column) -> Column:
    """Schema of a variant: STRING, BIGINT, DECIMAL(…), DOUBLE, BOOLEAN, VOID, ARRAY<…>, OBJECT<…>."""
    return F.schema_of_variant(v)


def fields(v: Column) -> Column:
    """MAP<STRING, VARIANT> of an object, else NULL."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def elements(v: Column) -> Column:
    """ARRAY<VARIANT> of an array, else NULL."""
    return F.try_variant_get(v, "$", "array<variant>")


def key(v: Column, name: str) -> Column:
    """The value at a key of an object: NULL if it is missing or ``v`` is none, a null variant if it is null."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def is_object(v: Column) -> Column:
    """Asked by a field that need not exist, so no map of all fields is built."""
    return F.try_variant_get(v, "$", "struct<_:variant>").isNotNull()


def is_null(v: Column) -> Column:
    """Missing or JSON null."""
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(True))


def is_string(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def string(v: Column) -> Column:
    """The value of a string, NULL for anything else."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def is_number(v: Column) -> Column:
    return F.coalesce(kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN|INT|SMALLINT|TINYINT)"), F.lit(False))


def number(v: Column) -> Column:
    """DOUBLE of a number or boolean, NULL for anything else."""
    flag = F.try_variant_get(v, "$", "boolean")
    return F.when(is_number(v), F.when(kind(v) == "BOOLEAN", flag.cast("double")).otherwise(F.try_variant_get(v, "$", "double")))


def is_true(v: Column) -> Column:
    """True for JSON true alone."""
    return F.coalesce((kind(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), F.lit(False))


def text(v: Column) -> Column:
    """Any value as text: strings as they are, the rest as JSON; NULL where missing or null."""
    return F.when(~is_null(v), F.when(is_string(v), F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v)))


def list_of(v: Column) -> Column:
    """Elements of an array; an empty array for anything else."""
    return F.coalesce(elements(v), F.array().cast("array<variant>"))


def texts() -> Column:
    return F.array().cast(NO_TEXTS)
