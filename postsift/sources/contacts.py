"""From any table of contacts to one raw address per row.

`select_addresses` adds working columns (all prefixed `ps_`):

* `ps_email`   the value as text, null when the field is missing
* `ps_is_text` whether the value was text to begin with
* `ps_pos`     position inside a fanned-out array (0 otherwise)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Selected:
    """Addressed contacts, the field name looked for (if any), and whether rows were fanned out."""

    frame: DataFrame
    field_searched: str | None
    fanned: bool


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def select_addresses(contacts: DataFrame, email: str | Column = "email", fan_out: bool = True) -> Selected:
    """Pick the address of each row; arrays become one row per address.

    `email` is a field name, an address (text with `@`), or a column expression. A
    missing field gives null. A fanned-out column is removed from the output, also where a
    JSON column holds arrays in some rows only; an empty or null array keeps its row, without an address.
    """
    field = email if isinstance(email, str) and "@" not in email else None
    if field is not None:
        present = field in contacts.columns
        value = quoted(field) if present else F.lit(None).cast("string")
    else:
        present = False
        value = F.lit(email) if isinstance(email, str) else email

    staged = contacts.withColumn("ps_value", value)
    kind = staged.schema["ps_value"].dataType
    fanned = fan_out and isinstance(kind, (T.ArrayType, T.VariantType))
    if fanned:
        items = F.col("ps_value")
        if isinstance(kind, T.VariantType):
            items = _variant_items(items)
        if present:
            staged = staged.drop(field)
        staged = staged.select(
            *[quoted(c) for c in staged.columns if c != "ps_value"],
            F.posexplode_outer(items).alias("ps_pos", "ps_value"),
        ).withColumn("ps_pos", F.coalesce("ps_pos", F.lit(0)))
        kind = staged.schema["ps_value"].dataType
    else:
        staged = staged.withColumn("ps_pos", F.lit(0))

    text, is_text = _as_text(F.col("ps_value"), kind)
    frame = staged.withColumns({"ps_email": text, "ps_is_text": is_text}).drop("ps_value")
    return Selected(frame, field, fanned)


def _variant_items(value: Column) -> Column:
    """The elements of a JSON array, or the value alone as a one-element array."""
    is_list = F.schema_of_variant(value).startswith("ARRAY")
    return F.when(is_list, F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array(value))


def _as_text(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """(text of the value, whether it was text). Null stays null: the field is missing."""
    if isinstance(kind, (T.StringType, T.NullType)):
        return value.cast("string"), F.lit(True)
    if isinstance(kind, T.VariantType):
        schema = F.schema_of_variant(value)
        absent = value.isNull() | F.is_variant_null(value)
        text = (
            F.when(absent, F.lit(None))
            .when(schema.startswith("ARRAY"), _joined(F.try_variant_get(value, "$", "array<variant>")))
            .otherwise(_variant_scalar(value))
        )
        return text, schema == "STRING"
    if isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda v: F.coalesce(_as_text(v, kind.elementType)[0], F.lit("")))
        return F.array_join(parts, ","), F.lit(False)
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.when(value.isNotNull(), F.lit("[object Object]")), F.lit(False)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _number_text(value), F.lit(False)
    return value.cast("string"), F.lit(False)


def _joined(items: Column) -> Column:
    parts = F.transform(items, lambda v: F.coalesce(_variant_scalar(v), F.lit("")))
    return F.array_join(parts, ",")


def _variant_scalar(value: Column) -> Column:
    schema = F.schema_of_variant(value)
    return F.when(schema.startswith("OBJECT"), F.lit("[object Object]")).otherwise(
        F.try_variant_get(value, "$", "string")
    )


def _number_text(value: Column) -> Column:
    """12345.0 reads "12345", as a JSON number does."""
    whole = (F.abs(value) < 1e15) & (value == F.floor(value))
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
