"""Typed JSON records, and a reject channel: a record that does not fit is kept with its reason, never lost or altered.

Every record ends in exactly one place. ``checked`` adds to each row the typed fields and, where they do not all fit,
why; ``accepted`` and ``rejected`` part the two. It works on batches and streams alike, as it only adds columns.

Rejected are, the first that holds counting:

* ``no document``: NULL or blank;
* ``malformed``: cut off, not JSON, a field named twice, or anything but white space after the document;
* ``not an object``: other JSON, several documents in one included;
* ``bad value``: a field whose value cannot be its declared type without loss (``"12,5"`` as an amount);
* ``missing``: a required field that is absent or null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON, FIELDS, TYPED = "reject_reason", "reject_fields", "typed_record"
NO_DOCUMENT, MALFORMED, NOT_AN_OBJECT, BAD_VALUE, MISSING = "no document", "malformed", "not an object", "bad value", "missing"

# How dates and times are written in documents. A moment has no zone, an instant may have one.
DATE = r"^\d{4}-\d{2}-\d{2}$"
MOMENT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"
_SHAPES = {T.DateType: DATE, T.TimestampNTZType: MOMENT, T.TimestampType: INSTANT, T.BooleanType: "^(true|false)$"}

_SPACE = " \t\r\n"


def checked(rows: DataFrame, column: str, schema: T.StructType, required: Sequence[str] = (), into: str = TYPED) -> DataFrame:
    """``rows`` with ``into`` (a struct of ``schema``), ``reject_reason`` (NULL where it fits) and ``reject_fields``.

    Fields that are absent or null are NULL; fields that ``schema`` does not name are ignored. A column that may hold
    any text (string fields) takes numbers and nested values as their JSON text. Input columns of the added names raise.
    """
    taken = {into, REASON, FIELDS} & set(rows.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    parsed, one = f"_{into}_parsed", f"_{into}_one"
    text = F.col(column).cast("string")
    # in an array, what follows the document shows: the parser alone stops at its end
    found = _once(rows, F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), parsed)
    # all fields in one pass over the document: values as their text, nested ones as they are
    raw = T.StructType([T.StructField(f.name, T.VariantType() if _is_nested(f.dataType) else T.StringType()) for f in schema.fields])
    found = _once(found, F.struct(
        F.col(parsed).isNotNull().alias("read"), F.try_variant_get(parsed, "$[1]", "variant").isNotNull().alias("several"),
        F.try_variant_get(parsed, "$[0]", raw.simpleString()).alias("raw"),
    ), f"{one}_raw")
    fields = [(f.name, *_field(F.col(f"{one}_raw.raw.{f.name}"), f.dataType)) for f in schema.fields]
    found = _once(found, F.struct(
        F.col(f"{one}_raw.read").alias("read"), F.col(f"{one}_raw.several").alias("several"),
        F.struct(*(typed.alias(name) for name, _, typed in fields)).alias("typed"), F.struct(*(given.alias(name) for name, given, _ in fields)).alias("given"),
    ), one)
    # white space is only looked for where there may be some: it takes as long as the text
    inner = F.trim(text, F.lit(_SPACE))
    opened = F.startswith(text, F.lit("{")) | F.startswith(inner, F.lit("{"))
    closed = F.endswith(text, F.lit("}")) | F.endswith(inner, F.lit("}"))
    shape = (
        F.when(text.isNull() | (~F.startswith(text, F.lit("{")) & (inner == "")), NO_DOCUMENT)
        .when(~F.col(f"{one}.read"), MALFORMED)
        .when(~opened | F.col(f"{one}.several"), NOT_AN_OBJECT)
        .when(~closed, MALFORMED)
    )
    given, typed = (lambda name: F.col(f"{one}.given.{name}")), (lambda name: F.col(f"{one}.typed.{name}"))
    bad = [F.when(given(n) & typed(n).isNull(), F.lit(n)) for n in schema.names]
    absent = [F.when(~given(n), F.lit(n)) for n in schema.names if n in required]
    nothing = F.array().cast("array<string>")

    def listed(names: list[Column]) -> Column:
        # compiled with the rest of the pass, which a filter by a function would keep from being; names differ
        return F.array_except(F.array(*names), F.array(F.lit(None).cast("string"))) if names else nothing

    found = _once(found, F.struct(shape.alias("shape"), listed(bad).alias("bad"), listed(absent).alias("absent")), f"{one}_faults")
    shape, bad, absent = (F.col(f"{one}_faults.{x}") for x in ("shape", "bad", "absent"))
    reason = F.coalesce(shape, F.when(F.size(bad) > 0, BAD_VALUE), F.when(F.size(absent) > 0, MISSING))
    named = F.when(shape.isNotNull(), nothing).when(F.size(bad) > 0, bad).otherwise(absent)
    found = _once(found, F.struct(reason.alias("reason"), named.alias("fields")), f"{one}_verdict")
    return found.withColumns({
        into: F.col(f"{one}.typed"), REASON: F.col(f"{one}_verdict.reason"), FIELDS: F.col(f"{one}_verdict.fields"),
    }).drop(parsed, one, f"{one}_raw", f"{one}_faults", f"{one}_verdict")


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with a column computed once a row: an expression below a generator is not copied into what uses it,
    where a filter on the result would otherwise parse the document again for each field it asks for."""
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.StructType))


def _field(raw: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Whether a value is given, and the value in its type (NULL where it does not fit whole)."""
    if not _is_nested(kind):
        return raw.isNotNull(), _scalar(raw, kind)
    given, typed = _nested(raw, "$", kind)
    if not _of_texts(kind):
        return given, typed
    # one cast of the whole value; any value can be a text, so where it left no part out it is what the walk would give
    whole = F.try_variant_get(raw, "$", kind.simpleString())
    return given, F.when(given, F.when(_complete(whole, kind), whole).otherwise(typed))


def _of_texts(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_of_texts(f.dataType) for f in kind.fields)
    return _of_texts(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.StringType)


def _complete(value: Column, kind: T.DataType) -> Column:
    """Whether no array or object inside is NULL, so none failed its cast. A NULL text is absent or null."""
    if isinstance(kind, T.StructType):
        parts = [_complete(value[f.name], f.dataType) for f in kind.fields if _is_nested(f.dataType)]
        return reduce(lambda x, y: x & y, parts, value.isNotNull())
    if not _is_nested(kind.elementType):
        return value.isNotNull()
    return F.coalesce(F.forall(value, lambda item: _complete(item, kind.elementType)), F.lit(False))


def _scalar(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    typed = text.try_cast(kind)
    if type(kind) in _SHAPES:
        typed = F.when(text.rlike(_SHAPES[type(kind)]), typed)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        typed = F.when(F.abs(typed) < float("inf"), typed)  # neither beyond the type's range nor NaN
    return typed


def _nested(holder: Column, path: str, kind: T.DataType) -> tuple[Column, Column]:
    """As ``_field``, of what a variant holds at a path. An array fits if all its elements do, NULL ones included."""
    value = F.try_variant_get(holder, path, "variant")
    given = value.isNotNull() & ~F.is_variant_null(value)
    if isinstance(kind, T.StructType):
        parts = [(f.name, *_nested(holder, f"{path}.{f.name}", f.dataType)) for f in kind.fields]
        whole = reduce(lambda x, y: x & y, [~there | typed.isNotNull() for _, there, typed in parts], F.startswith(F.schema_of_variant(value), F.lit("OBJECT")))
        return given, F.when(given & whole, F.struct(*(typed.alias(name) for name, _, typed in parts)))
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(holder, path, "array<variant>")

        def fits(item: Column) -> Column:
            there, typed = _nested(item, "$", kind.elementType)
            return ~there | typed.isNotNull()

        return given, F.when(F.forall(items, fits), F.transform(items, lambda item: _nested(item, "$", kind.elementType)[1]))
    return given, F.when(given, _scalar(F.try_variant_get(holder, path, "string"), kind))


def accepted(rows: DataFrame, into: str = TYPED, keep: Sequence[str] = ()) -> DataFrame:
    """The typed fields of the records that fit, after the columns ``keep``."""
    return rows.filter(F.col(REASON).isNull()).select(*keep, f"{into}.*")


def rejected(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records that do not fit: ``columns`` of ``rows``, reason and fields."""
    return rows.filter(F.col(REASON).isNotNull()).select(*columns, REASON, FIELDS)


def reject_counts(rows: DataFrame) -> DataFrame:
    """Per reason and field (NULL where the reason names none): how many records. ``rows`` are checked or rejected."""
    lost = rows.filter(F.col(REASON).isNotNull())
    return lost.select(REASON, F.explode_outer(FIELDS).alias("field")).groupBy(REASON, "field").agg(F.count("*").alias("records"))


def required_to_fit(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` as they are; reading one that does not fit raises. For callers that have no reject channel."""
    told = F.concat(F.lit("record does not fit ("), F.col(REASON), F.lit("): "), F.array_join(FIELDS, ", "), F.lit(" in "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    return rows.filter(F.col(REASON).isNull() | F.raise_error(told).cast("boolean"))
