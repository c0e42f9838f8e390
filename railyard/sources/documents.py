"""Documents of varying shape: the fixed projection, and the shape actually found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import contracts
from railyard.sources import rejects

WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def checked_documents(
    docs: DataFrame, column: str, schema: T.StructType | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """``docs`` with the contract's fields in ``typed_record``, and for a document that does not fit the reason (``rejects``)."""
    return rejects.checked(docs, column, schema or contracts.BRONZE["meeza_digital_wallet_events"], required)


def project_documents(
    docs: DataFrame, column: str, schema: T.StructType | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """The contract's fields of each JSON document; other fields are ignored, absent ones are NULL.

    Documents that do not fit are left out here and are the rows of ``rejected_documents``.
    """
    return rejects.accepted(checked_documents(docs, column, schema, required))


def rejected_documents(
    docs: DataFrame, column: str, schema: T.StructType | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``docs`` whose document does not fit, with the reason and the fields at fault."""
    return rejects.rejected(checked_documents(docs, column, schema, required), docs.columns)


def document_fields(docs: DataFrame, column: str) -> DataFrame:
    """Per top-level field and kind of value (STRING, DECIMAL, OBJECT, ...): in how many documents it occurs."""
    parsed = docs.select(F.parse_json(F.col(column)).alias("v"))
    exploded = parsed.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_extract(F.schema_of_variant(F.col("value")), "^[A-Z_]+", 0)
    return (
        exploded.select(F.col("key").alias("field"), kind.alias("type"))
        .groupBy("field", "type")
        .agg(F.count("*").alias("documents"))
    )


def document_schema(docs: DataFrame, column: str, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """One schema that covers the documents. ``fraction`` samples them first; all are read by default."""
    rows = docs if fraction is None else docs.sample(fraction=fraction, seed=seed)
    return rows.agg(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("document_schema"))
