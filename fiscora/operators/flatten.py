"""Payload documents to typed-text rows: one parse per document, one row per report.

``from_json`` reads only the requested fields; the parser skips the rest of the
document without building it. Catalyst cannot narrow the read schema through the
two generators below, so the caller names the fields it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import ANNUAL, QUARTERLY, Endpoint
from fiscora.functions import ingest_date, scalar_text
from fiscora.sources.bronze import BATCH

DATE_FIELD = "fiscalDateEnding"

# Orders copies of one period that arrived on the same day: the later delivery first,
# then by document content and by place in its array (the source lists the newest first).
TIEBREAK = ("delivery", "payload_hash", "position")


def report_struct(fields: Sequence[str], text_fields: Sequence[str]) -> T.StructType:
    """Read schema of one report. Text fields are read as VARIANT, which still
    tells a string from a nested object; every other scalar is read as its text."""
    return T.StructType(
        [T.StructField(n, T.VariantType() if n in text_fields else T.StringType()) for n in fields]
    )


def document_schema(endpoint: Endpoint, report: T.StructType) -> T.StructType:
    arrays = [T.StructField(a, T.ArrayType(report)) for a in endpoint.arrays]
    return T.StructType([T.StructField(endpoint.key, T.VariantType()), *arrays])


def parse_document(raw: str, schema: T.StructType) -> Column:
    """Generator that parses a document once and yields its fields as columns.

    A plain ``from_json`` projection would be parsed again for every filter that
    Catalyst pushes below it, such as the not-null test of a join key. Predicates
    do not pass through a generator.
    """
    return F.inline(F.array(F.from_json(raw, schema)))


def with_ingest_columns(staging: DataFrame) -> list[Column]:
    """Ingestion columns of a staging row, under their Silver names, and its tie-breaks."""
    return [
        F.col("year").alias("partition_year"),
        F.col("month").alias("partition_month"),
        F.col("day").alias("partition_day"),
        ingest_date(F.col("year"), F.col("month"), F.col("day")).alias("ingest_date"),
        # negative, so that all tie-breaks sort upwards
        (-F.col(BATCH) if BATCH in staging.columns else F.lit(0)).cast("bigint").alias("delivery"),
        F.xxhash64("raw_data").alias("payload_hash"),
    ]


def _elements(array: str, report: T.StructType) -> str:
    """A report array whose elements are read one by one.

    The typed parse gives no array at all if one element is not an object. Only then is the document
    read again, as VARIANT: each object keeps its fields and anything else becomes an empty report.
    """
    # SQL text, since this has an expression per field that building call by call would take long
    fields = ", ".join(
        f"try_variant_get(e, \"$['{f.name}']\", '{f.dataType.simpleString()}') as `{f.name}`" for f in report.fields
    )
    again = f"transform(from_json(raw_data, '`{array}` array<variant>').`{array}`, e -> struct({fields}))"
    return f"case when `{array}` is not null then `{array}` else {again} end"


def flatten_reports(
    staging: DataFrame, endpoint: Endpoint, fields: Sequence[str], text_fields: Sequence[str] = ()
) -> DataFrame:
    """One row per element of the annual and quarterly arrays.

    Output: ingestion columns, ``symbol``, ``report_type``, the requested fields as
    text under their source names, and the tie-break columns. An empty or missing
    array gives no rows; an element that is not an object gives a row of NULLs. The document
    is read once for both arrays.
    """
    texts = [DATE_FIELD, *text_fields]
    wanted = [DATE_FIELD, *(f for f in fields if f != DATE_FIELD), *text_fields]
    report = report_struct(wanted, texts)
    documents = staging.select(
        *with_ingest_columns(staging),
        "raw_data",
        parse_document("raw_data", document_schema(endpoint, report)),
    )
    annual, quarterly = (_elements(a, report) for a in endpoint.arrays)
    tagged = documents.select(
        *(c for c in documents.columns if c not in (*endpoint.arrays, "raw_data")),
        F.expr(f"stack(2, '{ANNUAL}', {annual}, '{QUARTERLY}', {quarterly})").alias("report_type", "reports"),
    )
    reports = tagged.select(
        *(c for c in tagged.columns if c != "reports"),
        F.posexplode("reports").alias("position", "report"),
    )

    def text(name: str) -> Column:
        value = F.col(f"report.{name}")
        return (scalar_text(value) if name in texts else value).alias(name)

    return reports.select(
        *(c for c in reports.columns if c not in (endpoint.key, "report")),
        scalar_text(F.col(endpoint.key)).alias("symbol"),
        *(text(n) for n in wanted),
    )


def flatten_document(staging: DataFrame, endpoint: Endpoint, fields: Sequence[str]) -> DataFrame:
    """One row per flat document; the requested fields as text under their source names."""
    texts = {f.source for f in endpoint.fields if f.is_text} | {endpoint.key}
    wanted = [endpoint.key, *fields]
    documents = staging.select(
        *with_ingest_columns(staging),
        F.lit(0).alias("position"),
        parse_document("raw_data", report_struct(wanted, texts)),
    )

    def text(name: str) -> Column:
        value = F.col(f"`{name}`")
        return scalar_text(value) if name in texts else value

    return documents.select(
        *(c for c in documents.columns if c not in wanted),
        text(endpoint.key).alias("symbol"),
        *(text(n).alias(n) for n in fields),
    )


def union_reports(annual: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Annual rows then quarterly rows, each tagged, duplicates kept."""
    return annual.withColumn("report_type", F.lit(ANNUAL)).unionByName(
        quarterly.withColumn("report_type", F.lit(QUARTERLY)), allowMissingColumns=True
    )
