"""Ingest contract as column expressions: classify, validate, detect extras, route.

Rules are strict where the source's own tests leave room: booleans are not
numbers, digit groups are not numbers, and a fiscal date is ``yyyy-MM-dd``.
Fields unknown to a report are allowed; unknown envelope fields are extras.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import SENTINELS, Endpoint, Field
from fiscora.functions import scalar_text
from fiscora.operators.flatten import DATE_FIELD

# Keys of an error envelope and the text of a daily limit.
NOTE, INFORMATION, ERROR_MESSAGE = "Note", "Information", "Error Message"
DAILY_LIMIT_TEXT = "rate limit"

RATE_LIMIT = "rate_limit"
DAILY_LIMIT = "daily_limit"
ACCESS_DENIED = "access_denied"
INVALID_REQUEST = "invalid_request"
NO_DATA = "no_data"
MALFORMED = "malformed"
DATA = "data"

ACCEPTED, QUARANTINE, REJECTED, NO_CHANGE = "accepted", "quarantine", "rejected", "no_change"

_SENTINEL = "|".join(re.escape(s) for s in SENTINELS)
_INTEGER = rf"^({_SENTINEL}|\s*[+-]?\d+(\.0*)?\s*)$"
# how a JSON number with an exponent reads after parsing, and how it is written
_LARGE = r"^-?\d\.\d+E\d+$"
_EXPONENT = r"[+-]?\d+(?:\.\d+)?[eE][+-]?\d+"
_EXACT = "decimal(38, 9)"
_DECIMAL = (
    rf"^({_SENTINEL}|\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*)$"
)
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_CURRENCY, _REPORTED_DATE, _REPORT_TIME = "reportedCurrency", "reportedDate", "reportTime"


def _text(value: str) -> str:
    """A SQL literal, backslashes as they are."""
    return "r'" + value + "'" if "'" not in value else 'r"' + value + '"'


# The checks are written as SQL text: an expression per field, built call by call, takes the driver longer
# than thousands of documents take to be checked.


def _is_string(value: str) -> str:
    return f"coalesce(schema_of_variant({value}) = 'STRING', false)"


def _is_missing(value: str) -> str:
    return f"({value} is null or is_variant_null({value}))"


def _is_date(text: str) -> str:
    """Dates are read as text: no JSON value but a string looks like one."""
    return f"coalesce({text} rlike {_text(_ISO_DATE)} and try_cast({text} as date) is not null, false)"


def _date_text(text: Column) -> Column:
    """The text of a date field; NULL for an object or array."""
    return F.when(~text.rlike(r"^\s*[\[{]"), text)


def _is_large_whole(text: str) -> str:
    """Is this a whole number that JSON gave with an exponent? ``plain_integers`` writes it out."""
    return f"(case when {text} rlike {_text(_LARGE)} then coalesce(try_cast({text} as {_EXACT}) % 1 = 0, false) else false end)"


def _bad_number(text: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.LongType):
        # nearly every amount passes the cheap cast and never meets the pattern
        valid = f"(try_cast({text} as bigint) is not null or {text} rlike {_text(_INTEGER)} or {_is_large_whole(text)})"
    else:
        valid = f"{text} rlike {_text(_DECIMAL)}"
    return f"({text} is not null and not {valid})"


def _number_groups(fields: list[Field]) -> list[tuple[T.DataType, list[str]]]:
    """Numeric fields by type, each group checked by one expression over its values."""
    groups: dict[str, tuple[T.DataType, list[str]]] = {}
    for field in fields:
        if not field.is_text:
            groups.setdefault(field.dtype.simpleString(), (field.dtype, []))[1].append(field.source)
    return list(groups.values())


def _values(owner: str, names: list[str]) -> str:
    return "array(" + ", ".join(f"{owner}.`{n}`" for n in names) + ")"


def _has_bad_number(owner: str, fields: list[Field]) -> str:
    groups = (f"exists({_values(owner, names)}, x -> {_bad_number('x', dtype)})" for dtype, names in _number_groups(fields))
    return " or ".join(groups)


def _bad_number_messages(owner: str, fields: list[Field], prefix: str = "") -> str:
    found = []
    for dtype, names in _number_groups(fields):
        messages = "array(" + ", ".join(_text(f"{prefix}{n}: not a number") for n in names) + ")"
        picked = f"case when {_bad_number('x', dtype)} then get({messages}, i) end"
        found.append(f"array_compact(transform({_values(owner, names)}, (x, i) -> {picked}))")
    return f"concat({', '.join(found)})"


def _report_texts(endpoint: Endpoint) -> list[str]:
    texts = [DATE_FIELD]
    if endpoint.currency_required:
        texts.append(_CURRENCY)
    if endpoint.quarterly_only:
        texts += [_REPORTED_DATE, _REPORT_TIME]
    return texts


def contract_schema(endpoint: Endpoint) -> T.StructType:
    """Read schema for validation: text fields as VARIANT, so that their JSON type shows; dates as text."""
    notes = [T.StructField(n, T.StringType()) for n in (NOTE, INFORMATION, ERROR_MESSAGE)]
    texts = _report_texts(endpoint)
    scalars = [
        T.StructField(f.source, T.VariantType() if f.is_text else T.StringType())
        for f in endpoint.fields
    ]
    key = T.StructField(endpoint.key, T.VariantType())
    if endpoint.is_flat:
        return T.StructType([key, *notes, *scalars])
    dates = (DATE_FIELD, _REPORTED_DATE)
    kinds = [T.StructField(t, T.StringType() if t in dates else T.VariantType()) for t in texts]
    report = T.StructType(kinds + scalars)
    arrays = [T.StructField(a, T.ArrayType(report)) for a in endpoint.arrays]
    return T.StructType([key, *notes, *arrays])


def payload_class(keys: Column, information: Column) -> Column:
    """What kind of answer a document is; error envelopes come before its content."""
    return (
        F.when(keys.isNull(), MALFORMED)
        .when(F.array_contains(keys, NOTE), RATE_LIMIT)
        .when(
            F.array_contains(keys, INFORMATION),
            F.when(F.lower(information).contains(DAILY_LIMIT_TEXT), DAILY_LIMIT).otherwise(ACCESS_DENIED),
        )
        .when(F.array_contains(keys, ERROR_MESSAGE), INVALID_REQUEST)
        .when(F.size(keys) == 0, NO_DATA)
        .otherwise(DATA)
    )


def extra_fields(keys: Column, endpoint: Endpoint) -> Column:
    """Envelope keys the contract does not know."""
    known = ", ".join(_text(k) for k in endpoint.envelope)
    return F.array_except(keys, F.expr(f"array({known})"))


def _report_numbers(endpoint: Endpoint, array: str) -> list[Field]:
    """Numeric fields the contract gives a report of this array."""
    annual = array == endpoint.annual
    return [f for f in endpoint.fields if not (annual and f.source in endpoint.quarterly_only)]


def _report_text_checks(endpoint: Endpoint, array: str, report: str) -> list[tuple[str, str]]:
    """Rules on the text fields of one report, as (violated, message)."""
    checks = [(f"not {_is_date(f'{report}.{DATE_FIELD}')}", f"{array}.{DATE_FIELD}: not a date")]
    if endpoint.currency_required:
        checks.append((f"not {_is_string(f'{report}.{_CURRENCY}')}", f"{array}.{_CURRENCY}: not a string"))
    if endpoint.quarterly_only and array != endpoint.annual:
        reported, time = f"{report}.{_REPORTED_DATE}", f"{report}.{_REPORT_TIME}"
        checks.append((f"({reported} is not null and not {_is_date(reported)})", f"{array}.{_REPORTED_DATE}: not a date"))
        checks.append((f"not ({_is_missing(time)} or {_is_string(time)})", f"{array}.{_REPORT_TIME}: not a string"))
    return checks


def _messages(checks: list[tuple[str, str]]) -> str:
    return "array_compact(array(" + ", ".join(f"case when {bad} then {_text(text)} end" for bad, text in checks) + "))"


def _array_violations(endpoint: Endpoint, array: str, reports: str) -> str:
    numbers = _report_numbers(endpoint, array)
    checks = _report_text_checks(endpoint, array, "r")
    is_bad = " or ".join(["r is null", *(bad for bad, _ in checks), _has_bad_number("r", numbers)])
    not_object = f"array({_text(f'{array}: report is not an object')})"
    explained = f"concat({_messages(checks)}, {_bad_number_messages('r', numbers, f'{array}.')})"
    # messages are built only for a document that fails
    return (
        f"case when {reports} is null then array({_text(f'{array}: missing or not a list of reports')}) "
        f"when exists({reports}, r -> {is_bad}) then "
        f"array_distinct(flatten(transform({reports}, r -> case when r is null then {not_object} else {explained} end))) "
        "else cast(array() as array<string>) end"
    )


def violations(doc: str, endpoint: Endpoint) -> Column:
    """Broken rules of a parsed document, a column of this name; empty when it honours the contract."""
    checks = [(f"not {_is_string(f'{doc}.`{endpoint.key}`')}", f"{endpoint.key}: missing or not a string")]
    if not endpoint.is_flat:
        parts = [_array_violations(endpoint, a, f"{doc}.`{a}`") for a in endpoint.arrays]
        return F.expr(f"concat({', '.join([_messages(checks), *parts])})")
    for field in endpoint.fields:
        if field.is_text:
            value = f"{doc}.`{field.source}`"
            checks.append((f"not ({_is_missing(value)} or {_is_string(value)})", f"{field.source}: not a string"))
    return F.expr(f"concat({_messages(checks)}, {_bad_number_messages(doc, list(endpoint.fields))})")


def fiscal_probe(doc: Column, endpoint: Endpoint, rule: str = "first") -> Column:
    """Fiscal date a document stands for, as text.

    ``first`` is the source's rule: the first report of the first non-empty array.
    It misses quarters that appear between two annual reports; ``max`` takes the
    newest date of all reports instead.
    """
    if endpoint.is_flat:
        texts = [F.nullif(scalar_text(doc[name]), F.lit("")) for name in endpoint.probe_order]
        return F.coalesce(*texts)
    if rule == "max":
        dates = F.flatten(
            F.array(
                *(
                    F.coalesce(
                        F.transform(doc[a], lambda r: _date_text(r[DATE_FIELD])),
                        F.array().cast("array<string>"),
                    )
                    for a in endpoint.probe_order
                )
            )
        )
        return F.array_max(dates)
    return F.coalesce(*(_date_text(F.get(doc[a], F.lit(0))[DATE_FIELD]) for a in endpoint.probe_order))


def payload_row_count(raw: Column) -> Column:
    """Records in a document: the lengths of its lists, 1 when it has none, 0 for nothing."""
    fields = F.map_values(F.from_json(raw, "map<string,variant>"))
    lengths = F.array_compact(
        F.transform(fields, lambda v: F.size(F.try_variant_get(v, "$", "array<variant>")))
    )
    # stays NULL when there is no list, so that the document is parsed for one use only
    total = F.aggregate(lengths, F.lit(None).cast("int"), lambda sum_, n: F.coalesce(sum_, F.lit(0)) + n)
    flat = F.when(F.json_object_keys(raw).isNotNull(), 1)
    return F.coalesce(F.json_array_length(raw), total, flat, F.lit(0)).cast("bigint")


def _known_records(doc: Column, endpoint: Endpoint) -> Column:
    """Record count of a document known to honour the contract, without a second parse."""
    if endpoint.is_flat:
        return F.lit(1).cast("bigint")
    return reduce(lambda a, b: a + b, [F.size(doc[a]) for a in endpoint.arrays]).cast("bigint")


def route(payloads: DataFrame, endpoint: Endpoint, probe_rule: str = "first") -> DataFrame:
    """Check documents of one endpoint against its contract.

    Adds ``endpoint, symbol, payload_class, violations, extra_fields, route,
    reason, fiscal_date, payload_hash, n_records, n_bytes``, so that later steps need
    not read the document again. Order of the tests: error envelope, contract, extras.
    A ``symbol`` already present is the company asked for and is kept: an error
    envelope names none.
    """
    # exploded, so that a later filter on the route cannot make Catalyst parse twice
    parsed = payloads.select(
        "*",
        F.json_object_keys("raw_data").alias("_keys"),
        F.explode(F.array(F.from_json("raw_data", contract_schema(endpoint)))).alias("_doc"),
    )
    doc, keys = F.col("_doc"), F.col("_keys")
    is_data = F.col("payload_class") == DATA
    none = F.array().cast("array<string>")
    checked = parsed.withColumn("payload_class", payload_class(keys, doc[INFORMATION])).withColumns(
        {
            "violations": F.when(is_data, violations("_doc", endpoint)).otherwise(none),
            "extra_fields": F.when(is_data, extra_fields(keys, endpoint)).otherwise(none),
        }
    )
    verdict = (
        F.when(~is_data | (F.size("violations") > 0), REJECTED)
        .when(F.size("extra_fields") > 0, QUARANTINE)
        .otherwise(ACCEPTED)
    )
    reason = (
        F.when(~is_data, F.col("payload_class"))
        .when(F.size("violations") > 0, F.array_join("violations", "; "))
        .when(F.size("extra_fields") > 0, F.concat(F.lit("extra fields: "), F.array_join("extra_fields", ", ")))
    )
    asked = "symbol" in payloads.columns
    return checked.select(
        F.lit(endpoint.name).alias("endpoint"),
        *payloads.columns,
        *([] if asked else [scalar_text(doc[endpoint.key]).alias("symbol")]),
        "payload_class",
        "violations",
        "extra_fields",
        verdict.alias("route"),
        reason.alias("reason"),
        fiscal_probe(doc, endpoint, probe_rule).alias("fiscal_date"),
        F.xxhash64("raw_data").alias("payload_hash"),
        F.when(verdict == ACCEPTED, _known_records(doc, endpoint))
        .otherwise(payload_row_count(F.col("raw_data")))
        .alias("n_records"),
        F.octet_length("raw_data").cast("bigint").alias("n_bytes"),
    )


def plain_integers(raw: Column, endpoint: Endpoint) -> Column:
    """Rewrite whole amounts sent as ``12.0`` or ``1e3`` to ``12`` and ``1000``, as validation reads them.

    The search for such a text is one cheap scan; only documents that hold one
    pay for the rewrite. A key inside a string value has escaped quotes and
    cannot match.
    """
    names = "|".join(f.source for f in endpoint.fields if isinstance(f.dtype, T.LongType))
    if not names:
        return raw
    pattern = rf'"({names})"(\s*:\s*)("?)\s*([+-]?\d+)\.0*\s*\3(?=\s*[,}}])'
    plain = F.when(
        raw.rlike(r'\d\.0*\s*"?\s*[,}]'), F.regexp_replace(raw, pattern, r'"$1"$2$3$4$3')
    ).otherwise(raw)
    return _without_exponents(plain, names)


def _without_exponents(raw: Column, names: str) -> Column:
    """Write out whole amounts given with an exponent."""
    # the mark that ends a value belongs to the match, so no match is the beginning of another
    found = F.array_distinct(F.regexp_extract_all(raw, F.lit(rf'("({names})"\s*:\s*{_EXPONENT}\s*[,}}])'), F.lit(1)))

    def written_out(document: Column, member: Column) -> Column:
        number = F.regexp_extract(member, rf":\s*({_EXPONENT})", 1)
        value = number.try_cast(_EXACT)
        digits = value.try_cast("decimal(38,0)").cast("string")
        whole = F.coalesce(value % 1 == 0, F.lit(False))
        return F.when(whole, F.replace(document, member, F.replace(member, number, digits))).otherwise(document)

    return F.when(raw.rlike(rf":\s*{_EXPONENT}\s*[,}}]"), F.aggregate(found, raw, written_out)).otherwise(raw)


def stamp_extraction_date(raw: Column, day: Column) -> Column:
    """Add ``extraction_date`` as the last key of an accepted (hence non-empty) document."""
    body = F.regexp_replace(raw, r"\s*\}\s*$", "")
    return F.concat(body, F.lit(',"extraction_date":"'), F.date_format(day, "yyyy-MM-dd"), F.lit('"}'))
