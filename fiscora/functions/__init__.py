"""Column functions. Each takes and returns a ``Column``; none needs Python workers."""

from fiscora.functions.json import json_scalar, scalar_text
from fiscora.functions.numbers import (
    cents_to_dollars,
    exact_ratio,
    first_or_sum,
    growth,
    null_if_sentinel,
    promote,
    safe_add,
    safe_integer,
    safe_numeric,
    safe_subtract,
)
from fiscora.functions.text import (
    alert_text,
    failure_reason,
    redact_api_keys,
    redact_secrets,
    upper_key,
)
from fiscora.functions.time import BUSINESS_TIMEZONE, business_date, days_since_monday, ingest_date, safe_date, weekday

__all__ = [
    "BUSINESS_TIMEZONE",
    "alert_text",
    "business_date",
    "cents_to_dollars",
    "days_since_monday",
    "exact_ratio",
    "failure_reason",
    "first_or_sum",
    "growth",
    "ingest_date",
    "json_scalar",
    "null_if_sentinel",
    "promote",
    "redact_api_keys",
    "redact_secrets",
    "safe_add",
    "safe_date",
    "safe_integer",
    "safe_numeric",
    "safe_subtract",
    "scalar_text",
    "upper_key",
    "weekday",
]
