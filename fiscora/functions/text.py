"""Text keys and redaction of secrets in audit messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Masks, and the shapes in which a credential shows up in a message.
API_KEY_MASK = "***REDACTED_API_KEY***"
SECRET_MASK = "***REDACTED***"
API_KEY_PATTERNS = (r"(?i)(apikey=)[^&\s]+", r"(?i)(API key as )([A-Z0-9_-]+)")
SECRET_PATTERNS = (r"(?i)((?:api[_-]?key|token|password)=)[^&\s]+",)
RATE_LIMIT_TEXT = "rate limit"


def upper_key(symbol: Column) -> Column:
    """Key under which state of a symbol is kept."""
    return F.upper(symbol)


def _mask(message: Column, known: Iterable[str], patterns: Iterable[str], mask: str) -> Column:
    masked = F.coalesce(message, F.lit(""))
    for secret in known:
        if secret:
            masked = F.replace(masked, F.lit(secret), F.lit(mask))
    for pattern in patterns:
        # the masks hold no "$" or "\", so only $1 is special in the replacement
        masked = F.regexp_replace(masked, pattern, "$1" + mask)
    return masked


def redact_api_keys(message: Column, known: Iterable[str] = ()) -> Column:
    """Message of a source call without API keys; empty text for NULL."""
    return _mask(message, known, API_KEY_PATTERNS, API_KEY_MASK)


def redact_secrets(message: Column, known: Iterable[str] = ()) -> Column:
    """Message of a failed job without keys, tokens or passwords."""
    return _mask(message, known, SECRET_PATTERNS, SECRET_MASK)


def alert_text(message: Column, known: Iterable[str] = ()) -> Column:
    """Error text of an alert: the whole message, redacted. A sender may shorten what it delivers."""
    return redact_secrets(message, known)


def failure_reason(message: Column) -> Column:
    """Coarse cause of a failed job, from its message."""
    plain = F.replace(F.lower(message), F.lit("-"), F.lit(" "))
    return F.when(plain.contains(RATE_LIMIT_TEXT), "rate_limit").otherwise("task_failure")
