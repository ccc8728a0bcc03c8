"""Scalar column functions (all JVM-side built-ins; no Python UDF)."""

from strata.functions.audit import epoch_batch_id, ingest_date, with_audit
from strata.functions.ids import duplicate_ids, surrogate_id
from strata.functions.labels import location_label, month_abbr, period_label, risk_level
from strata.functions.parse import double_of, int_of, null_nan, timestamp_of

__all__ = [
    "double_of",
    "duplicate_ids",
    "epoch_batch_id",
    "ingest_date",
    "int_of",
    "location_label",
    "month_abbr",
    "null_nan",
    "period_label",
    "risk_level",
    "surrogate_id",
    "timestamp_of",
    "with_audit",
]
