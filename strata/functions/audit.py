"""Audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_batch_id(prefix: str = "batch_") -> Column:
    """``batch_<epoch seconds>``; ``current_timestamp`` is fixed once per query."""
    return F.concat(F.lit(prefix), F.unix_timestamp(F.current_timestamp()).cast("string"))


def ingest_date() -> Column:
    """Landing-day partition value ``YYYY-MM-DD``."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd")


def audit_columns(
    source: str,
    batch_id: str | Column | None = None,
    ingestion_time: Column | None = None,
    as_string: bool = False,
) -> dict[str, Column]:
    """``ingestion_time``, ``source``, ``batch_id`` as column expressions.

    ``as_string`` stamps the bronze form (text timestamp), otherwise a typed timestamp.
    """
    ts = ingestion_time if ingestion_time is not None else F.current_timestamp()
    if as_string:
        ts = ts.cast("string")
    bid = epoch_batch_id() if batch_id is None else (F.lit(batch_id) if isinstance(batch_id, str) else batch_id)
    return {"ingestion_time": ts, "source": F.lit(source), "batch_id": bid}


def with_audit(
    df: DataFrame,
    source: str,
    batch_id: str | Column | None = None,
    ingestion_time: Column | None = None,
    as_string: bool = False,
) -> DataFrame:
    """Replace / add the audit columns (see ``audit_columns``)."""
    return df.withColumns(audit_columns(source, batch_id, ingestion_time, as_string))
