"""De-duplication.

``latest_per_key`` keeps one row per key with a deterministic survivor. It is written as a
grouped ``max`` over a struct (ordering columns first, then every other column as a tie
breaker), not as ``row_number`` over a window: the aggregate is combined map-side, so a key
that holds a third of all rows is reduced to one row per input partition before the
shuffle, where a window would sort that whole key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def latest_per_key(df: DataFrame, key: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: the row with the largest ``prefer`` columns (e.g. ingestion
    time), ties broken by the remaining columns in frame order, larger first; NULL counts
    as smallest. Identical rows are interchangeable, so the result is fully determined.
    """
    key = list(key)
    schema = df.schema
    columns = schema.fieldNames()
    prefer = [c for c in prefer if c not in key and c in columns]  # absent criteria are skipped
    rest = [c for c in columns if c not in key and c not in prefer]
    fields = prefer + rest
    if not fields:
        return df.select(*key).distinct()
    types = {f.name: f.dataType for f in schema.fields}
    ordered = [c for c in fields if _orderable(types[c])]
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    if len(ordered) == len(fields):
        best = F.max(packed)
    else:  # carry non-orderable columns, order on the orderable ones
        best = F.max_by(packed, F.struct(*[F.col(c) for c in ordered]))
    out = df.groupBy(*key).agg(best.alias("_best"))
    position = {c: i for i, c in enumerate(fields)}
    return out.select(*[F.col(c) if c in key else F.col(f"_best.f{position[c]}").alias(c) for c in columns])


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row distinct over ``cols`` (D2); hash aggregate with a map-side partial step."""
    return (df.select(*cols) if cols else df).distinct()


def distinct_values(df: DataFrame, cols: Sequence[str], descending: bool = False) -> DataFrame:
    """Distinct values, sorted (D3)."""
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in cols]
    return df.select(*cols).distinct().orderBy(*order)
