"""Joins (J1, J2) and the key-existence join used by incremental loads.

No join here forces a broadcast from a static guess. With AQE on, Spark measures each
side's shuffle output at runtime and switches to a broadcast hash join only when the
measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the
sort-merge join stays, and skewed partitions are split (skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join USING ``on``; NULL keys never match."""
    return left.join(right, list(on), how)


def keys_absent_from(delta: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` whose key does not occur in ``target``.

    Computed as ``delta ▷ (target ⋉ keys(delta))``: the semi join probes the large target
    with the (usually small) delta keys, which AQE broadcasts when small, so the target is
    scanned (key columns only) but not shuffled; the anti join then runs on two small sides.
    """
    key = list(key)
    existing = target.select(*key).join(delta.select(*key).distinct(), key, "left_semi")
    return delta.join(existing, key, "left_anti")
