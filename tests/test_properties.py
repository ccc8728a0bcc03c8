"""Property tests: the keyed de-duplication equals a brute-force survivor choice."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.dedup import latest_per_key

ROW = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
    st.one_of(st.none(), st.floats(-2, 2, allow_nan=False).map(lambda v: round(v, 1))),
)


def _brute(rows: list[tuple]) -> list[tuple]:
    """Per key: the largest (prio, s, d) tuple, NULL below every value."""
    best: dict = {}
    rank = lambda v: (0,) if v is None else (1, v)
    for k, prio, s, d in rows:
        cand = (prio, s, d)
        cur = best.get(k)
        if cur is None or tuple(map(rank, cand)) > tuple(map(rank, cur)):
            best[k] = cand
    return sorted(((k, *v) for k, v in best.items()), key=lambda r: tuple(map(str, r)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=30), st.integers(1, 5))
def test_latest_per_key_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, prio int, s string, d double")
    got = latest_per_key(df.repartition(parts), ["k"], prefer=["prio"]).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: tuple(map(str, r)))
    assert got == _brute(rows)
