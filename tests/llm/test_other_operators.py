"""Nearest neighbours, chat formatting and the pipeline."""

from __future__ import annotations

import math

import numpy as np
import pytest

from strata.llm import chat, neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    return spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], VECTORS), x.astype(float)


def test_neighbours_recall_and_scores(spark):
    df, x = vectors(spark, 3000)
    rows = neighbours.nearest(df).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 3000, 20))
    recall = []
    for q, own in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:20]
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(math.isclose(r.score, s[r.vec_id], rel_tol=1e-12) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        recall.append(len({r.vec_id for r in own} & set(want.tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbours_awkward(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 8)  # several blocks of a part and of its queries
    ones = [1.0, 0.0, 1.0]
    rows = [(i * 20, ones, 0) for i in range(30)] + [
        (3, None, 0), (60_000, [float("nan"), 1.0, 1.0], 0), (80_000, [0.0, 0.0, 0.0], 0), (100_000, [1.0, None, 1.0], 0),
        (None, ones, 0), (120_000, [1.0, 2.0], 0), (5, [0.0, 1.0, 0.5], None)]
    found = neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.query_id for r in found} == {i * 20 for i in range(30)}
    own = sorted((r["rank"], r.vec_id) for r in found if r.query_id == 40)
    assert [v for _, v in own] == [i * 20 for i in range(30) if i != 2][:20]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0
    few = neighbours.nearest(spark.createDataFrame(rows[:3], VECTORS)).collect()
    assert len(few) == 6


def recall_of(spark, x, ids=None):
    """Recall against all candidates; every query row must have its 20, in order, without a repeat."""
    ids = np.arange(len(x)) if ids is None else ids
    df = spark.createDataFrame([(int(i), [float(v) for v in row], 0) for i, row in zip(ids, x)], "vec_id long, embedding array<double>, label int")
    lists = {}
    for r in neighbours.nearest(df.repartition(5)).collect():
        lists.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(lists) == {int(i) for i in ids if i % 20 == 0}
    hits = []
    for q, rows in lists.items():
        own = np.flatnonzero(ids == q)
        assert sorted(r[0] for r in rows) == sorted(list(range(1, 21)) * len(own))
        for at in own:
            s = np.zeros(len(x))
            for i in range(x.shape[1]):
                s += x[at, i] * x[:, i]
            s[ids == q] = -np.inf
            want = {(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:20]}
            found = [(v, y) for _, v, y in rows]
            assert all((v, y) in {(int(ids[j]), s[j]) for j in range(len(x))} for v, y in found) or len(own) > 1
            hits.append(len(want & set(found)) / len(want))
    return float(np.mean(hits))


def test_neighbours_of_uneven_clusters(spark):
    """Six clusters, some smaller than the list: further parts are probed until there are enough candidates."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12)) * 4
    x = centres[rng.choice(6, 400, p=[0.5, 0.3, 0.12, 0.05, 0.02, 0.01])] + 0.3 * rng.normal(size=(400, 12))
    assert recall_of(spark, x) >= 0.95


def test_neighbours_of_spread_norms(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 12))
    x = centres[rng.integers(0, 10, 3000)] + 0.6 * rng.normal(size=(3000, 12))
    x *= 10 ** rng.uniform(0, 2, size=(3000, 1))
    assert recall_of(spark, x) >= 0.95


def test_neighbours_tie_over_blocks(spark, monkeypatch):
    """Equal vectors in several blocks have one score to the last bit, so smaller ids come first."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(5)
    kinds = rng.normal(size=(4, 33))
    assert recall_of(spark, kinds[rng.integers(0, 4, 300)]) == 1.0


def test_neighbours_of_repeated_query_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 8))
    ids = np.arange(200)
    assert recall_of(spark, np.concatenate([x, x[[40, 40, 7]]]), np.concatenate([ids, [40, 40, 7]])) >= 0.95


def test_balanced_parts_have_room():
    x = np.random.default_rng(1).normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    part = neighbours.balanced_parts(x, neighbours.neighbour_graph(x, 5), 8, np.random.default_rng(0))
    assert np.bincount(part, minlength=8).max() <= math.ceil(1.1 * 500 / 8) and part.min() >= 0


def brute_viterbi(model, lines):
    best = None
    n = len(model.start)

    def walk(at, state, score, path):
        nonlocal best
        if at == len(lines):
            if best is None or score > best[0]:
                best = (score, path)
            return
        for s in range(n):
            step = model.start[s] if state is None else model.step[state, s]
            if step > -np.inf:
                walk(at + 1, s, score + step + model.emit([lines[at]])[0, s], [*path, s])

    walk(0, None, 0.0, [])
    return best[1]


def test_viterbi_is_exact_and_splits_into_chunks():
    rng = np.random.default_rng(2)
    model = chat.Model(["assistant", "user"], rng.random(2), rng.random((2, 2)), [rng.random((4, s)) * 9 for s in chat.SIZES])
    lines = [[int(rng.integers(s)) for s in chat.SIZES] for _ in range(7)]
    want = brute_viterbi(model, lines)
    emit = model.emit(lines)
    assert model.decode(emit, -1, -1).tolist() == want
    first, second = model.transfer(emit[:4]), model.transfer(emit[4:])
    through = first[-1][:, None] + second[:-1]
    end = int(through.max(axis=0).argmax())
    middle = int(through[:, end].argmax())
    assert [*model.decode(emit[:4], -1, middle), *model.decode(emit[4:], middle, end)] == want


CHATS = "conv_id long, turn long, role string, text string"


def talk(spark, n=60, turns=6):
    rows = []
    for c in range(n):
        for t in range(turns):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role, "Short one?" if role == "user" else "A longer reply.\nIt has\nthree lines."))
    return spark.createDataFrame(rows, CHATS)


def test_chat_recovers_roles(spark):
    turns = talk(spark)
    found = chat.recover(turns, chat.train(turns)).collect()
    assert len(found) == 360 and all(r.role == r.role_pred for r in found)
    assert chat.render("user", "Human: hi there\n") == "<|user|>\nhi there\n<|end|>"


def test_chat_long_transcript_over_chunks(spark, monkeypatch):
    turns = talk(spark)
    model = chat.train(turns)
    long_ = talk(spark, 1, 500)
    whole = {r.turn: r.role_pred for r in chat.recover(long_, model).collect()}
    assert len(whole) == 500
    monkeypatch.setattr(chat, "CHUNK", 10_000)
    assert {r.turn: r.role_pred for r in chat.recover(long_, model).collect()} == whole


def test_chat_awkward(spark):
    rows = [(1, 0, "user", None), (1, None, "user", "x"), (None, 0, "user", "y"), (2, 0, None, ""), (2, 0, None, ""), (2, 0, "user", "other")]
    turns = spark.createDataFrame(rows, CHATS)
    found = chat.formatted(turns).collect()
    assert len(found) == 5 and sum(r.n_rows for r in found) == 6
    empty = spark.createDataFrame([], CHATS)
    assert chat.formatted(empty).count() == 0
    assert {r.role_pred for r in chat.recover(turns, chat.train(empty)).collect()} == {"user"}


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output on the smallest tables."""
    import corpus_pipeline
    from strata.llm.common import documents, stored

    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_pipeline_keeps_columns_and_chains(spark, stages):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert list(stages) == names and len(names) == 5
    for name in names[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns and after.count() <= before.count()
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == stages[names[-1]][1].count()


def test_pipeline_decisions(spark, stages):
    """Each stage's output does not hold what the stage looks for."""
    from strata.llm import decontaminate, jaccard, substrings
    from strata.llm.common import documents

    after = stages["ngram_jaccard_join"][1]
    assert jaccard.join(after).where("class_id != doc_id").count() == 0
    before, after = stages["substring_dedup"]
    assert substrings.digests(before).where("n_removed = 0").join(before, "doc_id").select(before.columns).exceptAll(
        after).count() == 0
    after = stages["benchmark_decontamination"][1]
    assert decontaminate.contamination(after, documents(spark, "/root/testdata/sf0.001", "benchmark")).where("contaminated").count() == 0
