"""Chunks of transcripts are bounded whatever the turn numbers are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.llm import chat

CHATS = "conv_id long, turn long, role string, text string"


def text(role, i):
    return f"Short {i}?" if role == "user" else f"A longer reply {i}.\nIt has\nthree lines."


@pytest.fixture(scope="module")
def hot(spark):
    """One transcript of null turns, one of a repeated turn, one without an id, and short ones."""
    rows = []
    for i in range(1000):
        role = "user" if i % 2 == 0 else "assistant"
        rows += [(1, None, role, text(role, i)), (2, 7, role, text(role, i)), (None, i % 5, role, text(role, i))]
    rows += [(c, t, r, text(r, t)) for c in range(10, 60) for t, r in enumerate(("user", "assistant") * 3)]
    return spark.createDataFrame(rows, CHATS)


@pytest.mark.parametrize("turns", [None, 7])
def test_chunks_of_one_turn_number_are_bounded(hot, turns):
    own = chat._entries(hot, "conv_id", "turn", "role", "text")
    sizes = own.where(F.col("turn").eqNullSafe(F.lit(turns).cast("long"))).groupBy("conv", "chunk").count()
    assert sizes.agg(F.max("count")).collect()[0][0] <= chat.CHUNK


def test_chunks_are_in_the_order_of_entries(hot):
    rows = chat._entries(hot, "conv_id", "turn", "role", "text").where("conv is not null").collect()
    key = lambda r: (r.conv, r.turn is not None, r.turn or 0, r.text)
    chunks = [r.chunk for r in sorted(rows, key=key)]
    assert len(rows) == 2300 and chunks == sorted(chunks)


def test_hot_turns_are_decoded_as_one_transcript(hot, monkeypatch):
    model = chat.train(hot)
    named = hot.where("conv_id is not null")
    take = lambda: {(r.conv, r.rendered): r.role_pred for r in chat.recover(named, model).collect()}
    cut = take()
    monkeypatch.setattr(chat, "CHUNK", 10**6)
    assert take() == cut


def test_entries_without_a_transcript_are_decided_singly(spark, hot):
    model = chat.train(hot)
    nameless = hot.where("conv_id is null")
    found = {r.rendered: r.role_pred for r in chat.recover(nameless, model).collect()}
    alone = nameless.withColumn("conv_id", F.monotonically_increasing_id())
    assert len(found) == 1000 and {r.rendered: r.role_pred for r in chat.recover(alone, model).collect()} == found
