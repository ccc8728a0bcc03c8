"""The trie of conversation prefixes, built by van Emde Boas recursion.

All conversations are cut at half the greatest depth. Every cut prefix is named; the prefixes form
the upper trie, and the turns below a name its lower forest. Both are cut at half their depth
again, all tries and forests of a height in one round, until each is one turn high. So the prefix
of ``d`` turns is named in the round of the largest power of two that divides ``d``: by the name of
the prefix that its block stands on and the digest of the block between. The name is the smallest
member, which with the depth identifies a node.

Totals of subtrees go the other way: the lower forests below a cut are added up there, and the sum
is grafted on the cut's ancestors in the upper trie, block heights doubling from one turn to all.
Rounds are as many as the depth has binary digits; each reads and writes tables in the shared
checkpoint folder. A round of height ``h`` names one prefix a block, and grafts along the path of
one member a cut, so no node's members are ever gathered but for ``ends_sha256``: a hash over ids
in order is serial, and one task streams them, holding one batch.

Positions of turns come from counts per range of the sorted table, so a conversation of very many
turns is spread over the ranges.

Defined cases: turns are ordered by turn (null first), then role, then text; a null role or text
is empty; rows of a null conversation are left out; equal rows are turns of their own; other
columns are ignored; an empty table gives no node. Digests are MD5 (128 bits) of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import partitions, small_batches, stored

#: Conversations of one base share their first turns: the base is the conversation of the next lower multiple.
GROUP = 100
#: At most so many turns less one are taken from the base.
HEADS = 6
#: Characters of a text by which ranges of the sorted table are cut.
_PREFIX = 64


def _digest(*parts) -> F.Column:
    return F.unhex(F.md5(F.concat(*parts)))


def ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``pos`` (from 0), ``digest`` and ``chars`` of each turn."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    spread = rows.repartitionByRange(partitions(turns.sparkSession), "conv", "turn", "role", F.substring("text", 1, _PREFIX))
    keyed = spread.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text").select(
        "conv", F.monotonically_increasing_id().alias("place"),
        _digest(F.char_length("role").cast("string"), F.lit(":"), "role", "text").alias("digest"), F.char_length("text").cast("long").alias("chars"))
    keyed = stored(keyed.withColumn("range", F.shiftright("place", 33)), "trie-turns")
    # a conversation's rows of a range are next to each other
    own = keyed.groupBy("conv", "range").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    own = own.select("conv", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return keyed.join(own, ["conv", "range"]).select("conv", (F.col("place") + F.col("shift")).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and each conversation with its number of turns."""
    convs = turns.select("conv").distinct().select(
        "conv", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    head = turns.where(F.col("pos") < heads - 1).select(F.col("conv").alias("base"), "pos", "digest", "chars")
    taken = convs.join(head, "base").where(F.col("pos") < F.col("h")).select("conv", "pos", "digest", "chars")
    have = stored(convs.join(taken.groupBy("conv").agg(F.count("*").alias("have")), "conv", "left")
                  .select("conv", "h", F.coalesce("have", F.lit(0)).alias("have")), "trie-conversations")
    rest = turns.join(have, "conv").where(F.col("pos") >= F.col("h")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("have")).alias("pos"), "digest", "chars")
    rows = stored(taken.unionByName(rest), "trie-rebuilt")
    length = rows.groupBy("conv").agg(F.count("*").alias("length"))
    return rows, stored(have.join(length, "conv", "left").select("conv", F.coalesce("length", F.lit(0)).alias("length")), "trie-lengths")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each node's ids, from rows sorted by node and id."""
    node, held = None, None
    names = ["owner", "depth", "ends"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([held.hexdigest()])], names=names)

    for batch in batches:
        for owner, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "conv"))):
            if (owner, depth) != node:
                if node:
                    yield out()
                node, held = (owner, depth), hashlib.sha256()
                held.update(b"%d" % conv)
            else:
                held.update(b",%d" % conv)
    if node:
        yield out()


def named(rows: DataFrame, lengths: DataFrame, root: int, rounds: int) -> DataFrame:
    """``conv``, ``depth``, ``owner`` and ``parent`` (owners) of every prefix of one turn or more, all members."""
    blocks = {0: rows.select("conv", F.col("pos").alias("block"), "digest")}
    for k in range(1, rounds):  # digests of the whole blocks of 2^k turns
        half = blocks[k - 1].groupBy("conv", (F.shiftright("block", 1)).alias("block")).agg(
            F.max(F.when(F.col("block") % 2 == 0, F.col("digest"))).alias("a"), F.max(F.when(F.col("block") % 2 == 1, F.col("digest"))).alias("b"))
        blocks[k] = stored(half.where("a is not null and b is not null").select("conv", "block", _digest("a", "b").alias("digest")), "trie-blocks")
    names = lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("owner"))
    parts: list[DataFrame] = []
    for k in reversed(range(rounds)):
        uppers = blocks[k].where("block % 2 = 0").select("conv", (F.col("block") * 2**k).alias("depth"), "digest")
        cut = uppers.join(names, ["conv", "depth"]).withColumnRenamed("owner", "base")
        least = cut.groupBy("base", "depth", "digest").agg(F.min("conv").alias("owner"))
        part = stored(cut.join(least, ["base", "depth", "digest"]).select("conv", (F.col("depth") + 2**k).alias("depth"), "owner"), "trie-names")
        parts.append(part)
        names = names.unionByName(part)
    above = names.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    return stored(reduce(DataFrame.unionByName, parts).join(above, ["conv", "depth"]), "trie-paths")


def grafted(nodes: DataFrame, paths: DataFrame, rounds: int) -> DataFrame:
    """``nodes`` (``owner``, ``depth``, ``parent``, ``leaves``, ``saved``) with the totals of their subtrees."""
    mine = paths.select("conv", "depth", "owner")
    now = nodes
    for k in range(rounds):
        half, block = 2**k, lambda d: F.shiftright(F.col(d) - 1, k + 1)  # noqa: E731, B023
        # totals of the forest below each cut, which is half a block deep
        below = now.where(F.col("depth") % (2 * half) == (half + 1) % (2 * half)).groupBy(
            F.col("parent").alias("conv"), (F.col("depth") - 1).alias("cut")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        below = below.where("cut > 0").withColumn("block", block("cut"))
        onto = (mine.withColumn("block", block("depth")).where(((F.col("depth") - 1) % (2 * half)) < half).join(below, ["conv", "block"])
                .groupBy("owner", "depth").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        now = stored(now.join(onto, ["owner", "depth"], "left").select(
            "owner", "depth", "parent", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-totals")
    return now


def trie(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = GROUP,
         heads: int = HEADS) -> DataFrame:
    """Contract of ``op13``: one row per node of the trie of rebuilt conversations."""
    spark = turns.sparkSession
    small_batches(spark, 10_000)
    rows, lengths = rebuilt(ordered(turns, conv, turn, role, text), group, heads)
    size = lengths.agg(F.min("conv").alias("root"), F.max("length").alias("longest"), F.count("*").alias("n")).collect()[0]
    root, rounds = size.root if size.n else 0, (size.longest or 0).bit_length()  # 2^rounds is above every depth
    paths = named(rows, lengths, root, rounds) if rounds else spark.createDataFrame([], "conv long, depth long, owner long, parent long")
    own = rows.select(F.col("conv").alias("owner"), (F.col("pos") + 1).alias("depth"), "chars")
    counted = paths.groupBy("owner", "depth").agg(F.min("parent").alias("parent"), F.count("*").alias("n_convs")).join(own, ["owner", "depth"])
    children = counted.groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = stored(counted.join(children, ["owner", "depth"], "left").select(
        "owner", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-nodes")
    totals = grafted(nodes.select("owner", "depth", "parent", "leaves", "saved"), paths, rounds)
    full = nodes.drop("leaves", "saved", "parent").join(totals, ["owner", "depth"])
    below = full.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = below.where(F.lit(size.n > 0)).select(
        F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(size.n).cast("long").alias("n_convs"), "n_children", F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    ends = paths.join(lengths.withColumnRenamed("length", "depth"), ["conv", "depth"]).select("owner", "depth", "conv").unionByName(
        lengths.where("length = 0").select(F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv"))
    ends = ends.repartition(partitions(spark), "owner", "depth").sortWithinPartitions("owner", "depth", "conv").mapInArrow(
        _ends, "owner long, depth long, ends string")
    return full.select(*top.columns).unionByName(top).join(ends, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
