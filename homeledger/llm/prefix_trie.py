"""Conversation prefix trie, by truncation peeling.

Each distinct sequence of first d turns is a node of depth d; the root is the empty sequence. A
conversation is kept as its path, the digests of its turns one after another, so a prefix is
a prefix of the path and "strip the last turn" is a cut of fixed width.

Peeling descends from the greatest depth. At each depth the nodes that survive from below, stripped of their
last turn, are merged with the conversations that end here, and grouped; the same grouping finds
the nodes and sums what is known of their subtrees, so no node is visited again. Conversations that are alike
are one row from the start, whatever their number. A round is one aggregate, combined before its shuffle, and a written table.

Below the depth from which a conversation shares its prefix with no other, its nodes form a chain whose
sums follow from its own turns. Such tails are cut off first, at the first multiple of ``STRIDE`` turns
at which the prefix is alone, so the rounds are as many as the longest shared prefix has turns, not the longest conversation.

The ids that end at a node are hashed in order. They are sorted by ranges of (path, id), so many tasks share a
node that holds most ids; each task writes its ids as text, and one streams these texts into the hash, a
megabyte at a time.

Null roles and texts are empty; null turns come first; turns of equal number are ordered by their digest, and
repeated rows are turns of their own. Rows without a conversation id are not used. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homeledger.llm.common import scratched
from homeledger.operators.joins import attach
from homeledger.session import cut_lineage

WIDTH = 32  # hex digits of a turn's digest in a path: 128 bits of SHA-256
IDS_AT_ONCE = 50_000
STRIDE = 8
NO_IDS = hashlib.sha256(b"").hexdigest()


def conversation_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the digest and the code points of each turn in order; texts themselves do not travel."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.left(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), F.lit(WIDTH))
    narrow = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.length(said).alias("chars")).alias("t"))
    return narrow.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def with_heads(convs: DataFrame, source: Column, length: Column, most: int) -> DataFrame:
    """Each conversation's first ``length`` turns, ``most`` at the utmost, replaced by those of the conversation
    ``source``; fewer if that has fewer, none if it is not there."""
    heads = convs.select(F.col("conv_id").alias("source"), F.slice("turns", 1, most).alias("head"))
    wanted = convs.withColumns({"source": source, "given": F.least(length.cast("int"), F.lit(most))})
    head = F.coalesce(F.slice("head", F.lit(1), F.col("given")), F.expr("slice(turns, 1, 0)"))
    return wanted.join(heads, "source", "left").select(
        "conv_id", F.concat(head, F.slice("turns", F.col("given") + 1, F.size("turns"))).alias("turns"))


def paths_of(convs: DataFrame) -> DataFrame:
    """(conv_id, path, sizes, depth)."""
    return convs.select("conv_id", F.array_join(F.col("turns.digest"), "").alias("path"), F.col("turns.chars").alias("sizes"),
                        F.size("turns").alias("depth"))


def ids_digest(paths: DataFrame) -> DataFrame:
    """(path, ends_sha256): SHA-256 of the ids that end at a path, ascending, joined by commas."""
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids = None, []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()))],
                                              names=["path", "first", "ids"])

        for batch in batches:
            rows = []
            for p, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (p != path or len(ids) >= IDS_AT_ONCE):
                    rows.append((path, ids[0], ",".join(map(str, ids))))
                    ids = []
                path = p
                ids.append(i)
            yield out(rows)
        if ids:
            yield out([(path, ids[0], ",".join(map(str, ids)))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, digest = None, None
        for batch in batches:
            rows = []
            for p, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is None or p != path:
                    if digest is not None:
                        rows.append((path, digest.hexdigest()))
                    path, digest = p, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "ends_sha256"), r)) for r in rows], schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"path": path, "ends_sha256": digest.hexdigest()}], schema)

    schema = pa.schema([("path", pa.string()), ("ends_sha256", pa.string())])
    texts = (paths.select("path", F.col("conv_id").cast("bigint").alias("conv_id")).repartitionByRange("path", "conv_id")
             .sortWithinPartitions("path", "conv_id").mapInArrow(written, "path string, first bigint, ids string"))
    return texts.repartition("path").sortWithinPartitions("path", "first").mapInArrow(hashed, "path string, ends_sha256 string")


def shorten(ended: DataFrame) -> DataFrame:
    """``ended`` with ``kept``: the first multiple of ``STRIDE`` turns from which a conversation is alone, or its depth."""
    cuts = ended.where(F.col("depth") >= STRIDE).select(
        "conv_id", "path", F.explode(F.sequence(F.lit(STRIDE), "depth", F.lit(STRIDE))).alias("cut")).select(
        "conv_id", "cut", F.sha2(F.left("path", F.col("cut") * WIDTH), 256).alias("prefix"))
    alone = cuts.groupBy("prefix").agg(F.count("*").alias("rows"), F.min("conv_id").alias("conv_id"), F.min("cut").alias("cut")).where("rows = 1")
    first = alone.groupBy("conv_id").agg(F.min("cut").alias("cut"))
    return ended.join(first, "conv_id", "left").withColumn("kept", F.coalesce("cut", "depth")).drop("cut")


def _saved(first: Column) -> Column:
    """Tokens saved by the turns from ``first`` on of conversations that are alike."""
    rest = F.slice("sizes", first, F.size("sizes"))
    return (F.col("n") - 1) * F.aggregate(rest, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def tails(ended: DataFrame) -> DataFrame:
    """The nodes below ``kept``, each the only child of the one above."""
    deeper = ended.where("kept < depth").select("*", F.explode(F.sequence(F.col("kept") + 1, "depth")).alias("at"))
    last = F.col("at") == F.col("depth")
    return deeper.select(
        "conv_id", F.col("at").cast("bigint").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        _saved(F.col("at")).alias("saved"), F.when(last, F.col("ends_sha256")).otherwise(NO_IDS).alias("ends_sha256"))


def peel(ended: DataFrame, deepest: int) -> DataFrame:
    """Nodes (path, depth, conv_id, n_convs, n_ended, n_children, n_leaves, saved) of depth ``kept`` and less: ``ended``
    has one row per distinct whole conversation."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    facts = ["n_convs", "n_ended", "n_children", "n_leaves", "saved"]
    whole = F.col("kept") == F.col("depth")
    entering = cut_lineage(ended.select(
        "kept", F.left("path", F.col("kept") * WIDTH).alias("path"), F.slice("sizes", F.lit(1), F.col("kept")).alias("sizes"), "conv_id",
        F.col("n").alias("n_convs"), F.when(whole, F.col("n")).otherwise(zero).alias("n_ended"),
        F.when(whole, zero).otherwise(one).alias("n_children"), F.when(whole, zero).otherwise(one).alias("n_leaves"),
        _saved(F.col("kept") + 1).alias("saved")).repartitionByRange("kept", "path"), "entering")
    below, levels = None, None
    for depth in range(deepest, -1, -1):
        rows = entering.where(F.col("kept") == depth).drop("kept")
        if below is not None:
            rows = rows.unionByName(below.select(
                F.left("path", F.lit(WIDTH * depth)).alias("path"), F.slice("sizes", 1, depth).alias("sizes"), "conv_id", "n_convs",
                zero.alias("n_ended"), one.alias("n_children"), "n_leaves", "saved"))
        grouped = rows.groupBy("path", "sizes").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in facts])
        own = (F.col("n_convs") - 1) * F.coalesce(F.try_element_at("sizes", F.lit(-1)), F.lit(0)) if depth else zero
        below = cut_lineage(grouped.select(
            "path", "sizes", F.lit(depth).cast("bigint").alias("depth"), "conv_id", "n_convs", "n_ended", "n_children",
            F.greatest("n_leaves", one).alias("n_leaves"), (F.col("saved") + own).alias("saved")), "level")
        level = below.drop("sizes")
        levels = level if levels is None else levels.unionByName(level)
    return levels


@scratched
def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node from (conv_id, turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    paths = cut_lineage(paths_of(convs), "paths")
    grouped = paths.groupBy("path", "sizes", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    ended = cut_lineage(grouped.join(ids_digest(paths), "path"), "ended")
    ended = cut_lineage(shorten(ended), "shortened")
    deepest = ended.agg(F.max("kept")).first()[0]
    nodes = cut_lineage(peel(ended, 0 if deepest is None else deepest), "nodes")
    parents = nodes.where("n_children > 0").select(
        F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    below = nodes.where("depth > 0").withColumn("parent", F.left("path", (F.col("depth").cast("int") - 1) * WIDTH))
    placed = attach(below, parents, "parent", "weight").drop("parent").unionByName(
        nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast(nodes.schema["conv_id"].dataType)))
    hashes = ended.where("kept = depth").select("path", "ends_sha256")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    met = placed.where("n_ended > 0").join(hashes, "path").select(*columns)
    passed = placed.where("n_ended = 0").withColumn("ends_sha256", F.lit(NO_IDS)).select(*columns)
    return met.unionByName(passed).unionByName(tails(ended).select(*columns)).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "depth", F.col("parent_conv_id").cast("bigint").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
