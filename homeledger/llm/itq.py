"""Near-duplicate vectors by iterative quantisation.

A rotation of the principal axes is learned on a bounded sample so that cutting each rotated
coordinate at its median gives balanced bits that keep angles best. Every vector is coded.
Codes are cut into segments with one table each; a code looks up its own buckets and those
within ``ball`` flipped bits, and pairs within ``reach`` bits over the whole code are
candidates, each kept in the first table that finds it. Candidates are reranked with the
original vectors by cosine in double precision; pairs below ``cosine`` never link.

Equal vectors are one entry, whatever their number. Entries are dealt by hash into blocks of bounded
size, and a task holds two blocks: it builds the tables of one, and the entries of the other look
their buckets up in it. So a vector is sent to as many tasks as there are blocks, whatever ``ball`` is, and
neither lookups nor candidates nor pairs leave a task: what leaves is a count per entry and a spanning
forest. The sample bound (``SAMPLE`` vectors) concerns the rotation alone.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components link with nothing and stand alone. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from homeledger.llm.common import ddl
from homeledger.llm.components import components
from homeledger.operators.joins import attach
from homeledger.session import cut_lineage

COSINE = 0.9
SAMPLE = 20_000
BITS = 64
SEGMENT = 16
BALL = 2
REACH = 24
ROUNDS = 40
BUCKET = 100_000  # entries of a block at most
BLOCK_BYTES = 64 << 20  # of a block's vectors in double precision at most
SPREAD, LEAST = 8, 1_000  # fewer entries are dealt into so many blocks, for the cores, of so many entries at least
LOOKUPS, PAIRS = 1 << 17, 1 << 19  # buckets looked up and pairs compared at a time


class Rotation:
    """Centre, axes and cuts of a binary code."""

    def __init__(self, centre: np.ndarray, axes: np.ndarray, cuts: np.ndarray):
        self.centre, self.axes, self.cuts = centre, axes, cuts

    def code(self, x: np.ndarray) -> np.ndarray:
        """Codes of unit vectors as signed longs; missing bits are 0."""
        bits = np.zeros((len(x), 64), dtype=np.uint8)
        bits[:, :self.axes.shape[1]] = (x - self.centre) @ self.axes > self.cuts
        return np.packbits(bits, axis=1, bitorder="little").view("<i8").reshape(-1)


def learn_rotation(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Rotation:
    """Iterative quantisation: rotate the principal axes towards the corners of a cube."""
    centre = x.mean(axis=0)
    centred = x - centre
    bits = min(bits, x.shape[1])
    _, vectors = np.linalg.eigh(centred.T @ centred)
    axes = vectors[:, ::-1][:, :bits]
    v = centred @ axes
    r, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    turned = v @ r
    return Rotation(centre, axes @ r, np.median(turned, axis=0))


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a list column, and which rows have one."""
    rows = np.zeros((len(column), dim))
    good = np.zeros(len(column), dtype=bool)
    for i, v in enumerate(column):
        own = v.values
        if own is not None and len(own) == dim and own.null_count == 0:
            rows[i], good[i] = own.to_numpy(zero_copy_only=False), True
    good &= np.isfinite(rows).all(axis=1)
    rows[~good] = 0
    norm = _norms(rows)
    good &= norm > 0
    rows[good] /= norm[good, None]
    return rows, good


def _norms(rows: np.ndarray) -> np.ndarray:
    """Scaled first, so that tiny and huge components neither vanish nor overflow."""
    top = np.abs(rows).max(axis=1, initial=0.0)
    return top * np.sqrt(((rows / np.where(top > 0, top, 1.0)[:, None]) ** 2).sum(axis=1))


def most_common_length(vectors: DataFrame, column: str) -> int:
    row = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0


def sample_vectors(vectors: DataFrame, column: str, dim: int, bound: int = SAMPLE) -> np.ndarray:
    """About ``bound`` unit vectors at most, chosen by hash; the rotation is learned from them alone."""
    fit = vectors.where(F.size(column) == dim)
    share = min(1.0, bound / max(1, fit.count()))
    chosen = fit.where(F.xxhash64(column) / F.lit(2.0 ** 64) + 0.5 < share).select(column).limit(2 * bound)
    x, good = _matrix(chosen.toArrow().column(0).combine_chunks(), dim)
    return x[good]


def unit_vectors(column: pa.Array, dim: int) -> np.ndarray:
    """The same unit vectors as ``_matrix`` makes, of rows that are all known to have one."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return rows / _norms(rows)[:, None]


def coded(vectors: DataFrame, key: str, column: str, rotation: Rotation, dim: int) -> DataFrame:
    """(key, digest, code, vector): all but the key are null where a vector links with nothing."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = _matrix(batch.column(1), dim)
            codes = rotation.code(x)
            digest = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() if g else None for r, g in zip(x, good)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(codes, pa.int64(), mask=~good), batch.column(1)],
                names=[key, "digest", "code", "vector"])

    kind = vectors.schema[column].dataType.simpleString()
    rows = vectors.select(key, column).mapInArrow(run, f"{ddl(vectors, key)}, digest binary, code bigint, vector {kind}")
    return rows.withColumn("vector", F.when(F.col("digest").isNotNull(), F.col("vector")))


def ball_masks(ball: int, width: int = SEGMENT) -> list[int]:
    """All ways to flip up to ``ball`` bits of a segment."""
    return [sum(1 << b for b in bits) for n in range(ball + 1) for bits in combinations(range(width), n)]


def block_count(entries: int, dim: int) -> int:
    """Blocks of at most ``BUCKET`` entries and ``BLOCK_BYTES``; up to ``SPREAD`` where fewer would do."""
    most = max(1, min(BUCKET, BLOCK_BYTES // (8 * dim)))
    return max(1, -(-entries // most), min(SPREAD, entries // LEAST))


MEMBER, SEEKER, BOTH = 0, 1, 2


def dealt(entries: DataFrame, blocks: int) -> DataFrame:
    """Rows (side, entry, code, n, vector), a partition for each two blocks and for each with itself. Of two
    blocks the entries of one are members and those of the other seekers; of one block they are both."""
    own, other = F.col("own"), F.col("other")
    high, low = F.greatest(own, other), F.least(own, other)
    rows = entries.withColumn("own", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pair = F.shiftright(high * (high + 1), 1) + low
    side = F.when(own == other, BOTH).when(own < other, MEMBER).otherwise(SEEKER)
    return rows.select(pair.alias("pair"), side.alias("side"), "entry", "code", "n", "vector").repartitionById(
        blocks * (blocks + 1) // 2, F.col("pair")).drop("pair")


class Block(NamedTuple):
    entry: np.ndarray
    code: np.ndarray
    n: np.ndarray
    unit: np.ndarray


def segment(code: np.ndarray, table: int) -> np.ndarray:
    return ((code.view(np.uint64) >> np.uint64(SEGMENT * table)) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64)


def table_pairs(members: np.ndarray, seekers: np.ndarray, table: int, ball: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (member, seeker) of the codes whose segment differs by at most ``ball`` bits, some ``PAIRS`` at a time."""
    own, sought = segment(members, table), segment(seekers, table)
    order = np.argsort(own, kind="stable")
    begins = np.searchsorted(own[order], np.arange((1 << SEGMENT) + 1))
    masks = np.array(ball_masks(ball))
    step = max(1, LOOKUPS // max(1, len(sought)))
    for m in range(0, len(masks), step):
        bucket = (masks[m:m + step, None] ^ sought).reshape(-1)
        many = begins[bucket + 1] - begins[bucket]
        found = np.flatnonzero(many)
        first, many, found = begins[bucket[found]], many[found], found % len(sought)
        total, at = np.cumsum(many), 0
        while at < len(found):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
            count = many[at:stop]
            k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            yield order[np.repeat(first[at:stop], count) + k], np.repeat(found[at:stop], count)
            at = stop


def candidates(members: Block, seekers: Block, tables: int, ball: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs that are in a table, each in the first, and within reach; of a block with itself each pair
    once, from its larger entry."""
    for t in range(tables):
        for i, j in table_pairs(members.code, seekers.code, t, ball):
            differ = (members.code[i] ^ seekers.code[j]).view(np.uint64)
            good = np.bitwise_count(differ) <= reach
            if members is seekers:
                good &= seekers.entry[j] > members.entry[i]
            i, j, differ = i[good], j[good], differ[good]
            for earlier in range(t):
                good = np.bitwise_count((differ >> np.uint64(SEGMENT * earlier)) & np.uint64((1 << SEGMENT) - 1)) > ball
                i, j, differ = i[good], j[good], differ[good]
            yield i, j


def links(rows: DataFrame, dim: int, tables: int, cosine: float, ball: int = BALL, reach: int = REACH) -> DataFrame:
    """From ``dealt`` entries: (a, b, linked). Rows with ``linked`` count the vectors that ``a`` links with
    in a task; rows without are edges that connect what is linked. At most two rows per entry leave a task."""
    from homeledger.llm.simhash import Forest

    def read(batches: Iterator[pa.RecordBatch]) -> tuple[Block, Block]:
        parts = {side: [] for side in (MEMBER, SEEKER, BOTH)}
        for batch in batches:
            sides = batch.column("side").to_numpy(zero_copy_only=False)
            whole = Block(*[batch.column(c).to_numpy(zero_copy_only=False) for c in ("entry", "code", "n")], unit_vectors(batch.column("vector"), dim))
            for side, blocks in parts.items():
                if (sides == side).any():
                    blocks.append(Block(*[v[sides == side] for v in whole]))
        none = Block(*[np.zeros(0, dtype=np.int64)] * 3, np.zeros((0, dim)))
        found = {side: Block(*map(np.concatenate, zip(*blocks))) if blocks else none for side, blocks in parts.items()}
        return (found[BOTH], found[BOTH]) if parts[BOTH] else (found[MEMBER], found[SEEKER])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, seekers = read(batches)
        if not len(members.entry) or not len(seekers.entry):
            return
        m = 0 if members is seekers else len(members.entry)  # where the seekers begin among all entries of the task
        entry = seekers.entry if members is seekers else np.concatenate([members.entry, seekers.entry])
        linked, forest, edges = np.zeros(len(entry)), Forest(len(entry)), []
        for i, j in candidates(members, seekers, tables, ball, reach):
            near = np.concatenate([
                np.einsum("ij,ij->i", members.unit[i[k:k + 65_536]], seekers.unit[j[k:k + 65_536]]) >= cosine
                for k in range(0, max(1, len(i)), 65_536)])
            i, j = i[near], j[near]
            if len(i):
                np.add.at(linked, i, seekers.n[j])
                np.add.at(linked, m + j, members.n[i])
                edges += [(a, b) for a, b in zip(i.tolist(), (m + j).tolist()) if forest.join(a, b)]
        who = np.flatnonzero(linked)
        a, b = np.array(edges, dtype=np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[entry[who], entry[a]]), pa.array([None] * len(who) + entry[b].tolist(), pa.int64()),
             pa.array(linked[who].astype(np.int64).tolist() + [None] * len(a), pa.int64())], names=["a", "b", "linked"])

    return rows.mapInArrow(run, "a bigint, b bigint, linked bigint")


def near_duplicate_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE,
                           bits: int = BITS, ball: int = BALL, reach: int = REACH, sample: int = SAMPLE) -> DataFrame:
    """Per vector: key, n_links (other vectors linked directly), component_id (smallest key
    reachable, itself included), kept (it is that key)."""
    dim = most_common_length(vectors, column)
    if not dim:
        return vectors.select(key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    learned = sample_vectors(vectors, column, dim, sample)
    rotation = learn_rotation(learned if len(learned) else np.eye(dim), bits)
    tables = max(1, min(bits, dim) // SEGMENT)
    rows = cut_lineage(coded(vectors, key, column, rotation, dim).withColumn("row", F.monotonically_increasing_id()), "coded")
    good = rows.where(F.col("digest").isNotNull())
    groups = good.groupBy("digest").agg(F.min("row").alias("entry"), F.min(key).alias("least"), F.count("*").alias("n"))
    groups = cut_lineage(groups, "groups")
    entries = groups.select("entry", "n").join(good.select(F.col("row").alias("entry"), "code", "vector"), "entry")
    linked = cut_lineage(links(dealt(entries, block_count(groups.count(), dim)), dim, tables, cosine, ball, reach), "links")
    degrees = linked.where(F.col("linked").isNotNull()).groupBy(F.col("a").alias("entry")).agg(F.sum("linked").alias("linked"))
    edges = linked.where(F.col("b").isNotNull()).select("a", "b")
    rooted = (
        groups.join(degrees, "entry", "left")
        .join(components(edges).withColumnRenamed("node", "entry"), "entry", "left")
        .select("digest", "least", "n", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "entry").alias("root")))
    rooted = cut_lineage(rooted, "rooted")
    roots = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("entries")), "roots")
    facts = cut_lineage(attach(rooted, roots, "root", "entries").select("digest", "n", "n_links", "component_id"), "facts")
    linked = attach(good.select(key, "digest"), facts, "digest", "n").select(
        key, "n_links", "component_id", (F.col(key) == F.col("component_id")).alias("kept"))
    alone = rows.where(F.col("digest").isNull()).select(
        key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)
