"""Near copies of texts: SimHash tables propose, the Jaccard similarity of word shingles decides.

Two texts link if their sets of ``WORDS``-word shingles have a Jaccard similarity of ``LIKE`` or more.
Texts with equal sets are one entry, whatever their number.

Each set has a SimHash code. Sets at 0.8 differ in about 15 % of their bits, far more than a plain radius of
three, so the code is cut into several segments, and each entry stands in a segment's table under its own key and
under the keys with one unset bit set: entries that differ in one bit of a segment meet, and half of those that differ in
two. ``plan`` gives segment width and number of tables by the number of rows: buckets stay about as
full at any size, and a pair at 0.8 meets with a chance of ``RECALL`` (pairs more alike more surely).

Inside a bucket, pairs within ``RADIUS`` of ``CHECKED`` bits are joined, and a spanning forest leaves, so groups are
found with as many edges as rows. In each group all pairs within the radius that are not linked through others yet are
then verified on the whole sets, and again a forest leaves. Buckets of over
``BUCKET`` rows and groups of over ``PART_BYTES`` of text are cut into parts, and every two parts meet in a task: no pair
is left out, and none leaves a task unless it links.

ASCII letters are compared in lower case. Null texts are empty; texts without words are equal.
A text shorter than a shingle is one shingle. Rows are told apart by number, so repeated ids and null ids are rows of
their own. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homeledger.llm.common import BROADCAST_ROWS, free_name, scratched, slices, within_rows
from homeledger.llm.components import components
from homeledger.llm.simhash import LOWER, Forest
from homeledger.operators.joins import attach
from homeledger.session import cut_lineage

WORDS = 5
LIKE = 0.8
RECALL = 0.96
APART = 0.152  # share of bits in which sets at LIKE differ: the angle of cosine 2 * 0.8 / 1.8, over pi
CHECKED, RADIUS = 128, 32  # at LIKE 19 bits differ, give or take 4; of texts that have nothing in common 64, give or take 6
NARROWEST = 16
PART_BYTES = 32 << 20
BUCKET = 20_000  # rows of a bucket that are compared in one task
BLOCK = 256
SEED = 42
_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plan(rows: int) -> tuple[int, int]:
    """Width of a segment and number of tables for so many rows."""
    width = min(48, max(NARROWEST, math.ceil(math.log2(max(1, rows))) - 2))
    same = 1 - APART
    met = same ** width + width * APART * same ** (width - 1) + 0.5 * math.comb(width, 2) * APART ** 2 * same ** (width - 2)
    return width, math.ceil(math.log(1 - RECALL) / math.log(1 - met))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8").translate(LOWER).split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends.tolist()[words - 1:] or [len(joined)]
    return np.unique(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64))


def code(hashes: np.ndarray, longs: int) -> np.ndarray:
    """SimHash of a set in ``longs`` times 64 bits: a bit is set if it is in over half the hashes."""
    out = np.zeros(longs, dtype=np.uint64)
    for k in range(longs):
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 65_536):
            mixed = hashes[at:at + 65_536] * FACTORS[k]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * FACTORS[-1 - k]
            mixed ^= mixed >> np.uint64(32)
            counts += np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def segments(bits: np.ndarray, width: int, tables: int) -> list[int]:
    """The keys of a code's segments."""
    flat = np.unpackbits(bits.view(np.uint8), bitorder="little")[:width * tables].reshape(tables, width)
    return (flat.astype(np.int64) << np.arange(width)).sum(axis=1).tolist()


def alike(a: np.ndarray, b: np.ndarray, like: float = LIKE) -> bool:
    if min(len(a), len(b)) < like * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= like * (len(a) + len(b) - shared)


def coded(docs: DataFrame, row: str, text: str, width: int, tables: int) -> DataFrame:
    """(row, digest, bytes, high, low, keys): the digest is that of the whole set, high and low the checked bits."""
    import hashlib

    longs = max(CHECKED // 64, -(-width * tables // 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, digests = batch.column(1).to_pylist(), []
            codes = np.zeros((len(texts), longs), dtype=np.uint64)
            for i, t in enumerate(texts):
                found = shingles(t)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                codes[i] = code(found, longs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array([len(t or "") for t in texts], pa.int64()),
                 *(pa.array(codes[:, k].copy().view(np.int64)) for k in (0, 1)),
                 pa.array([segments(c, width, tables) for c in codes], pa.list_(pa.int64()))],
                names=["row", "digest", "bytes", "high", "low", "keys"])

    return docs.select(row, text).mapInArrow(run, "row bigint, digest binary, bytes bigint, high bigint, low bigint, keys array<bigint>")


def with_one_more_bit(key: str, width: int) -> Column:
    """The key itself and those with one unset bit set."""
    bits = F.array(*[F.lit(1 << b).cast("bigint") for b in range(width)])
    free = F.filter(bits, lambda bit: F.col(key).bitwiseAND(bit) == 0)
    return F.transform(F.concat(F.array(F.lit(0).cast("bigint")), free), lambda bit: F.col(key).bitwiseOR(bit))


def table_rows(entries: DataFrame, width: int) -> DataFrame:
    """Rows (place, key, entry, high, low): each segment's own key, and those with one unset bit set."""
    own = entries.select("entry", "high", "low", F.posexplode("keys").alias("place", "own"))
    return own.select("place", F.explode(with_one_more_bit("own", width)).alias("key"), "entry", "high", "low")


def distances(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Differing bits of each of ``one`` and each of ``others``, both (rows, 2)."""
    return np.bitwise_count(one[:, None, :] ^ others[None, :, :]).sum(axis=2, dtype=np.int64)


def linked_pairs(codes: np.ndarray, split: int = 0, sets: list[np.ndarray] | None = None, like: float = LIKE) -> list[tuple[int, int]]:
    """A forest of positions that connects all pairs within the radius, and with ``sets`` only pairs that are alike: pairs
    of all positions or, with ``split``, of those before it with those from it on."""
    of, found = np.arange(len(codes)), []  # components as one array, so a position is compared with all others at once
    for i in range(split or len(codes)):
        start = split or i + 1
        near = start + np.flatnonzero(np.bitwise_count(codes[start:] ^ codes[i]).sum(axis=1, dtype=np.int64) <= RADIUS)
        while len(near := near[of[near] != of[i]]):
            j, near = int(near[0]), near[1:]
            if sets is None or alike(sets[i], sets[j], like):
                of[of == of[j]] = of[i]
                found.append((i, j))
    return found


def bucket_pairs(codes: np.ndarray, split: int) -> list[tuple[int, int]]:
    """As ``linked_pairs``; most buckets are small and hold no pair."""
    if len(codes) > BLOCK:
        return linked_pairs(codes, split)
    left = codes[:split] if split else codes
    near = distances(left, codes[split:]) <= RADIUS
    forest, found = Forest(len(codes)), []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near if split else np.triu(near, 1)))):
        if forest.join(i, split + j):
            found.append((i, split + j))
    return found


def met_in_parts(df: DataFrame, parts: Column) -> DataFrame:
    """Rows dealt so that every two parts of their group meet: columns one, two and side, which of both a row is of.
    ``parts`` is the number of parts of a row's group."""
    dealt = df.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumns({"one": F.least("part", "other"), "two": F.greatest("part", "other"),
                              "side": (F.col("part") > F.col("other")).cast("int")}).drop("parts", "part", "other")


def full_buckets(entries: DataFrame, width: int, most: int) -> DataFrame:
    """(place, key, parts) of the buckets of over ``most`` rows, from counts of whole keys."""
    own = entries.select(F.posexplode("keys").alias("place", "own")).groupBy("place", "own").agg(F.count("*").alias("n"))
    return own.select("place", F.explode(with_one_more_bit("own", width)).alias("key"), "n").groupBy("place", "key").agg(
        F.sum("n").alias("n")).where(F.col("n") > most).select("place", "key", F.ceil(F.col("n") / most).cast("int").alias("parts"))


def groups(entries: DataFrame, width: int, bucket_rows: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect the entries of each bucket that are within the radius, directly or through others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def work_off() -> list[tuple[int, int]]:
            side, entry, codes = (np.concatenate(x) for x in zip(*held))
            split = int(np.count_nonzero(side == 0)) if at[2] != at[3] else 0
            if len(entry) < 2 or (at[2] != at[3] and not 0 < split < len(entry)):
                return []
            return [(int(entry[i]), int(entry[j])) for i, j in bucket_pairs(codes, split)]

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            codes = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (6, 7)], axis=1)
            new = np.zeros(len(codes), dtype=bool)
            for c in columns[:4]:
                new[1:] |= c[1:] != c[:-1]
            first = np.r_[0, np.flatnonzero(new)]
            last, found = np.r_[first[1:], len(codes)], []
            if held and tuple(c[0] for c in columns[:4]) != at:
                found += work_off()
                held = []
            # a bucket of one row within a batch meets nobody
            whole = last - first > 1
            whole[[0, -1]] = True
            for a, b in zip(first[whole].tolist(), last[whole].tolist()):
                at = tuple(c[a] for c in columns[:4])
                held.append((columns[4][a:b], columns[5][a:b], codes[a:b]))
                if b < len(codes):
                    found += work_off()
                    held = []
            pairs = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], names=["a", "b"])
        if held and (found := work_off()):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    full = cut_lineage(full_buckets(entries, width, bucket_rows), "full")
    few = full.count() <= BROADCAST_ROWS  # there are at most as many as rows / bucket_rows
    rows = table_rows(entries, width).join(F.broadcast(full) if few else full, ["place", "key"], "left")
    order = ["place", "key", "one", "two", "side", "entry"]
    dealt = met_in_parts(rows, F.coalesce("parts", F.lit(1))).select(*order, "high", "low")
    return dealt.repartition(*order[:4]).sortWithinPartitions(*order).mapInArrow(run, "a bigint, b bigint")


def verified(members: DataFrame) -> DataFrame:
    """Edges (a, b) from rows (root, one, two, side, entry, high, low, text): the parts ``one`` and ``two`` of a group meet
    in a task; ``side`` tells which of them a row is of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def work_off() -> pa.RecordBatch:
            codes = np.array([r[:2] for r in rows], dtype=np.int64).view(np.uint64)
            split = 0 if at[1] == at[2] else sum(1 for r in rows if r[2] == 0)
            edges = linked_pairs(codes, split, [r[4] for r in rows]) if at[1] == at[2] or 0 < split < len(rows) else []
            columns = list(zip(*[(rows[i][3], rows[j][3]) for i, j in edges])) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for batch in batches:
            for root, one, two, side, entry, high, low, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, one, two) != at:
                    if rows:
                        yield work_off()
                    at, rows = (root, one, two), []
                rows.append((high, low, side, entry, shingles(text)))
        if rows:
            yield work_off()

    return members.mapInArrow(run, "a bigint, b bigint")


def meetings(members: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(root, one, two, side, entry, high, low): every two parts of a group, each part with itself as well."""
    sizes = cut_lineage(members.groupBy("root").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).where("n > 1"), "sizes")
    sizes = sizes.select("root", F.greatest(F.lit(1), F.ceil(F.col("bytes") / part_bytes)).cast("int").alias("of"), "n")
    return met_in_parts(attach(members.select("root", "entry", "high", "low"), sizes, "root", "n"), F.col("of")).drop("of")


def links(entries: DataFrame, texts: DataFrame, width: int, part_bytes: int = PART_BYTES, bucket_rows: int = BUCKET) -> DataFrame:
    """Verified edges (a, b) between entries. ``entries``: (entry, bytes, high, low, keys); ``texts``: (row, text)."""
    found = components(groups(entries, width, bucket_rows))
    members = cut_lineage(entries.drop("keys").join(found, F.col("entry") == F.col("node")).select(
        F.col("component").alias("root"), "entry", "bytes", "high", "low"), "members")
    wanted = cut_lineage(meetings(members, part_bytes), "meetings")
    used = cut_lineage(within_rows(texts, members.select(F.col("entry").alias("row")), "row").withColumnRenamed("row", "entry"), "used")
    met = wanted.join(used, "entry").select("root", "one", "two", "side", "entry", "high", "low", "text")
    order = ["root", "one", "two", "side", "entry"]
    return verified(met.repartition("root", "one", "two").sortWithinPartitions(*order))


def representatives(numbered: DataFrame, row: str, key: str, text: str, part_bytes: int = PART_BYTES, bucket_rows: int = BUCKET) -> DataFrame:
    """(row, least): for each row, the first row of its group, by key (null last), then row."""
    width, tables = plan(numbered.count())
    rows = cut_lineage(coded(numbered, row, text, width, tables), "sets")
    keys = numbered.select(F.col(row).alias("row"), F.struct(F.col(key).isNull().alias("absent"), F.col(key).alias("key"), F.col(row).alias("row")).alias("rank"))
    facts = rows.groupBy("digest").agg(F.min("row").alias("entry"), F.count("*").alias("n"))
    facts = cut_lineage(facts, "digests")
    first = rows.join(facts.select(F.col("entry").alias("row")), "row", "left_semi").withColumnRenamed("row", "entry")
    entries = cut_lineage(first.select("entry", "bytes", "high", "low", "keys"), "entries")
    edges = links(entries, numbered.select(F.col(row).alias("row"), F.col(text).alias("text")), width, part_bytes, bucket_rows)
    found = components(edges)
    rooted = cut_lineage(facts.join(found, F.col("entry") == F.col("node"), "left").select(
        "digest", "n", F.coalesce("component", "entry").alias("root")), "rooted")
    placed = cut_lineage(attach(rows.select("row", "digest"), rooted, "digest", "n").select("row", "root").join(keys, "row"), "placed")
    least = cut_lineage(placed.groupBy("root").agg(F.min("rank").alias("least"), F.count("*").alias("n")), "least")
    return attach(placed.select("row", "root"), least, "root", "n").select("row", "least")


@scratched
def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES,
                bucket_rows: int = BUCKET) -> DataFrame:
    """(key, component_id), one row per row of ``docs``: the smallest key reachable through links, itself included."""
    numbered = cut_lineage(docs.select(key, text).withColumn(free_name(docs, "row"), F.monotonically_increasing_id()), "numbered")
    row = numbered.columns[-1]
    groups_of = cut_lineage(representatives(numbered, row, key, text, part_bytes, bucket_rows), "groups")
    return numbered.select(key, F.col(row).alias("row")).join(groups_of, "row").select(key, F.col("least")["key"].alias("component_id"))


@scratched
def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES,
                bucket_rows: int = BUCKET) -> DataFrame:
    """One row of each group of near copies: that with the smallest key, null last. All columns stay."""
    row = free_name(docs, "row")
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups_of = cut_lineage(representatives(numbered, row, key, text, part_bytes, bucket_rows), "groups")
    dropped = groups_of.where(F.col("row") != F.col("least")["row"]).select(F.col("row").alias(row))
    return within_rows(numbered, dropped, row, kept=False).select(*[F.col(f"`{c}`") for c in docs.columns])
