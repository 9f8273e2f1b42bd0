"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has bit i set if over half of its word shingles' hashes have it.
Two fingerprints link at ``radius`` (3) or fewer differing bits. With two segments of 32
bits, one of the two differs by at most one bit, so each fingerprint looks up its own
segments and all at one flipped bit: a Hamming ball of 33 keys per segment. Table matches
are verified on all 64 bits.

Only distinct fingerprints enter the tables, whatever the number of copies. A pair at one
flipped bit is looked up from the side that has the bit unset, so once. Tables are
sorted, and each bucket is compared in blocks by numpy within a task; what leaves it is a
spanning forest, at most one edge per row and batch, never its pairs. A bucket with more
than ``BUCKET`` members is dealt over several tasks, and every lookup goes to each.

Null texts are empty; a text without words has fingerprint zero and links like any other.
Repeated rows are documents of their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homeledger.llm.common import ddl
from homeledger.llm.components import components
from homeledger.operators.joins import attach
from homeledger.session import cut_lineage

RADIUS = 3
SEED = 42
WORDS = 3
BUCKET = 20_000  # index rows of one bucket compared in one task
BLOCK = 1024  # of them compared at a time
LARGE = 100_000
LOW = 0xFFFFFFFF
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of the text's word shingles, unsigned."""
    from xxhash import xxh64_intdigest

    # ASCII letters and spaces are single bytes in UTF-8 and in no other character
    parts = (text or "").encode("utf-8").translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends.tolist()[words - 1:] or [len(joined)]
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fp): the fingerprint's bits in a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"{ddl(docs, key)}, fp bigint")


def lookups(distinct: DataFrame) -> DataFrame:
    """Rows (bucket, flip, fp): flip 0 is the fingerprint's own bucket, where others find it;
    the rest are lookups at one flipped bit that it has unset. A bucket's upper bit names
    its segment."""
    bits = F.array(*[F.lit(1 << b).cast("bigint") for b in range(32)])
    own = F.array(F.col("fp").bitwiseAND(LOW), F.shiftrightunsigned("fp", 32).bitwiseOR(1 << 32))
    tables = distinct.select("fp", F.explode(own).alias("own"))
    free = F.filter(bits, lambda bit: F.col("own").bitwiseAND(bit) == 0)
    flips = F.concat(F.array(F.lit(0).cast("bigint")), free)
    return tables.select("fp", "own", F.explode(flips).alias("flip")).select(
        F.col("own").bitwiseOR(F.col("flip")).alias("bucket"), "flip", "fp")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def bucket_edges(members: np.ndarray, seekers: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``members`` and between them and ``seekers``."""
    nodes = np.concatenate([members, seekers])
    forest, edges, m = Forest(len(nodes)), [], len(members)
    for a in range(0, m, BLOCK):
        left = members[a:a + BLOCK]
        for b in range(a, len(nodes), BLOCK):
            close = np.bitwise_count(left[:, None] ^ nodes[None, b:b + BLOCK]) <= radius
            for i, j in zip(*(x.tolist() for x in np.nonzero(close))):
                if forest.join(a + i, b + j):
                    edges.append((int(nodes[a + i]), int(nodes[b + j])))
    return edges


def _search(radius: int):
    """Over rows (bucket, part, seeker, fp), sorted so: members of a part of a bucket are kept,
    seekers are compared with them as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by, held = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            bucket, part, seeker = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fps = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            first = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
            last = np.r_[first[1:], len(fps)]
            edges: list[tuple[int, int]] = []
            # a bucket within one batch matters if it has a member and another row
            inner = (last - first > 1) & (seeker[first] == 0)
            inner[[0, -1]] = True
            for a, b in zip(first[inner].tolist(), last[inner].tolist()):
                n = int(np.count_nonzero(seeker[a:b] == 0))
                if held_by == (bucket[a], part[a]):
                    edges += bucket_edges(held, fps[a:b], radius)
                    members = np.concatenate([held, fps[a:a + n]])
                    if n:
                        edges += bucket_edges(fps[a:a + n], fps[a + n:b], radius)
                else:
                    members = fps[a:a + n]
                    edges += bucket_edges(members, fps[a + n:b], radius)
                if b == len(fps):
                    held_by, held = (bucket[a], part[a]), members.copy()
            x = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], names=["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` linked directly or through others."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments with one flipped bit find up to 3 differing bits")
    # at most 2 * LARGE buckets are larger than this, so the table of their parts can be broadcast
    most = max(bucket_rows, distinct.count() // LARGE)
    own = distinct.select(F.explode(F.array(F.col("fp").bitwiseAND(LOW), F.shiftrightunsigned("fp", 32).bitwiseOR(1 << 32))).alias("bucket"))
    parts = own.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > most).select(
        "bucket", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    dealt = lookups(distinct).join(F.broadcast(parts), "bucket", "left")
    split = F.coalesce("parts", F.lit(1))
    dealt = dealt.select("bucket", "flip", "fp", split.alias("parts"), F.explode(F.sequence(F.lit(0), split - 1)).alias("part"))
    member = (F.col("flip") == 0) & (F.pmod(F.xxhash64("fp"), "parts") == F.col("part"))
    rows = dealt.select("bucket", "part", F.when(member, 0).otherwise(1).alias("seeker"), "fp")
    return (
        rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "seeker", "fp")
        .mapInArrow(_search(radius), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id): the smallest key reachable through links, itself included."""
    prints = cut_lineage(fingerprints(docs, key, text, words), "prints")
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min(key).alias("least"), F.count("*").alias("n")), "distinct")
    found = components(links(distinct, radius))
    rooted = cut_lineage(
        distinct.join(found, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", "n", F.coalesce("component", "fp").alias("root")), "rooted")
    roots = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fps")), "roots")
    facts = cut_lineage(attach(rooted.select("fp", "n", "root"), roots, "root", "fps").select("fp", "n", "component_id"), "facts")
    return attach(prints, facts, "fp", "n").select(key, "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
