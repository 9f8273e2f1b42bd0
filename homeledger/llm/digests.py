"""Document fingerprints from improbable byte windows.

Every window of 64 bytes has an entropy. How rare its entropy class is over the whole corpus
ranks it: improbable windows come first. Among any 64 neighbouring windows the leftmost of
the lowest rank gets a vote, and windows with enough votes are the document's features; where
none has enough, the one with the most votes is (of those the lowest rank, then the leftmost).
They are hashed into a chain of Bloom filters of 2048 bits, a new one after 160 features. The
likeness of two fingerprints is the overlap of their filters' bits, above what chance gives
and relative to the most possible, averaged over the shorter chain.

Entropies of all windows come from two counts per byte (how often its value occurs among the
63 bytes before and after it) and integer sums, so they are exact and do not depend on what
else is in a batch: equal texts have equal fingerprints. Texts are bytes in UTF-8. A text
shorter than a window is one feature; an empty or null one has none and the fingerprint
``""``. Two empty fingerprints are alike (1.0), an empty and another one are not (0.0).

Memory is a block of windows, whatever a text's length, plus the texts of one Arrow batch.
Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from homeledger.llm.common import ddl

WINDOW = 64
NEIGHBOURS = 64
VOTES = 16
CLASSES = 512
BITS = 2048
HASHES = 5
FEATURES = 160
BLOCK = 1 << 19  # bytes of text worked on at a time
BUCKET_ROWS = 10_000
SCALE = 1 << 20
_C = np.arange(WINDOW + 1)
CLOGC = np.round(SCALE * _C * np.log2(np.maximum(_C, 1))).astype(np.int64)
WORST = np.int64(np.iinfo(np.int64).max)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class of each whole window in ``data``: 0 for one repeated byte, ``CLASSES`` for all different."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    later = np.zeros(len(data), dtype=np.uint8)  # equal bytes among the next 63
    before = np.zeros(len(data), dtype=np.uint8)  # and among the last 63
    for k in range(1, min(WINDOW, len(data))):
        same = (data[k:] == data[:-k]).view(np.uint8)
        later[:-k] += same
        before[k:] += same
    counts = np.bincount(data[:WINDOW], minlength=256)
    total = np.empty(n, dtype=np.int64)  # sum of c log c over the byte values of a window
    total[0] = CLOGC[counts].sum()
    step = CLOGC[1:] - CLOGC[:-1]
    total[1:] = step[before[WINDOW:]] - step[later[:n - 1]]
    np.cumsum(total, out=total)
    most = CLOGC[WINDOW]
    return (most - total) * CLASSES // most


def window_rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of the corpus have each entropy class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES + 1, dtype=np.int64)
        for batch in batches:
            for joined, starts, ends in blocks([(t or "").encode() for t in batch.column(0).to_pylist()]):
                classes = entropy_classes(joined)
                inside = np.zeros(len(classes) + 1, dtype=np.int64)
                long = ends - starts >= WINDOW
                np.add.at(inside, starts[long], 1)
                np.add.at(inside, ends[long] - WINDOW + 1, -1)
                counts += np.bincount(classes[np.cumsum(inside)[:-1] > 0], minlength=CLASSES + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 1)), pa.array(counts)], names=["class", "n"])

    rows = docs.select(text).mapInArrow(run, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(CLASSES + 1, dtype=np.int64)
    for row in rows:
        out[row["class"]] = row["n"]
    return out


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to blocks of about ``BLOCK`` bytes, with where each begins and ends. A longer
    text comes in several blocks that overlap by one window less a byte."""
    pending: list[bytes] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(p) for p in pending])
        return np.frombuffer(b"".join(pending), dtype=np.uint8), np.r_[0, ends[:-1]], ends

    for text in texts:
        for at in range(0, max(1, len(text) - WINDOW + 1), BLOCK):
            pending.append(text[at:at + BLOCK + WINDOW - 1])
            size += len(pending[-1])
            if size >= BLOCK:
                yield joined()
                pending, size = [], 0
    if pending:
        yield joined()


def sliding_least(keys: np.ndarray) -> np.ndarray:
    """The least of each ``NEIGHBOURS`` consecutive keys."""
    least, width = keys, 1
    while width < NEIGHBOURS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return least


def _chosen_in(classes: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Votes for each window of a run of neighbouring windows."""
    n = len(classes)
    keys = rank[classes] * n + np.arange(n)
    if n < NEIGHBOURS:
        return np.bincount([int(keys.min() % n)], minlength=n)
    return np.bincount(sliding_least(keys) % n, minlength=n)


def _votes(text: bytes, rank: np.ndarray) -> np.ndarray:
    """Votes for each window of a text of at least a window."""
    windows = len(text) - WINDOW + 1
    votes = np.zeros(windows, dtype=np.int32)
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, max(1, windows - NEIGHBOURS + 1), BLOCK):
        stop = min(windows, at + BLOCK + NEIGHBOURS - 1)
        votes[at:stop] += _chosen_in(entropy_classes(data[at:stop + WINDOW - 1]), rank).astype(np.int32)
    return votes


def feature_starts(text: bytes, rank: np.ndarray) -> np.ndarray:
    """Where the features of one text of at least a window begin."""
    votes = _votes(text, rank)
    return np.flatnonzero(votes >= min(VOTES, max(1, len(votes) - NEIGHBOURS + 1)))


def most_voted(text: bytes, rank: np.ndarray) -> np.ndarray:
    """Where the window with the most votes begins: of those the lowest rank, then the leftmost."""
    votes = _votes(text, rank)
    found = np.flatnonzero(votes == votes.max())
    data = np.frombuffer(text, dtype=np.uint8)
    ranks = []
    for at in range(0, len(votes), BLOCK):
        inside = found[(found >= at) & (found < at + BLOCK)]
        if len(inside):
            ranks.append(rank[entropy_classes(data[at:at + BLOCK + WINDOW - 1])[inside - at]])
    return found[[np.argmin(np.concatenate(ranks))]]


def many_feature_starts(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The same for many texts, short ones together."""
    out: list[np.ndarray | None] = [None] * len(texts)
    some: list[int] = []

    def together() -> None:
        ends = np.cumsum([len(texts[i]) for i in some])
        starts = np.r_[0, ends[:-1]]
        data = np.frombuffer(b"".join(texts[i] for i in some), dtype=np.uint8)
        n = len(data)
        keys = np.full(n, WORST)
        classes = entropy_classes(data)
        keys[:len(classes)] = rank[classes] * n + np.arange(len(classes))
        # runs of neighbours that lie within one text
        runs = np.zeros(n + 1, dtype=np.int64)
        np.add.at(runs, starts, 1)
        np.add.at(runs, ends - WINDOW - NEIGHBOURS + 2, -1)
        whole = np.flatnonzero(np.cumsum(runs)[:-1] > 0)
        votes = np.bincount(sliding_least(keys)[whole] % n, minlength=n)
        found = np.flatnonzero(votes)
        owner = np.searchsorted(ends, found, side="right")
        need = np.minimum(VOTES, ends - starts - WINDOW - NEIGHBOURS + 2)
        good = votes[found] >= need[owner]
        found, owner = found[good], owner[good]
        cut = np.searchsorted(owner, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            out[i] = found[cut[k]:cut[k + 1]] - starts[k]
        some.clear()

    size = 0
    for i, text in enumerate(texts):
        if len(text) < WINDOW + NEIGHBOURS - 1 or len(text) > BLOCK:
            out[i] = feature_starts(text, rank) if len(text) >= WINDOW else np.zeros(1 if text else 0, dtype=np.int64)
            continue
        some.append(i)
        size += len(text)
        if size >= BLOCK:
            together()
            size = 0
    if some:
        together()
    return out


def filters(text: bytes, starts: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, a row of 64-bit words each."""
    from xxhash import xxh3_64_intdigest

    hashes = list(dict.fromkeys(xxh3_64_intdigest(text[a:a + WINDOW]) for a in starts.tolist()))
    h = np.array(hashes, dtype=np.uint64)
    bits = np.zeros((-(-len(h) // FEATURES), BITS), dtype=np.uint8)
    chain = np.arange(len(h)) // FEATURES
    for k in range(HASHES):
        bits[chain, ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def fingerprint_string(chain: np.ndarray) -> str:
    """The filters one after another in base64."""
    return base64.b64encode(chain.astype("<u8").tobytes()).decode()


def chain_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u8").reshape(-1, BITS // 64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1. Each filter of the shorter chain counts with its best match in the other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    size_a, size_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    if (len(a), size_a.sum()) > (len(b), size_b.sum()):
        a, b, size_a, size_b = b, a, size_b, size_a
    total = 0.0
    for words, size in zip(a, size_a):
        shared = np.bitwise_count(b & words).sum(axis=1, dtype=np.int64)
        chance = size * size_b / BITS
        total += max(0.0, float(((shared - chance) / (np.minimum(size, size_b) - chance)).max()))
    return min(1.0, total / len(a))


def fingerprint_many(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    data = [t.encode("utf-8") for t in texts]
    voted = many_feature_starts(data, rank)
    return [filters(t, starts if len(starts) or not t else most_voted(t, rank)) for t, starts in zip(data, voted)]


def fingerprints(docs: DataFrame, rarity: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint)."""
    rank = np.argsort(np.argsort(rarity, kind="stable"), kind="stable").astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chains = fingerprint_many([t or "" for t in batch.column(1).to_pylist()], rank)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(fingerprint_string, chains), pa.string())], names=[key, "fingerprint"])

    return docs.select(key, text).mapInArrow(run, f"{ddl(docs, key)}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def place(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sixteen bytes that order as descending ids, then ascending hashes."""
    high, low = ~ids.astype(np.int64), hashes.astype(np.int64)
    both = np.stack([high, low], axis=1).view(np.uint64) ^ np.uint64(1 << 63)  # signed order as unsigned
    return np.ascontiguousarray(both.astype(">u8")).view("S16").reshape(-1)


def in_order(docs: DataFrame, key: str, text: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows (key, text, bucket, guest) in descending order of the key, then by a hash of the text, dealt out by ranges of both.

    Each bucket also gets, as a guest, the first row of the next one; the last bucket gets the
    first row of all. Ranges come from a pass over the keys and hashes alone; one pair per range comes
    to the driver, that is one per ``bucket_rows`` rows. Null keys come last. Rows of one key and different texts
    go to different buckets; equal rows share a bucket.
    """
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    keys = docs.select(order.alias("k"), F.xxhash64(text).alias("h"))
    ranges = max(1, -(-docs.count() // bucket_rows))
    firsts = keys.repartitionByRange(ranges, F.desc("k"), F.asc("h")).groupBy(F.spark_partition_id()).agg(
        F.min_by(F.struct("k", "h"), F.struct(F.bitwise_not("k"), "h")).alias("top")).collect()
    tops = np.sort(place(np.array([r["top"]["k"] for r in firsts], dtype=np.int64), np.array([r["top"]["h"] for r in firsts], dtype=np.int64)))
    n = len(tops)

    def buckets(ids, hashes):
        """Own bucket, and the one to visit as a guest."""
        import pandas as pd

        at = place(ids.to_numpy(), hashes.to_numpy())
        own = np.searchsorted(tops, at, side="right") - 1
        return pd.Series([[int(b), int((b - 1) % n)] if f else [int(b)] for b, f in zip(own, tops[own] == at)])

    where = F.pandas_udf(buckets, "array<int>")
    dealt = (
        docs.select(F.col(key), F.col(text), order.alias("k"), F.xxhash64(text).alias("h"))
        .select(key, text, "k", "h", F.posexplode(where("k", "h")).alias("guest", "bucket")))
    return (
        dealt.repartitionById(max(1, n), F.col("bucket"))
        .sortWithinPartitions("bucket", "guest", F.desc("k"), "h", text).select(key, text, "bucket", "guest"))


def compare_with_next(docs: DataFrame, rarity: np.ndarray, key: str = "doc_id", text: str = "text",
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, and likenesses."""
    rank = np.argsort(np.argsort(rarity, kind="stable"), kind="stable").astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that still waits for its next one: (key, text, chain)
        for batch in batches:
            keys = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            guests = batch.column(3).to_pylist()
            chains = fingerprint_many(texts, rank)
            rows = [*([last] if last else []), *((keys[i], texts[i], chains[i], guests[i]) for i in range(len(texts)))]
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[3]]
            last = rows[-1]
            changed = [edited(a[1], b[1]) for a, b in pairs]
            other = fingerprint_many(changed, rank)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[0].as_py() for a, _ in pairs], keys.type),
                pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed], pa.string()),
                pa.array([fingerprint_string(a[2]) for a, _ in pairs], pa.string()),
                pa.array(map(fingerprint_string, other), pa.string()),
                pa.array([likeness(a[2], e) for (a, _), e in zip(pairs, other)], pa.float64()),
                pa.array([likeness(a[2], b[2]) for a, b in pairs], pa.float64())],
                names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return in_order(docs, key, text, bucket_rows).mapInArrow(
        run, f"{ddl(docs, key)}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
