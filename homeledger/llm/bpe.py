"""Byte-pair encoding and decoding with forced boundaries.

A merge can only join two bytes that stand side by side inside some vocabulary token. A
byte pair that occurs inside none is therefore a certain cut: whatever stands left and
right of it, no merge ever crosses. Together with the pre-tokenizer's own cuts these
positions split a text into short fragments that are encoded independently of each other
and concatenated. Cuts are found for a whole Arrow batch at once with numpy, fragments
are encoded through a bounded memo, so a repeated fragment is merged once per worker.

The pre-tokenizer's pattern looks one character ahead, so it is applied to the whole
text; only then are forced pairs added. The result equals the tokenizers library's on
the same vocabulary file (``add_special_tokens=False``).

Nulls are empty texts; an empty text has no ids and decodes to an empty text. A text has
no length limit: a fragment without any cut is merged with a heap in n log n steps.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MEMO = 400_000  # fragments kept per worker
MEMO_BYTES = 48  # longer fragments are not kept
BLOCK_CHARS = 200_000  # characters encoded at a time, unless one text is longer
NO_RANK = np.iinfo(np.int32).max
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values of the pre-tokenizer's pattern


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: printable Latin-1
    stands for itself, the others take code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = (ord(every[m.start()]), ord(every[m.end() - 1]) + 1)
            table[a:b] = kind
    table[0xD800:0xE000] = OTHER
    return table


class Codec:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, model = byte_symbols(), spec["model"]
        raw = {token: bytes(symbols[c] for c in token) for token in model["vocab"]}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = {i: raw[token] for token, i in model["vocab"].items()}
        self.token_bytes |= {i: content.encode() for content, i in self.special.items()}
        by_bytes = {b: model["vocab"][token] for token, b in raw.items()}
        self.base = np.array([by_bytes[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in model["merges"]]
        self.merged = np.array([model["vocab"][a + b] for a, b in pairs], dtype=np.int64)  # by rank
        keys = np.array([model["vocab"][a] << 32 | model["vocab"][b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        a, b = np.divmod(np.arange(65536), 256)
        self.byte_ranks = np.array(
            [self.rank_of.get(k, NO_RANK) for k in (self.base[a] << 32 | self.base[b]).tolist()], dtype=np.int32)
        self.special_pattern = "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        inside = np.zeros(65536, dtype=bool)
        for b in raw.values():
            x = np.frombuffer(b, np.uint8).astype(np.int64)
            inside[x[:-1] * 256 + x[1:]] = True
        self.forced = ~inside
        self.memo: dict[bytes, bytes] = {}

    def merge_many(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of many fragments. Each round merges, in every fragment that still has one, the
        pair of lowest rank, the leftmost among equals; a fragment without any leaves."""
        out = [b""] * len(fragments)
        raw = np.frombuffer(b"".join(fragments), dtype=np.uint8)
        ids, owner = self.base[raw], np.repeat(np.arange(len(fragments)), [len(f) for f in fragments])
        rank = np.full(len(raw), NO_RANK, dtype=np.int32)  # of the pair that begins here
        rank[:-1] = self.byte_ranks[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        rank[:-1][owner[1:] != owner[:-1]] = NO_RANK
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(ids)])
            low = np.minimum.reduceat(rank, first)
            done = low == NO_RANK
            if done.any():
                packed = ids.astype("<u4").tobytes()
                for who, i, n in zip(owner[first[done]].tolist(), first[done].tolist(), size[done].tolist()):
                    out[who] = packed[4 * i:4 * (i + n)]
                keep = ~np.repeat(done, size)
                ids, owner, rank, low, size = ids[keep], owner[keep], rank[keep], low[~done], size[~done]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, size))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            ids[hits] = self.merged[rank[hits]]
            keep = np.ones(len(ids), dtype=bool)
            keep[hits + 1] = False
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            at = hits - np.arange(len(hits))  # where the merged ones stand now
            self._rank(ids, owner, rank, at)
            self._rank(ids, owner, rank, at[at > 0] - 1)
        return out

    def _rank(self, ids: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        inner = at[at + 1 < len(ids)]
        rank[at[at + 1 >= len(ids)]] = NO_RANK
        key = ids[inner].astype(np.int64) << 32 | ids[inner + 1]
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        known = (self.pair_keys[place] == key) & (owner[inner] == owner[inner + 1])
        rank[inner] = np.where(known, self.pair_ranks[place], NO_RANK)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same result for one long fragment, with a heap."""
        n = len(ids)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                rank = self.rank_of.get(ids[i] << 32 | ids[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def learn(self, fragments: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new fragments; short ones enter the memo."""
        short, found = [f for f in fragments if len(f) <= MEMO_BYTES], {}
        if len(self.memo) + len(short) > MEMO:
            self.memo.clear()
        self.memo.update(zip(short, self.merge_many(short)))
        for f in fragments:
            if len(f) > MEMO_BYTES:
                found[f] = np.array(self._merge_long(self.base[np.frombuffer(f, np.uint8)].tolist()), dtype="<u4").tobytes()
        return found

    def cuts(self, text: str) -> tuple[bytes, np.ndarray]:
        """The text's bytes and the byte offsets at which fragments begin."""
        data = text.encode("utf-8")
        if not data:
            return data, np.empty(0, dtype=np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        start = class_cuts(points, text)
        raw = np.frombuffer(data, dtype=np.uint8)
        cut = np.zeros(len(raw), dtype=bool)
        if len(raw) == len(points):
            cut[:] = start
        else:
            cut[(raw & 0xC0) != 0x80] = start
        pairs = raw[:-1].astype(np.uint16) << 8
        pairs |= raw[1:]
        cut[1:] |= self.forced[pairs]
        return data, np.flatnonzero(cut)

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens."""
        parts, memo = [], self.memo
        for text in texts:
            data, starts = self.cuts(text)
            at = starts.tolist()
            parts.append([data[a:b] for a, b in zip(at, [*at[1:], len(data)])])
        got = [[memo.get(f) for f in own] for own in parts]
        new = {f for own, ids in zip(parts, got) if None in ids for f, x in zip(own, ids) if x is None}
        if new:
            long = self.learn(new)
            got = [[x or memo.get(f) or long[f] for f, x in zip(own, ids)] if None in ids else ids
                   for own, ids in zip(parts, got)]
        return [b"".join(x) for x in got]

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            block, chars = [], 0
            while at + len(block) < len(texts) and (not block or chars < BLOCK_CHARS):
                block.append(texts[at + len(block)] or "")
                chars += len(block[-1])
            at += len(block)
            if not any(s in text for s in self.special for text in block):
                yield from self.encode_plain(block)
                continue
            for text in block:
                pieces = [p for p in re.split(self.special_pattern, text) if p]
                plain = iter(self.encode_plain([p for p in pieces if p not in self.special]))
                yield b"".join(self.special[p].to_bytes(4, "little") if p in self.special else next(plain) for p in pieces)

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_many([text]))

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def class_cuts(points: np.ndarray, text: str) -> np.ndarray:
    """True where the pre-tokenizer begins a piece: runs of letters, numbers, other signs and
    white space; one space joins the run after it; white space before a run gives up its last
    character; an apostrophe that begins a piece takes an English suffix with it."""
    kind = char_classes()[points]
    n = len(kind)
    start = np.ones(n, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    space = kind == SPACE
    last = space.copy()  # the last white space before something else
    last[:-1] &= ~space[1:]
    last[-1] = False
    start |= last
    joins = last & (points == 32)
    start[1:] &= ~joins[:-1]
    if "'" in text:
        for i in np.flatnonzero((points == 39) & start).tolist():
            for suffix in SUFFIXES:
                if text.startswith(suffix, i + 1):
                    start[i + 1] = False
                    if i + 1 + len(suffix) < n:
                        start[i + 1 + len(suffix)] = True
                    break
    return start


@functools.cache
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def encode_documents(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the text's ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = list(own.encode_many(batch.column(column).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", ids binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: the key, number of ids, and SHA-256 of the ids and of the decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            n, a, b = [], [], []
            for ids in own.encode_many(batch.column(column).to_pylist()):
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(own.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, column).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
