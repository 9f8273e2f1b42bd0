"""Periodic runs in texts, by minimizers at several scales.

A run is a stretch of words with smallest period q that is at least ``LEAST`` words and
``REPEATS`` periods long and that no neighbouring word extends with the same period.

Periods up to ``SHORT`` are found by direct lag scans: the words are compared with themselves
q places on. Longer ones are found a scale at a time, where scale k holds the periods from
Q = 48 * 2^k up to twice that. Blocks of Q/2 words are hashed (a block's hash is made of those of its
halves, so each scale costs one pass), and of every Q/6 neighbouring blocks the one with the
least hash is a minimizer. Inside a run the same block is the minimum again one period
on, so pairs of equal minimizers at a distance of this scale are seeds; each is
extended word by word to both sides, on the words themselves.

A block that lies within a run of a period up to a third of the block is left out. That is a property
of its words alone, so it is left out in all periods alike; a block that stays has no equal within Q/6 places, so
windows have no ties and a minimizer has at most twelve partners of its scale; and since a run whose
blocks were all left out would have a smaller period, every run keeps a seed. Nothing is missed.

Texts are worked off many at a time, joined by separators that equal nothing. Each text is handled in
one task, in memory proportional to its length. Null and empty texts have no words and no runs.
Repeated rows are documents of their own. Other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from homeledger.llm.common import ddl

LEAST = 24
REPEATS = 3
SHORT = 48  # periods below are scanned directly; the first block has SHORT / 2 >= LEAST words
AT_ONCE = 1 << 18  # words of texts worked off together; a longer text stands alone
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))
_MOST = np.uint64(np.iinfo(np.uint64).max)
_SHIFT = np.uint64(32)

Rewrite = Callable[[object, list[bytes]], list[bytes]]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    h = (a * _ODD[0]) ^ ((b + _ODD[1]) * _ODD[2])
    h = (h ^ (h >> _SHIFT)) * _ODD[2]
    return (h ^ (h >> _SHIFT)) * _ODD[1]


def _doubled(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of twice the size; blocks that would pass the end are not there."""
    return _mixed(h[:-size], h[size:]) if len(h) > size else h[:0]


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """Least or greatest of each ``size`` neighbours, a power of two."""
    step = 1
    while step < size and len(values) > step:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values if step >= size else values[:0]


def minimizers(h: np.ndarray, size: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``size`` blocks; ``_MOST`` is never one."""
    least = _sliding(h, size, np.minimum)
    if not len(least):
        return np.empty(0, dtype=np.int64)
    # the windows with position i are those that start from i - size + 1 to i
    around = np.concatenate([np.zeros(size - 1, dtype=np.uint64), least, np.zeros(size - 1, dtype=np.uint64)])
    return np.flatnonzero((_sliding(around, size, np.maximum) == h) & (h != _MOST))


def _reach(x: np.ndarray, i: int, j: int) -> int:
    """How many words from i and j on are equal."""
    done, step, room = 0, 64, len(x) - j
    while done < room:
        n = min(step, room - done)
        differ = x[i + done:i + done + n] != x[j + done:j + done + n]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = done + n, step * 2
    return done


def _reach_back(x: np.ndarray, i: int, j: int) -> int:
    """How many words before i and j are equal."""
    done, step = 0, 64
    while done < i:
        n = min(step, i - done)
        differ = (x[i - done - n:i - done] != x[j - done - n:j - done])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = done + n, step * 2
    return done


def short_runs(x: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Runs of periods below ``SHORT`` into ``found``: (start, end) to period."""
    for q in range(1, min(SHORT, len(x))):
        least = max(LEAST, REPEATS * q) - q
        # every stretch of so many equal pairs holds one of these places, and half of it lies on one side
        at = np.flatnonzero(x[least - 1:-q:least] == x[least - 1 + q::least]) * least + least - 1
        left, right = at, at
        for t in range(1, (least + 1) // 2):
            left = left[x[left - t] == x[left - t + q]]
            right = right[right + t + q < len(x)]
            right = right[x[right + t] == x[right + t + q]]
            if not len(left) and not len(right):
                break
        end = 0
        for p in np.union1d(left, right).tolist():
            if p < end:
                continue
            start, end = p - _reach_back(x, p, p + q), p + _reach(x, p, p + q)
            if end - start >= least:
                found.setdefault((start, end + q), q)


def long_runs(x: np.ndarray, found: dict[tuple[int, int], int], longest: int) -> None:
    """Runs of longer periods, in texts of up to ``longest`` words, into ``found``, which has the shorter ones."""
    size, h = 3, _mixed(_mixed(x[:-2], x[1:-1]), x[2:]) if len(x) > 2 else x[:0]
    while size < SHORT // 2:
        h, size = _doubled(h, size), size * 2
    while 2 * size * REPEATS <= longest:
        least, kept = 2 * size, h.copy()
        for (start, end), q in found.items():
            if 3 * q <= size <= end - start:
                kept[start:end - size + 1] = _MOST
        at = minimizers(kept, size // 3)
        at = at[np.lexsort((at, h[at]))]
        seen: dict[int, list[tuple[int, int]]] = {}
        for step in range(1, len(at)):
            same = h[at[:-step]] == h[at[step:]]
            lag = at[step:] - at[:-step]
            if not (same & (lag < 2 * least)).any():
                break
            for k in np.flatnonzero(same & (lag >= least) & (lag < 2 * least)).tolist():
                p, q = int(at[k]), int(lag[k])
                stretches = seen.setdefault(q, [])  # disjoint, by start
                i = bisect.bisect_right(stretches, (p, len(x)))
                if i and p < stretches[i - 1][1]:
                    continue
                start, end = p - _reach_back(x, p, p + q), p + _reach(x, p, p + q)
                stretches.insert(i, (start, end))
                if end - start >= (REPEATS - 1) * q:
                    found.setdefault((start, end + q), q)
        h, size = _doubled(h, size), size * 2


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. ``words`` are numbers, equal for equal
    words; ``longest`` bounds the length of a run."""
    x = words.astype(np.uint64)
    found: dict[tuple[int, int], int] = {}
    short_runs(x, found)
    long_runs(x, found, len(x) if longest is None else longest)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    block: list[int] = []

    def work_off() -> None:
        ids: dict[bytes, int] = {}
        number, joined, starts = ids.setdefault, [], []
        for k, i in enumerate(block):
            starts.append(len(joined))
            joined += [number(w, len(ids)) for w in texts[i]]
            joined.append(-1 - k)
        starts = np.array(starts)
        for start, length, q in find_runs(np.array(joined, dtype=np.int64), len(texts[block[-1]])):
            k = int(np.searchsorted(starts, start, side="right")) - 1
            out[block[k]].append((start - int(starts[k]), length, q))
        block.clear()

    # texts of similar length together: long scales then run over long texts alone
    held = 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if len(texts[i]) < LEAST:
            continue
        if block and (held + len(texts[i]) > AT_ONCE or len(texts[i]) > 4 * len(texts[block[0]])):
            work_off()
            held = 0
        block.append(i)
        held += len(texts[i])
    if block:
        work_off()
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; among equals the first, then the shortest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """(key, runs, best, collapsed): all runs, the strongest one, and the text with each run cut to one
    period, its words joined by spaces. ``rewrite(key, words)`` may change the words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            if rewrite is not None:
                texts = [rewrite(k, words) for k, words in zip(batch.column(0).to_pylist(), texts)]
            found = runs_of_texts(texts)
            names = ("start", "length", "period")
            best = [None if (r := strongest(runs)) is None else dict(zip(names, r)) for runs in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[dict(zip(names, r)) for r in runs] for runs in found], RUN_TYPE),
                 pa.array(best, RUN_TYPE.value_type),
                 pa.array([b" ".join(collapsed(words, runs)).decode() for words, runs in zip(texts, found)], pa.string())],
                names=[key, "runs", "best", "collapsed"])

    one = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select(key, text).mapInArrow(run, f"{ddl(docs, key)}, runs array<{one}>, best {one}, collapsed string")
