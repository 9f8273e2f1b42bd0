import hashlib
import random
import zlib

import pytest

from homeledger.llm import queries, runs


def by_hand(words):
    """All runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and (i, j + q) not in found:
                found[(i, j + q)] = q
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def texts(rng, kind):
    n = rng.randrange(900)
    if kind == "few":
        return [rng.choice([b"a", b"b"]) for _ in range(n)]
    if kind == "many":
        return [b"%d" % rng.randrange(50) for _ in range(n)]
    if kind == "blocks":
        out = []
        while len(out) < n:
            q = rng.randrange(1, 160)
            block = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(q)]
            out += (block * 7)[:int(q * rng.uniform(1, 6))] + [b"%d" % rng.randrange(50) for _ in range(rng.randrange(20))]
        return out
    if kind == "flat":
        q = rng.randrange(40, 260)
        block = [b"a"] * q
        for _ in range(rng.randrange(1, 4)):
            block[rng.randrange(q)] = b"b"
        return (block * 5)[:rng.randrange(q, 5 * q)]
    if kind == "nested":
        inner = ([b"a"] * rng.randrange(1, 30) + [b"b"]) * rng.randrange(1, 12) + [b"c"] * rng.randrange(1, 3)
        return (inner * 5)[:rng.randrange(1, 1500)]
    one, other = [b"a"], [b"a", b"b"]
    while len(other) < n:
        one, other = other, other + one
    return other[:n]


@pytest.mark.parametrize("kind", ["few", "many", "blocks", "flat", "nested", "fibonacci"])
def test_runs_equal_brute_force(kind):
    rng = random.Random(kind)
    given = [texts(rng, kind) for _ in range(25)]
    for words, got in zip(given, runs.runs_of_texts(given)):
        assert got == by_hand(words), words


def test_long_periods():
    rng = random.Random(3)
    block = [b"%d" % rng.randrange(9) for _ in range(5001)]
    flat = [b"a"] * 3000 + [b"b"]
    assert runs.runs_of_texts([block * 3, flat * 4 + [b"a"] * 7]) == [
        [(0, 15_003, 5001)],
        sorted([(0, 3001 * 4 + 7, 3001), *((3001 * k, 3000, 1) for k in range(4))], key=lambda r: (r[0], r[2]))]


def test_equal_gaps_of_a_failed_period_stay_linear():
    line = [b"h%d" % i for i in range(60)]
    words = [w for k in range(3000) for w in (*line, b"x%d" % k, *(b"y%d" % (k * 7 + i) for i in range(9)))]
    assert runs.runs_of_texts([words]) == [[]]


def test_collapsed_and_strongest():
    words = [b"x", *[b"a", b"b"] * 20, b"y", *[b"c"] * 60]
    found = runs.runs_of_texts([words])[0]
    assert found == [(1, 40, 2), (42, 60, 1)]
    assert runs.collapsed(words, found) == [b"x", b"a", b"b", b"y", b"c"]
    assert runs.strongest(found) == (42, 60, 1) and runs.strongest([]) is None
    assert runs.strongest([(50, 60, 2), (9, 30, 1), (4, 90, 3)]) == (4, 90, 3)


def test_odd_rows(frame):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t", "x"), (4, "a " * 30, "x"), (4, "a " * 30, "x"), (None, "a\x0bb " * 15, "x"), (5, "w  " * 100_000, "x")]
    df = frame(rows, "doc_id long, text string, runs string")
    got = {(r["doc_id"], r["collapsed"], tuple(map(tuple, r["runs"]))) for r in runs.periodic_runs(df).collect()}
    assert got == {(1, "", ()), (2, "", ()), (3, "", ()), (4, "a", ((0, 30, 1),)), (None, "a b", ((0, 30, 2),)), (5, "w ", ((0, 100_000, 1),))}
    assert runs.periodic_runs(df).count() == len(rows) and runs.periodic_runs(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(400)))) for i in range(150)] + [(900, None), (901, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for i, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = by_hand(words)
        best = min(found, key=lambda r: (-(r[1] * 10 ** 9) // r[2], r[0], r[2]), default=None)
        dropped = {k for s, n, q in found for k in range(s + q, s + n)}
        want.add((i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                  sha(b"".join(b"%d,%d,%d\n" % r for r in found)), sha(b" ".join(w for k, w in enumerate(words) if k not in dropped))))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == want
    assert [t for _, t in got.dtypes[:6]] == ["bigint"] * 6
    assert sum(1 for r in want if r[1]) > 5
