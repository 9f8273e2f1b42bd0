import math

import numpy as np
from pyspark.sql import functions as F

from homeledger.llm import itq


def brute(vectors, cosine=0.9):
    """(n_links, component) per row by all pairs."""
    good = {i: np.array(v) for i, (_, v) in enumerate(vectors)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 32}
    ids = [k for k, _ in vectors]
    links, up = [0] * len(ids), list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in good.items():
        for j, b in good.items():
            if i < j and a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)), key=lambda r: ids[r])
                up[y] = x
    return sorted((ids[i], links[i], ids[root(i)]) for i in range(len(ids)))


def test_equals_all_pairs(frame, monkeypatch):
    monkeypatch.setattr(itq, "BUCKET", 20)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 32))
    rows = [(c + rng.standard_normal(32) * s) for c in centres for s in (0, 0.05, 0.1)]
    rows += [rows[0]] * 30 + [centres[1] + rng.standard_normal(32) * 0.05 for _ in range(60)] + [-rows[0]]
    vectors = [(int(i), [float(np.float32(x)) for x in r]) for i, r in zip(rng.permutation(len(rows)) + 100, rows)]
    vectors += [(1, None), (2, []), (3, [0.0] * 32), (4, [1.0] * 31 + [None]), (5, [math.nan] + [1.0] * 31), (6, [math.inf] + [1.0] * 31),
                (7, [1.0] * 3), (8, [1.0] * 3)]
    df = frame([(k, v, 0) for k, v in vectors], "vec_id long, embedding array<float>, code int")
    got = itq.near_duplicate_vectors(df, ball=2).collect()
    want = brute(vectors)
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(w[1] for w in want)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_empty_and_odd_tables(frame):
    schema = "vec_id long, embedding array<float>"
    assert itq.near_duplicate_vectors(frame([], schema)).collect() == []
    only = itq.near_duplicate_vectors(frame([(1, None), (2, [0.0])], schema)).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_codes_are_balanced():
    x = np.random.default_rng(1).standard_normal((2000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes = itq.learn_rotation(x, 48).code(x)
    ones = [(codes >> b & 1).mean() for b in range(48)]
    assert all(0.45 < o < 0.55 for o in ones)


def test_no_pair_below_the_limit_and_tiny_numbers(frame):
    a = [1.0] + [0.0] * 15
    b = [0.9, math.sqrt(1 - 0.81)] + [0.0] * 14
    c = [0.8, 0.6] + [0.0] * 14
    rows = [(1, a), (2, [x * 1e-200 for x in a]), (3, [x * 1e200 for x in c])]
    got = itq.near_duplicate_vectors(frame(rows, "vec_id long, embedding array<double>"), reach=64, ball=3).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert b


def test_the_query_settings_find_planted_pairs_near_the_limit(frame):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((1200, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.standard_normal(x.shape)
    other -= (other * x).sum(axis=1)[:, None] * x
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = rng.uniform(0.901, 0.95, len(x))[:, None]
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine ** 2) * other])
    want = int((both @ both.T >= 0.9).sum()) - len(both)
    assert want == len(both)
    got = itq.near_duplicate_vectors(frame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")).collect()
    assert sum(r["n_links"] for r in got) >= 0.985 * want
    assert all(r["n_links"] <= 1 for r in got)


def test_a_vector_goes_to_one_task_a_block_and_two_vectors_meet_once(frame, monkeypatch):
    """Lookups stay in the task: what is shuffled follows from the blocks, not from the ball or the candidates."""
    monkeypatch.setattr(itq, "BUCKET", 50)
    assert [itq.block_count(n, 8) for n in (0, 1, 50, 51, 200)] == [1, 1, 1, 2, 4]
    monkeypatch.setattr(itq, "BLOCK_BYTES", 10 * 8 * 8)
    assert itq.block_count(200, 8) == 20
    entries = frame([(i, i * i, 1, [float(i), 1.0]) for i in range(200)], "entry long, code long, n long, vector array<double>")
    rows = itq.dealt(entries, 4).withColumn("part", F.spark_partition_id()).collect()
    assert len(rows) == 4 * 200 and len({r["part"] for r in rows}) == 10
    parts = {}
    for r in rows:
        parts.setdefault(r["part"], {}).setdefault(r["side"], []).append(r["entry"])
    met = sum(([(a, b) for a in p.get(itq.MEMBER, []) for b in p.get(itq.SEEKER, [])]
               + [(a, b) for a in p.get(itq.BOTH, []) for b in p.get(itq.BOTH, []) if a < b] for p in parts.values()), [])
    assert len(met) == 200 * 199 // 2 == len({frozenset(p) for p in met})


def test_pairs_in_a_table_are_all_found_in_small_steps(monkeypatch):
    monkeypatch.setattr(itq, "LOOKUPS", 100)
    monkeypatch.setattr(itq, "PAIRS", 7)
    codes = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 300)
    codes[100:200] = codes[:100] ^ (1 << 20)
    members, seekers = codes[:180], codes[120:]
    differ = (members[:, None] ^ seekers[None, :]).view(np.uint64) >> np.uint64(16) & np.uint64(0xFFFF)
    want = sorted(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(differ) <= 2))))
    got = sorted((int(a), int(b)) for i, j in itq.table_pairs(members, seekers, 1, 2) for a, b in zip(i, j))
    assert got == want and len(want) > 60
