import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import oracle
from homeledger.llm import oracles, prefix_trie, queries


def by_hand(rebuilt):
    """Nodes of {conv_id: turns} by listing every prefix."""
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for path, ids in members.items():
        d, below = len(path), [p for p in members if p[:len(path)] == path]
        ended = sorted(c for c in ids if len(rebuilt[c]) == d)
        child = lambda p: [x for x in below if len(x) == len(p) + 1 and x[:len(p)] == p]
        out.add((min(ids), d, min(members[path[:-1]]) if d else None, len(ids), len(child(path)), sum(1 for p in below if not child(p)),
                 sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                 hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return out


def grafted(convs, c):
    own, head, h = convs[c], convs.get(c - c % 100, ()), zlib.crc32(str(c).encode()) % 6
    return head[:h] + own[h:]


def conversations(seed, n=230):
    rng = random.Random(seed)
    said = lambda: (rng.choice(["user", "", "tool"]), rng.choice(["", "a", "bé", "ccc", "dd dd"]))
    common = tuple(said() for _ in range(4))
    ids = rng.sample(range(300), n) + [100_000 + 7]
    return {c: common[:rng.randrange(5)] + tuple(said() for _ in range(rng.randrange(1, 4))) if c % 3 else common for c in ids}


def rows_of(convs):
    rows = [(c, t if t else None, role or None, text or None, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, path string"


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force_and_sql(spark, tmp_path, seed):
    convs = conversations(seed)
    df = spark.createDataFrame([*rows_of(convs), (None, 1, "user", "lost", "x")], SCHEMA)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == by_hand({c: grafted(convs, c) for c in convs})
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert oracle.compare(got, con, oracles.PREFIX_TRIE) is None


def test_hot_conversations_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 7)
    df = spark.range(-40, 1000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    got = sorted(tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.conversation_turns(df)).collect())
    ids = hashlib.sha256(",".join(map(str, range(-40, 1000))).encode()).hexdigest()
    assert got == [(-40, 0, None, 1040, 1, 1, 1039 * 5, prefix_trie.NO_IDS), (-40, 1, -40, 1040, 0, 1, 1039 * 5, ids)]


@pytest.mark.parametrize("stride", [1, 3, 8])
def test_long_tails(spark, monkeypatch, stride):
    monkeypatch.setattr(prefix_trie, "STRIDE", stride)
    rng = random.Random(stride)
    said = lambda n: tuple(("user", rng.choice("abcdef") * rng.randrange(3)) for _ in range(n))
    head, long = said(9), said(40)
    convs = {c: head[:rng.randrange(10)] + said(rng.randrange(1, 60)) for c in range(30)}
    convs |= {50: long, 51: long, 40: long[:25], 52: long[:24], 53: long[:24] + said(9), 54: long[:8]}
    df = spark.createDataFrame(rows_of(convs), SCHEMA)
    got = prefix_trie.prefix_trie(prefix_trie.conversation_turns(df))
    assert {tuple(r) for r in got.collect()} == by_hand(convs)
    assert got.count() == len(by_hand(convs))


def test_ties_and_repeated_rows_are_turns(frame):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    nodes = prefix_trie.prefix_trie(prefix_trie.conversation_turns(frame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert sorted((r["depth"], r["n_convs"]) for r in nodes) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_no_conversations(frame):
    empty = frame([(None, 1, "user", "x", "y")], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.conversation_turns(empty)).collect() == []


def test_scratch_is_deleted(spark, tmp_path):
    before = spark.conf.get("spark.homeledger.scratch.dir", None)
    spark.conf.set("spark.homeledger.scratch.dir", str(tmp_path))
    try:
        df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
        assert prefix_trie.prefix_trie(prefix_trie.conversation_turns(df)).count() == 2
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["prefix_trie"]
    finally:
        spark.conf.set("spark.homeledger.scratch.dir", before) if before else spark.conf.unset("spark.homeledger.scratch.dir")
