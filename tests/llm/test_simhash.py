import random
import re

import numpy as np
import pytest
import xxhash

from homeledger.llm import simhash
from homeledger.llm.components import components
from homeledger.operators.joins import attach


def by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, radius=3):
    """Smallest member of each one's component, by all pairs."""
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(fps))]


def test_fingerprint():
    for text in (None, "", " \t\n", "One", "one two", "A b C d", "é Ö\xa0x y\x0bz\x1cq", "same same same same same", "\x85 a", "w " * 70_000):
        assert simhash.fingerprint(text) == by_hand(text), repr(text)[:40]


def near(rng, centre, n, bits):
    out = set()
    while len(out) < n:
        fp = centre
        for b in rng.sample(range(64), rng.randrange(bits + 1)):
            fp ^= 1 << b
        out.add(fp)
    return sorted(out)


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    rng = random.Random(5)
    fps = [0, (1 << 64) - 1, 1, 7, 15, *near(rng, rng.getrandbits(64), 300, 4), *near(rng, rng.getrandbits(64), 60, 9),
           *(rng.getrandbits(64) for _ in range(300))]
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    from homeledger.session import cut_lineage
    df = cut_lineage(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r["node"]: r["component"] for r in components(simhash.links(df, bucket_rows=bucket)).collect()}
    want = linked(fps)
    groups = {}
    for fp, root in zip(signed, want):
        groups.setdefault(root, set()).add(got.get(fp, fp))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_radius_beyond_the_index_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=4)


def test_bucket_edges_are_a_forest():
    members = np.array([0, 1, 3, 1 << 40], dtype=np.uint64)
    edges = simhash.bucket_edges(members, np.array([2, 7], dtype=np.uint64), 3)
    assert len(edges) == 5


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 620)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = chain + star + loose + [(7, 7), (chain[3][1], chain[3][0]), chain[0]]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {n: n for e in edges for n in e}
    for _ in range(len(up)):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {n: c for n, c in up.items() if n != 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_attach_keeps_hot_rows(spark):
    from homeledger.session import cut_lineage
    rows = cut_lineage(spark.createDataFrame([(1, i) for i in range(3000)] + [(k, 0) for k in range(2, 1500)], "k long, v long"))
    facts = cut_lineage(spark.createDataFrame([(1, 3000, "hot")] + [(k, 1, "cold") for k in range(2, 1500)], "k long, n long, f string"))
    got = attach(rows, facts, "k", "n").groupBy("f").count().collect()
    assert {r["f"]: r["count"] for r in got} == {"hot": 3000, "cold": 1498}


def test_documents(frame):
    texts = {5: "One two three four", 3: "one TWO\tthree  four", 9: None, 8: "", 4: " ", 7: "something else entirely here now", 1: "word " * 40_000}
    df = frame([(k, v, 1) for k, v in texts.items()] + [(5, texts[5], 1), (None, "alone with no id at all", 1)], "doc_id long, text string, fp int")
    rows = [(r["doc_id"], r["fp"] & ((1 << 64) - 1), r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert len(rows) == 9
    assert {(k, c) for k, _, c in rows} == {(5, 3), (3, 3), (9, 4), (8, 4), (4, 4), (7, 7), (1, 1), (None, None)}
    assert all(fp == by_hand(texts[k]) for k, fp, _ in rows if k)
    assert simhash.near_duplicates(df.limit(0)).collect() == []
