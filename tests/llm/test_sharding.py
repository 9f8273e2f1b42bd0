from collections import Counter

from pyspark.sql import functions as F

from homeledger.llm import sharding


def jump(key, n):
    """The published function."""
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_equals_the_published_function(spark):
    keys = [0, 1, -1, 7, 2 ** 40, 2 ** 63 - 1, -2 ** 63, *range(1000, 1300)]
    for n in (1, 2, 40, 41):
        rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shard(F.col("k"), n).alias("s")).collect()
        assert [r["s"] for r in rows] == [jump(r["k"], n) for r in rows]


def test_growth_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(5000).select(sharding.jump_shard(F.col("id"), 40).alias("a"), sharding.jump_shard(F.col("id"), 41).alias("b"))
    rows = df.collect()
    moved = [r for r in rows if r["a"] != r["b"]]
    assert all(r["b"] == 40 for r in moved) and 60 < len(moved) < 200


def test_slots_sizes_and_hot_rows(frame, monkeypatch):
    import zlib
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 20)
    monkeypatch.setattr(sharding, "BLOCK", 64)
    rows = [(i, f"text é {i}", 9) for i in range(500)] + [(7, "hot", 9)] * 300 + [(8, None, 9), (None, "", 9), (None, None, 9)]
    out = sharding.shard_rows(frame(rows, "doc_id long, text string, n long"), 4).collect()
    assert len(out) == len(rows)
    for shard in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    want = Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert all(r["shard"] == jump(r["doc_id"] or 0, 4) and r["grown_shard"] == jump(r["doc_id"] or 0, 5) and r["law"] == "key" for r in out)


def test_a_hot_key_with_different_texts_is_spread_over_chunks(spark, frame, monkeypatch):
    hot = spark.range(4000).select(F.lit(7).cast("long").alias("k"), (F.col("id") % 90 + 16).alias("size"), F.crc32(F.col("id").cast("string")).alias("crc"))
    chunks = [r["count"] for r in hot.groupBy(sharding.chunk_of(F.col("k"), F.col("size"), F.col("crc"), 16)).count().collect()]
    assert len(chunks) == 16 and max(chunks) < 400
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 50)
    rows = [(7, f"text {i}") for i in range(600)] + [(i, "x") for i in range(600)]
    out = sharding.shard_rows(frame(rows, "doc_id long, text string"), 4).collect()
    for shard in range(4):
        mine = [r["slot"] for r in out if r["shard"] == shard]
        assert sorted(mine) == list(range(len(mine)))
    assert {r["shard"] for r in out if r["doc_id"] == 7} == {jump(7, 4)}


def test_no_python_in_the_plan(frame):
    df = sharding.shard_rows(frame([(1, "a")], "doc_id long, text string"), 4)
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(frame):
    assert sharding.shard_rows(frame([], "doc_id long, text string"), 4).collect() == []
