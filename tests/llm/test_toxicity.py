import random
import zlib

import pytest
from pyspark.sql import functions as F

from homeledger.llm import toxicity

CLEAN = ["report", "on", "the", "river", "and", "its", "trade", "you", "see", "fields", "here", "later", "winter", "grain"]


def row(rng, toxic):
    words = [rng.choice(CLEAN) for _ in range(rng.randrange(20, 120))]
    if toxic:
        for _ in range(rng.randrange(1, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "blorfer", "gnarp", "scum", "zwex" + rng.choice("abcdefghijklm") + rng.choice("nopqrstuvw")]))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = [(i, row(rng, i % 6 == 0), int(i % 6 == 0)) for i in range(1500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(9001, None, "x"), (9002, "", "x"), (None, "no id", "x")],
                                 "doc_id long, text string, features string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (77_777, 1), (None, 1)], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    key = F.col("doc_id")
    scorer = toxicity.fit(docs, labels, ~toxicity.held_out(key))
    lexicon = scorer.lexicon
    assert all(lexicon.weight(w) > 1 for w in ("blorfer", "gnarp", "zwexyz")) and not lexicon.weight("river")
    rows = scorer.score(docs, ["doc_id"]).withColumn("held", toxicity.held_out(key)).collect()
    assert len(rows) == 1503 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held"] and r["doc_id"] < 1500]
    assert len(held) > 400 and sum((r["score"] >= 0.7) == (r["doc_id"] % 6 == 0) for r in held) >= 0.97 * len(held)
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert all(r["score"] < 0.7 for r in rows if r["doc_id"] in (9001, 9002))


def test_held_out_labels_are_not_learned(corpus):
    docs, labels = corpus
    key = F.col("doc_id")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(key), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.fit(docs, x, ~toxicity.held_out(key)).score(docs, ["doc_id"]).collect()}
            for x in (labels, turned))
    assert a == b


def test_one_class_no_labels_and_empty(frame):
    docs = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0), (2, 0)], [(1, None)]):
        scorer = toxicity.fit(docs, frame(labels, "doc_id long, toxic int"), F.lit(True))
        assert sorted(tuple(r) for r in scorer.score(docs, ["doc_id"]).collect()) == [(1, 0.0), (2, 0.0)]
    assert scorer.score(docs.limit(0), ["doc_id"]).collect() == []


def test_features():
    named = lambda t, w: dict(zip(toxicity.FEATURES, toxicity.features(t, toxicity.Lexicon(w))))
    f = named("You IDIOT!! such a gnarp, you 1d1ot i-d-i-o-t", {"gnarp": 2.0})
    assert f["given_hits"] == 1 and f["learned_hits"] == 1 and f["strongest"] == 2.0 and f["masked_hits"] == 3 and f["near_hits"] >= 3
    assert f["shouted"] > 0 and f["repeated"] > 0 and f["spelled"] > 0
    assert set(toxicity.features("", toxicity.Lexicon({}))) == set(toxicity.features(None, toxicity.Lexicon({}))) == {0.0}
    assert named("plain words only", {})["masked_hits"] == 0
    assert len(toxicity.features("long " * 400_000, toxicity.Lexicon({}))) == len(toxicity.FEATURES)


def test_texts_with_the_same_beginning_are_all_counted(frame):
    head = "this page is published under the terms of the common licence "
    rows = [(head + f"word{i} shared", 1.0, i % 2) for i in range(10)] + [(head + "word0 shared", 1.0, 0)]
    counts = {(r["word"], r["fold"]): (r["bad"], r["all"]) for r in toxicity.word_counts(frame(rows, "text string, label double, fold int")).collect()}
    assert counts["shared", 0] == counts["", 0] == (5, 5) and counts["shared", 1] == (5, 5)
    assert all(counts[f"word{i}", i % 2] == (1, 1) for i in range(10))


def test_parts_are_dealt_within_labels_and_rare_labels_are_kept(frame):
    """Five toxic rows among many: the trees and the calibration both see some, whatever the bound."""
    rng = random.Random(3)
    rows = [(i, row(rng, i < 5), int(i < 5)) for i in range(600)]
    docs = frame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = frame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels, F.lit(True), bound=200)
    assert scorer.trees is not None and scorer.calibration is not None
    one = toxicity.fit(docs, labels.where("doc_id <> 0 OR toxic = 1").where("doc_id = 0 OR toxic = 0"), F.lit(True), bound=200)
    assert one.trees is not None and one.calibration is None
    assert all(0 <= r["score"] <= 1 for r in one.score(docs, ["doc_id"]).collect())


def test_columns_of_any_name_stay(corpus):
    docs, labels = corpus
    odd = docs.select("doc_id", "text", F.lit(1).alias("score"), F.lit(2).alias("raw"), F.lit(3).alias("prediction"), F.lit("x").alias("a.b"))
    scorer = toxicity.fit(odd, labels, F.lit(True))
    got = scorer.score(odd, odd.columns, into="score_1")
    assert got.columns == [*odd.columns, "score_1"] and got.where("score = 1 AND raw = 2 AND prediction = 3").count() == odd.count()


def test_repeated_ids_count_once(frame):
    docs = frame([(1, f"text {i}") for i in range(300)] + [(2, "idiot")], "doc_id long, text string")
    labels = frame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels, F.lit(True)).calibration is None
