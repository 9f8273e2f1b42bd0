"""The registered queries over the small tables, and the pipeline against its parts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
import __spark_entry__ as contract
import corpus_pipeline
from homeledger.llm import copies, queries, secrets, toxicity

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_operator_is_listed():
    names = list(contract.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.ORACLES[name]) is None


def test_vectors_against_all_pairs(spark):
    got = queries.op3_itq_near_duplicates(spark, SF_DIR).collect()
    rows = queries.table(spark, SF_DIR, "embeddings").collect()
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = {r["vec_id"]: int(n) - 1 for r, n in zip(rows, (x @ x.T >= 0.9).sum(axis=1))}
    found = {r["vec_id"]: r["n_links"] for r in got}
    assert sum(found.values()) >= 0.9 * sum(want.values()) and all(found[k] <= want[k] for k in want)


def test_stages_keep_the_columns_and_have_their_effect(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "secrets", "packing"]
    left = corpus_pipeline.drop_toxic(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    scorer = toxicity.fit(docs, queries.table(spark, SF_DIR, "labels"), ~toxicity.held_out(F.col("doc_id")))
    low = {r["doc_id"] for r in scorer.score(docs, ["doc_id"]).collect() if r["score"] < 0.7}
    assert {r["doc_id"] for r in left.select("doc_id").collect()} == low
    one = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert one.columns == docs.columns
    groups = copies.near_copies(docs).collect()
    assert sorted(r["doc_id"] for r in one.select("doc_id").collect()) == sorted({r["component_id"] for r in groups})
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.mask_secrets(spark, docs, SF_DIR).collect()}
    assert clean == {r["doc_id"]: secrets.redact(r["text"], secrets.all_spans(r["text"]), "[SECRET]") for r in docs.collect()}


def test_run_packs_what_the_stages_leave(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = queries.table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_stages_on_odd_rows(frame, spark):
    docs = frame([(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, "x", None, None, None), (2, None, "en", "s", 0), (3, "", None, "s", 0)],
                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "simhash":
            assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "None"]
        elif name != "packing":
            assert out.columns == docs.columns and out.count() == 5
        else:
            assert out.count() == 5
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_stages_take_odd_rows(spark):
    """Repeated ids, null ids and texts, and columns with the names that the stages use inside."""
    docs = queries.table(spark, SF_DIR, "documents").limit(60)
    rows = [(*r, *range(9)) for r in docs.collect()]
    first = rows[0]
    texts = ["one two three four five six seven", "quite another text of some more words than seven", None, None]
    rows += [(first[0], t, *first[2:]) for t in texts] + [(None, t, *first[2:]) for t in ("no id at all here", None)]
    names = ["score", "features", "raw", "prediction", "row", "entry", "digest", "piece", "a.b"]
    extra = ", ".join(f"`{n}` int" for n in names)
    odd = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, odd, SF_DIR)
        assert left.columns == odd.columns and left.dtypes == odd.dtypes
        assert left.count() <= odd.count() and stage(spark, odd.limit(0), SF_DIR).count() == 0
    left = corpus_pipeline.drop_near_duplicates(spark, odd, SF_DIR)
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert {(first[0], t) for t in texts[:2]} <= set(kept)
    assert sum(1 for _, t in kept if not (t or "").split()) == 1 and (None, "no id at all here") in kept
    assert corpus_pipeline.pack(spark, odd, SF_DIR).count() >= len(rows)
