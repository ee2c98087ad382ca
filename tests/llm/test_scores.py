"""Quality, language and toxicity: held-out accuracy, folds, awkward rows."""

import zlib

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F
from sparkloom.llm import langid, pii, quality, queries, toxicity
from sparkloom.llm.common import fit_platt, sigmoid

SF = "/root/testdata/sf0.01"


def _labels(column):
    return dict(duckdb.sql(f"select doc_id, {column} from '{SF}/labels.parquet' where {column} is not null").fetchall())


@pytest.mark.parametrize("key, label, parts, held, accuracy", [
    ("op1_quality", "quality", 3, 1, 0.95), ("op5_toxicity", "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, key, label, parts, held, accuracy):
    rows = queries.QUERIES[key](spark, SF).collect()
    known = _labels(label)
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) for r in rows)
    right = [r.predicted == known[r.doc_id] for r in rows if r.held_out and r.doc_id in known]
    assert np.mean(right) >= accuracy


def test_language_held_out(spark):
    rows = queries.QUERIES["op2_language"](spark, SF).collect()
    langs = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    right = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id]]
    assert len(rows) == 1000 and np.mean(right) >= 0.98


def test_language_awkward_rows(spark, awkward, no_docs, frame):
    learned = frame([]).sparkSession.createDataFrame(
        [(k, "the house and the tree" if k % 2 else "das haus und der baum", "en" if k % 2 else "de")
         for k in range(40)], "doc_id bigint, text string, lang string")
    model = langid.train_langid(learned)
    got = langid.identify(awkward, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 12
    assert all(by_id[i].lang_pred == langid.UNKNOWN and by_id[i].score == 0 and not by_id[i].accepted for i in (1, 2, 3))
    assert by_id[5].lang_pred in ("de", "en") and by_id[5].score == by_id[6].score
    assert langid.identify(no_docs, model).collect() == []
    odd = spark.createDataFrame([(1, "² ½ 12"), (2, "das haus")], "doc_id int, text string")
    assert [r.lang_pred for r in langid.identify(odd, model).orderBy("doc_id").collect()] == ["und", "de"]
    for nothing in (no_docs, spark.createDataFrame([(1, "12 34", "en"), (2, None, "de")], "doc_id int, text string, lang string"),
                    spark.createDataFrame([("a", "the house", None)], "doc_id string, text string, lang string")):
        model = langid.train_langid(nothing)
        assert model.languages == [] and langid.identify(no_docs, model).collect() == []
        assert {(r.lang_pred, r.score, r.accepted) for r in langid.identify(odd, model).collect()} == {("und", 0.0, False)}


def test_models_do_not_depend_on_the_partitioning(spark):
    """Samples are picked by hash of what they are, so 1 and 50 partitions give the same models; ids may be texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    docs = docs.union(docs.filter("lang = 'en'").limit(50))
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("doc_id", F.col("doc_id").cast("string"))
    few = langid.LangParams(per_language=40, epochs=1, bits=12)
    one, many = docs.coalesce(1), docs.repartition(50)
    a, b = langid.train_langid(one, params=few), langid.train_langid(many, params=few)
    assert a.languages == b.languages and (a.logits == b.logits).all()
    (a, _), (b, _) = (quality.train_quality(d, labels, per_class=30) for d in (one, many))
    assert (a.weights == b.weights).all() and a.scale == b.scale
    a, b = (toxicity.train_toxicity(d, labels, per_class=100) for d in (one, many))
    assert a.lexicon == b.lexicon and np.allclose(a.weights, b.weights)
    assert pii.train_pii(one, 60, 20) == pii.train_pii(many, 60, 20)


@pytest.mark.parametrize("key", ["op1_quality", "op2_language", "op5_toxicity", "op7_personal_data"])
def test_query_on_an_empty_table(spark, tmp_path, key):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert queries.QUERIES[key](spark, str(tmp_path)).collect() == []


def test_toxic_documents_are_found_among_held_out_ones(spark):
    """Recall and precision of class 1 at the threshold, on the largest of the given tables."""
    sf = "/root/testdata/sf0.1"
    known = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet' where toxic is not null").fetchall())
    rows = [r for r in queries.QUERIES["op5_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in known]
    caught = [known[r.doc_id] for r in rows if r.predicted]
    assert np.mean(caught) >= 0.95 and sum(caught) >= 0.9 * sum(known[r.doc_id] for r in rows)


def test_quality_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(5, 1), (8, 0), (9, 0), (4, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.train_quality(awkward, labels)
    got = quality.score_quality(awkward, model)
    rows = got.collect()
    assert got.columns == [c for c in awkward.columns if c != "score"] + ["score"]
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert quality.score_quality(no_docs, model).collect() == []
    none = quality.train_quality(no_docs, labels)
    assert {r.score for r in quality.score_quality(awkward, none).collect()} == {0.5}


def test_toxicity_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(5, 1), (8, 0), (9, 0), (4, 0)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(awkward, labels)
    rows = toxicity.score_toxicity(awkward, model).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(no_docs, toxicity.train_toxicity(no_docs, labels)).collect() == []


def test_grammar_weighs_targets_denials_and_reports():
    reader = toxicity.Reader({"=fool": 2.0})

    def total(text):
        return np.expm1(reader(text)[0])

    plain = total("a fool came by")
    assert total("you fool came by") > plain > total("not a fool came by") > 0
    assert total("he said a fool came by") < total("he knew a fool came by")
    assert total("they burn wood") > total("we burn wood") > 0
    assert total("nothing here") == 0 and total("") == 0
    assert total("a fool. a fool.") == pytest.approx(plain)
    assert total("a fool came by. so it is a fool") == pytest.approx(2 * plain)
    assert reader.clauses("one. you fool, you fool! two three\n") == ([pytest.approx(2 * 2.0 * 1.25)], 3, 7)
    assert reader("a fool. and a fool. one more fool")[5] > reader("a fool. some more. one more")[5] > 0


def test_dual_coordinate_descent_separates():
    draw = np.random.default_rng(0)
    rows = [np.unique(draw.integers(0, 50, 6) + 100 * (k % 2)) for k in range(60)]
    target = np.array([k % 2 for k in range(60)], float)
    (model, norm) = quality.fit(rows, target)
    scores = sigmoid(model.scale[0] * np.array([model.margin(r, norm) for r in rows]) + model.scale[1])
    assert ((scores >= 0.5) == (target > 0)).all()
    assert fit_platt(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([0, 0, 1, 1]))[0] > 0
