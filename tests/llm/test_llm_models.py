"""Quality and toxicity models: accuracy on the held-out fold, identity, exceptions, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewatch.llm import quality, queries, toxicity
from tidewatch.llm.training import fit_logistic, held_out, training_rows

SF = "/root/testdata/sf0.01"


def labels_of(spark):
    return queries.table(spark, SF, "labels")


@pytest.mark.parametrize(("name", "label", "least"), [
    ("op4_quality_machine", "quality", 0.95), ("op10_toxic_lexicon", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.QUERIES[name](spark, SF).join(labels_of(spark), "doc_id").where(
        "held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= (0.7 if label == "quality" else 0.3)) for r in rows)


@pytest.mark.parametrize("name", ["op4_quality_machine", "op10_toxic_lexicon"])
def test_every_document_once_and_the_same_again(spark, name):
    first = sorted(map(tuple, queries.QUERIES[name](spark, SF).collect()))
    assert [r[0] for r in first] == sorted(
        r.doc_id for r in queries.table(spark, SF, "documents").select("doc_id").collect())
    assert first == sorted(map(tuple, queries.QUERIES[name](spark, SF).collect()))
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in first)


def test_training_keeps_to_its_fold_and_bound(spark):
    docs, labels = queries.table(spark, SF, "documents"), labels_of(spark)
    every = training_rows(docs, labels, "quality", 10_000)
    known = labels.where(~held_out()).count()
    assert every.count() == known
    assert training_rows(docs, labels, "quality", 7).count() == 7
    both = labels.unionByName(labels.withColumn("quality", 1 - F.col("quality")))
    assert training_rows(docs, both, "quality", 100).count() == 0


def brute_margin(model, index, value):
    total = model.bias + float(model.weight[index] @ value)
    for a in range(len(index)):
        for b in range(a):
            total += float(model.factors[index[a]] @ model.factors[index[b]]) * value[a] * value[b]
    return total


def test_linear_time_score_equals_the_pair_sum():
    rng = np.random.default_rng(1)
    texts = ["alpha beta beta gamma", "", "A B | c!! 12"]
    f = quality.featurise(texts, [None, 3, 12])
    size = (1 << quality.WORD_BITS) + len(quality.STRUCTURE)
    d = len(quality.STRUCTURE)
    model = quality.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(d),
                            np.ones(d))
    offsets, index, value = model.rows(f)
    got = model.margin(offsets, index, value)
    for k in range(len(texts)):
        own = slice(offsets[k], offsets[k + 1])
        assert got[k] == pytest.approx(brute_margin(model, index[own], value[own]), abs=1e-9)


@pytest.mark.parametrize("fit, score", [
    (quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)])
def test_odd_documents(spark, odd_documents, fit, score):
    none = labels_of(spark).limit(0)
    docs = odd_documents.withColumn("score", F.lit("clash"))
    for labels in (labels_of(spark), none):
        model = fit(queries.table(spark, SF, "documents"), labels)
        rows = score(docs, model).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r.score <= 1 for r in rows)
        repeated = [r.score for r in rows if r.doc_id == 4]
        assert len(repeated) == 2 and len(set(repeated)) == 1
    assert score(docs.limit(0), model).count() == 0
    assert fit(odd_documents.limit(0), labels_of(spark)) is not None


def test_rejected_documents_go(spark):
    docs = queries.table(spark, SF, "documents")
    kept = quality.keep_good(docs, labels_of(spark))
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.predicted for r in queries.QUERIES["op4_quality_machine"](spark, SF).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, p in rows.items() if p}


def test_folding():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("ІDIОT")
    assert toxicity.fold("ｓｔｕｐｉｄ") == "stupid"
    assert toxicity.fold("l​oser$") == toxicity.fold("loser") + "s"
    assert toxicity.fold("a,b.c") == "a b c"


def test_matches_exceptions_and_length(spark):
    lexicon = toxicity.Lexicon({" stupi": 2.0, " stupid ": 3.0, " moron ": 4.0},
                               {"not stupid"}, np.ones(3), 0.0)
    automaton = lexicon.automaton()
    assert lexicon.matches(automaton, "STUP1D, stupidity moron!")[1] == {0: 3.0, 7: 2.0, 17: 4.0}
    assert lexicon.evidence(automaton, "not stupid")[1] == 0.0
    assert lexicon.evidence(automaton, "so stupid")[1] == 3.0
    short, long = lexicon.features(["moron", "moron " + "word " * 500])
    assert short[0] > long[0] and short[1] == long[1] and short[2] > long[2]


def test_learned_exception_phrases(spark):
    rows = [(i, f"you are a moron number {i}", 0, 1) for i in range(60)]
    rows += [(100 + i, f"the moron mountain hotel {i} is fine", 0, 0) for i in range(20)]
    rows += [(200 + i, f"a plain text about things {i}", 0, 0) for i in range(400)]
    docs = spark.createDataFrame([(a, b, c) for a, b, c, _ in rows],
                                 "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(a, d) for a, _, _, d in rows], "doc_id long, toxic int")
    lexicon = toxicity.fit_toxicity(docs, labels)
    assert " moron " in lexicon.weights and "moron mountain" in lexicon.exceptions
    scored = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, lexicon).collect()}
    assert scored[0] == 1 and scored[100] == 0 and scored[200] == 0


def test_logistic_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    w, b = fit_logistic(x, y)
    assert np.allclose([*w, b], [2, -1, 0.5], atol=0.25)
