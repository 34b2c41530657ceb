import numpy as np
import pytest

from tarnlake.llm import toxicity


def test_fold_and_feature_sets():
    texts = [b"Some WORDS, some more", b"", "Ärger! ärgerlich words".encode(), b"..."]
    n, sets = toxicity.feature_sets(texts)
    assert sorted(toxicity.word_features(b"words")) == sorted([toxicity.zlib.crc32(b"words"), toxicity.zlib.crc32(b"word*")])
    by_text = [{f for w in words for f in toxicity.word_features(w.encode())}
               for words in (["some", "words", "more"], [], ["Ärger", "ärgerlich", "words"], [])]
    assert [set(part.tolist()) for part in np.split(sets, np.cumsum(n)[:-1])] == by_text
    known = np.array(sorted([*toxicity.word_features(b"more"), 5]))
    m, some = toxicity.feature_sets(texts, known)
    assert m.tolist() == [1, 0, 0, 0] and some.tolist() == toxicity.word_features(b"more")
    assert toxicity.feature_sets([])[0].tolist() == []


def test_slopes_are_those_of_the_likelihood_and_thresholds_rise():
    """Grades drawn from a known model: the fit finds the order of the weights and the thresholds."""
    rng = np.random.default_rng(1)
    truth, thresholds = np.array([3.0, 1.5, 0.0, -2.0]), np.array([0.5, 2.0, 3.5])
    x = rng.random((6000, 4)) < 0.5
    chance = 1 / (1 + np.exp(-(x @ truth)[:, None] + thresholds))
    grades = (rng.random(6000)[:, None] < chance).sum(axis=1)
    sizes, features = x.sum(axis=1), np.nonzero(x)[1] + 10
    model = toxicity.fit_ordinal(sizes, features, grades, 4, ridge=0.01, rounds=800)
    assert model.features.tolist() == [10, 11, 12, 13] and np.abs(model.weights - truth).max() < 0.3
    assert np.abs(model.thresholds - thresholds).max() < 0.3
    assert (np.diff(model.thresholds) > 0).all()
    above = model.above(np.array([0.0, 2.0, 9.0]))
    assert (np.diff(above, axis=1) < 0).all() and (np.diff(above, axis=0) > 0).all()


def test_few_or_no_labels():
    none = np.zeros(0, np.int64)
    model = toxicity.fit_ordinal(none, none, none, 3)
    assert len(model.weights) == 0 and model.above(np.zeros(1))[0, 0] < 0.5
    one = toxicity.fit_ordinal(np.array([1] * 20), np.arange(20), np.zeros(20, np.int64), 3)
    assert one.above(np.zeros(1))[0, 0] < 0.1


@pytest.fixture(scope="module")
def halves(spark):
    """A model fitted to the labels of even documents, and graded odd ones."""
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    sizes, features, toxic = toxicity.labelled_sets(docs, labels.where("doc_id % 2 = 0"))
    model = toxicity.fit_ordinal(sizes, features, toxicity.severity_grades(sizes, features, toxic), 3)
    graded = toxicity.grade_texts(docs.where("doc_id % 2 = 1"), model).drop("text")
    return model, graded.join(labels, "doc_id").toPandas()


def test_held_out_accuracy(halves):
    _, graded = halves
    toxic, clean = graded[graded.toxic == 1], graded[graded.toxic == 0]
    assert len(toxic) > 150 and toxic.is_toxic.mean() > 0.85
    assert clean.is_toxic.mean() < 0.005
    assert toxic.expected_severity.mean() > 1 > 0.2 > clean.expected_severity.mean()
    assert (graded.is_toxic == (graded.grade > 0)).all()


def test_labels_are_bounded_and_repeatable(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    first = toxicity.labelled_sets(docs, labels, most=50)
    again = toxicity.labelled_sets(docs.repartition(6), labels.repartition(3), most=50)
    assert len(first[0]) == 50 and all((a == b).all() for a, b in zip(first, again))


def test_oddities(spark, oddities, nothing, halves):
    model, _ = halves
    rows = toxicity.grade_texts(oddities, model).collect()
    assert len(rows) == 10 and all(r["row"] == 1 and r["target"] == 4 for r in rows)
    assert len({r["expected_severity"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert toxicity.grade_texts(nothing, model).collect() == []
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None), (6, 0), (77, 1)], "doc_id long, toxic int")
    sizes, features, toxic = toxicity.labelled_sets(oddities, labels)
    assert toxic.tolist() == [1, 0] and sizes.sum() == len(features)
    assert [len(a) for a in toxicity.labelled_sets(nothing, labels.where("false"))] == [0, 0, 0]


def test_a_key_that_repeats_is_one_document(spark):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "concat('text number ', id % 40) AS text").union(
        spark.sql("SELECT 8L, 'another one'"))
    labels = spark.createDataFrame([(7, 0), (7, 1), (8, 0)], "doc_id long, toxic int")
    first, again = (toxicity.labelled_sets(d, labels, most=10) for d in (docs, docs.repartition(5)))
    assert len(first[0]) == 2 and first[2].tolist() == [1, 0] and len(first[1]) == first[0].sum()
    assert all((a == b).all() for a, b in zip(first, again))
