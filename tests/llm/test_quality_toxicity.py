import numpy as np

from tilewright.llm import quality as Q
from tilewright.llm import toxicity as T
from tilewright.llm.word_features import Words

SF = "/root/testdata/sf0.01"


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.7, 0.9, 0.8, 0.75, 0.6])
    votes = np.where(rng.random((20_000, 8)) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = 2
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table = Q.label_model(patterns, counts.astype(float))
    assert ((posterior[inverse.ravel()] > 0.5) == truth).mean() > 0.97
    assert np.abs(table[1, :, 1] - accuracy).max() < 0.05
    assert np.abs(table[0, :, 0] - accuracy).max() < 0.08


def test_quality_against_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.classify(docs).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.995 and np.mean(bad) < 0.05
    assert Q.keep_good(docs).count() == Q.classify(docs).where("kept").count()


def test_quality_of_odd_rows(odd, empty):
    found = Q.classify(odd).collect()
    assert len(found) == odd.count()
    assert {r.doc_id for r in found if r.score == 0} == {1, 2, 3}
    kept = Q.keep_good(odd)
    assert kept.schema == odd.schema and kept.count() == sum(r.kept for r in found)
    assert Q.classify(empty).count() == 0 and Q.keep_good(empty).count() == 0


def test_votes_don_t_depend_on_the_block():
    texts = [b"One two two two.", b"", b" x | y | z ", "ÉA ÀB!! CÇ!!".encode(), b"***a ###b" * 9, b"Plain words, in a sentence. " * 5]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = Words(np.frombuffer(b"".join(texts), np.uint8), at)
    votes, vectors = Q.votes(whole), Q.vectors(whole)
    for i, t in enumerate(texts):
        one = Words(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert (Q.votes(one)[0] == votes[i]).all() and np.allclose(Q.vectors(one)[0], vectors[i])


def test_ordinal_regression():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    eta = x @ np.array([4.0, -2.0, 0.0]) + rng.logistic(size=4000)
    grade = np.searchsorted([0.0, 1.5, 3.0], eta)
    w, t = T.fit_ordinal(x, grade, np.ones(4000), steps=1500)
    assert np.abs(w - [4, -2, 0]).max() < 0.4 and np.abs(t - [0, 1.5, 3]).max() < 0.4
    assert (np.diff(t) > 0).all()


def test_toxicity_against_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = T.grade(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    yes, no = [r for r in rows if r.label], [r for r in rows if not r.label]
    assert np.mean([r.toxic for r in no]) < 0.005
    # some labelled documents are junk without any of their words
    assert np.mean([r.toxic for r in yes if r.quality]) > 0.95
    assert np.mean([r.severity for r in yes]) > 10 * np.mean([r.severity for r in no])
    assert {r.grade for r in yes} >= {0, 1, 2, 3}


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (12, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    found = T.grade(odd, labels).collect()
    assert len(found) == odd.count()
    assert {r.severity for r in found if r.doc_id in (1, 2, 3)} == {0.0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.severity for r in T.grade(odd, none).collect()} == {0.0}
    assert T.grade(empty, labels).count() == 0


def test_grades_in_the_labels(spark):
    """Labels with grades are taken as they are."""
    words = {0: "calm", 1: "mild", 2: "harsh", 3: "vile"}
    rows = [(i, f"text {i} {words[i % 4]} " * 3) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4) for i in range(400)], "doc_id long, toxic int")
    mean = {}
    for r in T.grade(docs, labels).collect():
        mean.setdefault(r.doc_id % 4, []).append(r.severity)
    values = [np.mean(mean[k]) for k in range(4)]
    assert values == sorted(values) and values[3] > values[1] + 0.5


def test_quality_learns_from_few_distinct_texts(spark):
    """Two texts in many copies are both drawn, so the junk among them isn't kept."""
    good = "The river bends here, and people walk along it in the evening. " * 8
    junk = "BUY|now !!! $$$ *** | | | WIN WIN WIN $$$ ### | | " * 8
    docs = spark.createDataFrame([(i, good if i % 4 else junk) for i in range(4000)], "doc_id long, text string")
    rows = Q.classify(docs, 40).collect()
    assert {r.kept for r in rows if r.doc_id % 4} == {True} and {r.kept for r in rows if r.doc_id % 4 == 0} == {False}


def test_distinct_sample(spark):
    from pyspark.sql import functions as F

    from tilewright.llm.common import distinct_sample

    texts = spark.createDataFrame([("a", f"t{i % 7}") for i in range(700)] + [("b", f"t{i}") for i in range(3000)] + [("c", "t0")], "part string, text string")
    rows = distinct_sample(texts, 50).collect()
    expected = {}
    for r in texts.distinct().withColumn("h", F.xxhash64("text")).collect():
        expected.setdefault(r.part, []).append((r.h % (1 << 30), r.h, r.text))
    assert {p: {r.text for r in rows if r.part == p} for p in "abc"} == {p: {t for _, _, t in sorted(v)[:50]} for p, v in expected.items()}
    assert len(rows) == 58 and {r.n for r in rows if r.part == "a"} == {100} and {r.n for r in rows if r.part != "a"} == {1}
