import random

from pyspark.sql import functions as F

from tallyfold.llm import quality
from tallyfold.llm.common import is_held_out, labelled_sample
from tallyfold.llm.queries import QUERIES

from .samples import SCHEMA, awkward, nothing


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    good = ["the", "house", "river", "walked", "slowly", "and", "evening", "light", "of"]
    bad = ["click", "$$$", "!!!", "BUY", "now", "%%%", "free", "|", "deal"]
    for i in range(n):
        label = int(rng.random() < 0.7)
        found = [rng.choice(good if label else bad) for _ in range(rng.randint(20, 300))]
        rows.append((i, " ".join(found), "en", "s", 0, "x", 7, "f", -1, 0.5, 3, "k", 2))
        labels.append((i, label))
    return rows, labels


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    sample = labelled_sample(docs, marks, "doc_id", "text", "quality", ~is_held_out("key", 3, 1), 20_000)
    scored = quality.quality_scores(docs, sample).withColumn("held", is_held_out("doc_id", 3, 1)).collect()
    truth = dict(labels)
    right = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in scored if r.held]
    assert len(right) > 100 and sum(right) / len(right) >= 0.97
    assert len(scored) == len(rows)


def test_both_kinds_are_found_in_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = QUERIES["op9_quality_classifier"](spark, sf).where("held_out").collect()
    found = [(truth[r.doc_id], r.predicted) for r in scored if truth.get(r.doc_id) is not None]
    for kind in (0, 1):
        right = [p == kind for t, p in found if t == kind]
        assert len(right) > 100 and sum(right) / len(right) >= 0.93, (kind, sum(right), len(right))


def test_repeated_words_do_not_pass(spark):
    rows, labels = corpus(400)
    rng = random.Random(1)
    for i in range(400, 460):
        word = rng.choice(["the", "house", "river", "evening"])
        rows.append((i, " ".join([word] * rng.randint(100, 400)), *rows[0][2:]))
        labels.append((i, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    sample = labelled_sample(docs, marks, "doc_id", "text", "quality", ~is_held_out("key", 3, 1), 20_000)
    held = quality.quality_scores(docs, sample).where(is_held_out("doc_id", 3, 1)).collect()
    right = [(r.score >= 0.5) == bool(dict(labels)[r.doc_id]) for r in held if r.doc_id >= 400]
    assert len(right) > 10 and sum(right) / len(right) >= 0.95


def test_awkward_and_empty_tables(spark):
    rows, labels = corpus(100)
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = labelled_sample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id", "text", "quality", F.lit(True), 1000)
    odd = awkward(spark)
    scored = quality.quality_scores(odd, sample).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (103, 104)}) == 1
    assert quality.quality_scores(nothing(spark), sample).collect() == []
    assert {r.score for r in quality.quality_scores(odd, sample.where("false")).collect()} == {0.5}
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(odd, sample.where("label = 1")).collect())
