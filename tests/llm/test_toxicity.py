import random

from pyspark.sql import functions as F

from tallyfold.llm import toxicity
from tallyfold.llm.common import is_held_out, labelled_sample

from .samples import SCHEMA, awkward, nothing

BAD = ["zorkel", "brafny", "quolt"]


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        found = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(2, 4) if toxic else 0):
            bad = rng.choice(BAD) + rng.choice(["", "ing", "s"])
            bad = rng.choice([bad, bad.upper(), bad.replace("o", "0"), bad.replace("a", "а"), bad + "$$$"])
            found.insert(rng.randint(0, len(found)), bad)
        if not toxic and rng.random() < 0.3:
            found += ["mount", "quolt"]  # a harmless phrase with a term in it
        rows.append((i, " ".join(found), "en", "s", 0, "x", 7, "f", -1, 0.5, 3, "k", 2))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = labelled_sample(docs, marks, "doc_id", "text", "toxic", ~is_held_out("key", 5, 0), 20_000)
    scored = toxicity.toxicity_scores(docs, sample).select("row.doc_id", "score").collect()
    truth = dict(labels)
    held = {r[0] for r in docs.where(is_held_out("doc_id", 5, 0)).select("doc_id").collect()}
    right = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in scored if r.doc_id in held]
    assert len(right) > 80 and sum(right) / len(right) >= 0.97
    kept = toxicity.drop_toxic(docs, sample)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in scored)


def test_folding():
    assert toxicity.fold("ZОRK3L, zork€l") == " zorkel zork l"
    assert toxicity.fold("stupid$$$ A$$ | x") == " stupid a x" or "stupid" in toxicity.fold("stupid$$$")
    assert toxicity.fold("ｆｕｌｌ") == " full"
    assert toxicity.fold("") == " "


def test_exceptions_win_over_terms():
    built = toxicity.automaton({"quolt": 2.0, "zork": 3.0}, ["mount quolt", "quolt hill"])

    def total(text):
        return toxicity.matched(toxicity.fold(text), built)

    assert total("a quolt") == 2.0
    assert total("a mount quolt b") == 0.0
    assert total("quolt hill") == 0.0
    assert total("mount quolting zorkel") == 5.0
    assert total("unzork") == 0.0
    assert toxicity.matched(" x", toxicity.automaton({})) == 0.0


def test_awkward_and_empty_tables(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = labelled_sample(docs, spark.createDataFrame([*labels, (None, 1), (1, 1), (1, 0), (2, None)], "doc_id long, toxic int"), "doc_id", "text", "toxic", F.lit(True), 1000)
    assert sample.where("key = 1").count() == 0
    odd = awkward(spark)
    scored = toxicity.toxicity_scores(odd, sample).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    empty = {r.score for r in scored if not (r.row.text or "").strip()}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert toxicity.toxicity_scores(nothing(spark), sample).collect() == []
    assert {r.score for r in toxicity.toxicity_scores(odd, sample.where("false")).collect()} == {0.5}


def test_a_term_follows_an_exception_at_once():
    built = toxicity.automaton({"quolt": 2.0, "zork": 3.0, "xo ": 4.0, "*毒药": 5.0}, ["mount quolt", "quolt hill"])

    def total(text):
        return toxicity.matched(toxicity.fold(text), built)

    assert total("a mount quolt zorkel") == 3.0
    assert total("mount quolt mount quolt zork quolt") == 5.0
    assert total("xo zork xo xoa") == 11.0
    assert total("这是毒药吗毒药") == 10.0


def test_short_words_and_runs_without_spaces_are_learned(spark):
    rows = [(i, f"{a} qz {b}" if i % 2 else f"{a} {b}", i % 2) for i, (a, b) in enumerate(("abcd", f"word{j}") for j in range(80))]
    rows += [(100 + i, f"今天天气{'毒药' if i % 2 else '很好'}朋友{i}", i % 2) for i in range(80)]
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "key long, text string, label int"))
    assert "qz " in terms
    assert toxicity.matched(toxicity.fold("明天毒药"), toxicity.automaton(terms)) > 0


def test_all_labels_are_learned_from(spark):
    """A term in so few labelled texts that one half of them has too few."""
    rows = [(i, f"zorkel plain{i}" if i < toxicity.LEAST_TEXTS else f"plain{i}", int(i < 20)) for i in range(60)]
    labelled = spark.createDataFrame(rows, "key long, text string, label int")
    docs = spark.createDataFrame([("zorkel",), ("nothing",)], "text string")
    seen = []
    whole = toxicity.learn_terms
    toxicity.learn_terms = lambda rows: seen.append(whole(rows)) or seen[-1]
    try:
        toxicity.toxicity_scores(docs, labelled).collect()
    finally:
        toxicity.learn_terms = whole
    assert "zor" in seen[0] and not any("zor" in terms for terms in seen[1:])
