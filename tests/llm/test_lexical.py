import math
import random
import re
from collections import Counter

import pytest
from compare import connect, differences

from tallyfold.llm import lexical, queries
from tallyfold.session import staged

from .samples import LOWER, awkward, awkward_rows, nothing

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id string, text string, term string, doc_id int, m int, query int"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) by brute force."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, length = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, c, size in counted:
            m = 50 + (50 * size * n) // length
            score = 0
            for t in set(terms(text)) & set(c):
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -score) for i, (score, null, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, k):
    asked = staged(lexical.query_terms(spark.createDataFrame([(*i, "x", 1, 2, 3) for i in items], ITEMS)), "items")
    index = lexical.build_index(staged(lexical.term_counts(docs), "counts"))
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(index, asked, k).collect()), key=str)


def items():
    rng = random.Random(8)
    rows = awkward_rows()
    made = [(str(i), " ".join(rng.sample(rows[rng.randrange(40)][1].split(), 1))) for i in range(6)]
    made += [(str(10 + i), rows[3 * i][1]) for i in range(6)]
    made += [("a", "W1 w1 w2, w3-w4"), ("a", "w9"), ("a", "w9"), (None, "word ÀÉ ß ασ"), ("none", None), ("empty", ""), ("absent", "zzzz"), ("same", "same")]
    return made


@pytest.mark.parametrize("k", [1, 7, 50])
def test_ranks_match_brute_force(spark, k):
    docs = [(r[0], r[1]) for r in awkward_rows()]
    assert searched(spark, awkward(spark), items(), k) == ranked(docs, items(), k)


def test_small_blocks_waves_and_query_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 2)
    monkeypatch.setattr(lexical, "FIRST_VISITS", 2)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 150)
    monkeypatch.setattr(lexical, "_PAIRS", 40)
    rng = random.Random(3)
    rows = awkward_rows() + [(1000 + i, " ".join(rng.choice(["w1", "w2", "w3", f"x{i % 9}"]) for _ in range(6)), *awkward_rows()[0][2:]) for i in range(300)]
    docs = spark.createDataFrame(rows, awkward(spark).schema).repartition(6)
    assert searched(spark, docs, items(), 5) == ranked([(r[0], r[1]) for r in rows], items(), 5)


def test_an_index_of_the_asked_terms_gives_the_same(spark):
    asked = staged(lexical.query_terms(spark.createDataFrame([(*i, "x", 1, 2, 3) for i in items()], ITEMS)), "items")
    counts = staged(lexical.term_counts(awkward(spark)), "counts")
    wanted = asked.selectExpr("explode(terms) AS term")
    found = [lexical.search(lexical.build_index(counts, t), asked, 9).drop("item").collect() for t in (None, wanted)]
    assert sorted(found[0], key=str) == sorted(found[1], key=str)


def test_no_documents_and_no_items(spark):
    assert searched(spark, nothing(spark), items(), 5) == []
    assert searched(spark, awkward(spark), [], 5) == []


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(queries.QUERIES["op11_lexical_search"](spark, sf), connect(sf), queries.SQL["op11_lexical_search"]) == ""
