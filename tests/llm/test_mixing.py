import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

from tallyfold.llm import mixing

from .samples import SCHEMA, awkward, awkward_rows, nothing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, share=Fraction(3, 2), most=2):
    """Share by weight, cut at the limit, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > most * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in rest}
        for s in over:
            full[s] = Fraction(most * sizes[s])
        left = share * sum(sizes.values()) - sum(full.values())


def source_sizes(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    return dict(sizes)


def test_plan_meets_the_targets(spark):
    rows = awkward_rows()
    sizes = source_sizes(rows)
    targets = plain_targets(sizes)
    found = mixing.mix_plan(awkward(spark), block_words=64, shard_blocks=4).selectExpr("row.*", "size as n", "source_size", "target", "copies as c").collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        words = sum(c["taken"] for c in r.c)
        assert r.n == size_of(r.text) and words <= 2 * r.n
        assert r.source_size == sizes[r.source] and abs(r.target - float(targets[r.source])) < 1e-6
        taken[r.source] += words
    assert all(abs(taken[s] - float(targets[s])) <= 1 for s in sizes)
    again = mixing.mix_plan(awkward(spark), block_words=64, shard_blocks=4).selectExpr("row.doc_id", "row.text", "copies as c").collect()
    assert Counter((r.doc_id, r.text, str(r.c)) for r in again) == Counter((r.doc_id, r.text, str(r.c)) for r in found)


def test_mix_holds_the_planned_words(spark):
    docs = awkward(spark)
    sizes = source_sizes(awkward_rows())
    targets = plain_targets(sizes)
    out = mixing.mixed(docs, block_words=64, shard_blocks=4)
    assert out.columns == [*docs.columns, "mix_shard", "mix_pass"]
    rows = out.collect()
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += size_of(r.text)
    assert all(abs(taken[s] - float(targets[s])) <= 1 for s in sizes)
    texts = {(r[0], r[1]) for r in awkward_rows()}
    assert all(any(r.doc_id == i and t is not None and t.startswith(r.text) for i, t in texts) for r in rows)
    assert len({r.mix_shard for r in rows}) > 3


def test_tree_deals_every_block_once():
    quotas, shards = [50, 0, 7, 300], 9
    dealt = [mixing.shard_slices(quotas, shards, 1, s) for s in range(shards)]
    for k, quota in enumerate(quotas):
        places = sorted(p for first, n in dealt for p in range(first[k], first[k] + n[k]))
        assert places == list(range(quota))
    loads = [int(n.sum()) for _, n in dealt]
    assert max(loads) - min(loads) <= 1
    drawn = np.array([[mixing.shard_slices(quotas, 2, seed, 0)[1] for seed in range(300)]])[0].mean(axis=0)
    assert abs(drawn[3] - 150) < 3 and abs(drawn[0] - 25) < 2


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_plan(nothing(spark)).collect() == []
    assert mixing.mixed(nothing(spark)).collect() == []
    blank = spark.createDataFrame([r for r in awkward_rows() if not size_of(r[1])], SCHEMA)
    rows = mixing.mix_plan(blank).collect()
    assert len(rows) == blank.count() and all(r.copies == [] and r.target == 0 for r in rows)
    assert mixing.mixed(blank).collect() == []
