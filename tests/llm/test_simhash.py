import random
import re
from collections import Counter

import numpy as np
import xxhash

from tallyfold.llm import simhash
from tallyfold.llm.components import components

from .samples import LOWER, awkward, awkward_rows, nothing


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return 0
    grams = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_groups_match_brute_force(spark):
    rows = awkward_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(prints, 3)
    least = {}
    for row, group in zip(rows, groups):
        if row[0] is not None:
            least[group] = min(least.get(group, row[0]), row[0])
    expected = Counter((r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups))
    found = simhash.near_duplicate_groups(awkward(spark)).collect()
    assert Counter(tuple(r) for r in found) == expected


def test_one_row_of_each_group_stays_as_it_came(spark):
    docs = awkward(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = awkward_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(prints, 3)
    found = kept.collect()
    assert len(found) == len(set(groups))
    assert {tuple(r) for r in found} <= set(rows)
    least = {}
    for row, group in zip(rows, groups):
        least[group] = min(least.get(group, 1 << 62), 1 << 62 if row[0] is None else row[0])
    assert Counter(1 << 62 if r.doc_id is None else r.doc_id for r in found) == Counter(least.values())


def test_empty_table(spark):
    assert simhash.near_duplicate_groups(nothing(spark)).collect() == []
    assert simhash.drop_near_duplicates(nothing(spark)).collect() == []


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(3)
    for turn in range(3):
        masks = simhash.covering_masks(3, turn)
        assert len(masks) == 15
        for _ in range(2000):
            differing = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(differing & m == 0 for m in masks)


def test_split_buckets_lose_no_link(spark):
    rng = np.random.default_rng(4)
    centre = int(rng.integers(1 << 62))
    prints = {centre}
    while len(prints) < 400:
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 9), replace=False)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for limit in (4, 4096):
        found = {r.node: r.root for r in components(simhash.near_links(frame, 3, bucket_limit=limit)).collect()}
        groups = plain_components(prints, 3)
        by_group, by_root = {}, {}
        for p, g in zip(signed, groups):
            by_group.setdefault(g, set()).add(p)
            by_root.setdefault(found.get(p, p), set()).add(p)
        assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, by_root.values()))
