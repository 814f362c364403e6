import hashlib
import random
import zlib

import pytest

from tallyfold.llm import prefixtrie, queries

from compare import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string, conv int, pos string, at int, block string, t0 int"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def trie(sequences):
    """Nodes by brute force from {conv_id: [(role, text)]}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            sum(v not in children for v in below), sum((len(members[v]) - 1) * len(v[-1][1]) for v in below if v),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def grouped(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(sequences):
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in sequences}
    return {c: sequences.get(c - c % 100, [])[: heads[c]] + turns[heads[c] :] for c, turns in sequences.items()}


def extra(rows):
    return [(*r, 1, "x", 2, "y", 3) for r in rows]


def awkward():
    rng = random.Random(6)
    rows = []
    for conv in [*range(40), *range(100, 130), 205, 299, 1000, 10**15, 10**15 + 7]:
        for turn in range(rng.randint(0, 5) if conv % 100 else 9):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "é🙂"])))
    rows += [(500 + i, t, "user", "same") for i in range(30) for t in range(19)]  # a group of copies over three blocks
    rows += [(700, t, "user", str(t % 3)) for t in range(3000)]  # a long conversation and its near copy
    rows += [(800, t, "user", str(t % 3) if t != 2990 else "other") for t in range(3000)]
    rows += [(c, 0, "user", "gone with its head") for c in range(1301, 1310)]  # no conversation 1300 to take a head from
    rows += [(None, 0, "user", "nobody's"), (900, None, "user", "null first"), (900, 0, "user", "then"), (900, 1, None, "third")]
    rows += [(901, 7, "user", "tie")] * 9 + [(902, t, "user", "few") for t in range(2)]
    return rows


def plain(frame):
    return sorted((tuple(r[n] for n in NAMES) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def ordered(spark):
    frame = spark.createDataFrame(extra(awkward()), SCHEMA).repartition(7)
    return prefixtrie.ordered_turns(frame)


def short(sequences):
    """Brute force over whole subtrees is quadratic: without the two long conversations."""
    return {c: turns for c, turns in sequences.items() if len(turns) < 100}


def test_nodes_match_brute_force(spark, ordered):
    kept = ordered.where("conv not in (700, 800)")
    expected = trie(short(grouped(awkward())))
    assert plain(prefixtrie.prefix_trie(kept, kept.select("conv").distinct())) == expected


def test_rebuilt_conversations_match_brute_force(spark, ordered):
    kept = ordered.where("conv not in (700, 800)")
    turns, convs = prefixtrie.with_shared_heads(kept)
    sequences = rebuilt(short(grouped(awkward())))
    assert any(not turns for turns in sequences.values())
    assert plain(prefixtrie.prefix_trie(turns, convs)) == trie(sequences)


def test_a_long_conversation_continues_in_further_blocks(spark, ordered, monkeypatch):
    monkeypatch.setattr(prefixtrie, "_FAR", 16)
    kept = ordered.where("conv in (700, 800)")
    nodes = {(r.conv_id, r.depth): r for r in prefixtrie.prefix_trie(kept, kept.select("conv").distinct()).collect()}
    assert len(nodes) == 2991 + 2 * 10
    assert nodes[(700, 2990)].n_children == 2 and nodes[(700, 2990)].n_leaves == 2 == nodes[(700, 0)].n_leaves
    assert nodes[(700, 0)].saved_tokens == 2990 and nodes[(700, 2000)].saved_tokens == 991
    assert nodes[(800, 2991)].parent_conv_id == 700 and nodes[(800, 3000)].saved_tokens == 0


def test_empty_and_turnless(spark):
    none = prefixtrie.ordered_turns(spark.createDataFrame([], SCHEMA))
    assert plain(prefixtrie.prefix_trie(none, none.select("conv"))) == []
    only = spark.createDataFrame([(3,), (11,)], "conv long")
    digest = hashlib.sha256(b"3,11").hexdigest()
    assert plain(prefixtrie.prefix_trie(none, only)) == [(3, 0, None, 2, 0, 1, 0, digest)]


def test_ids_of_many_ends_are_hashed_in_ranges(spark):
    convs = spark.range(5000).selectExpr("id * 7 AS conv")
    turns = convs.selectExpr("conv", "1L AS pos", "unhex('00') AS turn_id", "2L AS chars")
    digest = hashlib.sha256(",".join(str(7 * i) for i in range(5000)).encode()).hexdigest()
    last = [r for r in plain(prefixtrie.prefix_trie(turns, convs)) if r[1] == 1]
    assert last == [(0, 1, 0, 5000, 0, 1, 2 * 4999, digest)]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(queries.QUERIES["op12_prefix_trie"](spark, sf), connect(sf), queries.SQL["op12_prefix_trie"]) == ""
