import re
from collections import Counter, defaultdict

from compare import connect, differences

from tallyfold.llm import decontaminate
from tallyfold.llm.queries import QUERIES, SQL

from .samples import LOWER, awkward_rows, nothing, SCHEMA


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def benchmark_rows():
    rows = awkward_rows()
    long = tokens(rows[53][1])
    return [
        (1, " ".join(long[100:150])),
        (2, " ".join(long[120:140]).upper()),
        (2, "other text of the"),
        (10, "ΑΣ ασ"),
        (3, rows[3][1]),
        (4, "word"),
        (5, None),
        (6, "... !!"),
        (None, "same line here"),
        (1, " ".join(long[100:150])),
    ]


def expected(rows, items, n=13, share=20):
    windows = defaultdict(set)
    for item, text in items:
        found = tokens(text)
        size = min(n, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            windows[tuple(found[i : i + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for r in rows:
        found = tokens(r[1])
        hit, seen = set(), set()
        for i in range(len(found)):
            for size in sizes:
                window = tuple(found[i : i + size])
                if len(window) == size and window in windows:
                    hit |= set(range(i, i + size))
                    seen |= windows[window]
        names = sorted(str(x) for x in seen if x is not None)
        out.append((r[0], len(found), len(hit), tuple(names), len(hit) > 0 and share * len(hit) >= len(found)))
    return Counter(out)


def test_hits_match_brute_force(spark):
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    items = spark.createDataFrame([(*r, 1) for r in benchmark_rows()], "item_id long, text string, at int")
    found = decontaminate.contamination(docs, items).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.items), r.contaminated) for r in found)
    assert got == expected(rows, benchmark_rows())
    kept = decontaminate.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    bad = expected(rows, benchmark_rows())
    assert kept.count() == sum(n for row, n in bad.items() if not row[-1])


def test_beyond_the_broadcast_bounds_the_result_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCUMENTS", 0)
    test_hits_match_brute_force(spark)


def test_empty_tables(spark):
    items = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    assert decontaminate.contamination(nothing(spark), items).collect() == []
    docs = spark.createDataFrame(awkward_rows()[:5], SCHEMA)
    rows = decontaminate.contamination(docs, items.where("false")).collect()
    assert len(rows) == 5 and not any(r.n_hit or r.contaminated for r in rows)
    assert decontaminate.remove_contaminated(docs, items.where("false")).count() == 5


def test_query_matches_sql(spark):
    name, tables = "op4_benchmark_decontamination", "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, tables), connect(tables), SQL[name]) == ""
