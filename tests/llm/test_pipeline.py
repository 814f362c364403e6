"""The stages on the smallest tables: what each one must keep and what it must take away."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyfold.session import staged

from .samples import LOWER, awkward, nothing
from .test_decontaminate import expected as contaminated
from .test_linededup import plain_removed
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(staged(stage(spark, tables[-1], SF), name))
    return tables


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_order_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing"]
    assert all(t.columns == results[0].columns for t in results[:-1])


def test_toxic_documents_go(spark, results):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in results[1].collect()}
    clean = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in kept for i in clean) / len(clean) > 0.95
    assert set(rows_of(results[1])) <= set(rows_of(results[0]))


def test_repeated_lines_go(results):
    before, after = rows_of(results[1]), dict((r[0], r[1]) for r in rows_of(results[2]))
    removed = plain_removed(before)
    assert len(after) == len(before)
    for r in before:
        assert after[r[0]] == "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in removed[r[0], r[1]])


def test_one_document_of_each_group_stays(results):
    before, after = rows_of(results[2]), rows_of(results[3])
    groups = plain_components([plain_fingerprint(r[1]) for r in before], 3)
    least = {}
    for r, g in zip(before, groups):
        least[g] = min(least.get(g, r[0]), r[0])
    assert sorted(r[0] for r in after) == sorted(least.values())
    assert set(after) <= set(before)


def test_contaminated_documents_go(spark, results):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = rows_of(results[3]), rows_of(results[4])
    bad = {r[0] for r in contaminated(before, items) if r[-1]}
    assert sorted(r[0] for r in after) == sorted(r[0] for r in before if r[0] not in bad)


def test_mix_keeps_to_the_documents(results):
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text.translate(LOWER))) for r in results[4].collect()}
    taken = {}
    for r in results[5].collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 20
    assert all(n <= 2 * sizes[i] for i, n in taken.items())


def test_run_and_registration(spark, results):
    assert sorted(n for n in entry.queries() if re.match(r"op\d+_", n)) == sorted(
        "op1_html_extraction op2_mixing op3_simhash_near_dedup op4_benchmark_decontamination op5_lm_scoring "
        "op6_nearest_neighbours op7_chat_formatting op8_toxicity op9_quality_classifier op10_line_dedup "
        "op11_lexical_search op12_prefix_trie op13_byte_bpe".split()
    )
    found = entry.queries()["pipeline"](spark, SF)
    assert found.columns == results[5].columns and found.count() == results[5].count()


@pytest.mark.parametrize("rows", [awkward, nothing], ids=["awkward", "empty"])
def test_stages_take_awkward_and_empty_tables(spark, rows):
    """Nulls, long and repeated texts, ties and clashing names, or no rows: nothing fails, columns stay, nothing is made up."""
    tables = [rows(spark)]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(staged(stage(spark, tables[-1], SF), name))
    assert all(t.columns == tables[0].columns for t in tables[:-1])
    counts = [t.count() for t in tables[:-1]]
    assert counts == sorted(counts, reverse=True)
    texts = [{r.text for r in t.collect()} for t in tables]
    assert texts[1] <= texts[0] and texts[3] <= texts[2] and texts[4] <= texts[3]
    # The mix may take a part of a document, from its beginning.
    assert all(any((whole or "").startswith(part or "") for whole in texts[4]) for part in texts[5])
    assert (counts[0] == 0) == (rows is nothing) and (rows is awkward or tables[-1].count() == 0)
