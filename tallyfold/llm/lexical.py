"""Ranked lexical search over a length-stratified index.

Documents of equal normaliser m form a stratum, in which a term's weight in a document depends on its
count tf alone: the impact of a posting is computed once per tf, and the greatest tf of each term bounds
what any document of the stratum can score. A query visits the strata in the order of their bounds, a
few at first, and leaves out those whose bound lies below the last of the best documents found so far.
Bounds and scores are exact integers, so nothing that belongs to the result is left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallyfold.llm.common import stretches
from tallyfold.session import staged

BLOCK_DOCS = 1024  # documents of a stratum in one row of the index
QUERY_TERMS = 500_000  # (item, term) rows of the queries that are searched together
FIRST_VISITS = 16  # strata a query visits in its first wave; the next waves go 16 times as far each
_PAIRS = 500_000  # (query, posting) pairs scored at a time
_TEXT_BYTES = 2_000_000  # texts counted at a time

# FIXED VALUES: what is not part of a term, and the scales of the ranking.
_FOLDED = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
IMPACT, TF_SCALE, M_SCALE, M_MEAN, M_LENGTH = 1_000_000_000, 1000, 20, 100, 50


def terms_of(text: str) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, only A-Z lower-cased."""
    return text.encode().translate(_FOLDED).split()


def term_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``doc_id``, ``n``, ``terms``, ``tfs``): each document's terms, counted over its whole text.

    Documents without a term (null or empty texts) are left out. The key numbers the rows, so that
    repeated rows and null ids stay apart; write the table before its keys are used.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in stretches(pc.binary_length(batch.column("text")).to_numpy(), _TEXT_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                counts = [Counter(terms_of(text)) for text in part.column("text").to_pylist()]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int32))
                terms = pa.array([t for c in counts for t in c], pa.binary()).cast(pa.string())
                tfs = pa.array([n for c in counts for n in c.values()], pa.int64())
                sizes = pa.array([c.total() for c in counts], pa.int64())
                lists = [pa.ListArray.from_arrays(offsets, values) for values in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, *lists], names=["doc_id", "n", "terms", "tfs"])

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = narrow.mapInArrow(counted, "doc_id long, n long, terms array<string>, tfs array<long>")
    return rows.where("n > 0").select(F.monotonically_increasing_id().alias("key"), "*")


class Index(NamedTuple):
    """``blocks``: a row per block of a stratum, its postings ordered by term and tf; ``tops``: the greatest
    tf of a term in a stratum; ``sizes``: documents of a stratum; ``df``: documents of a term; ``documents``:
    how many documents have a term."""

    blocks: DataFrame
    tops: DataFrame
    sizes: DataFrame
    df: DataFrame
    documents: int


def build_index(counts: DataFrame, asked: DataFrame | None = None) -> Index:
    """The index over the written table of ``term_counts``, of the terms in ``asked`` only if it is given.

    A stratum of any size is cut into blocks by hash of the document, so that neither a frequent length
    nor a frequent term meets in one task. No document, no block.
    """
    documents, length = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    m = F.expr(f"{M_MEAN - M_LENGTH} + ({M_LENGTH} * n * {documents}L) DIV {length or 1}L")
    sizes = staged(counts.groupBy(m.alias("m")).agg(F.count(F.lit(1)).alias("docs")), "strata")
    pairs = F.explode(F.arrays_zip("terms", "tfs"))
    postings = counts.select("key", "doc_id", m.alias("m"), pairs.alias("p")).select("key", "doc_id", "m", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
    if asked is not None:
        postings = postings.join(asked.select("term").distinct(), "term")
    cut = F.pmod(F.xxhash64("key"), F.ceil(F.col("docs") / BLOCK_DOCS))
    placed = postings.join(sizes, "m").select("m", cut.alias("block"), "term", "tf", "key", "doc_id")
    ordered = placed.repartition("m", "block").sortWithinPartitions("m", "block", "term", "tf", "key")
    schema = (
        "m long, block long, doc_ids array<long>, terms array<string>, tfs array<long>, ends array<int>, places array<int>"
    )
    blocks = staged(ordered.mapInArrow(_blocks, schema), "lexical_index")
    begins = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    runs = blocks.withColumn("begins", begins).select("m", F.explode(F.arrays_zip("terms", "tfs", "begins", "ends")).alias("r"))
    df = runs.groupBy(F.col("r.terms").alias("term")).agg(F.sum(F.col("r.ends") - F.col("r.begins")).alias("df"))
    tops = runs.groupBy("m", F.col("r.terms").alias("term")).agg(F.max("r.tfs").alias("tf"))
    return Index(blocks, staged(tops, "lexical_tops"), sizes, staged(df, "lexical_df"), documents)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows from postings in the order of (m, block, term, tf)."""
    held: list[pa.Table] = []
    current = None

    def closed() -> pa.RecordBatch:
        rows = pa.concat_tables(held).combine_chunks()
        keys, first, places = np.unique(rows["key"].to_numpy(), return_index=True, return_inverse=True)
        terms = rows["term"].combine_chunks().dictionary_encode()
        code, tf = terms.indices.to_numpy(), rows["tf"].to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
        ends = np.append(begins[1:], len(code)).astype(np.int32)
        columns = [rows["doc_id"].take(pa.array(first)), terms.dictionary.take(pa.array(code[begins])), pa.array(tf[begins]), pa.array(ends)]
        arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in [*columns, pa.array(places.astype(np.int32))]]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays]
        return pa.RecordBatch.from_arrays(
            [pa.array([current[0]]), pa.array([current[1]]), *lists], names=["m", "block", "doc_ids", "terms", "tfs", "ends", "places"]
        )

    for batch in batches:
        if batch.num_rows == 0:
            continue
        m, block = batch.column("m").to_numpy(), batch.column("block").to_numpy()
        edges = np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(m)]):
            key = (int(m[a]), int(block[a]))
            if key != current:
                if held:
                    yield closed()
                held, current = [], key
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield closed()


class _Queries(NamedTuple):
    """Queries searched together: their terms as (term number, query, weight), ordered by term number."""

    names: pa.Array
    starts: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    count: int

    def pairs(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every place in ``terms`` the queries that ask for it: (place, query, weight)."""
        number = pc.index_in(terms, value_set=self.names)
        place = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
        number = number.drop_null().to_numpy()
        many = self.starts[number + 1] - self.starts[number]
        at = _spread(self.starts[number], many)
        return np.repeat(place, many), self.query[at], self.weight[at]


def _spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each begin, as many as its count."""
    upto = np.cumsum(counts)
    return np.arange(counts.sum()) + np.repeat(begins - (upto - counts), counts)


def _impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (IMPACT * tf) // (TF_SCALE * tf + M_SCALE * m)


def _bounds(tops: DataFrame, queries: _Queries) -> DataFrame:
    """(``m``, ``query``, ``bound``): what a document of the stratum can score at most, where that is above 0."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                m = batch.column("m")[i].as_py()
                tops = batch.column("tops")[i].values
                place, query, weight = queries.pairs(tops.field("term"))
                impact = _impacts(tops.field("tf").to_numpy(), m)
                total = np.zeros(queries.count, dtype=np.int64)
                np.add.at(total, query, weight * impact[place])
                found = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), m)), pa.array(found), pa.array(total[found])], names=["m", "query", "bound"])

    grouped = tops.groupBy("m").agg(F.collect_list(F.struct("term", "tf")).alias("tops"))
    return grouped.mapInArrow(bounded, "m long, query long, bound long")


def _best(query: np.ndarray, score: np.ndarray, known: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, equal scores by document, null ones last."""
    order = np.lexsort((doc, ~known, -score, query))
    starts = np.flatnonzero(np.concatenate([[True], query[order][1:] != query[order][:-1]])) if len(order) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _scored(blocks: DataFrame, queries: _Queries, k: int, start: np.ndarray) -> DataFrame:
    """Each task's best ``k`` of every query over the given blocks, whose rows name the queries that visit them
    (``visitors``); ``start`` holds the score that each query's documents have to reach."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = start.copy()
        found = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)]

        def keep(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
            joined = [np.concatenate(c) for c in zip(found, *parts)]
            best = _best(*joined, k)
            kept = [c[best] for c in joined]
            full = np.bincount(kept[0], minlength=queries.count) == k
            last = np.zeros(queries.count, dtype=np.int64)
            last[kept[0]] = kept[1]  # ordered by falling score, so the last one stays
            np.maximum(least, np.where(full, last, least), out=least)
            return kept

        pending: list[list[np.ndarray]] = []
        waiting = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                visitors = row["visitors"].values.to_numpy()
                for part in _block_scores(row, visitors, queries, least):
                    pending.append(part)
                    waiting += len(part[0])
                if waiting > _PAIRS:
                    found, pending, waiting = keep(pending), [], 0
        found = keep(pending)
        query, score, known, doc = found
        ids = pa.array(doc, mask=~known)
        yield pa.RecordBatch.from_arrays([pa.array(query), ids, pa.array(score)], names=["query", "doc_id", "score"])

    return blocks.mapInArrow(scan, "query long, doc_id long, score long")


def _block_scores(row: dict, visitors: np.ndarray, queries: _Queries, least: np.ndarray) -> Iterator[list[np.ndarray]]:
    """(query, score, known, doc) of the block's documents that reach their query's least score."""
    place, query, weight = queries.pairs(row["terms"].values)
    wanted = np.zeros(queries.count, dtype=bool)
    wanted[visitors] = True
    kept = wanted[query]
    place, query, weight = place[kept], query[kept], weight[kept]
    order = np.argsort(query, kind="stable")
    place, query, weight = place[order], query[order], weight[order]
    ends = row["ends"].values.to_numpy().astype(np.int64)
    begins = np.append(0, ends[:-1])
    gain = weight * _impacts(row["tfs"].values.to_numpy(), row["m"].as_py())[place]
    places = row["places"].values.to_numpy()
    docs = row["doc_ids"].values
    known = docs.is_valid().to_numpy(zero_copy_only=False)
    doc = docs.fill_null(0).to_numpy()
    many = (ends - begins)[place]
    # Whole queries at a time, as many as keep the pairs within their bound.
    edges = np.flatnonzero(np.diff(query, prepend=-1))
    upto = np.append(0, np.cumsum(many))
    first = 0
    while first < len(edges):
        last = int(np.searchsorted(upto[np.append(edges, len(query))], upto[edges[first]] + _PAIRS, "right")) - 1
        last = max(last, first + 1)
        cut = slice(edges[first], edges[last] if last < len(edges) else len(query))
        asked = query[edges[first:last]]
        local = np.searchsorted(asked, query[cut])
        at = places[_spread(begins[place[cut]], many[cut])]
        total = np.zeros(len(asked) * len(doc), dtype=np.int64)
        np.add.at(total, np.repeat(local, many[cut]) * len(doc) + at, np.repeat(gain[cut], many[cut]))
        hit = np.flatnonzero(total >= np.repeat(least[asked], len(doc)))
        yield [asked[hit // len(doc)], total[hit], known[hit % len(doc)], doc[hit % len(doc)]]
        first = last


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(``item``, ``item_id``, ``terms``): the distinct terms of every item; rows equal in id and text are one item.

    The numbers in ``item`` hold once the table is written.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(text))) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string()))], names=["item_id", "terms"])

    narrow = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    schema = StructType([narrow.schema["item_id"], StructField("terms", ArrayType(StringType()))])
    return narrow.mapInArrow(distinct, schema).select(F.monotonically_increasing_id().alias("item"), "*")


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: (``item``, ``item_id``, ``rank`` from 1, ``doc_id``, ``score``).

    ``items`` is the written table of ``query_terms``. Scores above 0 only; equal scores follow the document
    id, null last; of repeated rows each has a rank of its own. Items without a term, or whose terms no
    document holds, have no rows, so an empty index or no items give an empty table. Items are searched
    in blocks of about ``QUERY_TERMS`` terms, the only rows that pass the driver.
    """
    spark = items.sparkSession
    ratio = F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(1000 * F.log(ratio)).cast("long")
    asked = items.select("item", F.explode("terms").alias("term")).join(index.df, "term").select("item", "term", weight.alias("weight"))
    asked = staged(asked.where("weight > 0"), "asked")
    n_blocks = -(-asked.count() // QUERY_TERMS)
    n_strata = index.sizes.count()
    found = []
    for number in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == number).toArrow()
        keys, query = np.unique(rows["item"].to_numpy(), return_inverse=True)
        names = rows["term"].combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        starts = np.searchsorted(code[order], np.arange(len(names.dictionary) + 1))
        queries = _Queries(names.dictionary, starts, query[order], rows["weight"].to_numpy()[order], len(keys))
        items_of = spark.createDataFrame(pa.table({"query": np.arange(len(keys)), "item": keys}))
        best = _visited(index, asked.select("term").distinct(), queries, n_strata, k)
        found.append(best.join(items_of, "query").select("item", "rank", "doc_id", "score"))
    if not found:
        return items.selectExpr("item", "item_id", "0 AS rank", "0L AS doc_id", "0L AS score").where("false")
    whole = reduce(DataFrame.unionByName, found)
    return whole.join(items.select("item", "item_id"), "item").select("item", "item_id", "rank", "doc_id", "score")


def _visited(index: Index, terms: DataFrame, queries: _Queries, n_strata: int, k: int) -> DataFrame:
    """The best of every query, from as many waves of strata as their bounds call for."""
    bounds = _bounds(index.tops.join(terms, "term", "left_semi"), queries)
    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "m"))
    bounds = staged(bounds.withColumn("turn", turn), "bounds")
    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = None
    least = np.ones(queries.count, dtype=np.int64)
    after, upto = 0, FIRST_VISITS
    while True:
        due = bounds.where(F.col("turn").between(after + 1, upto))
        if best is not None:
            last = best.where(F.col("rank") == k).select("query", "score")
            for row in last.collect():  # one number a query
                least[row.query] = row.score
            due = due.join(last, "query", "left").where(F.col("score").isNull() | (F.col("bound") >= F.col("score")))
        # Written, so that its size is known: a row a stratum with the numbers of its visitors.
        visits = staged(due.groupBy("m").agg(F.collect_list(F.col("query").cast("int")).alias("visitors")), "visits")
        scored = _scored(index.blocks.join(visits, "m"), queries, k, least.copy())
        if best is not None:
            scored = scored.unionByName(best.drop("rank"))
        best = staged(scored.withColumn("rank", ranked).where(F.col("rank") <= k), "best")
        if upto >= n_strata:
            return best
        after, upto = upto, upto * FIRST_VISITS
