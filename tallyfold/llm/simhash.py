"""Near duplicates by SimHash fingerprints and a covering family of bit masks.

Every bit of the fingerprint gets a non-zero vector of ``radius + 1`` bits. Table ``v`` (any non-zero
vector) keeps the bits whose vector has an odd inner product with ``v``. Up to ``radius`` differing
bits span a proper subspace, so some ``v`` is orthogonal to all of them: in that table the two
fingerprints are equal. No pair within the radius is missed, and each table keeps about half of the
bits, so that a bucket holds few strangers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import group_starts, packed, text_hash, utf8, whole_groups
from tallyfold.llm.components import components
from tallyfold.session import staged

BITS = 64
_digest = partial(xxhash.xxh64_intdigest, seed=42)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased text, repeats included; none if it has no word."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) <= shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    return np.fromiter(map(_digest, grams), dtype=np.uint64, count=n)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; 0 for a text without words."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(rows: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    """``rows`` (all but the text) with ``fingerprint`` as a signed long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            prints = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column(at)], dtype=np.uint64)
            kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(prints.view(np.int64))], [*names, "fingerprint"])

    kept = rows.drop(text)
    return rows.mapInArrow(scan, kept.withColumn("fingerprint", F.lit(0).cast("long")).schema)


def covering_masks(radius: int, turn: int = 0) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` masks; ``turn`` deals the vectors to the bits in another order."""
    vectors = 2 ** (radius + 1) - 1
    order = np.random.default_rng(turn).permutation(BITS)
    of_bit = {int(bit): i % vectors + 1 for i, bit in enumerate(order)}
    return [sum(1 << b for b in range(BITS) if (of_bit[b] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _split(rows: DataFrame, masks: list[int]) -> DataFrame:
    """One row per mask: bits fixed so far and the new mask's, with the path of tables that led there."""
    choices = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(masks)])
    split = rows.withColumn("t", F.explode(choices))
    fixed = F.col("fixed").bitwiseOR(F.col("t.m"))
    return split.select(
        (F.col("path") * len(masks) + F.col("t.i")).alias("path"),
        F.col("fingerprint").bitwiseAND(fixed).alias("bucket"),
        fixed.alias("fixed"),
        "fingerprint",
    )


def _bucket_links(radius: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["path", "bucket"]):
            path, bucket = rows["path"].to_numpy(), rows["bucket"].to_numpy()
            prints = rows["fingerprint"].to_numpy()
            bits = prints.view(np.uint64)
            group = np.cumsum(group_starts(path, bucket))
            lefts, rights = [], []
            near, step = np.arange(len(bits)), 1
            while True:  # compare each row with the one `step` rows on, as long as some bucket is that large
                near = near[near + step < len(bits)]
                near = near[group[near] == group[near + step]]
                if not len(near):
                    break
                close = near[np.bitwise_count(bits[near] ^ bits[near + step]) <= radius]
                lefts.append(close)
                rights.append(close + step)
                step += 1
            if not lefts:
                continue
            left, right = np.concatenate(lefts), np.concatenate(rights)
            least = np.arange(len(bits))
            while True:  # a star per connected part of the bucket instead of all its pairs
                low = np.minimum(least[left], least[right])
                before = least.copy()
                np.minimum.at(least, left, low)
                np.minimum.at(least, right, low)
                least = least[least]
                if (least == before).all():
                    break
            moved = np.flatnonzero(least != np.arange(len(bits)))
            yield pa.RecordBatch.from_arrays([pa.array(prints[moved]), pa.array(prints[least[moved]])], ["a", "b"])

    return scan


def near_links(prints: DataFrame, radius: int = 3, bucket_limit: int = 4096) -> DataFrame:
    """Links (``a``, ``b``) with the same components as all pairs of distinct fingerprints within ``radius``.

    A bucket of more than ``bucket_limit`` fingerprints is split by a second covering family on top
    of the first, and so on: every pair within the radius still meets in some part, and each split
    halves the bits left free, which bounds the size of a part whatever the data.
    """
    rows = prints.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("fixed"), "fingerprint")
    found = None
    for turn in range(4):
        rows = staged(_split(rows, covering_masks(radius, turn)), "buckets")
        sizes = rows.groupBy("path", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = staged(sizes, "bucket-sizes")
        large = sizes.where(F.col("n") > bucket_limit) if turn < 3 else sizes.where("false")
        small = sizes.where(F.col("n") <= bucket_limit) if turn < 3 else sizes
        ready = rows.join(small.drop("n"), ["path", "bucket"])
        links = (
            ready.repartition("path", "bucket")
            .sortWithinPartitions("path", "bucket", "fingerprint")
            .select("path", "bucket", "fingerprint")
            .mapInArrow(_bucket_links(radius), "a long, b long")
        )
        found = links if found is None else found.unionByName(links)
        if large.isEmpty():
            break
        rows = rows.join(large.drop("n"), ["path", "bucket"]).select("path", "fixed", "fingerprint")
    return found.distinct()


def fingerprint_classes(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(rows of ``doc_id``, ``text_key``, ``fingerprint``; ``fingerprint`` to the ``root`` of its component)."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_key"), utf8(text).alias("text"))
    rows = staged(with_fingerprints(narrow, "text", shingle), "fingerprints")
    distinct = staged(rows.select("fingerprint").distinct(), "distinct-fingerprints")
    linked = components(near_links(distinct, radius))
    roots = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )
    return rows, roots


def near_duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(``doc_id``, ``fingerprint`` in hex, ``component_id``) for every row of ``docs``.

    Rows are linked if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    least ``doc_id`` reachable over links. A null, empty or blank text has fingerprint zero. A null
    id takes no part in the least id; a component of null ids only has a null id. Repeated rows are
    returned as often as they came; an empty table gives an empty one. Other columns are ignored.
    """
    rows, roots = fingerprint_classes(docs, doc_id, text, shingle, radius)
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    classes = staged(least.join(roots, "fingerprint"), "classes")
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(ids, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row of each component of :func:`near_duplicate_groups`, with its columns as they came.

    The row with the least id stays (a null id sorts last; then the least hash of the text). Of rows
    that are equal in id and text one stays.
    """
    rows, roots = fingerprint_classes(docs, doc_id, text, shingle, radius)
    first = Window.partitionBy("root").orderBy(F.asc_nulls_last("doc_id"), "text_key")
    ranked = rows.join(roots, "fingerprint").withColumn("rank", F.row_number().over(first))
    kept = staged(ranked.where("rank = 1").select("doc_id", "text_key"), "kept")
    keyed = packed(docs, doc_id=F.col(doc_id), text_key=text_hash(text)).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_key") == F.col("k.text_key"))
    found = keyed.join(kept.alias("k"), same, "left_semi")
    order = Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64("row"))
    return found.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("row.*")
