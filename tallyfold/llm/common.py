"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(rows: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``rows`` as one struct ``row`` beside the named ones, so that no names clash."""
    return rows.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def text_hash(text: str | Column) -> Column:
    """Hash that tells apart rows of the same id; rows equal in both are equal in every result."""
    return F.xxhash64(text)


def utf8(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def is_held_out(doc_id: str | Column, modulus: int, *remainders: int) -> Column:
    """Whether crc32 of the id as text, modulo ``modulus``, is one of the remainders; null ids are not."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
    return F.coalesce(remainder.isin(list(remainders)), F.lit(False))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables that end where a key ends, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        differs = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            differs |= values != values[-1]
        before_last = np.flatnonzero(differs)
        cut = int(before_last[-1]) + 1 if len(before_last) else 0
        if cut == 0 and held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


class Words(NamedTuple):
    """The words of some texts: the distinct ones in order of appearance, their index per word, and where words begin."""

    distinct: list[bytes]
    ids: np.ndarray
    begins: np.ndarray  # in the joined texts
    texts: np.ndarray  # where texts begin, and one more would
    joined: np.ndarray  # bytes of the texts, each with a line end behind it


def word_spans(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, found on the bytes of all texts at once.

    Bytes of the texts with A-Z in lower case, each with a line end behind it and seven zeros behind all;
    which of them are of words, where words begin and end, and where texts begin.
    """
    joined = np.frombuffer(b"\n".join(texts).lower() + b"\n" + bytes(7), dtype=np.uint8)
    inside = (joined != 32) & (joined - np.uint8(9) > 4)
    inside[-7:] = False
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    return joined, inside, edges[::2], edges[1::2], np.append(0, np.cumsum(sizes))


def words_of(texts: Sequence[bytes]) -> Words:
    """Words between ASCII white space, A-Z in lower case, found on the bytes of all texts at once."""
    joined, inside, begins, ends, starts = word_spans(texts)
    offsets = np.append(0, np.cumsum(ends - begins))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(joined[inside])])
    coded = words.dictionary_encode()
    _, bounds, letters = coded.dictionary.buffers()
    bounds, letters = np.frombuffer(bounds, dtype=np.int64)[: len(coded.dictionary) + 1].tolist(), letters.to_pybytes()
    distinct = [letters[i:j] for i, j in zip(bounds, bounds[1:])]
    return Words(distinct, coded.indices.to_numpy().astype(np.int64), begins, starts, joined[:-7])


#: Rows and bytes that a task holds before it deals them out to the buckets; least number of buckets.
_DEALT_ROWS, _DEALT_BYTES, _BUCKETS = 1 << 19, 32 << 20, 256


def _pieces(batches: Iterator[pa.RecordBatch], bucket: Callable[[pa.RecordBatch], np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """(``bucket``, ``data``): the rows in pieces of one bucket each."""

    def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        of = (bucket(rows) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(of, kind="stable")
        rows, of = rows.take(pa.array(order)), of[order]
        starts = np.flatnonzero(group_starts(of))
        data = [rows.slice(i, j - i).serialize().to_pybytes() for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(of)])]
        return pa.RecordBatch.from_arrays([pa.array(of[starts]), pa.array(data, pa.binary())], names=["bucket", "data"])

    held, n, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
        if n >= _DEALT_ROWS or size >= _DEALT_BYTES:
            yield dealt(held)
            held, n, size = [], 0, 0
    if held:
        yield dealt(held)


def gathered(
    rows: DataFrame,
    scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: pa.Schema,
    bucket: Callable[[pa.RecordBatch], np.ndarray],
    merge: Callable[[pa.Table], Iterator[pa.RecordBatch]],
    returns: str,
    least: int = 0,
) -> DataFrame:
    """What ``merge`` makes of the rows that ``scan`` makes of ``rows``, all rows of one bucket at a time.

    ``bucket`` hashes rows to 64 bits (unsigned). Rows travel as columns in a piece for each bucket, which
    costs a small part of what a shuffle and a sort of single rows cost. A task holds one bucket at a time,
    in no order. There are as many buckets as shuffle partitions and ``least`` at least: with many more, a
    task's pieces would be small.
    """
    buckets = max(_BUCKETS, least, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None

        def out() -> Iterator[pa.RecordBatch]:
            return merge(pa.Table.from_batches(held, schema).combine_chunks())

        for batch in batches:
            for of, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
                if of != last and held:
                    yield from out()
                    held = []
                last = of
                held.append(pa.ipc.read_record_batch(pa.py_buffer(data.as_buffer().to_pybytes()), schema))
        if held:
            yield from out()

    pieces = rows.mapInArrow(lambda batches: _pieces(scan(batches), bucket, buckets), "bucket int, data binary")
    return pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merged, returns)


def larger(tables: Iterator[pa.Table], rows: int = 1 << 16, size: int = 4 << 20) -> Iterator[pa.Table]:
    """The tables put together until they have so many rows or bytes, since small arrays cost more a row."""
    held: list[pa.Table] = []
    for table in tables:
        held.append(table)
        if sum(t.num_rows for t in held) >= rows or sum(t.nbytes for t in held) >= size:
            yield pa.concat_tables(held)
            held = []
    if held:
        yield pa.concat_tables(held)


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Whether each row begins a new group of equal, adjacent keys."""
    starts = np.zeros(len(columns[0]), dtype=bool)
    starts[:1] = True
    for values in columns:
        starts[1:] |= values[1:] != values[:-1]
    return starts


def stretches(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """The rows in stretches of about ``most`` in size, one row at least."""
    upto = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + most, "right")))
        yield slice(first, last)
        first = last


def broadcast_within(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (a written table) marked for broadcast if it has at most ``limit`` rows, else as it is."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, usable: Column, limit: int
) -> DataFrame:
    """At most ``limit`` labelled ids, chosen by hash, with their texts: (``key``, ``text``, ``label``).

    ``usable`` is a condition on ``key``. Ids that are null or labelled both ways are left out. The
    ids are broadcast, which their number bounds; equal rows of one id count once.
    """
    agreed = (
        labels.select(F.col(doc_id).alias("key"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin([0, 1]) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where((F.col("label") == F.col("most")) & usable)
    )
    chosen = agreed.orderBy(F.xxhash64("key", F.lit(7)), "key").limit(limit).select("key", "label")
    texts = docs.select(F.col(doc_id).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "key").dropDuplicates(["key", "text"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (the intercept last) of a ridge logistic regression by Newton's method."""
    rows = np.column_stack([x, np.ones(len(y))])
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, rows.T @ (y - p) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return weights
