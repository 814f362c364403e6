"""Quality by compression: how much better a text packs with a dictionary of good texts than of bad ones.

Two zstandard dictionaries are built from pieces of good and bad labelled texts. The difference of
the compressed sizes, normalised by their sum, is calibrated by logistic regression, together with how
far the better dictionary shrinks the text: what repeats itself, or holds no pattern at all, packs
alike with both. Each half of the labelled texts is measured with dictionaries of the other half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import fit_logistic, utf8
from tallyfold.session import staged

#: Pieces per class that a dictionary is built from, and labelled rows that the calibration is fitted on.
SAMPLE_PIECES = 6_000
SAMPLE_ROWS = 20_000
PIECE_BYTES = 1_024
DICTIONARY_BYTES = 1 << 17
LEVEL = 3
SCAN_BYTES = 1 << 17
FRAME_BYTES = 16  # about what a frame takes besides its content


def _sampled(rows: DataFrame, wanted: int, *keys: str) -> DataFrame:
    """About ``wanted`` rows, those of small hash: a bounded sample that does not depend on partitions.

    Every task picks its own; nothing is sorted or gathered in one place to be cut.
    """
    total = rows.count()
    place = (F.xxhash64(*keys, F.lit(7)).cast("double") + 2.0**63) / 2.0**64
    return rows if total <= wanted else rows.where(place < wanted / total)


def build_dictionary(pieces: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A trained dictionary, or the pieces themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(pieces)[-size:] or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def train_dictionaries(labelled: DataFrame) -> tuple[bytes, bytes]:
    """Dictionaries (good, bad) from a bounded sample of pieces of the labelled texts, whole texts cut up."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("text")), F.lit(PIECE_BYTES))
    pieces = labelled.select("key", "label", "text", F.posexplode(starts).alias("at", "start")).select(
        "key", "label", "at", F.substring("text", F.col("start"), F.lit(PIECE_BYTES)).alias("piece")
    )
    found = []
    for value in (1, 0):
        rows = _sampled(pieces.where((F.col("label") == value) & (F.length("piece") > 0)), SAMPLE_PIECES, "key", "at")
        # In the order of a hash: the trainer goes through its pieces in stretches, each of which should be mixed.
        mixed = rows.orderBy(F.xxhash64("key", "at", F.lit(3)), "key", "at").select("piece").collect()
        found.append(build_dictionary([r.piece.encode() for r in mixed]).as_bytes())
    return found[0], found[1]


def _packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data)


def _measures(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float]:
    """(bad - good) / (bad + good) over the whole text, and the log of the smaller of both against its length.

    The text goes in blocks, so that the dictionary stays in reach.
    """
    blocks = [text[i : i + SCAN_BYTES] for i in range(0, len(text), SCAN_BYTES)] or [b""]
    with_good = sum(len(good.compress(b)) for b in blocks)
    with_bad = sum(len(bad.compress(b)) for b in blocks)
    shrunk = math.log((min(with_good, with_bad) + FRAME_BYTES) / (len(text) + FRAME_BYTES))
    return (with_bad - with_good) / (with_bad + with_good), shrunk


def _measured(rows: DataFrame, text: str, dictionaries: tuple[bytes, bytes]) -> DataFrame:
    """``rows`` without the (binary) text, with ``difference`` and ``shrunk``."""
    broadcast = rows.sparkSession.sparkContext.broadcast(dictionaries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = (_packer(d) for d in broadcast.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = np.array([_measures(t.as_buffer().to_pybytes(), good, bad) for t in batch.column(at)], dtype=float).reshape(-1, 2)
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), *(pa.array(c) for c in found.T.copy())],
                [*(batch.schema.names[i] for i in kept), "difference", "shrunk"],
            )

    schema = rows.drop(text).withColumn("difference", F.lit(0.0)).withColumn("shrunk", F.lit(0.0)).schema
    return rows.mapInArrow(scan, schema)


def _calibration(labelled: DataFrame) -> np.ndarray:
    """Weights of the difference (times ten), of ``shrunk`` and its square, and the intercept."""
    halved = labelled.withColumn("half", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(2)))
    sample = _sampled(halved, SAMPLE_ROWS, "key", "text").select(utf8("text").alias("text"), "label", "half")
    parts = [
        _measured(sample.where(F.col("half") == h), "text", train_dictionaries(halved.where(F.col("half") != h))).toPandas()
        for h in (0, 1)
    ]
    x = np.concatenate([p[["difference", "shrunk"]].to_numpy(float) for p in parts])
    y = np.concatenate([p["label"].to_numpy(float) for p in parts])
    return fit_logistic(np.column_stack([x[:, 0] * 10, x[:, 1], x[:, 1] ** 2]), y) if len(y) else np.zeros(4)


def quality_scores(
    docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(``doc_id``, ``difference``, ``shrunk``, ``score``) of every row of ``docs``; score is the chance of label 1.

    ``labelled`` is a bounded sample as of :func:`~tallyfold.llm.common.labelled_sample`. Nothing but
    the text enters a score. Null texts score as empty ones; with no usable labels every score is one
    half. Repeated rows are scored each, an empty table gives an empty one. Other columns are ignored.
    """
    labelled = staged(labelled, "labelled")
    difference, shrunk, square, rest = (float(w) for w in _calibration(labelled))
    texts = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    scored = _measured(texts, "text", train_dictionaries(labelled))
    logit = F.lit(difference * 10) * F.col("difference") + shrunk * F.col("shrunk") + square * F.col("shrunk") * F.col("shrunk") + rest
    return scored.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(logit, F.lit(700.0))))))
