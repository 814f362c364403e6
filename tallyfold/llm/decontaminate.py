"""Benchmark decontamination: a hash set of normalised test n-grams against training token windows.

DataFrame operations only. Window hashes of the benchmark are broadcast (behind a check of their
number) and meet the hashes of all windows of a document; hits are then verified word by word, since
the hashes are of a coarser spelling and may collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import broadcast_within, packed, text_hash
from tallyfold.session import staged

#: What separates words once A-Z is lower-cased; upper case is kept so that either spelling splits alike.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_WINDOWS = 1_000_000
BROADCAST_DOCUMENTS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def coarse_words(text: Column) -> Column:
    """Words in full lower case: equal wherever the A-Z lower-cased words are, and fast.

    The capital sigma is replaced first, being the one letter whose lower case depends on its neighbours.
    """
    return _split(F.lower(F.replace(text, F.lit("Σ"), F.lit("σ"))))


def _windows(words: Column, length: int) -> Column:
    """(``at`` from 1, ``length``, ``hash``) of every run of ``length`` words."""
    last = F.size(words) - length + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), F.xxhash64(F.slice(words, i, length)).alias("hash")),
    )


def _spelled(words: Column, at: Column, length: Column) -> Column:
    """The run of words as one string, A-Z in lower case."""
    return F.translate(F.array_join(F.slice(words, at, length), " "), _UPPER, _LOWER)


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """Distinct windows: (``length``, ``hash``, ``spelled``, ``items``: the ids as strings that have it)."""
    words = benchmark.select(
        F.col(item_id).cast("string").alias("item"),
        coarse_words(F.col(text)).alias("coarse"),
        _split(F.col(text)).alias("words"),
    ).where(F.size("words") > 0)
    length = F.least(F.lit(n), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    each = words.withColumn("length", length).withColumn("at", F.explode(starts))
    return (
        each.select(
            "item",
            "length",
            F.xxhash64(F.slice("coarse", F.col("at"), F.col("length"))).alias("hash"),
            _spelled(F.col("words"), F.col("at"), F.col("length")).alias("spelled"),
        )
        .groupBy("length", "hash", "spelled")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Places in documents whose window hash is one of the benchmark's, one row per document."""
    lengths = [r.length for r in windows.select("length").distinct().collect()]  # at most n values
    words = docs.select("doc_id", "text_key", coarse_words(F.col("text")).alias("words"))
    if not lengths:
        each = words.select("doc_id", "text_key", F.lit(0).alias("at"), F.lit(0).alias("length")).where("false")
    else:
        runs = F.concat(*[_windows(F.col("words"), n) for n in lengths])
        each = words.select("doc_id", "text_key", F.explode(runs).alias("run")).select("doc_id", "text_key", "run.*")
        each = each.join(broadcast_within(windows, BROADCAST_WINDOWS).select("length", "hash").distinct(), ["length", "hash"])
    return each.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "length")).alias("places"))


def hits(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, n: int) -> DataFrame:
    """Verified hits of the documents that have any, per (``doc_id``, ``text_key``).

    ``spans`` are (``at`` from 1, ``length``) of the occurrences in words, ``items`` the sorted ids.
    """
    windows = staged(benchmark_windows(benchmark, item_id, item_text, n), "benchmark-windows")
    found = staged(_candidates(docs, windows), "window-candidates")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_key") == F.col("c.text_key"))
    held = docs.alias("d").join(broadcast_within(found, BROADCAST_DOCUMENTS).alias("c"), same)
    spelled = held.select("d.doc_id", "d.text_key", _split(F.col("d.text")).alias("words"), "c.places").select(
        "doc_id",
        "text_key",
        F.transform(
            "places",
            lambda p: F.struct(p["at"].alias("at"), p["length"].alias("length"), _spelled(F.col("words"), p["at"], p["length"]).alias("spelled")),
        ).alias("places"),
    )
    each = spelled.select("doc_id", "text_key", F.explode("places").alias("p")).select("doc_id", "text_key", "p.*")
    exact = each.join(broadcast_within(windows, BROADCAST_WINDOWS).select("spelled", "items"), "spelled")
    grouped = exact.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("at", "length")).alias("spans"), F.collect_set("items").alias("items")
    )
    return grouped.withColumn("items", F.sort_array(F.array_distinct(F.flatten("items"))))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 13,
    share: int = 20,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans``, ``contaminated``.

    A word is hit if it lies inside an occurrence of a benchmark window of ``n`` words (of all words
    where an item has fewer). A document is contaminated if it has a hit and at least one word in
    ``share`` is hit. A null or wordless text has no words and no hits; wordless items are no windows.
    Rows are told apart by id (null too) and text; repeated rows are returned as often as they came.
    Empty tables give an empty result or no hits. Other columns are ignored.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_key"), F.col(text).alias("text"))
    found = staged(hits(keyed, benchmark, item_id, item_text, n), "window-hits").alias("h")
    counted = keyed.select("doc_id", "text_key", F.size(_split(F.col("text"))).cast("long").alias("n_words")).alias("k")
    same = F.col("k.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("k.text_key") == F.col("h.text_key"))
    places = F.flatten(F.transform("h.spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))
    n_hit = F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long")
    rows = counted.join(found, same, "left").select(
        "k.doc_id",
        "k.text_key",
        "k.n_words",
        F.when(F.col("h.spans").isNull(), F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"),
        F.coalesce("h.items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("h.spans", F.array().cast("array<struct<at:int,length:int>>")).alias("spans"),
    )
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that :func:`contamination` does not mark, as they came."""
    marked = contamination(docs, benchmark, doc_id, text, **options).where("contaminated")
    bad = staged(marked.select("doc_id", "text_key").distinct(), "contaminated")
    keyed = packed(docs, doc_id=F.col(doc_id), text_key=text_hash(text)).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("d.text_key").eqNullSafe(F.col("b.text_key"))
    kept = keyed.join(broadcast_within(bad, BROADCAST_DOCUMENTS).alias("b"), same, "left_anti")
    return kept.select("row.*")
