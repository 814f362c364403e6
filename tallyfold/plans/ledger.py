"""Case counts kept so that days already loaded can be corrected.

The ledger stores every day's cumulated counts beside its increments, by month, and one *end* row per
place and month: the counts of the month's last day. A batch may bring new, earlier and revised days.
A changed day changes its own increment and that of the next day the place has, so the months that
hold these two are the only directories that are read and rewritten; the end rows tell which
month that is and what comes before it. Days and ends of a batch appear in one commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators.delta import one_per_key
from tallyfold.operators.latest import latest_rows
from tallyfold.operators.timeseries import FIRST_ROW_RULES
from tallyfold.session import staging
from tallyfold.sinks.committed import CommittedTable

LEDGER_SCHEMA = schemas.columns(
    "location_id bigint, date date, cases int, deaths int, daily_cases int, daily_deaths int, kind string, month string"
)
_PAIR = ["location_id", "month"]
_KEY = ["location_id", "date"]
_COUNTS = ["cases", "deaths"]


def ledger(spark: SparkSession, path: str) -> CommittedTable:
    return CommittedTable(spark, path, LEDGER_SCHEMA, ["kind", "month"])


def _months(rows: DataFrame) -> list[str]:
    return [row.month for row in rows.select("month").distinct().collect()]


def _counts(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in _COUNTS])


def load_counts(spark: SparkSession, path: str, counts: DataFrame, batch: str, first: str = "zero") -> list[str]:
    """Bring cumulated counts (``location_id``, ``date``, ``cases``, ``deaths``) into the ledger as batch ``batch``.

    Days may come in any order, again or revised; the same day with two counts in one batch fails the job.
    Any sequence of batches gives what one load of the latest counts gives. A batch that is loaded
    already changes nothing; so does one without a new or revised day. ``first`` is the rule for the
    increment of a place's first day. Returns the months whose days were rewritten.
    """
    if first not in FIRST_ROW_RULES:
        raise ValueError(f"first must be one of {FIRST_ROW_RULES}")
    table = ledger(spark, path)
    seen = table.version()
    if batch in seen.batches:
        return []
    undated = F.raise_error(F.lit("a row without a date")).cast("string")
    with staging(spark) as stage:
        rows = one_per_key(counts.select(*_KEY, *_COUNTS), _KEY, what="batch")
        rows = stage(rows.withColumn("month", F.coalesce(F.date_format("date", "yyyy-MM"), undated)), "ledger-batch")
        stored = table.read(seen, [table.part(("day", m)) for m in _months(rows)])
        old = stored.select(*_KEY, _counts().alias("_old"))
        fresh = F.col("_old").isNull() | ~F.col("_old").eqNullSafe(_counts())
        changed = stage(rows.join(old, _KEY, "left").where(fresh).drop("_old"), "ledger-changed")
        pairs = changed.select(*_PAIR).distinct()
        held = stored.select(*rows.columns).join(pairs, _PAIR, "left_semi").join(changed, _KEY, "left_anti")
        # The last day of each touched month, and whether it differs from what was stored.
        last = held.unionByName(changed).groupBy(*_PAIR).agg(F.max_by(F.struct("date", *_COUNTS), "date").alias("end"))
        old_ends = table.read(seen, [p for p in seen.parts if p.startswith("kind=end/")])
        old_ends = old_ends.select(*_PAIR, F.struct("date", *_COUNTS).alias("end"))
        kept = old_ends.join(pairs, _PAIR, "left_anti").withColumn("touched", F.lit(False)).withColumn("moved", F.lit(False))
        moved = last.join(old_ends.withColumnRenamed("end", "_old"), _PAIR, "left")
        moved = moved.select(*_PAIR, "end", F.lit(True).alias("touched"), (~F.col("end").eqNullSafe(F.col("_old"))).alias("moved"))
        along = Window.partitionBy("location_id").orderBy("month")
        ends = kept.unionByName(moved).select(
            "*", F.lag("end").over(along).alias("before"), F.lag("moved", 1, False).over(along).alias("follows")
        )
        ends = stage(ends, "ledger-ends")
        touched = ends.where("touched OR follows").select(*_PAIR, "before")
        day_months, end_months = _months(touched), _months(ends.where("touched"))
        days = table.read(seen, [table.part(("day", m)) for m in day_months])
        others = days.join(touched, _PAIR, "left_anti").select(*LEDGER_SCHEMA.names)
        series = days.select(*rows.columns).join(changed, _KEY, "left_anti").unionByName(changed)
        renewed = _increments(series.join(touched, _PAIR), first)
        tops = ends.where(F.col("month").isin(end_months)).select(*_PAIR, "end.*", F.lit("end").alias("kind"))
        result = others.unionByName(renewed.withColumn("kind", F.lit("day"))).unionByName(tops, allowMissingColumns=True)
        parts = [table.part(("day", m)) for m in day_months] + [table.part(("end", m)) for m in end_months]
        if parts:
            table.replace(result, parts, seen, batch, alone=True)  # what comes before a month lies in others
        return sorted(day_months)


def _increments(rows: DataFrame, first: str) -> DataFrame:
    """Increments inside each (place, month); ``before`` holds the counts of the place's day before the month."""
    within = Window.partitionBy(*_PAIR).orderBy("date")
    previous = F.coalesce(F.lag(_counts()).over(within), F.when(F.col("before").isNotNull(), _counts("before.")))
    rows = rows.withColumn("_previous", previous)
    for name in _COUNTS:
        value = F.col(name)
        earlier = F.col(f"_previous.{name}")
        if first == "zero":
            earlier = F.when(F.col("_previous").isNull(), F.lit(0)).otherwise(earlier)
        step = value - earlier
        rows = rows.withColumn(f"daily_{name}", F.coalesce(step, value) if first == "self" else step)
    return rows.drop("_previous", "before")


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """(``location_id``, ``date``, ``cases``, ``deaths``, ``daily_cases``, ``daily_deaths``) as of now."""
    table = ledger(spark, path)
    seen = table.version()
    return table.read(seen, [p for p in seen.parts if p.startswith("kind=day/")]).drop("kind", "month")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest day of every place, from the end rows alone."""
    table = ledger(spark, path)
    seen = table.version()
    ends = table.read(seen, [p for p in seen.parts if p.startswith("kind=end/")])
    return latest_rows(ends, ["location_id"]).select(*_KEY, *_COUNTS)
