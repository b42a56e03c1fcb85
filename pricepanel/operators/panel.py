"""Shape and calendar operators on price panels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricepanel.functions.dates import day_of, is_business_day, next_business_days
from pricepanel.functions.numbers import clean_number

# ---------------------------------------------------------------- rows


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest ``order`` columns; remaining columns kept whole.

    An aggregation, not a window: copies of a row are combined before the shuffle, so a
    key that holds a large share of the input costs one row per map task.  Ties on
    ``order`` fall back to the other columns, so the choice never depends on file order.
    """
    rest = [c for c in df.columns if c not in keys]
    tail = [c for c in rest if c not in order]
    if len(rest) == 1:  # plain max keeps the hash aggregate
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(*df.columns)
    pick = F.max(F.struct(*order, *tail)).alias("row")
    return (
        df.groupBy(*keys)
        .agg(pick)
        .select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])
    )


def unique_columns(names: Iterable[str]) -> list[int]:
    """Positions of the first occurrence of every name."""
    seen: dict[str, int] = {}
    for i, name in enumerate(names):
        seen.setdefault(name, i)
    return list(seen.values())


def sanitize(df: DataFrame, date: str = "date", order: Sequence[str] = ()) -> DataFrame:
    """Valid day, one row per day (the last by ``order``), one column per name.

    Rows whose date does not parse are dropped.  Output is not sorted: sort where it
    is shown or written.
    """
    keep = unique_columns(df.columns)
    if len(keep) < len(df.columns):
        named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        df = named.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in keep])
    day = df.withColumn(date, day_of(df, date)).where(F.col(date).isNotNull())
    last = keep_last(day, [date], list(order))
    return last.drop(*[c for c in order if c != date])


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_number(F.col(c)) for c in columns})


def business_days_only(df: DataFrame, date: str = "date") -> DataFrame:
    return df.where(is_business_day(F.col(date)))


# ---------------------------------------------------------------- columns


def safe_cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column of ``schema``; values that do not fit become NULL."""
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def reconcile(
    df: DataFrame, schema: T.StructType, alternates: Mapping[str, str] | None = None
) -> DataFrame:
    """Fit a drifting input to ``schema``.

    Columns are matched without regard to case, then by their alternate name; a column
    found nowhere becomes a typed NULL, one not in the schema is dropped.  All of it is
    decided from column names while the plan is built, so the scan reads only what is used.
    """
    found = {c.lower(): c for c in df.columns}
    alternates = alternates or {}

    def pick(field: T.StructField) -> Column:
        source = found.get(field.name.lower()) or found.get(
            alternates.get(field.name, field.name).lower()
        )
        value = F.col(f"`{source}`") if source else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in schema])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


# ---------------------------------------------------------------- wide <-> long


def to_long(
    df: DataFrame,
    columns: Sequence[str],
    keep_nulls: bool,
    ids: Sequence[str] | None = None,
    series: str = "series",
    value: str = "value",
) -> DataFrame:
    """Wide to long in one scan.  ``keep_nulls`` must be chosen: NULLs count in quality
    checks and do not exist in reports."""
    ids = [c for c in df.columns if c not in columns] if ids is None else list(ids)
    long = df.unpivot(ids, [F.col(f"`{c}`").cast("double").alias(c) for c in columns], series, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def to_wide(
    long: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    series: str = "series",
    value: str = "value",
) -> DataFrame:
    """Long to wide by conditional max; the columns are given, so no extra scan."""
    picks = [F.max(F.when(F.col(series) == c, F.col(value))).alias(c) for c in columns]
    return long.groupBy(*keys).agg(*picks)


def outer_align(frames: Sequence[DataFrame], date: str = "date") -> DataFrame:
    """All dates of all wide frames, every column once (the first frame to bring it).

    One union and one aggregation replace a chain of full outer joins.
    """
    parts, taken = [], {date}
    for df in frames:
        new = [c for c in df.columns if c not in taken]
        taken.update(new)
        parts.append(df.select(date, *new))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c != date]
    return stacked.groupBy(date).agg(*[F.max(f"`{c}`").alias(c) for c in values])


def left_align(first: DataFrame, others: Sequence[DataFrame], date: str = "date") -> DataFrame:
    """Every column on the calendar of the first frame; dates only others have are lost."""
    return reindex(outer_align([first, *others], date), first, date)


def reindex(df: DataFrame, spine: DataFrame, date: str = "date") -> DataFrame:
    """Rows of ``df`` on exactly the dates of ``spine``; new dates hold NULLs."""
    return spine.select(date).distinct().join(df, date, "left")


# ---------------------------------------------------------------- tasks

TASK_ROWS = 100_000


def by_series(panel: DataFrame, rows: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Whole series dealt to tasks of about ``TASK_ROWS`` rows, ``rows`` being the panel's number
    of rows or more.

    The number of tasks grows with the panel, and adaptive execution, which fits tasks to shuffled
    bytes, leaves it: a few bytes a row unpack to many in sorts and aggregates.  Windows, aggregates
    and joins that have the keys among theirs need no other shuffle.
    """
    return panel.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


# ---------------------------------------------------------------- calendars


def business_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Business days from the first to the last date of ``df``."""
    bounds = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias(date)
    )
    return business_days_only(days, date)


def future_dates(long: DataFrame, horizon: int, by: Sequence[str] = ()) -> DataFrame:
    """``step`` and ``date`` of the next ``horizon`` business days after the last valid row.

    Without ``by`` there is one calendar for all series (any series with a value counts).
    """
    last = long.where(F.col("value").isNotNull()).groupBy(*by).agg(F.max("date").alias("last"))
    return last.where(F.col("last").isNotNull()).select(
        *by, F.posexplode(next_business_days(F.col("last"), horizon)).alias("step", "date")
    ).withColumn("step", (F.col("step") + 1).cast("long"))


def replicate(df: DataFrame, labels: Sequence[str], column: str = "label") -> DataFrame:
    """Every row once per label."""
    return df.select("*", F.explode(F.array(*[F.lit(x) for x in labels])).alias(column))


def look_up(panel: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a dimension.  No broadcast hint: Spark broadcasts it while its size is
    below the threshold and shuffles beyond."""
    return panel.join(dimension, list(on), "left")
