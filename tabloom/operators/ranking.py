"""Global order without a single-task window.

``Window.orderBy`` with no partition key sends every row to one task. Here the input is cut
into ordered slices by a few literal cut points, rows are numbered inside their slice, and
the totals of all earlier slices are added. Slice membership is a plain function of the row,
so a lost task recomputes to the same answer, and only one shuffle of the rows is needed.
A value that alone fills more than a slice gets slices of its own, cut along the tie-break key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, NumericType

from tabloom.session import default_slices, scratch_path

_SLICE, _LEAD = "__slice", "__lead"
BROADCAST_SLICES = 100_000


def _quantile_cuts(df: DataFrame, column: str, slices: int) -> list[float]:
    """Interior quantiles of a double column: at most ``slices`` numbers reach the driver."""
    probabilities = [i / slices for i in range(1, slices)]
    accuracy = max(10_000, 20 * slices)
    row = df.agg(F.percentile_approx(column, probabilities, accuracy).alias("q")).first()
    return [v for v in (row.q or []) if v is not None and not math.isnan(v)]


def _edges(cuts: Sequence[float], endless: bool) -> tuple[list[float], list[float]]:
    """Bucket edges from quantiles, and the values hot enough to repeat among them.

    A repeated quantile v becomes a bucket holding only v: edges at v and just above it.
    Beyond 2^53 different whole numbers share a double, so those are not taken as points.
    The infinite places are points only if ``endless``, where each stands for one value.
    """
    times = Counter(cuts)
    hot = [v for v in sorted(times) if times[v] > 1 and (abs(v) < 2**53 or (endless and math.isinf(v)))]
    inner = set(times) | {math.nextafter(v, math.inf) for v in hot}
    return [-math.inf, *sorted(inner - {-math.inf, math.inf}), math.inf], hot


def _rising(name: str, descending: bool) -> Column:
    """A numeric column as a double that never falls along the order, nulls last.

    NaN sorts as the largest number, so it comes first when descending.
    """
    value = F.col(name).cast("double")
    return (
        F.when(value.isNull(), math.inf)
        .when(F.isnan(value), -math.inf if descending else math.inf)
        .otherwise(-value if descending else value)
    )


def _cut(
    df: DataFrame, value: str, keys: Sequence[str], descending: bool, slices: int
) -> tuple[DataFrame, list[str], int]:
    """Adds slice columns that rise, read left to right, with the requested order.

    Missing and not-a-number values are set apart; the others are cut along ``value``. While
    some point of the order so far repeats among the cuts, a further column cuts the rows at
    such points, missing values among them, along the next key. Also returns the most slices
    that the cuts can make.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    number = F.col(value).cast("double")
    kind = F.when(number.isNull(), 3).when(F.isnan(number), 0 if descending else 2).otherwise(1)
    work = df.withColumn(f"{_SLICE}_kind", kind)
    place, at_hot, wanted = [f"{_SLICE}_kind"], F.lit(True), slices
    points, most = 4, 0  # four kinds; each point of a level is cut by the next
    for depth, name in enumerate([value, *keys]):
        if not isinstance(types[name], NumericType):
            break
        lead, out = f"{_LEAD}{depth}", f"{_SLICE}{depth}"
        work = work.withColumn(lead, _rising(name, descending and depth == 0))
        cuts = _quantile_cuts(work.where(at_hot).select(lead), lead, wanted)
        edges, hot = _edges(cuts, endless=depth == 0)
        if isinstance(types[name], DecimalType):
            hot = [v for v in hot if math.isinf(v)]  # as doubles, different decimals can look equal
        if len(edges) > 2:
            cutter = Bucketizer(splits=edges, inputCol=lead, outputCol=out, handleInvalid="keep")
            work = cutter.transform(work)
        else:
            work = work.withColumn(out, F.lit(0.0))
        if depth:
            work = work.withColumn(out, F.when(at_hot, F.col(out)).otherwise(0.0))
        place.append(out)
        most += points * (len(edges) - 1)
        points *= len(hot)
        if not hot:
            break
        at_hot = at_hot & F.col(lead).isin(*hot)
        # A value repeated m times among the cuts fills m slices, so 2m are plenty for it.
        times = Counter(cuts)
        wanted = 2 * max(times[v] for v in hot)
    return work, place, max(most, 4)


def _sliced(
    df: DataFrame, value: str, keys: Sequence[str], descending: bool, slices: int
) -> tuple[DataFrame, list[str]]:
    """The frame with its slice columns, and their names."""
    return _cut(df, value, keys, descending, slices)[:2]


def running_totals(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    *,
    within: Sequence[str] = (),
    descending: bool = True,
    sums: dict[str, Column] | None = None,
    position: str | None = "position",
    overall: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Rows with their 1-based place in the whole order and inclusive running sums.

    The order is ``value`` (numeric), then ``keys`` ascending; together they must identify a
    row, and heavily repeated values can only be spread along numeric keys. ``within`` runs
    one order per group; it is meant for a few large groups, such as compared data sets.
    ``overall`` adds ``<name>_all`` with the total of each sum over the whole order.
    """
    if not isinstance(df.schema[value].dataType, NumericType):
        raise ValueError(f"order column {value!r} must be numeric, such as unix_micros of a time")
    totals = dict(sums or {})
    if position:
        totals[position] = F.lit(1).cast("bigint")
    slices = slices or default_slices(df.sparkSession)
    adds = {name: f"__add_{name}" for name in totals}
    work = df.withColumns({adds[n]: expr for n, expr in totals.items()})
    work, cuts, most = _cut(work, value, keys, descending, slices)
    place = [*within, *cuts]

    # One small row per slice: its totals, then the totals of everything before it.
    per_slice = work.groupBy(*place).agg(*[F.sum(adds[n]).alias(f"__sum_{n}") for n in totals])
    group = Window.partitionBy(*within)
    before = group.orderBy(*cuts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *[F.col(c).alias(f"__at_{c}") for c in place],
        *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in totals],
        *[F.sum(f"__sum_{n}").over(group).alias(f"{n}_all") for n in totals if overall],
    )
    if not within and most <= BROADCAST_SLICES:
        offsets = F.broadcast(offsets)  # beyond the bound the join shuffles
    lead = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    inside = (
        Window.partitionBy(*place)
        .orderBy(lead, *[F.col(k).asc_nulls_last() for k in keys])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = work.withColumns({f"__in_{n}": F.sum(adds[n]).over(inside) for n in totals})
    match = [F.col(c).eqNullSafe(F.col(f"__at_{c}")) for c in place]
    return local.join(offsets, match).select(
        *df.columns,
        *[(F.col(f"__in_{n}") + F.col(f"__off_{n}")).alias(n) for n in totals],
        *[f"{n}_all" for n in totals if overall],
    )


def numbered(df: DataFrame, order: Sequence[Column], out: str, label: str = "numbered") -> DataFrame:
    """Rows with their place, from 0 on, in an order of any sortable columns, text among them.

    Rows are range-partitioned along the whole order, so that a value on many rows is cut along its
    tie-break keys whatever their type; each is numbered inside its partition and written, and the
    sizes of the partitions before are added. Only rows equal in all of ``order`` stay together.
    """
    spark = df.sparkSession
    path, id_bits = scratch_path(spark, label), 33  # the partition stands above the lower 33 bits
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("__part", F.shiftright("__id", id_bits))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))  # one row for each partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__id").bitwiseAND((1 << id_bits) - 1)
    return placed.join(F.broadcast(offsets), "__part").select(*df.columns, place.cast("long").alias(out))


def ntile_of(position: Column, rows: Column, buckets: int) -> Column:
    """The bucket of a 1-based position when the first ``rows mod buckets`` get one extra."""
    small = F.floor(rows / buckets)
    extra = rows % buckets
    edge = extra * (small + 1)
    return (
        F.when(position <= edge, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(extra + F.floor(F.try_divide(position - 1 - edge, small)) + 1)
        .cast("int")
    )


def global_ntile(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    buckets: int = 10,
    *,
    within: Sequence[str] = (),
    descending: bool = True,
    out: str = "bucket",
    slices: int | None = None,
) -> DataFrame:
    """``ntile(buckets)`` over the whole table; sizes differ by at most one row."""
    placed = running_totals(
        df, value, keys, within=within, descending=descending, position="__pos",
        overall=True, slices=slices,
    )
    bucket = ntile_of(F.col("__pos"), F.col("__pos_all"), buckets)
    return placed.withColumn(out, bucket).drop("__pos", "__pos_all")


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, out: str = "rank_no"
) -> DataFrame:
    """Best ``k`` rows per group; Spark trims each group before the shuffle."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


def nth_ranked(df: DataFrame, group: str, value: str, n: int, out: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` by descending value within the group is exactly ``n``.

    Ranks are worked out on distinct values with their counts, of which only the top ``n``
    per group can matter, so a huge group or a huge tie never sits in one task.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("__c"))
    best = top_per_group(counts, [group], [F.col(value).desc()], n, "__r")
    earlier = (
        Window.partitionBy(group)
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    hits = (
        best.withColumn(out, F.coalesce(F.sum("__c").over(earlier), F.lit(0)) + 1)
        .where(F.col(out) == n)
        .select(group, value, out)
    )
    return df.join(hits, [group, value])


def gap_to_group_max(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Group maximum minus own value; the maxima are aggregated first, then joined back."""
    from tabloom.operators.joins import broadcast_checked

    peaks = df.groupBy(group).agg(F.max(value).alias("__peak"))
    return (
        df.join(broadcast_checked(peaks), group, "left")
        .withColumn(out, F.col("__peak") - F.col(value))
        .drop("__peak")
    )


def exact_quantile(
    df: DataFrame, column: str, quantile: float = 0.5, slices: int | None = None
) -> DataFrame:
    """One row with the exact interpolated quantile.

    A sketch gives a narrow bracket around the quantile, one count says how many rows lie
    below it, and only the values inside are grouped and ordered. Should the bracket miss,
    which the count shows, the whole range is ordered instead.
    """
    accuracy = 10_000
    present = df.where(F.col(column).isNotNull()).select(F.col(column).alias("x"))
    ends = [max(0.0, quantile - 5 / accuracy), min(1.0, quantile + 5 / accuracy)]
    sketch = present.agg(
        F.percentile_approx("x", ends, accuracy).alias("q"), F.count("x").alias("n"),
    ).first()
    if not sketch.n:
        return present.agg(F.max("x").cast("double").alias("quantile"))
    at = (sketch.n - 1) * quantile
    first, last = math.floor(at), math.ceil(at)
    low, high = sketch.q
    counts = present.agg(
        F.count(F.when(F.col("x") < low, 1)).alias("below"),
        F.count(F.when(F.col("x") <= high, 1)).alias("upto"),
    ).first()
    below, inside = counts.below, present.where(F.col("x").between(low, high))
    if not counts.below <= first <= last < counts.upto:
        below, inside = 0, present
    grouped = inside.groupBy("x").agg(F.count("x").alias("c"))
    placed = running_totals(
        grouped, "x", descending=False, sums={"cum": F.col("c")}, position=None, slices=slices
    )
    upto = F.col("cum") + below
    covers = lambda place: (upto > place) & (upto - F.col("c") <= place)
    share = at - first
    return placed.where(covers(first) | covers(last)).select(
        F.when(covers(first), F.col("x")).alias("lo"), F.when(covers(last), F.col("x")).alias("hi")
    ).agg((F.max("lo") * (1 - share) + F.max("hi") * share).alias("quantile"))


def numbered_ntile(df: DataFrame, order: Sequence[Column], buckets: int, out: str = "bucket") -> DataFrame:
    """``ntile(buckets)`` over an order of any sortable columns, by ``numbered``; sizes differ by at most one row."""
    placed = numbered(df, order, "__pos")
    rows = placed.agg(F.count(F.lit(1))).scalar()
    return placed.withColumn(out, ntile_of(F.col("__pos") + 1, rows, buckets)).drop("__pos")
