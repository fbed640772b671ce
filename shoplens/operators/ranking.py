"""Exact global ordering without a single-partition window.

A window with an ``orderBy`` but no ``partitionBy`` moves every row into one
task.  ``global_rank`` gives the same answer -- the 1-based position of each
row in the total order (key, tiebreak, ...) and running sums in that order --
with Spark's own range partitioning:

1. Rows are range-partitioned on all order columns in their own types and
   sorted inside their partition.  A very frequent key is cut by the
   tie-break columns, so it spreads over many partitions like any other.
2. The placed rows are written to the shared checkpoint folder, so each row's
   partition and position stay what they are whatever is recomputed later.
3. One count (and sum) per partition -- as many rows as the session has
   shuffle partitions -- becomes an offset for the next partitions.
4. Position inside the partition plus offset is the rank.

Nulls come last in either direction, after NaN.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators._util import written

# monotonically_increasing_id() keeps the partition above this bit.
_PART_BITS = 33


def resolve_buckets(spark, buckets: int | None) -> int:
    """Range partitions of a ranking pass: given, or the session's
    ``spark.sql.shuffle.partitions`` (size that to the data)."""
    return int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))


def _placed(df: DataFrame, order: Sequence[Column], buckets: int | None) -> DataFrame:
    """``df`` with ``_part`` and ``_row`` (0-based), written in global order."""
    n = resolve_buckets(df.sparkSession, buckets)
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    return (placed.withColumn("_part", F.shiftright("_at", _PART_BITS).cast("int"))
            .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))))


def global_rank(
    df: DataFrame,
    key: str,
    tiebreak: str | None = None,
    descending: bool = False,
    sums: Sequence[str] = (),
    rank_col: str = "rank",
    buckets: int | None = None,
    extra_order: Sequence[str] = (),
    groups: Sequence[str] = (),
) -> DataFrame:
    """Exact position in the order (key [desc], tiebreak asc) + running sums.

    With ``groups`` positions and sums start anew in each group.  All groups are
    ranked by one shuffle, and a group may be the whole table: it is cut into
    ranges like any other stretch of the order.

    Adds ``rank_col`` (1-based) and ``cum_<c>`` for each column in ``sums``
    (inclusive running sum in the same order; nulls count as 0).  Give a unique
    ``tiebreak`` (or ``extra_order`` columns, compared after it) for a
    deterministic order among equal keys.
    """
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    order = [first] + [F.col(c).asc_nulls_last() for c in [tiebreak, *extra_order] if c]
    if groups:
        return _group_rank(df, list(groups), order, sums, rank_col, buckets)
    placed = _placed(df, order, buckets)
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *[
        F.coalesce(F.sum(c), F.lit(0)).alias(f"_s{i}") for i, c in enumerate(sums)])
    rows, run = [], None
    for r in sorted(totals.collect(), key=lambda r: r["_part"]):
        run = run or [0] * (len(sums) + 1)
        rows.append((r["_part"], *run))
        run = [x + y for x, y in zip(run, r[1:])]
    kinds = [f.dataType for f in totals.schema.fields]
    schema = ", ".join(f"{n} {k.simpleString()}" for n, k in zip(
        ["_part", "_off", *[f"_off{i}" for i in range(len(sums))]], kinds))
    # Booleans and numbers come back in the type that the sum has.
    rows = [tuple(float(v) if k.typeName() == "double" else v for v, k in zip(r, kinds)) for r in rows]
    # One row per range partition: bounded by the session's configuration.
    out = placed.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), "_part")
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn(rank_col, F.col("_off") + F.col("_row") + 1)
    for i, c in enumerate(sums):
        out = out.withColumn(f"cum_{c}", F.col(f"_off{i}") + F.sum(F.coalesce(F.col(c), F.lit(0))).over(inside))
    return out.drop("_part", "_at", "_row", "_off", *[f"_off{i}" for i in range(len(sums))])


def with_next(ranked: DataFrame, cols: Sequence[str], position: str) -> DataFrame:
    """Adds ``next_<c>``: the value of the row at the next ``position`` (null at the end).

    ``ranked`` comes from ``global_rank`` with ``position``.  Rows are dealt out by
    stretches of positions, and the first row of each stretch is handed to the
    one before, so neighbours meet without a join of the rows with themselves.
    """
    stretch = 1 << 16
    r = ranked.withColumn("_part", F.floor(F.col(position) / stretch))
    first = ranked.where(F.col(position) % stretch == 0).select(
        (F.floor(F.col(position) / stretch) - 1).alias("_part"), *[F.col(c).alias(f"_first_{c}") for c in cols])
    ahead = Window.partitionBy("_part").orderBy(position)
    out = r.withColumns({f"_lead_{c}": F.lead(c).over(ahead) for c in cols}).withColumn("_last", F.lead(position).over(ahead).isNull())
    out = out.join(first, "_part", "left")
    return out.select(*ranked.columns, *[F.when(F.col("_last"), F.col(f"_first_{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}")
                                         for c in cols])


def _group_rank(df: DataFrame, groups: list[str], order: Sequence[Column], sums: Sequence[str], rank_col: str,
                buckets: int | None) -> DataFrame:
    """``global_rank`` inside groups.  A range partition holds a stretch of each
    of its groups; a stretch's offset is the sum of the stretches before it,
    of which a group has one a partition at most."""
    placed = _placed(df, [F.col(c).asc_nulls_last() for c in groups] + list(order), buckets)
    count = F.count(F.lit(1)).alias("_n")
    totals = placed.groupBy("_part", *groups).agg(count, *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_s{i}") for i, c in enumerate(sums)])
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_opart"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_off{i}") for i in range(len(sums))])
    inside = Window.partitionBy("_part", *groups).orderBy("_row")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.withColumns({"_at_rank": F.row_number().over(inside),
                              **{f"_run{i}": F.sum(F.coalesce(F.col(c), F.lit(0))).over(running) for i, c in enumerate(sums)}})
    same = F.col("_part") == F.col("_opart")
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = out.join(offsets, same)
    return out.select(*df.columns, (F.col("_off") + F.col("_at_rank")).alias(rank_col),
                      *[(F.col(f"_off{i}") + F.col(f"_run{i}")).alias(f"cum_{c}") for i, c in enumerate(sums)])


def quantile_values_multi(df: DataFrame, wanted: dict[str, Sequence[float]],
                          buckets: int | None = None, totals: dict | None = None) -> dict[str, list]:
    """Exact linear-interpolated quantiles of several columns, as floats.

    Values are counted first (the count is combined on the map side, so a very
    frequent value is one row), then the distinct values of all columns are
    range-partitioned.  Counts per partition and column say which partitions
    hold the wanted positions, and only those are read again.  Nulls and NaN
    take no part.
    """
    cols = list(wanted)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)
    ])).alias("_r")).select("_r.*").where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counted = long.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = _placed(counted, [F.col("_c").asc(), F.col("_v").asc()], buckets)
    parts: dict[int, list] = {i: [] for i in range(len(cols))}
    for r in placed.groupBy("_c", "_part").agg(F.sum("_n").alias("n")).collect():
        parts[r["_c"]].append((r["_part"], r["n"]))
    spans: dict[str, list] = {}
    reads = []  # (column, partition, values before it, position)
    for i, c in enumerate(cols):
        total = sum(n for _, n in parts[i])
        if totals is not None:
            totals[c] = total
        spans[c] = []
        for p in wanted[c] if total else ():
            h = (total - 1) * float(p)
            spans[c].append((math.floor(h), math.ceil(h), h - math.floor(h)))
        need = sorted({x for lo, hi, _ in spans[c] for x in (lo, hi)})
        run = 0
        for part, n in sorted(parts[i]):
            reads += [(i, part, run, x) for x in need if run <= x < run + n]
            run += n
    at: dict[tuple, float] = {}
    if reads:
        few = df.sparkSession.createDataFrame(reads, "_c int, _part int, _before bigint, _pos bigint")
        inside = Window.partitionBy("_c", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = placed.join(F.broadcast(few.select("_c", "_part", "_before").distinct()), ["_c", "_part"])
        hit = hit.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
        # two rows per wanted quantile
        picked = hit.join(F.broadcast(few.drop("_before")), ["_c", "_part"]).where(
            (F.col("_pos") < F.col("_upto")) & (F.col("_pos") >= F.col("_upto") - F.col("_n")))
        at = {(r["_c"], r["_pos"]): r["_v"] for r in picked.select("_c", "_pos", "_v").collect()}
    return {c: [at[i, lo] + (at[i, hi] - at[i, lo]) * frac for lo, hi, frac in spans[c]] if spans[c] else [None] * len(wanted[c])
            for i, c in enumerate(cols)}


def quantile_values(df: DataFrame, col: str, probs: Sequence[float], buckets: int | None = None) -> list:
    """Exact linear-interpolated quantiles of one column (see the multi form)."""
    return quantile_values_multi(df, {col: probs}, buckets)[col]


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles (pandas ``quantile`` / SQL ``quantile_cont``)
    as a one-row frame with one double column per prob (``q0``... or ``names``).

    The values are scalars computed by ``quantile_values``; returning them as
    a literal row keeps every plan that broadcasts them small.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    vals = quantile_values(df, col, probs, buckets)
    schema = ", ".join(f"`{n}` double" for n in names)
    return df.sparkSession.createDataFrame([tuple(vals)], schema)


def qcut_score(value: Column, edges: Sequence[Column], reverse: bool = False) -> Column:
    """pandas ``qcut`` label for a value given its inner edges.

    Bins are right-closed with the lowest edge included, so the label is
    1 + number of inner edges strictly below the value; with ``reverse`` the
    labels run the other way (q..1).  Repeated edges collapse instead of
    raising as pandas does.
    """
    bucket = F.lit(1)
    for e in edges:
        bucket = bucket + (value > e).cast("int")
    return (F.lit(len(edges) + 2) - bucket) if reverse else bucket


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], descending: bool = False
) -> DataFrame:
    """One row per key: the first by ``order_by`` (pandas ``keep='first'``).

    An aggregate of the least (order, row), so partial aggregation leaves one
    row per key and task and no task ever holds a whole key group.  Its buffer
    holds a struct, for which Spark uses a sort-based aggregate.  Ties on
    ``order_by`` are broken by the remaining columns, which keeps the choice
    deterministic.
    """
    cols = df.columns
    pick = F.max if descending else F.min
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                      F.struct(*cols).alias("_row"))
    return df.groupBy(*keys).agg(pick(packed).alias("_m")).select("_m._row.*")


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[Column | str],
    k: int,
    rank_col: str = "rank",
    salt_buckets: int = 32,
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """First ``k`` rows of every group in the given order, ranked 1..k.

    Two rounds keep a huge group out of a single task: first the top ``k`` of
    each (group, hash(salt_on) % salt_buckets) slice, then the top ``k`` of the
    at most ``k * salt_buckets`` survivors per group.  Exact, because every
    global top-k row is within the top k of its own slice.
    """
    salt_cols = list(salt_on or [c for c in df.columns if c not in group])
    salted = df.withColumn("_salt", F.abs(F.xxhash64(*salt_cols)) % salt_buckets)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order_by)
    first = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order_by)
    return (
        first.drop("_salt", "_r1")
        .withColumn(rank_col, F.row_number().over(w2))
        .where(F.col(rank_col) <= k)
    )
