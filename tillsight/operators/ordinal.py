"""Exact positions in a global order without moving all rows into one task.

An un-partitioned window sorts everything in a single task. Here rows are cut into buckets by
approximate quantiles of the sort key; only the balance depends on their accuracy, never the
result. A bucket is a pure expression of the row, so a recomputed task puts a row into the same
bucket again. A sort value that holds a large share of all rows shows up as a repeated boundary
and is cut further by the hash of the row's id, which is also the tie-break.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.exprs import hash_key, num, scalar_of

_MAX_BUCKETS = 4_096
#: Bounds and bucket totals are broadcast for at most this many groups; beyond it they are joined by a shuffle.
BROADCAST_GROUPS = 1_000


def default_buckets(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, within 64..4096: both grow with the data."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(64, min(_MAX_BUCKETS, parts))


def buckets_for(table: DataFrame, group: Sequence[str], rows_each: int = 50_000) -> int:
    """As many buckets as the largest group of a written table needs for about ``rows_each`` rows in each, within 1..4096."""
    sizes = table.groupBy(*group).count() if group else table.select(F.count(F.lit(1)).alias("count"))
    largest = sizes.agg(F.max("count")).first()[0] or 0
    return max(1, min(_MAX_BUCKETS, -(-largest // rows_each)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which a null key equals a null key; the keys come back once, from the left."""
    other = right.select("*", *[F.col(k).alias(f"_n_{k}") for k in keys]).drop(*keys)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    return left.join(other, on, how).drop(*[f"_n_{k}" for k in keys])


Hint = Callable[[DataFrame], DataFrame]


def _hint(df: DataFrame, group: list[str]) -> Hint:
    """Broadcast for a counted, short list of groups; otherwise no hint. Counted once for each order, before anything else."""
    if not group or df.select(*group).distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        return F.broadcast
    return lambda table: table


def _merged_bounds(keys: DataFrame, group: list[str], buckets: int) -> DataFrame:
    """(group..., _bounds): approximate quantiles of ``_k`` at i / buckets, merged in two steps.

    The tasks' summaries are first merged in several groups of tasks, each by a task of its own; the last step takes the quantiles of these groups' quantiles,
    weighted by their rows. So no task reads the summaries of all others.
    """
    probs = ", ".join(repr(i / buckets) for i in range(1, buckets))
    tasks = max(4, min(256, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
    first = keys.where(F.col("_k").isNotNull()).withColumn("_t", F.spark_partition_id() % tasks).groupBy(*group, "_t").agg(
        F.expr(f"percentile_approx(_k, array({probs}), {4 * buckets})").alias("_q"), F.count(F.lit(1)).alias("_c"))
    each = first.select(*group, "_c", F.explode("_q").alias("_k"))
    merged = F.expr(f"percentile(_k, array({probs}), _c)")
    return each.groupBy(*group).agg(F.coalesce(merged, F.array(F.lit(0.0))).alias("_bounds"))


def _code_by_value(df: DataFrame, order: str | Column, group: list[str], tie: str | None, descending: bool,
                   buckets: int | None, sample_of: DataFrame | None = None, hint: Hint = F.broadcast) -> tuple[DataFrame, list[Column]]:
    """Add the bucket number ``_code``, increasing in the wanted order; also returns the order inside a bucket.

    The bucket is chosen by the value as a double; inside it rows are sorted by the value itself, so long integers
    and decimals keep all their digits. NaN is above all numbers, as in Spark's own order; nulls come last in either direction.
    """
    buckets = buckets or default_buckets(df)
    value = F.col(order) if isinstance(order, str) else order
    kind = df.select(value.alias("v")).schema["v"].dataType
    double = value.cast("double")
    top = F.lit(float("inf"))
    # Always descending: what is not a number goes to the end where it belongs.
    key = F.when(F.isnan(double), top if descending else -top).otherwise(double if descending else -double)
    keyed = df.withColumns({"_v": value, "_k": key})
    sampled = keyed if sample_of is None else sample_of.select(*group, key.alias("_k"))

    # Only the balance hangs on the boundaries, so a light sketch is enough.
    bounds, none = _merged_bounds(sampled, group, buckets), F.array(F.lit(0.0))
    # A group of nulls alone has no boundaries.
    coded = join_null_safe(keyed, hint(bounds), group, "left") if group else keyed.withColumn("_bounds", scalar_of(bounds.select("_bounds")))
    coded = coded.withColumn("_bounds", F.coalesce("_bounds", none))

    # Binary search in the sorted boundaries: how many are at most the key, how many are below it. One column a step, so that
    # no step is a function call of its own.
    coded = coded.withColumns({"_upto": F.lit(0), "_below": F.lit(0)})
    for j in reversed(range((buckets - 1).bit_length())):
        step = lambda c, op: F.expr(f"{c} + IF(coalesce(get(_bounds, {c} + {2 ** j - 1}) {op} _k, false), {2 ** j}, 0)")
        coded = coded.withColumns({"_upto": step("_upto", "<="), "_below": step("_below", "<")})
    # Rows of one double are cut further by hash only where the double stands for one value.
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        one = "abs(_k) < double('Infinity')"
    elif isinstance(kind, (T.DecimalType, T.LongType)):
        one = "abs(_k) < 9007199254740992D" if isinstance(kind, T.LongType) else str(kind.precision <= 15).lower()
    else:
        one = "true"
    place = {"_above": F.expr(f"{buckets - 1} - _upto"), "_same": F.expr(f"IF({one}, _upto - _below, least(_upto - _below, 1))")}
    sub, spread = "0", "0"
    if tie is not None:
        place["_h"] = F.md5(F.coalesce(F.col(tie).cast("string"), F.lit("")))
        share = "CAST(conv(substring(_h, 1, 8), 16, 10) AS DOUBLE) / 4294967296D"
        sub, spread = f"CAST(floor({share} * _same) AS INT)", f"CAST(floor({share} * {buckets}) AS INT)"
    # Never null, and said so: otherwise the join below adds a null filter that evaluates it again.
    last = 2 * buckets * buckets
    code = F.expr(f"coalesce(IF(_k IS NULL, {last} + {spread}, _above * {2 * buckets} + CASE WHEN _same > 0 THEN 1 + {sub} ELSE 0 END), 0)")
    coded = coded.withColumns(place).withColumn("_code", code).drop("_bounds", "_upto", "_below", "_above", "_same")
    inside = F.desc_nulls_last("_v") if descending else F.asc_nulls_last("_v")
    return coded, [inside] + ([F.asc("_h"), F.asc(tie)] if tie else [])


def _code_by_hash(df: DataFrame, key: str, seed: int | str) -> tuple[DataFrame, list[Column]]:
    """The hash is uniform, so its first digits (three or more, by the session's partitions) are already balanced buckets."""
    digits = 3 if default_buckets(df) <= 4096 else 4
    coded = df.withColumn("_h", hash_key(key, seed)).withColumn("_code", F.coalesce(F.substring("_h", 1, digits), F.lit("")))
    return coded, [F.asc("_h"), F.asc(key)]


def _with_offsets(coded: DataFrame, group: list[str], values: dict[str, Column], hint: Hint) -> DataFrame:
    """Add for each value the sum over earlier buckets (_o_), over the own bucket (_b_) and over the group (_total).

    One row per bucket and group is joined; it is broadcast where the groups were counted to be few.
    """
    sums = coded.groupBy(*group, "_code").agg(*[F.sum(v).alias(f"_b_{n}") for n, v in values.items()])
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("*", *[
        c for n in values for c in (
            F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_o_{n}"),
            F.sum(f"_b_{n}").over(whole).alias(f"{n}_total"),
        )
    ])
    return join_null_safe(coded, hint(offsets), [*group, "_code"])


def _add_prefix(placed: DataFrame, group: list[str], within: list[Column], values: dict[str, Column]) -> DataFrame:
    before = Window.partitionBy(*group, "_code").orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumns({
        n: F.coalesce(F.sum(v).over(before), F.lit(0)) + F.col(f"_o_{n}") for n, v in values.items()
    })
    return out.drop("_k", "_v", "_h", "_code", *[f"{p}{n}" for n in values for p in ("_o_", "_b_")])


def prefix_sums(
    df: DataFrame,
    order: str | Column,
    values: dict[str, Column],
    group: Sequence[str] = (),
    tie: str | None = None,
    descending: bool = True,
    buckets: int | None = None,
    sample_of: DataFrame | None = None,
    needed: Column | None = None,
) -> DataFrame:
    """Add, per row, the sums of ``values`` over all rows before it (exclusive) within its group.

    Groups may be null and many: boundaries and bucket totals are broadcast only where the groups were counted
    to be few (models, features, splits), else joined by a shuffle. ``tie`` is a unique id; without it equal sort values must not occur in a group.
    Totals come back as ``<name>_total``. When ``df`` is itself an aggregate, ``sample_of`` is the table
    below it: the boundaries then come from one pass that combines on the map side, without a shuffle
    of their own. ``needed`` is a condition on the bucket (_o_, _b_, _total columns): rows of other
    buckets are dropped before anything is sorted.
    """
    group = list(group)
    if buckets == 1 and tie is None and needed is None:
        # No group is larger than one task sorts easily: the windows alone do.
        value = F.col(order) if isinstance(order, str) else order
        whole = Window.partitionBy(*group)
        before = whole.orderBy(F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({**{n: F.coalesce(F.sum(v).over(before), F.lit(0)) for n, v in values.items()},
                               **{f"{n}_total": F.sum(v).over(whole) for n, v in values.items()}})
    hint = _hint(df if sample_of is None else sample_of, group)
    coded, within = _code_by_value(df, order, group, tie, descending, buckets, sample_of, hint)
    placed = _with_offsets(coded, group, values, hint)
    return _add_prefix(placed if needed is None else placed.where(needed), group, within, values)


def _as_ordinal(out: DataFrame) -> DataFrame:
    return (
        out.withColumn("ordinal", F.col("_before") + 1)
        .withColumnRenamed("_before_total", "n_rows")
        .drop("_before")
    )


def _ones() -> dict[str, Column]:
    return {"_before": F.lit(1)}


def global_ordinal(df: DataFrame, order: str | Column, tie: str, group: Sequence[str] = (),
                   descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Add ``ordinal`` (1-based, ties by md5 of the id, then the id) and ``n_rows`` of the group."""
    return _as_ordinal(prefix_sums(df, order, _ones(), group, tie, descending, buckets))


def hash_ordinal(df: DataFrame, key: str, seed: int | str, group: Sequence[str] = (), first: int | None = None) -> DataFrame:
    """Add ``ordinal`` in the order of the seeded hash of a unique id, and ``n_rows``: a shuffle that repeats.

    With ``first`` only that many rows come back, and only their buckets are sorted.
    """
    group = list(group)
    coded, within = _code_by_hash(df, key, seed)
    placed = _with_offsets(coded, group, _ones(), _hint(df, group))
    if first is not None:
        placed = placed.where(F.col("_o__before") < first)
    out = _as_ordinal(_add_prefix(placed, group, within, _ones()))
    return out if first is None else out.where(F.col("ordinal") <= first)


Cuts = Callable[[Column], list[Column]]


def _cut_at(coded: DataFrame, within: list[Column], group: list[str], cuts: Cuts, out: str, hint: Hint, flags: bool = False) -> DataFrame:
    """Add the number of cut positions before each row, or with ``flags`` an array telling which.

    A bucket without a cut inside has one answer for all its rows; only the few buckets that a cut
    goes through are sorted, so nearly all rows are neither shuffled nor sorted.
    """
    placed = _with_offsets(coded, group, _ones(), hint).withColumnRenamed("_before_total", "n_rows")
    start, size = F.col("_o__before"), F.col("_b__before")
    positions = cuts(F.col("n_rows"))
    split = F.lit(False)
    for c in positions:
        split = split | ((start < c) & (c < start + size))
    if flags:
        passed = lambda at: F.array(*[at > c for c in positions])
    else:
        passed = lambda at: sum((at > c).cast("int") for c in positions)
    clear = placed.where(~split).withColumn(out, passed(start + 1))
    row = F.row_number().over(Window.partitionBy(*group, "_code").orderBy(*within))
    edge = placed.where(split).withColumn("_at", start + row).withColumn(out, passed(F.col("_at"))).drop("_at")
    spare = [c for c in ("_k", "_v", "_h", "_code", "_o__before", "_b__before", "n_rows") if c in placed.columns]
    return clear.unionByName(edge).drop(*spare)


def cut_by_value(df: DataFrame, order: str | Column, tie: str, cuts: Cuts, group: Sequence[str] = (),
                 descending: bool = True, out: str = "part", buckets: int | None = None, flags: bool = False) -> DataFrame:
    """Number of cut positions before a row's place in the order of a value, 0 .. len(cuts) (or which, see above).

    ``cuts`` gives the positions from the number of rows: a row at 1-based place p lies behind the cut c
    when p > c.
    """
    group = list(group)
    hint = _hint(df, group)
    coded, within = _code_by_value(df, order, group, tie, descending, buckets, hint=hint)
    return _cut_at(coded, within, group, cuts, out, hint, flags)


def cut_by_hash(df: DataFrame, key: str, seed: int | str, cuts: Cuts, group: Sequence[str] = (), out: str = "part") -> DataFrame:
    """As :func:`cut_by_value`, in the order of the seeded hash of a unique id."""
    coded, within = _code_by_hash(df, key, seed)
    return _cut_at(coded, within, list(group), cuts, out, _hint(df, list(group)))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], group: Sequence[str] = (),
                    buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per name in ``probs``.

    The built-in exact ``percentile`` keeps every distinct value in one task's buffer; here values
    are counted, and only the buckets that hold the two neighbours of a rank are put in order.
    """
    group = list(group)
    known = df.where(F.col(value).isNotNull()).select(*group, value)
    counts = known.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))
    ranks = {n: f"((_first_total - 1) * {num(p)})" for n, p in probs.items()}
    needed = F.expr(" OR ".join(f"(_o__first <= ceil({x}) AND floor({x}) < _o__first + _b__first)" for x in ranks.values()))
    placed = prefix_sums(counts, value, {"_first": F.col("_c")}, group, None, False, buckets, known, needed)
    aggs = []
    for name, rank in ranks.items():
        for side, at in (("lo", f"floor({rank})"), ("hi", f"ceil({rank})")):
            here = f"_first <= {at} AND {at} < _first + _c"
            aggs.append(F.expr(f"max(CASE WHEN {here} THEN CAST({value} AS DOUBLE) END) AS _{side}_{name}"))
    picked = placed.groupBy(*group).agg(F.max("_first_total").alias("n_values"), *aggs)
    between = [
        F.expr(f"_lo_{n} + (_hi_{n} - _lo_{n}) * ((n_values - 1) * {num(p)} - floor((n_values - 1) * {num(p)})) AS {n}")
        for n, p in probs.items()
    ]
    return picked.select(*group, "n_values", *between)
