"""Exact quantiles and empirical distributions that never gather a group into one task.

`percentile` keeps every distinct value of a group in one task's memory and a value-ordered window over a
group sorts the whole group in one task; neither holds when one group owns a large share of the rows.
Here values are counted first, and crowded groups are split into nodes by the leading binary digits of the value:

1. `value_counts`  rows -> (group, value, n); combined map-side and shuffled on both, so copies of one value
                   collapse to one row and a large group spreads over all tasks.
2. nodes           a group of at most `NODE_VALUES` counted values is one node. A larger one is refined twice:
                   by sign, binary exponent and 6 bits of the mantissa (coarse, at most 268,544 different
                   ones), and by the next 23 bits (fine). Only 23 bits are left inside a node, so no node
                   holds more than 8.4 million different values, wherever the values of a group lie.
3. prefix sums     of crowded groups, on two levels of node totals: fine nodes inside a coarse one (at most
                   8.4 million short rows), coarse ones inside a group (at most 268,544). No window sees the
                   values of a crowded group. Without crowded groups these steps vanish from the running plan.
4. values          ordered inside a node; of a crowded group only in the nodes that hold a wanted rank.

Group keys are packed into one struct so that NULL keys match each other and every step shares the same
partitioning expression.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_VALUES = 1 << 20
COARSE_BITS, FINE_BITS = 6, 23
# binary exponents of normal numbers; smaller numbers share the least one, where digits go on linearly
LEAST_EXPONENT, GREATEST_EXPONENT = -1022, 1023

KEY, VALUE, N = "_key", "_value", "_n"
COARSE, FINE = "_coarse", "_fine"
GROUP, CROWDED = "_group", "_crowded"
NODE = [KEY, COARSE, FINE]


def value_digits(value: str) -> tuple[str, str]:
    """SQL text of two integers that, taken in turn, never decrease as `value` grows, and hold for all doubles.

    log2 is monotone, so its floor may stand for the exponent even where it is off by one; scaling by a power
    of two is exact. Infinities count as the greatest finite number here: they share its node, not its place.
    """
    size = f"least(abs({value}), 1.7976931348623157E308D)"
    exponent = f"greatest(least(coalesce(floor(log2({size})), {LEAST_EXPONENT}L), {GREATEST_EXPONENT}L), {LEAST_EXPONENT}L)"
    # in two steps: 2 to the power of 1022 + 6 is no double
    digits = f"({size} * pow(2D, -{exponent}) * {1 << COARSE_BITS}D)"
    coarse = f"(({exponent} - {LEAST_EXPONENT}L) * {1 << (COARSE_BITS + 1)}L + floor({digits}))"
    fine = f"floor(({digits} - floor({digits})) * {1 << FINE_BITS}D)"
    return (
        f"case when {value} < 0 then -1L - {coarse} else {coarse} end",
        f"case when {value} < 0 then {(1 << FINE_BITS) - 1}L - {fine} else {fine} end",
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str | Column) -> DataFrame:
    """(group, value) -> n over the non-missing values."""
    col = F.col(value) if isinstance(value, str) else value
    slim = df.select(F.struct(*keys).alias(KEY), F.nanvl(col.cast("double"), F.lit(None)).alias(VALUE))
    return slim.where(f"{VALUE} is not null").groupBy(KEY, VALUE).agg(F.count(F.lit(1)).alias(N))


def crowded_groups(counts: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Groups with more than `NODE_VALUES` counted values, by all or some of the packed keys.

    A list of at most one row for `NODE_VALUES` rows of `counts`; it is broadcast. Sizes are read from `n`, because a
    reader that left a column out would not share the shuffle of `counts` with the others.
    """
    group = F.col(KEY) if keys is None else _fewer_keys(keys)
    sizes = counts.groupBy(group.alias(GROUP)).agg(F.count_if(F.col(N) > 0).alias("_size"))
    sizes = sizes.where(f"_size > {NODE_VALUES}")
    return F.broadcast(sizes.select(GROUP, F.lit(True).alias(CROWDED)))


def _fewer_keys(keys: Sequence[str]) -> Column:
    return F.expr("named_struct(" + ", ".join(f"'{k}', {KEY}.`{k}`" for k in keys) + ")")


def _in_nodes(rows: DataFrame, crowded: DataFrame, keys: Sequence[str] | None, how: str = "left") -> DataFrame:
    """Each row with the node of its value; `how="inner"` keeps crowded groups only."""
    on = F.col(KEY) if keys is None else _fewer_keys(keys)
    marked = rows.withColumn("_on", on).join(crowded, F.col("_on") == F.col(GROUP), how).drop("_on", GROUP)
    coarse, fine = value_digits(VALUE)
    return marked.withColumns(
        {
            # never NULL: a join on them would push a NULL filter below the shuffle of the counts, which would then not be shared
            COARSE: F.expr(f"coalesce(case when {CROWDED} then {coarse} end, 0L)"),
            FINE: F.expr(f"coalesce(case when {CROWDED} then {fine} end, 0L)"),
        }
    )


def _node_bounds(rows: DataFrame) -> DataFrame:
    """Per node: values before it (`_start`) and up to it (`_end`); number and sum of the group's values."""
    fine = rows.groupBy(*NODE).agg(F.sum(N).alias("_n_node"), F.sum(F.col(N) * F.col(VALUE)).alias("_sum_node"))
    fine = fine.withColumn(
        "_inside_coarse", F.expr(f"sum(_n_node) over (partition by {KEY}, {COARSE} order by {FINE})")
    )
    coarse = (
        fine.groupBy(KEY, COARSE)
        .agg(F.sum("_n_node").alias("_n_coarse"), F.sum("_sum_node").alias("_sum_coarse"))
        .selectExpr(
            KEY,
            COARSE,
            f"sum(_n_coarse) over (partition by {KEY} order by {COARSE}) - _n_coarse as _before_coarse",
            f"sum(_n_coarse) over (partition by {KEY}) as _n_group",
            f"sum(_sum_coarse) over (partition by {KEY}) as _sum_group",
        )
    )
    return fine.join(coarse, [KEY, COARSE]).selectExpr(
        *NODE,
        "_before_coarse + _inside_coarse - _n_node as _start",
        "_before_coarse + _inside_coarse as _end",
        "_n_group",
        "_sum_group",
    )


def quantiles_of_counts(
    counts: DataFrame, probs: Mapping[str, float], crowded: DataFrame | None = None, crowded_keys: Sequence[str] | None = None
) -> DataFrame:
    """Linear-interpolation ("type 7") quantiles: one row per group, one column per entry of `probs`.

    `counts` is (group, value, n); a value may come in several rows. `crowded` is a list from `crowded_groups`
    where the caller has one; it may name more groups than need it.
    """
    if crowded is None:
        crowded = crowded_groups(counts)
    h = {name: f"((_total - 1) * {float(p)!r}D)" for name, p in probs.items()}
    ranks = [f"{f}({x})" for x in h.values() for f in ("floor", "ceil")]

    def holds_a_rank(first: str, last: str) -> str:
        return " or ".join(f"{rank} between {first} and {last}" for rank in ranks)

    bounds = _node_bounds(_in_nodes(counts, crowded, crowded_keys, "inner")).drop("_sum_group")
    wanted = bounds.where(holds_a_rank("_start", "_end - 1").replace("_total", "_n_group")).drop("_end")
    node = f"over (partition by {', '.join(NODE)}"
    ranked = (
        _in_nodes(counts, crowded, crowded_keys)
        .join(wanted, NODE, "left")
        .where(f"{CROWDED} is null or _start is not null")
        .selectExpr(
            KEY,
            VALUE,
            N,
            f"coalesce(_n_group, sum({N}) {node})) as _total",
            f"coalesce(_start, 0L) - 1 + sum({N}) {node} order by {VALUE} rows between unbounded preceding and current row)"
            " as _last",
        )
        .withColumn("_first", F.expr(f"_last - {N} + 1"))
        .where(holds_a_rank("_first", "_last"))
    )

    def at(rank: str) -> str:
        return f"max(case when {rank} between _first and _last then {VALUE} end)"

    def interpolated(x: str) -> str:
        low, high = at(f"floor({x})"), at(f"ceil({x})")
        return f"{low} + ({high} - {low}) * ({x} - floor({x}))"

    return ranked.groupBy(KEY, "_total").agg(*[F.expr(interpolated(x)).alias(name) for name, x in h.items()])


def regrouped(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same counts under fewer of their keys; a value then comes in several rows."""
    return counts.select(_fewer_keys(keys).alias(KEY), VALUE, N)


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str | Column, probs: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles of `value` per group, as `keys` plus one column per entry of `probs`."""
    return quantiles_of_counts(value_counts(df, keys, value), probs).select(
        f"{KEY}.*", *[F.col(name) for name in probs]
    )


def quantiles_of_columns(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """Exact quantiles of several columns per group in one pass over `df`; `wanted` maps column to probs."""
    if len(wanted) == 1:
        ((value, probs),) = wanted.items()
        return grouped_quantiles(df, keys, value, probs)
    stacked = ", ".join(f"'{column}', cast(`{column}` as double)" for column in wanted)
    long = df.select(*keys, F.expr(f"stack({len(wanted)}, {stacked}) as (_column, _stacked)"))
    names = {f"p{i}": p for i, p in enumerate(sorted({p for probs in wanted.values() for p in probs.values()}))}
    found = quantiles_of_counts(value_counts(long, [*keys, "_column"], "_stacked"), names)
    source = {p: name for name, p in names.items()}
    columns = [
        F.expr(f"max(case when {KEY}._column = '{column}' then {source[p]} end)").alias(alias)
        for column, probs in wanted.items()
        for alias, p in probs.items()
    ]
    return found.groupBy(*[F.col(f"{KEY}.`{k}`").alias(k) for k in keys]).agg(*columns)


def sorted_quantile(values: str, p: float) -> str:
    """SQL text of the same quantile of an ascending array without missing values; NULL for an empty one."""
    x = f"((size({values}) - 1) * {float(p)!r}D)"
    low, high = (f"element_at({values}, cast({f}({x}) as int) + 1)" for f in ("floor", "ceil"))
    return f"case when size({values}) > 0 then {low} + ({high} - {low}) * ({x} - floor({x})) end"


def share_at_or_below(
    counts: DataFrame, probes: DataFrame, probe_value: str, crowded: DataFrame | None = None
) -> DataFrame:
    """Empirical distribution of each group, read at the probes of that group.

    `counts` is (group, value, n), where a value may come in several rows; `probes` has the packed group key,
    `probe_value` and any other columns. Returns the probes with `_share` = (values <= probe) / (all values),
    ties included, NULL for a group without values, and the group's number (`_total`) and sum (`_sum`) of values.
    """
    if crowded is None:
        crowded = crowded_groups(counts)
    others = ", ".join(c for c in probes.columns if c != KEY)
    tagged = probes.selectExpr(KEY, f"{probe_value} as {VALUE}", f"0L as {N}", f"struct({others}) as _probe")
    pool = counts.select(KEY, VALUE, N).unionByName(tagged, allowMissingColumns=True)
    bounds = _node_bounds(_in_nodes(pool, crowded, None, "inner")).drop("_end")
    # the default RANGE frame counts values equal to the probe as "at or below"
    node = f"over (partition by {', '.join(NODE)}"
    inside = _in_nodes(pool, crowded, None).selectExpr(
        *NODE,
        "_probe",
        f"sum({N}) {node} order by {VALUE}) as _inside",
        f"sum({N}) {node}) as _n_node",
        f"sum({N} * {VALUE}) {node}) as _sum_node",
    )
    return (
        inside.where("_probe is not null")
        .join(bounds, NODE, "left")
        .selectExpr(
            KEY,
            "_probe.*",
            "coalesce(_start, 0L) + _inside as _below",
            "coalesce(_n_group, _n_node) as _total",
            "coalesce(_sum_group, _sum_node) as _sum",
        )
        .selectExpr(KEY, "* except (_key, _below, _total, _sum)", "try_divide(_below, _total) as _share", "_total", "_sum")
    )
