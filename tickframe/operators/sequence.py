"""Long series in parallel: a row index without sorting a whole ticker, frames with a halo, and
first-order recursions by blocks."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Blocks, or stretches of blocks, whose maps become one.
STRETCH = 256


def row_index(df: DataFrame, ts: str = "timestamp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """df with rn: 0, 1, ... along each ticker's time. Days are counted and summed up (a few rows for
    each ticker), and rows are numbered within their day only."""
    day = F.to_date(ts).alias("_day")
    counts = df.groupBy("ticker", day).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy("ticker").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("ticker", "_day", before.alias("_start"))
    within = Window.partitionBy("ticker", "_day").orderBy(ts, *tiebreak)
    numbered = df.withColumn("_day", F.to_date(ts)).withColumn("_n", F.row_number().over(within))
    return numbered.join(starts, ["ticker", "_day"]).withColumn("rn", F.col("_start") + F.col("_n") - 1).drop("_day", "_n", "_start")


def with_halo(df: DataFrame, rows: int, block: int = 4096, ahead: bool = False) -> tuple[DataFrame, object]:
    """(df with the last `rows` rows of each block repeated in the next one, a window over blocks).
    A frame of up to `rows` preceding rows is whole for all but the repeated rows (`_halo`). With `ahead` the
    first rows of each block are repeated in the one before, for frames of following rows."""
    if rows > block:
        raise ValueError("a block must be at least as long as its halo")
    own = F.floor(F.col("rn") / block)
    near, beside = (F.col("rn") % block < rows, own - 1) if ahead else (F.col("rn") % block >= block - rows, own + 1)
    blocks = F.when(near & (beside >= 0), F.array(own, beside)).otherwise(F.array(own))
    out = df.withColumn("_block", F.explode(blocks)).withColumn("_halo", F.col("_block") != own)
    return out, Window.partitionBy("ticker", "_block").orderBy("rn")


def in_blocks(df: DataFrame, ts: str, size: int) -> tuple[DataFrame, object]:
    """(df with _b and _i, a running window over blocks): rows are numbered within their ticker's day
    and cut into blocks of `size`. _b sorts by time, _i is 0, 1, ... in a block; no other row is needed
    for either."""
    within = Window.partitionBy("ticker", "_day").orderBy(ts)
    d = df.withColumn("_day", F.to_date(ts)).withColumn("_n", F.row_number().over(within) - 1)
    d = d.withColumn("_b", F.struct("_day", F.floor(F.col("_n") / size).alias("k"))).withColumn("_i", (F.col("_n") % size).cast("double"))
    running = Window.partitionBy("ticker", "_day", "_b").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    return d.drop("_n"), running


#: What each state after a block depends on: itself and others before it.
Pattern = Mapping[str, Sequence[str]]


def _plus(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _composed(pattern: Pattern, one: Column, two: Column) -> Column:
    """The affine map that is `one` and then `two`: a struct of a_x_y, what x takes of y, and b_x."""
    out = []
    for x, ys in pattern.items():
        out += [_plus([two[f"a_{x}_{z}"] * one[f"a_{z}_{y}"] for z in ys if y in pattern[z]]).alias(f"a_{x}_{y}") for y in ys]
        out.append((two[f"b_{x}"] + _plus([two[f"a_{x}_{z}"] * one[f"b_{z}"] for z in ys])).alias(f"b_{x}"))
    return F.struct(*out)


def _applied(pattern: Pattern, m: Column, state: Column) -> Column:
    return F.struct(*[(m[f"b_{x}"] + _plus([m[f"a_{x}_{y}"] * state[y] for y in ys])).alias(x) for x, ys in pattern.items()])


def _before_each(pattern: Pattern, listed: str, state: Column, entry: Callable[[Column, Column], Column]) -> Column:
    """For each element x of a list with maps x.m, in order: entry(x, the state before it)."""
    first = F.transform(F.slice(listed, 1, 1), lambda x: entry(x, state))

    def one(acc: Column, x: Column) -> Column:
        return F.struct(_applied(pattern, x["m"], acc["now"]).alias("now"), F.concat(acc["made"], F.array(entry(x, acc["now"]))).alias("made"))

    return F.aggregate(listed, F.struct(state.alias("now"), F.slice(first, F.lit(1), F.lit(0)).alias("made")), one, lambda acc: acc["made"])


def carry_blocks(d: DataFrame, end: Sequence[Column], pattern: Pattern, block_map: Callable[[Column, Column, Column], Mapping[str, Column]], last: str | None = None) -> DataFrame:
    """d (see `in_blocks`) with `_c`: rn, the ticker's rows before the block; last, the field `last` of the
    block before; and the states that are carried into the block.

    end: columns of a block's last row; block_map(end, rn, last): the affine map from states before the
    block to states after it, as a_x_y and b_x. A ticker's first block must not depend on what is carried
    into it (its a_x_y are 0). Maps compose, so they are folded as a tree: STRETCH blocks to one map, STRETCH
    of these to one, and what is left of a ticker (one for each STRETCH^2 blocks, 33 million rows) in order;
    then states are handed down the same way. A list holds STRETCH maps, whatever a ticker's length. All of
    a ticker that one task sees is a row for each block, one after the other."""
    ends = d.groupBy("ticker", "_b").agg(F.max_by(F.struct(*end), "_i").alias("_end"))
    held = F.col(f"_end.{last}") if last else F.lit(None).cast("double")
    along = Window.partitionBy("ticker").orderBy("_b")  # a row for each block, streamed
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    blocks = ends.select(
        "ticker", "_b", (F.row_number().over(along) - 1).alias("idx"), F.coalesce(F.sum(F.col("_end._i").cast("long") + 1).over(before), F.lit(0)).alias("rn"), F.lag(held, 1).over(along).alias("last"), "_end",
    )
    m = F.struct(*[c.alias(name) for name, c in block_map(F.col("_end"), F.col("rn"), F.col("last")).items()])
    listed = blocks.withColumn("m", m).groupBy("ticker", F.floor(F.col("idx") / STRETCH).alias("s")).agg(F.array_sort(F.collect_list(F.struct("idx", "_b", "rn", "last", "m"))).alias("l"))

    def whole(df: DataFrame) -> Column:
        return F.aggregate(F.slice("l", F.lit(2), F.size("l")), F.element_at("l", 1)["m"], lambda acc, x: _composed(pattern, acc, x["m"]))

    upper = listed.select("ticker", "s", whole(listed).alias("m")).groupBy("ticker", F.floor(F.col("s") / STRETCH).alias("t")).agg(F.array_sort(F.collect_list(F.struct("s", "m"))).alias("l"))
    top = upper.select("ticker", "t", whole(upper).alias("m")).groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("t", "m"))).alias("l"))
    none = F.struct(*[F.lit(0.0).alias(x) for x in pattern])

    def down(df: DataFrame, state: Column, entry) -> DataFrame:
        return df.select("ticker", F.inline(_before_each(pattern, "l", state, entry)))

    to_upper = down(top, none, lambda x, now: F.struct(x["t"].alias("t"), now.alias("now")))
    to_listed = down(upper.join(to_upper, ["ticker", "t"]), F.col("now"), lambda x, now: F.struct(x["s"].alias("s"), now.alias("now")))
    states = down(
        listed.join(to_listed, ["ticker", "s"]), F.col("now"),
        lambda x, now: F.struct(x["_b"].alias("_b"), F.struct(x["rn"].alias("rn"), x["last"].alias("last"), *[now[s].alias(s) for s in pattern]).alias("_c")),
    )
    return d.join(states.hint("shuffle_hash"), ["ticker", "_b"])  # a hash table of blocks: rows are neither sorted again nor, where few, sent to one task


def ema_term(x: Column, alpha: float, running) -> Column:
    """The recursion y[i] = (1 - alpha) y[i-1] + alpha x[i] within a block, from nothing before it."""
    return F.sum(alpha * x * F.pow(F.lit(1 - alpha), -F.col("_i"))).over(running) * F.pow(F.lit(1 - alpha), F.col("_i"))


def block_size(alphas: Sequence[float]) -> int:
    """As long as the powers of 1 - alpha stay far inside a double's range (1e50), 512 at most."""
    return min(512, *(int(50 * math.log(10) / -math.log(1 - a)) for a in alphas))


def block_scan(df: DataFrame, series: Sequence[tuple[str, str, float]], block: int | None = None, ts: str = "timestamp") -> DataFrame:
    """df with rn, the number of a ticker's rows before, and for each (out, x, alpha) y[0] = x[0] and
    y[i] = (1 - alpha) y[i-1] + alpha x[i]. A null x counts as 0.

    Within a block, y is (1 - alpha)^i times a running sum of alpha (1 - alpha)^(-i) x; what is carried
    into it is added on. The input is read twice, whatever the number of series."""
    size = block or block_size([a for _, _, a in series])
    d, running = in_blocks(df, ts, size)
    d = d.withColumns({f"_y_{out}": F.coalesce(ema_term(F.col(x), a, running), F.lit(0.0)) for out, x, a in series})
    d = d.withColumns({f"_x_{out}": F.first(F.coalesce(F.col(x), F.lit(0.0))).over(running) for out, x, _ in series})
    end = [F.col(c) for c in ("_i", *[f"_{k}_{out}" for out, _, _ in series for k in "yx"])]

    def block_map(e: Column, rn: Column, _: Column) -> dict[str, Column]:
        out = {}
        for name, _, a in series:
            power = F.pow(F.lit(1 - a), e["_i"] + 1)  # a ticker's first x stands for all before it
            out[f"a_{name}_{name}"] = F.when(rn == 0, F.lit(0.0)).otherwise(power)
            out[f"b_{name}"] = e[f"_y_{name}"] + F.when(rn == 0, e[f"_x_{name}"] * power).otherwise(F.lit(0.0))
        return out

    d = carry_blocks(d, end, {out: (out,) for out, _, _ in series}, block_map)
    c = F.col("_c")
    ys = {out: F.col(f"_y_{out}") + F.when(c["rn"] == 0, F.col(f"_x_{out}")).otherwise(c[out]) * F.pow(F.lit(1 - a), F.col("_i") + 1) for out, _, a in series}
    return d.withColumns({**ys, "rn": c["rn"] + F.col("_i").cast("long")}).select(*[c for c in df.columns if c != "rn"], "rn", *ys)
