"""Moving averages, MACD and RSI on the closes of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.sequence import block_scan, block_size, carry_blocks, ema_term, in_blocks, row_index, with_halo
from tickframe.operators.ticks import EMA_WINDOWS, SMA_WINDOWS


def sma_wide(indexed: DataFrame, windows: Sequence[int] = SMA_WINDOWS) -> DataFrame:
    """Means of the last n closes, from the n-th on."""
    d, over = with_halo(indexed, max(windows) - 1)
    for n in windows:
        d = d.withColumn(f"sma_{n}", F.when(F.col("rn") >= n - 1, F.avg("close").over(over.rowsBetween(1 - n, 0))))
    return d.where("not _halo").drop("_block", "_halo")


def recursions(bars: DataFrame, emas: Sequence[int] = EMA_WINDOWS, short: int = 12, long: int = 26, signal: int = 9, rsi: int = 14, block: int | None = None) -> DataFrame:
    """bars(ticker, timestamp, close) with rn and the recursive indicators, in one scan by blocks.

    EMA_n from the n-th close on; MACD with its signal (an EMA of MACD from the first close on) from
    where both are warm; RSI by Wilder's means of gains and losses, from `rsi` changes on. All series
    start at the first close and go on over days.

    Everything is linear in what a block is given: the EMAs' values, the signal's (on which the EMAs
    act through a closed form), the means of gains and losses, and the close before, which makes the
    first gain or loss of the block."""
    spans = sorted({*emas, short, long})
    alpha = {n: 2 / (n + 1) for n in spans}
    sig, wild = 2 / (signal + 1), 1 / rsi
    size = block or block_size([*alpha.values(), sig, wild])
    d, running = in_blocks(bars.select("ticker", "timestamp", "close"), "timestamp", size)
    close = F.col("close")
    in_order = Window.partitionBy("ticker", "_day", "_b").orderBy("timestamp")
    change = close - F.lag("close", 1).over(in_order)  # null in a block's first row
    d = d.withColumns({"_up": F.greatest(F.coalesce(change, F.lit(0.0)), F.lit(0.0)), "_down": F.greatest(F.coalesce(-change, F.lit(0.0)), F.lit(0.0))})
    d = d.withColumns({f"_e{n}": ema_term(close, alpha[n], running) for n in spans})
    d = d.withColumns(
        {
            "_sig": ema_term(F.col(f"_e{short}") - F.col(f"_e{long}"), sig, running),
            "_mu": ema_term(F.col("_up"), wild, running),
            "_md": ema_term(F.col("_down"), wild, running),
            "_first": F.first("close").over(running),
            "_second": F.max(F.when(F.col("_i") == 1, close)).over(running),
        }
    )
    kept = 1 - wild

    def pull(n: int, i: Column) -> Column:
        """What one of a carried EMA adds to the signal at place i."""
        b = 1 - alpha[n]
        return F.lit(sig * b / (b - (1 - sig))) * (F.pow(F.lit(b), i + 1) - F.pow(F.lit(1 - sig), i + 1))

    def driven(c: Column, i: Column) -> Column:
        """What the carried EMAs add to the signal at place i."""
        return c[f"e{short}"] * pull(short, i) - c[f"e{long}"] * pull(long, i)

    def given(c: Column, e: Column) -> Column:
        """The carried values as they act on this block: a ticker's first close stands for all before
        it, and its first change for the means before it."""
        moved = e["_first"] - c["last"]
        later = e["_second"] - e["_first"]

        def mean(name: str, sign: int) -> Column:
            new = F.greatest(sign * later, F.lit(0.0))
            own = F.greatest(sign * moved, F.lit(0.0))
            return F.when(c["rn"] == 0, F.coalesce(new, F.lit(0.0)) / kept).when(c["rn"] == 1, own).otherwise(c[name])

        def jump(sign: int) -> Column:
            return F.when(c["rn"] == 0, F.lit(0.0)).otherwise(F.greatest(sign * moved, F.lit(0.0)))

        es = [F.when(c["rn"] == 0, e["_first"]).otherwise(c[f"e{n}"]).alias(f"e{n}") for n in spans]
        return F.struct(*es, c["sig"].alias("sig"), mean("mu", 1).alias("mu"), mean("md", -1).alias("md"), jump(1).alias("ju"), jump(-1).alias("jd"))

    def at(g: Column, e: Column, i: Column) -> dict[str, Column]:
        """Values at place i from what is given and the block's own terms e."""
        out = {f"e{n}": e[f"_e{n}"] + g[f"e{n}"] * F.pow(F.lit(1 - alpha[n]), i + 1) for n in spans}
        out["sig"] = e["_sig"] + g["sig"] * F.pow(F.lit(1 - sig), i + 1) + driven(g, i)
        for name, jump in (("mu", "ju"), ("md", "jd")):
            out[name] = e[f"_{name}"] + g[name] * F.pow(F.lit(kept), i + 1) + wild * g[jump] * F.pow(F.lit(kept), i)
        return out

    own = [F.col(c) for c in ("_i", "_first", "_second", "_sig", "_mu", "_md", *[f"_e{n}" for n in spans])]

    def block_map(e: Column, rn: Column, last: Column) -> dict[str, Column]:
        """`at` of a block's last place as a map of what is carried. A ticker's first block depends on
        nothing carried, nor do the means of the block that has its first change (see `given`)."""
        i, none = e["_i"], F.lit(0.0)
        out = {}
        for n in spans:
            power = F.pow(F.lit(1 - alpha[n]), i + 1)
            out[f"a_e{n}_e{n}"] = F.when(rn == 0, none).otherwise(power)
            out[f"b_e{n}"] = e[f"_e{n}"] + F.when(rn == 0, e["_first"] * power).otherwise(none)
        for x, c in (("sig", F.pow(F.lit(1 - sig), i + 1)), (f"e{short}", pull(short, i)), (f"e{long}", -pull(long, i))):
            out[f"a_sig_{x}"] = F.when(rn == 0, none).otherwise(c)
        out["b_sig"] = e["_sig"] + F.when(rn == 0, e["_first"] * (pull(short, i) - pull(long, i))).otherwise(none)
        for x, sign in (("mu", 1), ("md", -1)):
            jump, later = F.greatest(sign * (e["_first"] - last), none), F.greatest(F.coalesce(sign * (e["_second"] - e["_first"]), none), none)
            power = F.pow(F.lit(kept), i + 1)
            out[f"a_{x}_{x}"] = F.when(rn <= 1, none).otherwise(power)
            now = wild * jump * F.pow(F.lit(kept), i)
            out[f"b_{x}"] = e[f"_{x}"] + F.when(rn == 0, later / kept * power).when(rn == 1, jump * power + now).otherwise(now)
        return out

    pattern = {**{f"e{n}": (f"e{n}",) for n in spans}, "sig": ("sig", f"e{short}", f"e{long}"), "mu": ("mu",), "md": ("md",)}
    d = carry_blocks(d, [*own, close], pattern, block_map, "close")
    # _second of the block, for the ticker's first block: known from its second row on, where it is needed
    d = d.withColumn("_g", given(F.col("_c"), F.struct("_first", "_second"))).withColumn("rn", F.col("_c.rn") + F.col("_i").cast("long"))
    v = at(F.col("_g"), F.struct(*own), F.col("_i"))
    d = d.withColumns({f"_v_{k}": x for k, x in v.items()})
    warm = F.col("rn") >= long + signal - 2
    macd_ = F.col(f"_v_e{short}") - F.col(f"_v_e{long}")
    strength = F.when(F.col("_v_md") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(F.col("_v_mu"), F.col("_v_md"))))
    out = {f"ema_{n}": F.when(F.col("rn") >= n - 1, F.col(f"_v_e{n}")) for n in emas}
    out |= {"macd_value": F.when(warm, macd_), "macd_signal": F.when(warm, F.col("_v_sig")), "macd_histogram": F.when(warm, macd_ - F.col("_v_sig"))}
    out["rsi_14"] = F.when(F.col("rn") >= rsi, strength)
    return d.withColumns(out).select("ticker", "timestamp", "close", "rn", *out)


def indicators_wide(bars: DataFrame) -> DataFrame:
    """All indicators of a bar in one row: the scan also numbers the rows, which the means need."""
    return sma_wide(recursions(bars))


def _long(wide: DataFrame, kinds: list[tuple[str, int, str, str | None, str | None]]) -> DataFrame:
    """(indicator_type, window, value, signal, histogram) of the given columns, unfolded in one pass."""
    none = F.lit(None).cast("double")
    rows = [
        F.struct(F.lit(kind).alias("indicator_type"), F.lit(n).alias("window"), F.col(v).alias("value"), (F.col(s) if s else none).alias("signal"), (F.col(h) if h else none).alias("histogram"))
        for kind, n, v, s, h in kinds
    ]
    return wide.select("ticker", "timestamp", F.inline(F.array(*rows))).where("value is not null")


def sma(bars: DataFrame, windows: Sequence[int] = SMA_WINDOWS) -> DataFrame:
    wide = sma_wide(row_index(bars.select("ticker", "timestamp", "close")), windows)
    return _long(wide, [(f"SMA_{n}", n, f"sma_{n}", None, None) for n in windows])


def ema(bars: DataFrame, windows: Sequence[int] = EMA_WINDOWS) -> DataFrame:
    d = block_scan(bars.select("ticker", "timestamp", "close"), [(f"_e{n}", "close", 2 / (n + 1)) for n in windows])
    wide = d.withColumns({f"ema_{n}": F.when(F.col("rn") >= n - 1, F.col(f"_e{n}")) for n in windows})
    return _long(wide, [(f"EMA_{n}", n, f"ema_{n}", None, None) for n in windows])


def macd(bars: DataFrame) -> DataFrame:
    return _long(recursions(bars), [("MACD", 0, "macd_value", "macd_signal", "macd_histogram")])


def rsi(bars: DataFrame) -> DataFrame:
    return _long(recursions(bars), [("RSI", 14, "rsi_14", None, None)])


def indicators_long(bars: DataFrame) -> DataFrame:
    """All twelve types in the long form."""
    kinds = [(f"SMA_{n}", n, f"sma_{n}", None, None) for n in SMA_WINDOWS] + [(f"EMA_{n}", n, f"ema_{n}", None, None) for n in EMA_WINDOWS]
    return _long(indicators_wide(bars), [*kinds, ("MACD", 0, "macd_value", "macd_signal", "macd_histogram"), ("RSI", 14, "rsi_14", None, None)])
