"""Exit simulators.

Prices: entity, date, open, high, close.  A signal on date T is entered at the open of
the next row or calendar position.  Horizons are a few days, so an exploded signal
has a few rows, and everything is joins and windows on (entity, position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOL = 1e-12


RESULTS = ("buy", "sell", "ret", "ret_ew", "bench", "holding_days", "exit_reason", "target")


def _exits(signals: DataFrame, live: Column, prices: DataFrame, benchmark: DataFrame, horizon: int, gain: float, cut: float, key: list[str]) -> DataFrame:
    """``key``, ``_old`` (the other columns of a signal), ``_live`` and RESULTS, null where not live; signals are evaluated once."""
    cal = benchmark.select("date", "r", (F.row_number().over(Window.orderBy("date")) - 1).alias("pos"))  # one row a date
    rest = [F.col(c) for c in signals.columns if c not in key]
    start = signals.select(*key, F.struct(F.lit(None).cast("boolean").alias("_"), *rest).alias("_old"), live.alias("_live"))
    start = start.join(cal.select("date", F.col("pos").alias("t")), "date", "left")
    steps = F.when(F.col("_live"), F.sequence(F.lit(1), F.lit(horizon))).otherwise(F.array(F.lit(1)))
    days = start.select(*key, "_old", "_live", F.when(F.col("_live"), F.col("t")).alias("t"), F.explode(steps).alias("k")).withColumn("pos", F.col("t") + F.col("k"))
    px = prices.join(cal, "date").select("entity", "pos", "open", "high", "close", "r")
    days = days.join(px, ["entity", "pos"], "left")
    w = Window.partitionBy(*key).orderBy("k")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    ok = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("close").isNotNull() & F.col("r").isNotNull() & (F.col("r") > -1)
    d = days.withColumns({
        "bench": F.product(1 + F.col("r")).over(run) - 1,
        "buy": F.max(F.when((F.col("k") == 1) & (F.col("open") > 0), F.col("open"))).over(whole),
        "valid": F.min(F.coalesce(ok, F.lit(False)).cast("int")).over(run) == 1,
    })
    d = d.withColumn("valid", F.col("valid") & F.col("buy").isNotNull())
    adj = lambda c: F.col(c) / F.col("buy") - 1 - F.col("bench")
    stop1 = F.col("valid") & (F.col("k") == 1) & (adj("close") <= cut + TOL)
    d = d.withColumn("stopped", F.max(stop1.cast("int")).over(whole) == 1)
    k, last = F.col("k"), F.lit(horizon)
    at_gain, at_cut = F.col("buy") * (1 + F.col("bench") + gain), F.col("buy") * (1 + F.col("bench") + cut)

    def exit_(reason: str, sell: Column, target: int) -> Column:
        return F.struct(F.lit(reason).alias("reason"), sell.cast("double").alias("sell"), F.lit(target).alias("target"))

    expire = F.when(adj("close") >= gain - TOL, exit_("expiry_gain", F.col("close"), 1)).otherwise(exit_("expiry_close", F.col("close"), 0))
    hit = (
        F.when(F.col("stopped"), F.when(k == 2, exit_("t1_stop_t2_open", F.col("open"), 0)))
        .when(k == 1, F.when(last == 1, expire))
        .when(adj("open") >= gain - TOL, exit_("profit_open", F.col("open"), 1))
        .when(adj("high") >= gain - TOL, exit_("profit_intraday", at_gain, 1))
        .when(adj("close") <= cut + TOL, exit_("stop_close", at_cut, 0))
        .when(k == last, expire)
    )
    d = d.withColumn("hit", F.when(F.col("valid"), hit))
    out = d.groupBy(*key).agg(
        F.first("_old").alias("_old"),
        F.first("_live").alias("_live"),
        F.max(F.when(F.col("valid"), F.col("buy"))).alias("buy"),
        F.min_by(F.struct("k", "bench", "hit"), F.when(F.col("hit").isNotNull(), k)).alias("x"),
        F.max_by(F.struct("k", "bench", "close"), F.when(F.col("valid"), k)).alias("open_mark"),
    )
    done = F.col("x.hit").isNotNull()
    price = F.when(done, F.col("x.hit.sell")).otherwise(F.col("open_mark.close"))
    bench = F.when(done, F.col("x.bench")).otherwise(F.col("open_mark.bench"))
    return out.select(*key, "_old", "_live", "buy", F.when(done, price).alias("sell"), (price / F.col("buy") - 1).alias("ret"), (price / F.col("buy") - 1 - bench).alias("ret_ew"), bench.alias("bench"), F.when(done, F.col("x.k")).otherwise(F.col("open_mark.k")).alias("holding_days"), F.col("x.hit.reason").alias("exit_reason"), F.col("x.hit.target").alias("target"))


def simulate_adjusted(signals: DataFrame, prices: DataFrame, benchmark: DataFrame, horizon: int, gain: float, cut: float, key: list[str]) -> DataFrame:
    """Benchmark-adjusted exits.

    ``signals``: one row for each ``key`` (with entity and date); ``benchmark``: date, r, whose dates are the calendar.
    Adds buy, sell, ret, ret_ew, bench, holding_days, exit_reason, target; open positions are marked
    at the last evaluated close, without sell, reason and target; unresolved ones keep nulls.
    """
    out = _exits(signals, F.lit(True), prices, benchmark, horizon, gain, cut, key)
    return out.select(*[c if c in key else f"_old.{c}" for c in signals.columns], *RESULTS)


def refill(audit: DataFrame, prices: DataFrame, benchmark: DataFrame, horizon: int, gain: float, cut: float, key: list[str]) -> DataFrame:
    """Rows that have a target are frozen; all others are simulated again."""
    out = _exits(audit, F.col("target").isNull(), prices, benchmark, horizon, gain, cut, key)
    fresh = lambda c: F.when(F.col("_live"), F.col(c)).otherwise(F.col(f"_old.{c}")).alias(c)
    return out.select(*[c if c in key else fresh(c) if c in RESULTS else f"_old.{c}" for c in audit.columns])


def _with_days(prices: DataFrame, horizon: int) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("date")
    return prices.withColumns({f"t{k}_{c}": F.lead(c, k).over(w) for k in range(horizon + 2) for c in ("open", "high", "close")}).withColumn("_ahead", F.count(F.lit(1)).over(w.rowsBetween(1, Window.unboundedFollowing)))


def price_ladder(signals: DataFrame, prices: DataFrame, days: int = 5) -> DataFrame:
    """Signals with T0_open, T0_close, T0_high ... of the entity's own rows from the signal's date on; null past the last row."""
    w = Window.partitionBy("entity").orderBy("date")
    steps = prices.select("entity", "date", *[F.lead(c, k).over(w).alias(f"T{k}_{c}") for k in range(days + 1) for c in ("open", "close", "high")])
    return signals.join(steps, ["entity", "date"], "left")


def simulate_raw_strict(signals: DataFrame, prices: DataFrame, horizon: int, gain: float, cut: float) -> DataFrame:
    """Raw exits on the entity's own rows: strict stop, filled at the close; a first-day stop sells at the next open."""
    p = _with_days(prices.select("entity", "date", "open", "high", "close"), horizon)
    s = signals.join(p, ["entity", "date"], "left")
    buy = F.when(F.col("t1_open") > 0, F.col("t1_open"))
    up, down = buy * (1 + gain), buy * (1 - cut)
    sell = F.when((F.col("t1_close") < down) & F.col("t2_open").isNotNull(), F.col("t2_open"))
    for k in range(2, horizon + 1):
        o, h, c = (F.col(f"t{k}_{x}") for x in ("open", "high", "close"))
        sell = sell.when(o >= up, o).when(h >= up, up).when(c < down, c)
        if k == horizon:
            sell = sell.when(c.isNotNull(), c)
    sell = F.when(buy.isNotNull(), sell)
    return s.select(*signals.columns, buy.alias("buy"), sell.alias("sell"), (sell / buy - 1).alias("ret"), F.when(sell.isNotNull(), (sell / buy - 1 >= gain).cast("int")).alias("target"))


def simulate_raw_forced(signals: DataFrame, prices: DataFrame, horizon: int, gain: float, cut: float) -> DataFrame:
    """Raw exits with an inclusive stop and a forced exit at the horizon or the last row there is.

    ``cut`` is negative; holding_days counts rows after the entry.
    """
    p = _with_days(prices.select("entity", "date", "open", "high", "close"), horizon)
    s = signals.join(p, ["entity", "date"], "left")
    buy = F.when((F.col("_ahead") >= 1) & (F.col("t1_open") > 0), F.col("t1_open"))
    up, down = buy * (1 + gain), buy * (1 + cut)

    def exit_(k: int, price: Column, reason: str) -> Column:
        return F.struct(F.lit(k - 1).alias("days"), price.alias("price"), F.lit(reason).alias("reason"))

    out = F.when((F.col("t1_close") <= down) & (F.col("_ahead") >= 2), exit_(2, F.col("t2_open"), "t1_stop_t2_open"))
    for k in range(2, horizon + 1):
        there = F.col("_ahead") >= k
        o, h, c = (F.col(f"t{k}_{x}") for x in ("open", "high", "close"))
        out = out.when(there & (o >= up), exit_(k, o, "tp_open")).when(there & (h >= up), exit_(k, up, "tp_intraday")).when(there & (c <= down), exit_(k, c, "stop_close"))
    for k in range(horizon, 0, -1):
        out = out.when(F.col("_ahead") >= k, exit_(k, F.col(f"t{k}_close"), "forced_close"))
    x = F.when(buy.isNotNull(), out)
    s = s.withColumn("_x", x).withColumn("_buy", buy)
    good = F.col("_x.price") > 0
    return s.select(*signals.columns, F.when(good, F.col("_buy")).alias("buy"), F.when(good, F.col("_x.price")).alias("sell"), F.when(good, F.col("_x.price") / F.col("_buy") - 1).alias("ret"), F.when(good, F.col("_x.days")).alias("holding_days"), F.when(good, F.col("_x.reason")).alias("exit_reason"), F.when(good, F.col("_x.reason").startswith("tp_").cast("int")).alias("target"))
