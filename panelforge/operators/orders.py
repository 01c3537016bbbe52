"""Order sheet of open positions and its text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_sheet(positions: DataFrame, horizon: int, gain: float, cut: float, first_close: str = "first_close") -> DataFrame:
    """Exit prices of positions that may be sold: buy * (1 + benchmark + threshold).

    ``positions``: model, entity, buy, bench, holding_days, day (2 on the first day that may sell) and
    the close of the entry day.  On day 2 a breached stop gives the price -1: sell at the open.
    """
    p = positions.where((F.col("day") >= 2) & (F.col("buy") > 0) & F.col("bench").isNotNull())
    breached = F.coalesce((F.col("day") == 2) & (F.col(first_close) / F.col("buy") - 1 - F.col("bench") <= cut), F.lit(False))
    return p.withColumns({"gain_price": F.col("buy") * (1 + F.col("bench") + gain), "cut_price": F.when(breached, -1.0).otherwise(F.col("buy") * (1 + F.col("bench") + cut)), "expire": F.lit(horizon) - F.col("holding_days"), "first_stop": breached})


def message(sheet: DataFrame, model: str = "model", entity: str = "entity", decimals: int = 3) -> DataFrame:
    """One text a model: its positions in order, two lines each.  A model's open positions are few."""
    fmt = lambda c: F.format_number(F.col(c), decimals)
    head = F.concat_ws(" | ", F.col(entity).cast("string"), F.when(F.col("priority").isNotNull(), F.concat(F.lit("P"), F.col("priority").cast("string"))), F.when(F.col("expire") <= 0, "EXPIRE TODAY").otherwise(F.concat(F.lit("Exp "), F.col("expire").cast("string"))))
    prices = F.concat(F.lit("Buy "), fmt("buy"), F.lit(" | + "), fmt("gain_price"), F.lit(" | - "), F.when(F.col("cut_price") == -1, "OPEN").otherwise(fmt("cut_price")))
    lines = F.concat(head, F.lit("\n"), prices)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(entity).alias("e"), lines.alias("t")))), lambda x: x["t"])
    return sheet.groupBy(model).agg(F.concat(F.lit("["), F.first(F.col(model)).cast("string"), F.lit("]\n"), F.array_join(listed, "\n")).alias("text"))
