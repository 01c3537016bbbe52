"""Cross-section operators: all entities of one date (or date and group)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from panelforge.functions.nulls import _c, finite


def _average_rank(c: Column, by: list, descending: bool) -> Column:
    order = c.desc_nulls_last() if descending else c.asc_nulls_last()
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, c))
    return F.rank().over(Window.partitionBy(*by).orderBy(order)) + (ties - 1) / 2


def rank_share_all(c, *by, descending: bool = False) -> Column:
    """Average rank / all rows of the date, missing ones included; missing in, missing out."""
    return F.when(_c(c).isNotNull(), _average_rank(_c(c), list(by), descending) / F.count(F.lit(1)).over(Window.partitionBy(*by)))


def rank_share(c, *by, descending: bool = False) -> Column:
    """Average rank / rows with a value; missing in, missing out."""
    return F.when(_c(c).isNotNull(), _average_rank(_c(c), list(by), descending) / F.count(_c(c)).over(Window.partitionBy(*by)))


def passes_gate(c, most: float, *by) -> Column:
    """Is the percentile of a finite value at most ``most``; missing does not pass."""
    return F.coalesce(rank_share(finite(c), *by) <= most, F.lit(False))


def rank_first(c, tie, *by, descending: bool = True) -> Column:
    """1, 2, 3, ... by value, ties in the order of ``tie``; missing values come last."""
    order = _c(c).desc_nulls_last() if descending else _c(c).asc_nulls_last()
    return F.row_number().over(Window.partitionBy(*by).orderBy(order, *([tie] if not isinstance(tie, (list, tuple)) else tie)))


def excess(c, *by) -> Column:
    """Value minus the mean of its group; a missing group key is a group of its own."""
    return _c(c) - F.avg(_c(c)).over(Window.partitionBy(*by))


def relative(c, *by, least: float = 1e-9) -> Column:
    """Value / mean of its group, missing where the mean is about 0."""
    m = F.avg(_c(c)).over(Window.partitionBy(*by))
    return F.when(F.abs(m) > least, _c(c) / m)


#: Ranks over all rows of a date: source and output names are fixed values.
RANKS = (
    ("ret_1", "ret_1_cs_rank"), ("ret_1", "ret_1_prank_1500"), ("ret_2", "ret_2_prank_1500"), ("ret_3", "ret_3_prank_1500"), ("ret_5", "ret_5_prank_1500"),
    ("ret_10", "ret_10_prank_1500"), ("vol", "vol_prank_1500"), ("oc_ret", "oc_ret_cs_rank"), ("amount", "amount_cs_rank"), ("amount", "amount_prank_1500"),
    ("turnover_f_log", "turnover_f_cs_rank"), ("turnover_f_log", "turnover_prank_1500"), ("mf_inst_rate", "mf_inst_rate_cs_rank"), ("mf_inst_rate", "mf_inst_rate_prank_1500"),
    ("vwap_close_ratio", "vwap_close_ratio_prank_1500"), ("mf_price_align_z_20", "mf_price_align_prank_1500"), ("close_to_high", "close_to_high_cs_rank"),
    ("winner_rate", "winner_rate_cs_rank"), ("circ_mv", "circ_mv_cs_rank"), ("circ_mv", "mv_prank_1500"),
)
#: Values over the date's mean, and less the mean of the date or of the group: fixed values.
RELATIVE = (("vol", "vol_rel_1500"), ("amount", "amount_rel_1500"), ("turnover_f_log", "turnover_rel_1500"))
EXCESS = (("mf_inst_rate", "mf_inst_rate_rel_1500", False), ("mf_inst_rate", "mf_inst_rate_rel_sw_l2", True), ("turnover_f_log", "turnover_rel_sw_l2", True))


def block(df, date: str, group: str):
    """The whole cross-section block: 20 ranks, 3 relative levels and 3 excesses, of those sources that exist."""
    out = {name: rank_share_all(x, date) for x, name in RANKS if x in df.columns}
    out |= {name: relative(x, date) for x, name in RELATIVE if x in df.columns}
    out |= {name: excess(x, date, *([group] if grouped else [])) for x, name, grouped in EXCESS if x in df.columns}
    return df.withColumns(out)


def top_k(df, k: int, by: list, *order):
    """First k rows of each group in the given order (which should end in a unique key)."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def first_of_date(c, date: str, *order) -> Column:
    """A value of the date's first row, for all its rows."""
    return F.first(_c(c)).over(Window.partitionBy(date).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
