"""Gap-aware validity flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def invalid_flags(df: DataFrame, calendar: DataFrame, entity: str, date: str, ipo: int = 20, delist: int = 20, grace: int = 30, before: int = 10, after: int = 10) -> DataFrame:
    """Adds ``invalid`` (1 or 0): the first ``ipo`` rows, the last ``delist`` rows of an entity whose last
    date lies more than ``grace`` calendar positions before the end, the ``before`` rows up to a gap in
    the calendar and the ``after`` rows from its end.  Dates that are not in the calendar never open a gap.
    ``calendar``: date, pos.
    """
    w = Window.partitionBy(entity).orderBy(date)
    end = calendar.agg(F.max("pos").alias("_end"))
    rows = df.join(calendar.select(date, "pos"), date, "left").join(F.broadcast(end))  # one row
    whole = Window.partitionBy(entity)
    rows = rows.withColumns({
        "_pre": F.coalesce((F.lead("pos").over(w) - F.col("pos") > 1).cast("int"), F.lit(0)),
        "_rn": F.row_number().over(w),
        "_n": F.count(F.lit(1)).over(whole),
        "_last": F.max("pos").over(whole),
    }).withColumn("_post", F.coalesce(F.lag("_pre").over(w), F.lit(0)))
    gone = (F.col("_end") - F.col("_last") > grace) & (F.col("_n") - F.col("_rn") < delist)
    bad = (F.col("_rn") <= ipo) | F.coalesce(gone, F.lit(False)) | (F.max("_pre").over(w.rowsBetween(0, before - 1)) > 0) | (F.max("_post").over(w.rowsBetween(1 - after, 0)) > 0)
    return rows.withColumn("invalid", bad.cast("int")).select(*df.columns, "invalid")
