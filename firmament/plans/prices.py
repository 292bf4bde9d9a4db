"""Year-end prices from a daily series."""

from pyspark.sql import DataFrame, functions as F

from firmament.functions.dates import iso_day


def year_end_prices(daily: DataFrame, start: str, end: str, arrival: str | None = None) -> DataFrame:
    """Last trading day of each ticker and calendar year within ``start``..``end`` (both days included).

    ``arrival`` orders prices of the same moment; the last one counts.
    """
    last = F.struct("time", *([arrival] if arrival else []), "close")
    return (
        daily.filter(F.col("time") >= F.lit(start).cast("timestamp"))
        .filter(F.col("time") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
        .groupBy("ticker", F.year("time").alias("fiscal_year"))
        .agg(F.max(last).alias("last"))
        .select("ticker", "fiscal_year", iso_day(F.col("last.time")).alias("trading_date"),
                F.col("last.close").alias("share_price"))
    )
