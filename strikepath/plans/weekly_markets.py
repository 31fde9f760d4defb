"""Weekly market build: bars, the leading symbol, label behaviour and threshold matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strikepath.functions import clock
from strikepath.operators import bars, match, metrics
from strikepath.sources.tables import product_path, read_product, write_csv, write_product


def _weekly(df: DataFrame) -> DataFrame:
    return df.withColumn("week_id", clock.week_id("week_start"))


def build(
    spark: SparkSession, micro: DataFrame, markets: DataFrame, labels: DataFrame, root: str, week_of: str = "window"
) -> dict[str, str]:
    """Write the market products of all weeks, each source read once.

    Bars are written before anything joins them: the joins then see a small
    table whose size is known from its files.
    """
    written = {}

    def put(name: str, df: DataFrame, *order: str) -> DataFrame:
        written[name] = write_product(_weekly(df), root, name, order)
        return read_product(spark, root, name)

    leading = put("futures_15m_windows", bars.keep_dominant(bars.ohlc_bars(micro)), "window_start", "symbol")
    listed = put("kalshi_markets", match.clean_markets(markets), "close_time", "ticker")
    windows = put("labels_15m", match.clean_labels(labels), "window_start")
    unnamed = leading.drop("week_id")
    put("futures_label_window_behavior", match.window_behavior(windows.drop("week_id"), unnamed), "window_start")
    matches = put(
        "kalshi_threshold_matches",
        match.threshold_matches(listed.drop("week_id"), unnamed, week_of),
        "close_time",
        "ticker",
    )
    written["summary_metrics"] = write_product(
        metrics.market_metrics(listed, windows, leading, matches), root, "summary_metrics", ("metric",)
    )
    index = metrics.week_index(listed, windows, leading)
    written["week_index"] = write_csv(index.orderBy("week_start"), product_path(root, "week_index.csv"))
    return written
