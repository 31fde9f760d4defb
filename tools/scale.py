"""Time the window stage and contract products on a generated dense panel.

    python tools/scale.py [contracts] [hot contract rows]

Each contract has 900 one-second rows; one more contract can be made to hold
many rows, to see large groups being cut.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strikepath import roles  # noqa: E402
from strikepath.operators import summary  # noqa: E402
from strikepath.operators.panel import panel_features  # noqa: E402
from strikepath.session import build_session  # noqa: E402

ROWS = 900


def generated(spark, contracts: int, hot: int):
    dense = spark.range(contracts * ROWS).selectExpr(
        f"concat('C', id div {ROWS}) AS ticker", f"id div {ROWS} AS c", f"id % {ROWS} AS s", "id"
    )
    large = spark.range(hot).selectExpr("'HOT' AS ticker", "0L AS c", "id AS s", "id")
    df = dense.unionByName(large).selectExpr(
        "ticker",
        "timestamp_seconds(1704067200 + (c % 672) * 900 + s) AS second",
        f"s % {ROWS} AS relative_second",
        f"({ROWS} - s % {ROWS}) / 60 AS minutes_to_close",
        "timestamp_seconds(1704067200 + (c % 672) * 900 + 899) AS contract_close_time",
        "pmod(xxhash64(id), 101) / 100 AS kalshi_yes_price",
        "1e5 + pmod(xxhash64(id, 1), 1000) / 10 AS underlying_value",
        "pmod(xxhash64(id, 2), 600) / 10 AS abs_z_bps",
        "id % 3 = 0 AS has_trade_this_second",
    )
    return roles.conform(df, roles.CONTRACT_1S, required=("ticker", "second"))


def main() -> None:
    contracts = int(sys.argv[1]) if len(sys.argv) > 1 else 41_000
    hot = int(sys.argv[2]) if len(sys.argv) > 2 else 0
    spark = build_session(
        "scale", "local[8]", **{"spark.driver.memory": "20g", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    panel = generated(spark, contracts, hot)
    for name, build in (
        ("sensitivity_bins", lambda f: summary.sensitivity_bins(f)),
        ("event_window_response", lambda f: summary.event_window_response(f)),
    ):
        began = time.perf_counter()
        rows = build(panel_features(panel)).agg(F.sum("n_rows")).first()[0]
        print(f"{name}: {contracts * ROWS + hot:,} rows in, {rows:,} counted, {time.perf_counter() - began:.1f} s", flush=True)


if __name__ == "__main__":
    main()
