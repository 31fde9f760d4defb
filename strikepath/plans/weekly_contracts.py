"""Weekly contract-behaviour build: one feature pass, all weeks at once or only those that changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikepath.functions.aggregates import rows
from strikepath.operators import metrics, summary
from strikepath.operators.panel import panel_features
from strikepath.operators.sample import capped_sample
from strikepath.sources import manifest
from strikepath.sources.tables import drop_weeks, product_path, read_product, write_csv, write_product

FEATURES = "contract_features_1s"
# The products a complete week has.
SIX_PRODUCTS = (
    "contract_summary",
    "contract_evolution_1s",
    "contract_plot_sample",
    "sensitivity_bins",
    "threshold_heatmap",
    "contract_decision_times",
)


def products(features: DataFrame, price_unit: str = "dollars", cap: int | None = None) -> dict[str, DataFrame]:
    """Every weekly product, each a lazy frame over the same features.

    The plot table holds every row unless the caller asks for a sample of ``cap`` rows a week.
    """
    return {
        "contract_summary": summary.contract_summary(features),
        "contract_decision_times": summary.decision_times(features),
        "sensitivity_bins": summary.sensitivity_bins(features),
        "threshold_heatmap": summary.threshold_heatmap(features),
        "contract_event_window_response": summary.event_window_response(features),
        "contract_plot_sample": features if cap is None else capped_sample(features, cap),
        "contract_evolution_1s": summary.contract_evolution(features),
        "contract_behavior_summary_metrics": metrics.contract_metrics(features, price_unit),
        "contract_week_index": metrics.contract_week_index(features),
    }


SORTED_BY = {
    "contract_summary": ("contract_close_time", "ticker"),
    "contract_decision_times": ("contract_close_time", "ticker"),
    "sensitivity_bins": ("time_to_close_bucket", "moneyness_bucket"),
    "threshold_heatmap": ("time_to_close_bucket", "moneyness_bucket"),
    "contract_event_window_response": ("relative_second", "time_to_close_bucket", "moneyness_bucket"),
    "contract_plot_sample": ("ticker", "second"),
    "contract_evolution_1s": ("ticker", "second"),
    "contract_behavior_summary_metrics": ("metric",),
    "contract_week_index": (),
}
#: The time column whose extremes the manifest keeps.
TIMED = dict.fromkeys((FEATURES, "contract_plot_sample", "contract_evolution_1s"), "second")


def build(
    spark: SparkSession,
    panel: DataFrame,
    root: str,
    price_unit: str = "dollars",
    cap: int | None = None,
    sources: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Write the feature table once, then every product from it, for the weeks that ``panel`` holds.

    The features live in the shared output folder rather than in executor
    memory, so a lost executor costs a re-read and not the window stage.
    ``sources`` names the weeks asked for by the fingerprints of their source.
    """
    write_product(panel_features(panel, price_unit), root, FEATURES, ("ticker", "second"), "second", sources)
    features = read_product(spark, root, FEATURES)
    if sources is not None:
        features = features.where(F.col("week_id").isin(*sources))
    written = {
        name: write_product(df, root, name, SORTED_BY[name], TIMED.get(name), sources)
        for name, df in products(features, price_unit, cap).items()
    }
    written["week_index_contract_behavior"] = write_index(spark, root)
    return written


def write_index(spark: SparkSession, root: str) -> str:
    """The week index as one file, from its one row per week."""
    index = read_product(spark, root, "contract_week_index")
    return write_csv(index.orderBy("week_start"), product_path(root, "week_index_contract_behavior.csv"))


def refresh(
    spark: SparkSession, panel: DataFrame, root: str, price_unit: str = "dollars", cap: int | None = None
) -> tuple[list[str], list[str]]:
    """Build the weeks whose source changed and drop those that vanished; returns both.

    ``panel`` has a ``week_id`` that its files are partitioned by, so that a build of
    one week reads one week. A week is up to date when every product was made from
    a source of the same content with the same settings; a run that died between
    two products therefore builds the week again.
    """
    names = (FEATURES, *SORTED_BY)
    found = {r["week_id"]: f"{r['source']}/{price_unit}/{cap}" for r in manifest.fingerprints(panel).where("week_id IS NOT NULL").collect()}
    known = {name: manifest.current(spark, root, name).collect() for name in names}
    made = {name: {r["week_id"]: r["source"] for r in entries if r["source"]} for name, entries in known.items()}
    changed = sorted(w for w, source in found.items() if any(made[name].get(w) != source for name in names))
    gone = sorted({r["week_id"] for entries in known.values() for r in entries if r["n_rows"] and r["week_id"] not in found})
    for name in names if gone else ():
        drop_weeks(spark, root, name, gone)
    if changed:
        build(spark, panel.where(F.col("week_id").isin(*changed)), root, price_unit, cap, {w: found[w] for w in changed})
    elif gone:
        write_index(spark, root)
    return changed, gone


def complete_weeks(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Weeks of a written folder that hold all six products, from the manifest alone."""
    held = {name: manifest.current(spark, root, name).where("n_rows > 0") for name in SIX_PRODUCTS}
    return metrics.complete_weeks(held, path)


def holdings(features: DataFrame) -> DataFrame:
    """(week_id, product, n_source_rows): how many feature rows each of the six products of a week is made from.

    One grouped pass, and nothing is written. A product holds a week if it has any.
    """
    counts = {
        "sensitivity_bins": F.count_if(F.col("yes_price_change_5s").isNotNull() & F.col("underlying_change_5s").isNotNull()),
        "threshold_heatmap": F.count("abs_yes_price_change_5s"),
    }
    per_week = features.groupBy("week_id").agg(*[counts.get(name, rows()).alias(name) for name in SIX_PRODUCTS])
    return per_week.unpivot("week_id", list(SIX_PRODUCTS), "product", "n_source_rows")


def weeks_to_be_complete(features: DataFrame, path: str) -> DataFrame:
    """The weeks that a build over ``features`` makes complete."""
    return metrics.named_complete(holdings(features).where("n_source_rows > 0"), len(SIX_PRODUCTS), path)
