"""Headline timings. Prints one JSON line.

The source tables are first written once in their stored form (parquet, laid out by date); every
query then reads those, as it would in use. ``$BENCH_SF_DIR`` names the input folder and
``$BENCH_CPUS`` the number of local threads. Each query runs once to warm up and twice timed; the
better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tidemark.contracts import FEATURE_TABLES  # noqa: E402
from tidemark.maintain import FeatureStore, restatement_dates  # noqa: E402
from tidemark.operators.grid import Axis  # noqa: E402
from tidemark.plans.datasets import (  # noqa: E402
    feature_tables,
    prediction_set_from_logs,
    training_set_from_logs,
    wide_features,
)
from tidemark.plans.features import WINDOW_TABLES, build_table, full_axis, window_table  # noqa: E402
from tidemark.plans.labels import eligibility_prediction, label_axis  # noqa: E402
from tidemark.quality import quality_report  # noqa: E402
from tidemark.sources.roles import role_sources  # noqa: E402


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Methods above this size are not compiled by the JVM; Spark then splits them itself.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    store = FeatureStore(spark, tempfile.mkdtemp(prefix="tidemark-bench-"))
    started = time.perf_counter()
    store.load(role_sources(spark, sf_dir))
    setup = time.perf_counter() - started
    sources = store.sources()
    features = [n for n in feature_names(sources)]
    dates = restatement_dates(sources["login"])

    def slice_of(name: str) -> DataFrame:
        return build_table(sources, name, Axis.of_days(spark, dates))

    queries = {f"feat_{n}": (lambda n=n: build_table(sources, n)) for n in FEATURE_TABLES}
    queries |= {
        "spender_tier": lambda: build_table(sources, "spender_tier"),
        "purchase_velocity": lambda: build_table(sources, "purchase_velocity"),
        "label_login_7d": lambda: build_table(sources, "label_login_7d"),
        "eligibility_prediction": lambda: eligibility_prediction(sources),
        "all_features": lambda: wide_features(sources, features, full_axis(sources)),
        "training_set": lambda: training_set_from_logs(sources),
        "prediction_set": lambda: prediction_set_from_logs(sources),
        "quality_report": lambda: quality_report({"battle": build_table(sources, "battle")}),
        "battle_slice_3_dates": lambda: slice_of("battle"),
        "progression_slice_3_dates": lambda: slice_of("progression"),
    }
    for name in ("battle", "progression", "label_login_7d"):
        axis = label_axis if name == "label_login_7d" else full_axis
        queries[f"{name}_by_range_join"] = lambda name=name, axis=axis: window_table(
            WINDOW_TABLES[name], sources, axis(sources), "join"
        )
    seconds = {name: measure(make) for name, make in queries.items()}

    # Datasets over stored tables, as the jobs of a deployed pipeline read them.
    started = time.perf_counter()
    store.publish()
    seconds["publish_all_tables"] = round(time.perf_counter() - started, 3)
    seconds["training_set_from_stored"] = measure(lambda: store.training_set(dense=False))
    seconds["training_set_from_stored_dense"] = measure(store.training_set)
    seconds["prediction_set_from_stored_dense"] = measure(store.prediction_set)
    seconds["prediction_set_from_stored"] = measure(lambda: store.prediction_set(dense=False))
    started = time.perf_counter()
    store.refresh({"battle": dates})
    seconds["refresh_battle_3_dates"] = round(time.perf_counter() - started, 3)

    print(
        json.dumps(
            {
                "metric": "feature_build_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup_sec": round(setup, 3),
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )
    spark.stop()


def feature_names(sources) -> list[str]:
    from tidemark.plans.catalog import FeatureIndex

    return list(FeatureIndex(feature_tables(sources)))


def measure(make, repeats: int = 2) -> float:
    run(make())
    best = float("inf")
    for _ in range(repeats):
        started = time.perf_counter()
        run(make())
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


if __name__ == "__main__":
    main()
