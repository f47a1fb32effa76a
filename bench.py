"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Payments are derived from ``orders`` and
stored once before the clock starts, so the queries scan a payment table as they would in use. Each
query is built and run in full (a ``noop`` sink takes every row and column). The first run warms the
JVM up and is reported as ``cold``; the value is the median of the next three. ``fourfold`` is one warm
run over four times the payments (ids made distinct), and ``slope`` the seconds that a further million
payments take, fixed cost left out.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope import FAMILIES, Options, assemble_features, family_features, tune
from payscope.operators.families import top_k
from payscope.operators.profile import profile_schema
from payscope.sources import derived
from payscope.sources.schema import ID
from payscope.sources.tables import read_payments, scratch_path

OPTIONS = Options(as_of=date(2002, 1, 15), expose_card_number=True)
SPLIT = Options(as_of=date(2002, 1, 15), expose_card_number=True, hot_rows=1000)
FOURFOLD = ("email_features", "channel_features", "email_features_split", "assemble_features",
            "assemble_features_split", "profile_schema")


def stored_payments(spark: SparkSession, sf_dir: str, times: int = 1) -> DataFrame:
    path = scratch_path(spark, "bench-payments")
    dates = {c: F.col(c).cast("timestamp") for c in ("PaymentDate", "SettledDate")}
    payments = derived.payments(spark, sf_dir).withColumns(dates)
    if times > 1:
        copies = payments.crossJoin(F.broadcast(spark.range(times)))
        payments = copies.withColumn(ID, F.concat_ws("-", ID, "id")).drop("id")
    payments.write.parquet(path)
    return read_payments(spark, path)


def workload(payments: DataFrame, ruca: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    runs = {
        f"{name}_features": lambda name=name: family_features(payments, name, ruca, OPTIONS)
        for name in FAMILIES
    }
    runs["assemble_features"] = lambda: assemble_features(payments, ruca, OPTIONS)
    runs["top_100_addresses"] = lambda: top_k(
        family_features(payments, "address", options=OPTIONS), "address_risk_score", 100
    )
    runs["profile_schema"] = lambda: profile_schema(payments)
    runs["email_features_split"] = lambda: family_features(payments, "email", options=SPLIT)
    runs["assemble_features_split"] = lambda: assemble_features(payments, ruca, SPLIT)
    if os.environ.get("BENCH_EXTRA"):
        runs["assemble_features_join"] = lambda: assemble_features(payments, ruca, OPTIONS, "join")
    return runs


def timed(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("payscope-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    runs = workload(stored_payments(spark, sf_dir), derived.ruca(spark, sf_dir))
    seconds, cold = {}, {}
    for name, build in runs.items():
        cold[name] = round(timed(build), 3)
        seconds[name] = round(statistics.median(timed(build) for _ in range(3)), 3)
    larger = stored_payments(spark, sf_dir, 4)
    more = (larger.count() - larger.count() / 4) / 1e6
    runs = workload(larger, derived.ruca(spark, sf_dir))
    fourfold = {name: round(timed(runs[name]), 3) for name in FOURFOLD}
    slope = {name: round((fourfold[name] - seconds[name]) / more, 2) for name in FOURFOLD}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "payment_feature_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "fourfold": fourfold,
                "slope": slope,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
