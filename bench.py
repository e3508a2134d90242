"""Time the layer build and the headline queries; prints one JSON line.

The layers are written once and the queries read the stored tables, as a deployment
would; ``from_raw`` entries compute everything from the raw Parquet tables.
"""

from __future__ import annotations

import json
import os
import time

from lodework import session
from lodework.operators import bi, governance
from lodework.plans import build
from lodework.plans.queries import NOW, QUERIES
from lodework.plans.star import SalesModel

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

STORED = {
    "bi_territory_month_growth": lambda m: bi.territory_month_growth(m.monthly_sales),
    "bi_top_customers": lambda m: bi.top_customers(m.lifetime_value),
    "bi_rep_scorecard": lambda m: bi.rep_scorecard(m.scorecard),
    "bi_top_products": lambda m: bi.top_products(m.product_performance),
    "bi_segment_mix": lambda m: bi.segment_mix(m.segmentation, m.lifetime_value),
    "bi_quarterly_yoy": lambda m: bi.quarterly_year_over_year(m.monthly_sales),
    "bi_cohort_trend": lambda m: bi.cohort_trend(m.cohorts),
    "bi_cash_flow": lambda m: bi.cash_flow(m.monthly_sales),
    "bi_category_mix": lambda m: bi.category_mix(m.product_performance),
    "bi_territory_performance": lambda m: bi.territory_performance(m.monthly_sales, m.scorecard),
    "bi_month_territory_category": lambda m: bi.month_territory_category(
        m.fact, m.dim_territories, m.dim_products),
    "sla_status": lambda m: governance.sla_status(m.published(), NOW),
    "training_customers": lambda m: m.training_customers,
    "training_products": lambda m: m.training_products,
}
FROM_RAW = ("gold_fact_orders", "gold_monthly_sales_summary", "gold_customer_segmentation",
            "product_revenue_forecast", "features_sales_rep_quota")


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session.create("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    consume(SalesModel(spark, FOLDER).landing["territories"])  # start-up is not part of any query

    target = session.work_dir(spark, "bench")
    model = build.run(spark, FOLDER, target,
                      on_phase=lambda phase, took: seconds.update({f"build_{phase}": round(took, 3)}))
    for name, make in STORED.items():
        seconds[name] = timed(lambda: consume(make(model)))
    for name in FROM_RAW:
        seconds[f"from_raw_{name}"] = timed(lambda: consume(QUERIES[name](spark, FOLDER)))
    print(json.dumps({"metric": "lakehouse_build_and_headline_queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/"))}))


if __name__ == "__main__":
    main()
