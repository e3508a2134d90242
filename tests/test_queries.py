import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_queries import TABLES, compare

# One query per family; tools/check_queries.py runs all of them.
CHOSEN = [
    "landing_order_items", "landing_null_profile", "bronze_order_items", "bronze_parity", "silver_orders_as_of",
    "silver_unique_items", "damaged_rejected_items", "damaged_rejected_by_key", "damaged_quality_log",
    "quality_row_flow", "quality_forecast_outliers_ranged", "gold_dim_customers", "gold_fact_orders",
    "gold_monthly_sales_summary", "gold_customer_lifetime_value_ranged", "gold_customer_segmentation",
    "product_revenue_forecast", "product_acquisition_cohort", "product_performance_analytics_ranged",
    "governance_gates", "bi_territory_month_growth", "bi_segment_mix", "bi_cash_flow", "features_customer_rfm_ranged",
    "features_product_performance", "features_sales_rep_quota", "features_as_of_batch", "features_churn_label",
    "features_training_sample", "features_product_trend_fit", "gold_quarterly_revenue_fixed_calendar",
    "sink_upsert", "search_documents_text", "streaming_orders", "streaming_order_items_late",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SMALL), duck.sql(entry.oracle_sql()[name])).startswith("ok")


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "month_over_month_growth_pct" in found.columns
