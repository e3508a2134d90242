"""Curated catalogue rows: the feature registry, feature lineage and semantic metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.sources.tables import inline

CREATED_AT = datetime(2024, 1, 1)

REGISTRY_SCHEMA = (
    "feature_id string, feature_name string, data_type string, entity_type string, entity_key string, "
    "owner_team string, description string, is_point_in_time boolean, online_enabled boolean, "
    "offline_enabled boolean, tags string, lineage_source_table string, lineage_source_column string"
)

# The registered features.
REGISTRY_ROWS = [
    ("cust_recency_days", "Customer Recency (Days Since Last Purchase)", "INT", "customer", "CUSTOMER_ID", "Analytics",
     "Days since last order within 12-month window", True, False, True, "rfm,customer-lifetime-value", "FACT_ORDERS", "DATE_KEY"),
    ("cust_frequency_12m", "Customer Frequency (12-Month Orders)", "INT", "customer", "CUSTOMER_ID", "Analytics",
     "Number of orders in past 12 months", True, False, True, "rfm,customer-lifetime-value", "FACT_ORDERS", "ORDER_ID"),
    ("cust_monetary_12m", "Customer Monetary Value (12-Month)", "DECIMAL", "customer", "CUSTOMER_ID", "Analytics",
     "Total revenue in past 12 months", True, False, True, "rfm,customer-lifetime-value", "FACT_ORDERS", "REVENUE"),
    ("cust_rfm_composite_score", "Customer RFM Composite Score", "INT", "customer", "CUSTOMER_ID", "Analytics",
     "Sum of R, F, M scores (3-15 range)", True, False, True, "rfm,customer-lifetime-value", "CUSTOMER_RFM_FEATURES_OFFLINE", None),
    ("cust_segment_rfm", "Customer Segment (RFM)", "VARCHAR", "customer", "CUSTOMER_ID", "Analytics",
     "VIP | Loyal | At-Risk | Inactive | Engaged", True, False, True, "rfm,customer-lifetime-value,segmentation", "CUSTOMER_RFM_FEATURES_OFFLINE", None),
    ("cust_days_since_purchase", "Days Since Last Purchase", "INT", "customer", "CUSTOMER_ID", "Analytics",
     "Recency in days", True, False, True, "engagement,churn", "DIM_CUSTOMERS", "LAST_ORDER_DATE"),
    ("cust_engagement_status", "Customer Engagement Status", "VARCHAR", "customer", "CUSTOMER_ID", "Analytics",
     "Active | Dormant | At-Risk | Churned", True, False, True, "engagement,churn", "CUSTOMER_ENGAGEMENT_FEATURES_OFFLINE", None),
    ("cust_lifetime_value", "Customer Lifetime Value", "DECIMAL", "customer", "CUSTOMER_ID", "Analytics",
     "Total revenue from customer", True, False, True, "customer-lifetime-value,customer-value", "DIM_CUSTOMERS", "LIFETIME_VALUE"),
    ("cust_lifetime_order_count", "Customer Lifetime Order Count", "INT", "customer", "CUSTOMER_ID", "Analytics",
     "Total number of orders", True, False, True, "customer-lifetime-value", "DIM_CUSTOMERS", "LIFETIME_ORDER_COUNT"),
    ("cust_avg_order_value", "Customer Average Order Value", "DECIMAL", "customer", "CUSTOMER_ID", "Analytics",
     "LTV / order count", True, False, True, "customer-lifetime-value,order-metrics", "CUSTOMER_ENGAGEMENT_FEATURES_OFFLINE", None),
    ("prod_cumulative_revenue", "Product Cumulative Revenue", "DECIMAL", "product", "PRODUCT_ID", "Analytics",
     "Total revenue generated by product", True, False, True, "product-performance,revenue", "FACT_ORDERS", "REVENUE"),
    ("prod_revenue_12m", "Product Revenue (12-Month)", "DECIMAL", "product", "PRODUCT_ID", "Analytics",
     "Revenue in past 12 months", True, False, True, "product-performance,revenue", "FACT_ORDERS", "REVENUE"),
    ("prod_units_sold", "Product Cumulative Units Sold", "INT", "product", "PRODUCT_ID", "Analytics",
     "Total units sold", True, False, True, "product-performance,volume", "FACT_ORDERS", "QUANTITY"),
    ("prod_return_rate_pct", "Product Return Rate (%)", "DECIMAL", "product", "PRODUCT_ID", "Analytics",
     "Percentage of items returned", True, False, True, "product-performance,quality", "FACT_ORDERS", "RETURN_FLAG"),
    ("prod_revenue_rank", "Product Revenue Rank", "INT", "product", "PRODUCT_ID", "Analytics",
     "Dense rank by revenue (1 = top)", True, False, True, "product-performance,ranking", "PRODUCT_PERFORMANCE_FEATURES_OFFLINE", None),
    ("rep_ytd_revenue", "Sales Rep YTD Revenue", "DECIMAL", "sales_rep", "REP_ID", "Sales",
     "Year-to-date revenue", True, False, True, "quota_attainment,sales-performance", "FACT_ORDERS", "REVENUE"),
    ("rep_quota", "Sales Rep Quota", "DECIMAL", "sales_rep", "REP_ID", "Sales",
     "Annual quota target", False, False, True, "quota_attainment,sales-performance", "DIM_SALES_REPS", "QUOTA"),
    ("rep_quota_attainment_ratio", "Sales Rep Quota Attainment Ratio", "DECIMAL", "sales_rep", "REP_ID", "Sales",
     "YTD revenue / quota", True, False, True, "quota_attainment,sales-performance", "SALES_REP_QUOTA_FEATURES_OFFLINE", None),
    ("rep_quota_attainment_pct", "Sales Rep Quota Attainment (%)", "DECIMAL", "sales_rep", "REP_ID", "Sales",
     "YTD revenue as % of quota", True, False, True, "quota_attainment,sales-performance", "SALES_REP_QUOTA_FEATURES_OFFLINE", None),
    ("rep_ytd_orders", "Sales Rep YTD Order Count", "INT", "sales_rep", "REP_ID", "Sales",
     "Orders closed YTD", True, False, True, "quota_attainment,sales-performance", "FACT_ORDERS", "ORDER_ID"),
    ("rep_ytd_customers", "Sales Rep YTD Customer Count", "INT", "sales_rep", "REP_ID", "Sales",
     "Unique customers engaged YTD", True, False, True, "quota_attainment,sales-performance", "FACT_ORDERS", "CUSTOMER_ID"),
]

LINEAGE_SCHEMA = (
    "lineage_id long, upstream_feature_id string, downstream_feature_id string, upstream_table_name string, "
    "upstream_column_name string, dependency_type string"
)

# The declared dependencies between features and tables.
LINEAGE_ROWS = [
    (1, None, "cust_rfm_composite_score", "CUSTOMER_RFM_FEATURES_OFFLINE", None, "aggregated"),
    (2, "cust_rfm_composite_score", "cust_segment_rfm", None, None, "computed"),
    (3, "cust_days_since_purchase", "cust_engagement_status", None, None, "computed"),
    (4, "prod_cumulative_revenue", "prod_revenue_rank", None, None, "computed"),
]

METADATA_SCHEMA = (
    "entity_name string, column_name string, business_definition string, example_value string, "
    "embedding_ready_text string"
)

# Business definitions of three columns.
METADATA_ROWS = [
    ("fact_orders", "REVENUE", "Line-level revenue after discount from order items", "1234.56",
     "Revenue is monetary value for a sold order item after discount."),
    ("customer_lifetime_value", "LIFETIME_VALUE", "Cumulative spending by customer across all recorded orders",
     "98765.43", "Lifetime value is the total historical spend of a customer."),
    ("sales_rep_monthly_performance", "QUOTA_ATTAINMENT_PCT",
     "Percent of quota achieved by a sales representative in a month", "84.1",
     "Quota attainment percent compares generated revenue to assigned quota."),
]

INDEX_SCHEMA = "doc_id string, doc_type string, source_table string, source_key string, chunk_text string"

# The retrieval index entries.
INDEX_ROWS = [
    ("doc_customer_ltv_1", "metric_definition", "GOLD.customer_lifetime_value", "CUSTOMER_ID=1",
     "Customer lifetime value summarizes total spend and can be used for value-based segmentation."),
    ("doc_sales_perf_1", "kpi_definition", "GOLD.sales_rep_monthly_performance", "REP_ID=1",
     "Quota attainment indicates monthly progress toward sales targets for a representative."),
]

VERSIONS_SCHEMA = (
    "version_id long, feature_id string, version_number int, definition_sql string, schema_hash string, "
    "deployment_timestamp timestamp_ntz, created_by string, change_reason string, is_active boolean"
)

ENTITY_KEYS_SCHEMA = (
    "entity_id long, entity_type string, entity_key_value string, description string, "
    "first_seen timestamp_ntz, last_updated timestamp_ntz"
)


def feature_registry(spark: SparkSession, created_at: datetime = CREATED_AT) -> DataFrame:
    """The registry with its defaulted columns."""
    return inline(spark, REGISTRY_ROWS, REGISTRY_SCHEMA).withColumns({
        "version": F.lit(1),
        "created_at": X.moment(created_at),
        "deprecated_at": F.lit(None).cast("timestamp_ntz"),
    })


def feature_lineage(spark: SparkSession, created_at: datetime = CREATED_AT) -> DataFrame:
    return inline(spark, LINEAGE_ROWS, LINEAGE_SCHEMA).withColumn(
        "created_at", X.moment(created_at))


def feature_versions(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return inline(spark, list(rows), VERSIONS_SCHEMA)


def entity_keys(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return inline(spark, list(rows), ENTITY_KEYS_SCHEMA)


def _with_stub_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("embedding_vector_stub", F.from_json(F.lit("[0.0, 0.0, 0.0]"), "array<double>"))


def semantic_metadata(spark: SparkSession) -> DataFrame:
    return _with_stub_vector(inline(spark, METADATA_ROWS, METADATA_SCHEMA))


def retrieval_index(spark: SparkSession) -> DataFrame:
    return _with_stub_vector(inline(spark, INDEX_ROWS, INDEX_SCHEMA))
