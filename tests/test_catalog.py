from datetime import datetime

import pytest

from lodework.operators import catalog, gold
from lodework.sources import seeds
from tests.conftest import rows


@pytest.fixture(scope="module")
def registry(spark):
    return seeds.feature_registry(spark)


@pytest.fixture(scope="module")
def lineage(spark):
    return seeds.feature_lineage(spark)


def test_registry(registry):
    assert registry.count() == 21 and len(registry.columns) == 16
    assert catalog.registry_health(registry).first().status == "HEALTHY"
    assert rows(catalog.teams(registry)) == [("Analytics", 15), ("Sales", 6)]
    assert rows(catalog.pit_flag_counts(registry)) == [(False, 1), (True, 20)]


def test_listing(registry):
    assert catalog.list_features(registry, "product").count() == 5
    assert catalog.list_features(registry, tags="CHURN,quota").count() == 8
    assert catalog.list_features(registry, "customer", "churn,quota").count() == 2
    assert catalog.with_tag(registry, "rfm").count() == 5
    assert catalog.of_team(registry, "Sales").count() == 6 and catalog.of_entity(registry, "customer").count() == 10
    assert catalog.pit_only(registry).count() == 20


def test_search(spark, registry):
    assert catalog.search_features(registry, "QUOTA").count() == 6
    assert catalog.search_features(registry, "q").count() == 21
    metadata = seeds.semantic_metadata(spark)
    found = catalog.search_metadata(metadata, "revenue").collect()
    assert [(r.entity_name, r.relevance_score) for r in found] == [
        ("fact_orders", 2), ("sales_rep_monthly_performance", 0)]


def test_lists_are_ordered(registry):
    sales = [r for r in catalog.ownership(registry).collect() if r.owner_team == "Sales"][0]
    ids = sales.feature_ids.split(", ")
    assert ids == sorted(ids) and len(ids) == sales.feature_count == 6
    product = [r for r in catalog.features_by_entity(registry).collect() if r.entity_type == "product"][0]
    assert product.all_tags.count("product-performance,revenue") == 1


def test_lineage(registry, lineage):
    assert rows(catalog.lineage_tree(lineage), "upstream", "downstream")[0] == (
        "CUSTOMER_RFM_FEATURES_OFFLINE", "cust_rfm_composite_score")
    named = {r.downstream_feature_id: r.upstream_name for r in catalog.lineage_named(lineage, registry).collect()}
    assert named["cust_segment_rfm"] == "Customer RFM Composite Score"
    assert named["cust_rfm_composite_score"] == "CUSTOMER_RFM_FEATURES_OFFLINE"
    assert catalog.feature_lineage(lineage, "cust_rfm_composite_score").count() == 2


def test_impact(registry, lineage):
    assert catalog.impact(lineage, registry, "FACT_ORDERS").count() == 0
    edges = lineage.select("upstream_feature_id", "downstream_feature_id", "upstream_table_name").unionByName(
        catalog.source_edges(registry))
    affected = [r.feature_id for r in catalog.impact(edges, registry, "FACT_ORDERS").collect()]
    assert "prod_cumulative_revenue" in affected and "prod_revenue_rank" in affected


def test_reachability_ends_on_cycles(spark):
    edges = spark.createDataFrame(
        [(None, "a", "T"), ("a", "b", None), ("b", "c", None), ("c", "a", None), ("x", "y", None)],
        "upstream_feature_id string, downstream_feature_id string, upstream_table_name string")
    assert rows(catalog.reachable(edges, "T")) == [("a",), ("b",), ("c",)]
    assert rows(catalog.reachable(edges, "T", max_depth=2)) == [("a",), ("b",)]


def test_versions(spark, registry):
    at = datetime(2024, 1, 1)
    versions = seeds.feature_versions(spark, [
        (1, "rep_quota", 1, "q1", "h1", at, "ann", "first", False), (2, "rep_quota", 2, "q2", "h2", at, "ann", "fix", True),
        (3, "gone", 1, "q", "h", at, "bob", "x", True)])
    assert [(r.feature_id, r.version_number) for r in catalog.version_history(versions, registry).collect()] == [
        ("gone", 1), ("rep_quota", 2), ("rep_quota", 1)]
    assert catalog.version_history(versions, registry, "rep_quota").count() == 2
    assert seeds.entity_keys(spark).columns[0] == "entity_id"


def test_summary(spark, registry, lineage):
    found = dict(tuple(r) for r in catalog.summary(registry, seeds.feature_versions(spark), lineage, spark.range(7),
                                                   spark.range(9)).collect())
    assert found["Features Registered"] == "21" and found["Product Training Rows"] == "9"
    assert dict(map(tuple, catalog.portal_summary(registry).collect()))["Offline-Enabled"] == "21"


def test_semantic_path(spark):
    found = rows(gold.semantic_search_path(seeds.semantic_metadata(spark), seeds.retrieval_index(spark)),
                 "entity_name", "doc_id")
    assert found == [("customer_lifetime_value", "doc_customer_ltv_1"), ("fact_orders", None),
                     ("sales_rep_monthly_performance", "doc_sales_perf_1")]
