"""Feature catalogue, lineage and text search."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework import session
from lodework.operators.quality import union_all
from lodework.operators.stretches import Stretches, row_count

BROWSER_COLUMNS = (
    "feature_id", "feature_name", "entity_type", "data_type", "owner_team", "is_point_in_time", "offline_enabled",
    "online_enabled", "tags", "description", "lineage_source_table", "version", "created_at",
)


def registry_browser(registry: DataFrame) -> DataFrame:
    return registry.select(*BROWSER_COLUMNS).orderBy("entity_type", "feature_name")


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def list_features(registry: DataFrame, entity: str | None = None, tags: str | None = None) -> DataFrame:
    """Features of an entity type whose tags contain any of the comma-separated texts."""
    if entity:
        registry = registry.filter(F.col("entity_type") == entity)
    if tags:
        registry = registry.filter(_any([F.col("tags").ilike(f"%{t}%") for t in tags.split(",")]))
    return registry


def contains_text(column: Column | str, text: str) -> Column:
    """Case-insensitive match of a text anywhere; % and _ in it act as wildcards."""
    column = F.col(column) if isinstance(column, str) else column
    return F.upper(column).like(f"%{text.upper()}%")


def search_features(registry: DataFrame, text: str = "") -> DataFrame:
    """Features whose name, tags, description or entity contain the text; all for a text under two letters."""
    if len(text) < 2:
        return registry_browser(registry)
    columns = ("feature_name", "tags", "description", "entity_type")
    return registry_browser(registry.filter(_any([contains_text(c, text) for c in columns])))


def search(table: DataFrame, text: str, ranked_columns: Sequence[str], other_columns: Sequence[str] = (),
           order: Sequence[str] = (), k: int = 50) -> DataFrame:
    """Rows mentioning a text, the best matching column first.

    The first of n ranked columns scores n, the next n - 1, and so on; a match in the other
    columns scores 0. A map-side filter and a top-k: nothing else moves.
    """
    hits = [contains_text(c, text) for c in ranked_columns]
    score = F.when(hits[0], len(hits))
    for position, hit in enumerate(hits[1:], start=1):
        score = score.when(hit, len(hits) - position)
    matched = table.filter(_any(hits + [contains_text(c, text) for c in other_columns]))
    return matched.withColumn("relevance_score", score.otherwise(0)).orderBy(
        F.col("relevance_score").desc(), *order).limit(k)


def search_metadata(metadata: DataFrame, text: str) -> DataFrame:
    return search(metadata, text, ("entity_name", "column_name", "business_definition"), ("embedding_ready_text",),
                  ("entity_name", "column_name"))


# --- listings ---------------------------------------------------------------------------------------

def _listed(column: str, separator: str, distinct: bool = False) -> Column:
    kind = "DISTINCT " if distinct else ""
    return F.expr(f"listagg({kind}{column}, '{separator}') WITHIN GROUP (ORDER BY {column})")


def ownership(registry: DataFrame) -> DataFrame:
    return registry.groupBy("owner_team", "entity_type").agg(
        F.count(F.lit(1)).alias("feature_count"),
        _listed("feature_id", ", ").alias("feature_ids"),
        _listed("feature_name", " | ").alias("feature_names"))


def features_by_entity(registry: DataFrame) -> DataFrame:
    return registry.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("feature_count"),
        _listed("tags", " | ", distinct=True).alias("all_tags"),
        _listed("feature_id", ", ").alias("feature_ids"),
        _listed("feature_name", " → ").alias("feature_names"))


def teams(registry: DataFrame) -> DataFrame:
    return registry.groupBy("owner_team").agg(F.count(F.lit(1)).alias("feature_count"))


def pit_flag_counts(registry: DataFrame) -> DataFrame:
    return registry.groupBy("is_point_in_time").agg(F.count(F.lit(1)).alias("feature_count"))


def with_tag(registry: DataFrame, *tags: str) -> DataFrame:
    return registry_browser(registry.filter(_any([F.col("tags").like(f"%{t}%") for t in tags])))


def of_entity(registry: DataFrame, entity: str) -> DataFrame:
    return registry_browser(registry.filter(F.col("entity_type") == entity))


def of_team(registry: DataFrame, team: str) -> DataFrame:
    return registry_browser(registry.filter(F.col("owner_team") == team))


def pit_only(registry: DataFrame) -> DataFrame:
    return registry_browser(registry.filter("is_point_in_time"))


def registry_health(registry: DataFrame, least: int = 20) -> DataFrame:
    return registry.agg(F.count(F.lit(1)).alias("feature_count")).withColumn(
        "status", F.when(F.col("feature_count") >= least, "HEALTHY").otherwise("LOW"))


# --- lineage ----------------------------------------------------------------------------------------

def lineage_tree(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.coalesce("upstream_feature_id", "upstream_table_name", F.lit("SOURCE")).alias("upstream"),
        F.col("downstream_feature_id").alias("downstream"), "dependency_type", "created_at",
    ).orderBy("downstream", "upstream")


def lineage_named(edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Edges with both ends resolved to feature names."""
    up = registry.select(F.col("feature_id").alias("upstream_feature_id"), F.col("feature_name").alias("_up"))
    down = registry.select(F.col("feature_id").alias("downstream_feature_id"), F.col("feature_name").alias("_down"))
    return edges.join(up, "upstream_feature_id", "left").join(down, "downstream_feature_id", "left").select(
        "upstream_feature_id", "downstream_feature_id", "dependency_type",
        F.coalesce("upstream_table_name", F.lit("")).alias("upstream_table_name"),
        F.coalesce("_up", "upstream_table_name", F.lit("SOURCE")).alias("upstream_name"),
        F.coalesce("_down", "downstream_feature_id").alias("downstream_name"),
    ).orderBy(F.col("downstream_feature_id"), F.col("upstream_feature_id").asc_nulls_last())


def feature_lineage(edges: DataFrame, feature_id: str) -> DataFrame:
    touching = (F.col("downstream_feature_id") == feature_id) | (F.col("upstream_feature_id") == feature_id)
    return edges.filter(touching).orderBy(F.col("created_at").desc(), "downstream_feature_id")


def source_edges(registry: DataFrame) -> DataFrame:
    """Edges table -> feature as stated by the registry itself."""
    return registry.filter(F.col("lineage_source_table").isNotNull()).select(
        F.lit(None).cast("string").alias("upstream_feature_id"),
        F.col("feature_id").alias("downstream_feature_id"),
        F.col("lineage_source_table").alias("upstream_table_name"))


def reachable(edges: DataFrame, table: str, max_depth: int | None = None) -> DataFrame:
    """Features derived from a table directly or through other features.

    Breadth-first over an edge table: each round joins the new features to the edges and
    drops those already reached, so cycles end. Rounds are checkpointed on shared storage.
    """
    session.enable_checkpoints(edges.sparkSession)
    hops = edges.filter(F.col("upstream_feature_id").isNotNull()).select(
        F.col("upstream_feature_id").alias("feature_id"), F.col("downstream_feature_id").alias("_next"))
    frontier = edges.filter(F.col("upstream_table_name") == table).select(
        F.col("downstream_feature_id").alias("feature_id")).distinct().checkpoint()
    found, depth = frontier, 1
    while (max_depth is None or depth < max_depth) and not frontier.isEmpty():
        onward = frontier.join(hops, "feature_id").select(F.col("_next").alias("feature_id")).distinct()
        frontier = onward.join(found, "feature_id", "left_anti").checkpoint()
        found, depth = found.unionByName(frontier).checkpoint(), depth + 1
    return found


def impact(edges: DataFrame, registry: DataFrame, table: str, max_depth: int | None = None) -> DataFrame:
    """Registered features that need recomputing when a table changes."""
    return registry.join(reachable(edges, table, max_depth), "feature_id", "left_semi").select(
        "feature_id", "feature_name", "owner_team", "entity_type", F.lit("NEEDS RECOMPUTE").alias("action"),
    ).orderBy("owner_team", "feature_name")


def version_history(versions: DataFrame, registry: DataFrame, feature_id: str | None = None, k: int = 50) -> DataFrame:
    if feature_id:
        versions = versions.filter(F.col("feature_id") == feature_id)
    return versions.join(registry.select("feature_id", "feature_name"), "feature_id", "left").select(
        "feature_id", "feature_name", "version_number", "is_active", "deployment_timestamp", "created_by",
        "change_reason").orderBy("feature_id", F.col("version_number").desc()).limit(k)


# --- summary ----------------------------------------------------------------------------------------

def summary(registry: DataFrame, versions: DataFrame, edges: DataFrame, training_customers: DataFrame | Stretches,
            training_products: DataFrame | Stretches) -> DataFrame:
    """Metric and value rows in display order."""
    def of(entity: str) -> Column:
        return F.count_if(F.col("entity_type") == entity)
    everything = F.count(F.lit(1))
    groups = [
        (registry, [("Features Registered", everything), ("Entities", F.count_distinct("entity_type")),
                    ("Owner Teams", F.count_distinct("owner_team")), ("Customer Features", of("customer")),
                    ("Product Features", of("product")), ("SalesRep Features", of("sales_rep")),
                    ("PIT-Correct Features", F.count_if("is_point_in_time"))]),
        (versions, [("Feature Versions", F.count_distinct("version_number"))]),
        (edges, [("Lineage Dependencies", everything)]),
        (row_count(training_customers), [("Customer Training Rows", F.sum("n"))]),
        (row_count(training_products), [("Product Training Rows", F.sum("n"))]),
    ]
    return _metric_rows(groups).orderBy("position").select("metric", "value")


def portal_summary(registry: DataFrame) -> DataFrame:
    return _metric_rows([(registry, [
        ("Features Registered", F.count(F.lit(1))), ("Entity Types", F.count_distinct("entity_type")),
        ("PIT-Correct Features", F.count_if("is_point_in_time")),
        ("Offline-Enabled", F.count_if("offline_enabled")),
    ])]).orderBy("position").select("metric", "value")


def _metric_rows(groups) -> DataFrame:
    parts, position = [], 0
    for df, metrics in groups:
        counted = df.agg(*[value.alias(f"m{i}") for i, (_, value) in enumerate(metrics)])
        rows = [F.struct(F.lit(position + i).alias("position"), F.lit(name).alias("metric"),
                         F.col(f"m{i}").cast("string").alias("value")) for i, (name, _) in enumerate(metrics)]
        parts.append(counted.select(F.inline(F.array(*rows))))
        position += len(metrics)
    return union_all(parts)
