"""The registered queries of the evidence-fusion operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidara.plans import acquisition_plans, document_plans, drawing_plans, fusion_plans, material_plans, path_plans, portal_plans, registration_plans, spatial_plans, surface_plans, terrain_plans, text_plans

PLANS = (text_plans, spatial_plans, fusion_plans, portal_plans, drawing_plans, terrain_plans, document_plans, surface_plans, material_plans, path_plans, registration_plans, acquisition_plans)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for plans in PLANS for k, v in plans.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for plans in PLANS for k, v in plans.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each map tile that holds a customer."""
    return text_plans.latest_partition_per_quadkey(spark, sf_dir)
