"""Reporting views as functions: two facts and five bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crmlake.operators.edges import filter_edges


def fact_deals(deals: DataFrame) -> DataFrame:
    """Deal facts. "Created" is the load time; days to close counts day boundaries from it."""
    return deals.select(
        F.col("id").alias("deal_id"), "source_id", "deal_name", "deal_stage", "pipeline", "amount",
        F.col("etl_date").alias("created_date"), F.col("close_date").alias("closed_date"),
        F.datediff("close_date", "etl_date").alias("days_to_close"))


def fact_activities(activities: DataFrame) -> DataFrame:
    return activities.select(
        F.col("id").alias("activity_id"), "source_id", "activity_type", "subject", "activity_date",
        "status", "source_object_type", "source_object_id")


def bridge_activity(edges: DataFrame, object_type: str) -> DataFrame:
    """Activity to contact, deal or company pairs."""
    return filter_edges(edges, object_type).select(
        "activity_source_id", F.col("associated_object_id").alias(f"{object_type}_source_id"))


def bridge_contact_deal(contact_company: DataFrame, activity_edges: DataFrame) -> DataFrame:
    """Contacts with the deals whose id equals the id of their company.

    The rule is kept as it was defined. The result only says whether such a deal edge exists, so a
    semi join on the distinct deal ids answers it and the many-to-many pairs are never formed.
    """
    deals = filter_edges(activity_edges, "deal").select("associated_object_id").distinct()
    return contact_company.join(
        deals, F.col("company_source_id") == F.col("associated_object_id"), "left_semi",
    ).select("contact_source_id", F.col("company_source_id").alias("deal_source_id")).distinct()


def bridge_contact_company(contact_company: DataFrame) -> DataFrame:
    return contact_company.select("contact_source_id", "company_source_id", "association_type")


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Temporary views over stored tables; returns their names."""
    edges, pairs = tables["activity_associations"], tables["contact_company_associations"]
    views = {
        "fact_deals": fact_deals(tables["deals"]),
        "fact_activities": fact_activities(tables["activities"]),
        "bridge_activity_contact": bridge_activity(edges, "contact"),
        "bridge_activity_deal": bridge_activity(edges, "deal"),
        "bridge_activity_company": bridge_activity(edges, "company"),
        "bridge_contact_deal": bridge_contact_deal(pairs, edges),
        "bridge_contact_company": bridge_contact_company(pairs),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
