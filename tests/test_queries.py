"""Registered queries against their SQL, and the shape of their plans.

A part of the queries runs by default. ALL_QUERIES=1 runs every one; SF_DIR chooses the data.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from queryset.base import ORACLES, QUERIES
from tools.check import TABLES, compare

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
PART = ("s1_read_objects", "p1_flatten_contacts", "p12_task_details", "p17_strip_html", "p22_split_valid",
        "j3_resolve_stage", "s7_object_edges", "a1_edge_lists", "x3_union_edges", "w1_property_history",
        "w1_history_of_changes", "u1_merge_coalesce", "u18_upsert_object_edges", "t3_email_opened",
        "t6_ticket_status_changed", "v1_fact_deals", "v6_bridge_contact_deal", "r4_load_deals")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES if os.environ.get("ALL_QUERIES") else PART)
def test_against_sql(spark, connection, name):
    message, good = compare(spark, connection, name, SF_DIR)
    assert good, message


def plan(spark, name):
    return entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PART)
def test_plans_have_no_pairing_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("NestedLoop", "CartesianProduct", "Python", "InPandas"):
        assert bad not in text


def test_narrow_operators_move_nothing(spark):
    """Flattening, edge explosion and history pairing only read."""
    for name in ("p1_flatten_contacts", "p3_flatten_deals", "s7_object_edges", "w1_property_history"):
        text = plan(spark, name)
        assert text.count("Exchange") <= (3 if name == "p3_flatten_deals" else 0)


def test_payloads_are_parsed_once(spark):
    """The object, its properties, and the type check that only rows with a misfit run."""
    df = entry.queries()["p1_flatten_contacts"](spark, SF_DIR)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 3
