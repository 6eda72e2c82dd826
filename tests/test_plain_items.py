"""Association batches read as plain values give what reading every value by its kind gives."""

import json

from pyspark.sql import functions as F

from crmlake.functions.associations import all_labels, last_type, plain_target_id, target_id
from crmlake.functions.text import label_list
from crmlake.operators import edges as E
from crmlake.sources import landed as L


def page(to, start=1, **more):
    return json.dumps({"results": [{"from": {"id": start}, "to": to, **more}]})


def kinds(*types):
    return [{"toObjectId": 7, "associationTypes": [*types]}]


ODD = [
    page(kinds({"label": "Plain", "category": "USER", "associationTypeId": 5, "typeId": 6})),
    page(kinds({"label": 5, "category": "USER"}, {"label": "5", "category": 6})),
    page(kinds({"label": True}, {"label": "true"}, {"label": {"a": 1}}, {"label": ["x"]}, {"label": None}, {"label": 1.5}, {"label": -3})),
    page(kinds({"associationTypeId": "5", "typeId": 6}, {"associationTypeId": 2.5, "typeId": "7"})),
    page(kinds({"associationTypeId": 2 ** 31, "typeId": 6}, {"associationTypeId": 2 ** 70}, {"typeId": 1e3})),
    page(kinds({"label": " ", "category": ""}, {"label": "", "category": None, "typeId": None})),
    page(kinds({"label": 'a "label": 5 b', "category": "x"})),
    page([{"toObjectId": None, "id": "11"}, {"id": 12}, {"toObjectId": True, "id": 13}, {"toObjectId": 1.5, "id": 4},
          {"toObjectId": 2 ** 70}, {"toObjectId": "-0"}, {"toObjectId": {"id": 1}}, None, 5]),
    page([{"id": "1", "types": [{"label": "old", "typeId": 3}, {"label": 4}]}, {"id": "2", "associationTypes": {"label": "x"}},
          {"id": "3", "associationTypes": [None, 5, {"label": "after"}]}, {"id": "4", "associationTypes": [], "types": [{"label": "n"}]}]),
    page(kinds({"label": "x"}), start=None), page(kinds({"label": "x"}), start="a"), page(None), page([]),
    page(kinds({"label": "x"}), createdAt="2024-01-01T00:00:00Z", updatedAt=5),
    page(kinds({"label": 5, "category": "USER"})).replace('"label": ', '"l\\u0061bel" \t:\n '),
    page(kinds({"label": 5, "category": 6})).replace('"', "'"), page(kinds({"label": "x", "typeId": 5})).replace('"', "'"),
    '{"results":[{"from":{"id":1},"to":[{"toObjectId":7,"associationTypes":[{"label":5,"label":"twice"}]}]}]}',
    '{"results":[{"from":{"id":1},"to":[{"toObjectId":7,"associationTypes":[{"label":"cut', "{}", "[]", "", "null", None,
]


def test_plain_values_equal_values_by_kind(spark):
    pages = spark.createDataFrame([(p, "f", k) for k, p in enumerate(ODD)], "page string, file string, at long")
    to = F.col("to")
    items = L.association_items(pages)
    labels, typed = all_labels(F.coalesce(to["associationTypes"], to["types"])), last_type(to["associationTypes"])
    wanted = items.select("from_id", target_id(to).alias("to_id"), labels.alias("labels"), typed["type_id"].alias("type_id"),
                          typed["category"].alias("category"), "seq", "pos")
    found = E._edge_items(pages).select(*wanted.columns)
    assert wanted.count() >= 18
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    ends = L.association_ends(pages).select("from_id", target_id(to).alias("to_id"), "seq", "pos")
    assert sorted(map(str, ends.collect())) == sorted(map(str, wanted.drop("labels", "type_id", "category").collect()))


def test_plain_batches_are_not_read_by_kind(spark):
    """Types of an association are told by kind only in the branch for batches that are not plain; ends always."""
    edges = E.object_edges(spark.createDataFrame([("{}",)], "page string"), "deal", "ticket")
    lines = edges._jdf.queryExecution().optimizedPlan().toString().splitlines()
    told = [line.count("schemaOfVariant") for line in lines if "posexplode(CASE WHEN" not in line]
    assert sum(told) <= 3


def test_ends_read_as_texts_equal_ends_by_kind(spark):
    """Ids in every form: strings, whole numbers as they are written, and values that are no ids."""
    ids = ["5", '"5"', "-5", "-0", "0", "05", '"-0"', "5.0", "5e1", "true", "null", "{\"id\":1}", "[1]", '""', '" "', "'5'",
           "999999999999999999", "9223372036854775807", "9223372036854775808", "-9223372036854775808", '"a\\"id\\":true"', "NaN"]
    pages = ODD + [form.replace("?", i) for i in ids for form in (
        '{"results":[{"from":{"id" : ? },"to":[{"toObjectId":?,"id":7},{"id":?\n}, {"id":"b","toObjectId":"c"}]}]}',
        '{"results":[{"from":{"x":1,"id":?},"to":[{"\\u0069d":?}]},{"from":?,"to":[{"id":3}]},{"from":{"id":4},"to":?}]}',
        "{'results':[{'from':{'id':?},'to':[{'toObjectId':?}]}]}", '{"results":[{"from":{"id":1,"id":?},"to":[{"id":?,"id":2},?]}]}')]
    pages = spark.createDataFrame([(p, "f", k) for k, p in enumerate(pages)], "page string, file string, at long")
    wanted = L.association_ends(pages).select("from_id", target_id(F.col("to")).alias("to_id"), "seq", "pos")
    wanted = sorted(map(str, wanted.collect()))
    assert len(wanted) > 140
    for read in (L.plain_ends, L.plain_items):
        found = read(pages).select("from_id", plain_target_id(F.col("to")).alias("to_id"), "seq", "pos")
        assert sorted(map(str, found.collect())) == wanted


def test_ends_of_plain_batches_are_not_read_by_kind(spark):
    pages = spark.createDataFrame([("{}",)], "page string")
    for edges in (E.contact_company_edges(pages), E.object_edges(pages, "deal", "ticket")):
        lines = edges._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [line for line in lines if "schemaOfVariant" in line and "posexplode(CASE WHEN" not in line]


def test_a_primary_label_that_stands_first_is_not_compared_with_itself(spark):
    df = spark.sql("select * from values (array('a','A','b'), 'a'), (array('a'), 'a'), (array('b','A'), 'a'), (array(), null), "
                   "(array('a'), ' '), (cast(null as array<string>), null), (cast(null as array<string>), 'a') as t(labels, p)")
    assert [r[0] for r in df.select(label_list(F.col("labels"), "p")).collect()] == [
        ["a", "b"], ["a"], ["a", "b"], [], ["a"], None, None]
