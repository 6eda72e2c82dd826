import json

from pyspark.sql import functions as F

from crmlake.operators import edges as E, history as H, resolve as R
from crmlake.sources import landed as L


def batch(*results):
    return {"results": list(results)}


def test_contact_company_details(pages):
    df = E.contact_company_details(pages(batch(
        {"from": {"id": 101}, "createdAt": "2024-01-01T00:00:00Z", "to": [
            {"toObjectId": 9, "associationTypes": [
                {"category": "S", "typeId": 1, "label": None},
                {"category": "U", "typeId": 20, "label": "Primary"}], "source": "API"},
            {"id": "10", "types": [{"label": "old"}], "createdAt": "bad"},
            {"toObjectId": None, "id": "11"}, {"toObjectId": " "}]},
        {"from": {"id": " "}, "to": [{"id": "1"}]}, {"to": [{"id": "1"}]}), {}))
    rows = {r["company_source_id"]: r for r in df.collect()}
    assert set(rows) == {"9", "10"}
    assert rows["9"]["association_type"] == "Primary"
    assert rows["9"]["association_labels_json"] == '["Primary"]'
    assert rows["10"]["association_type"] == "old"
    assert str(rows["10"]["association_created_at"]) == str(rows["9"]["association_created_at"])


def test_object_edges(pages):
    row = E.object_edges(pages(batch({"from": {"id": "1"}, "to": [{"toObjectId": 2, "associationTypes": [
        {"associationTypeId": 5, "category": "A", "label": "x primary"},
        {"associationTypeId": "no", "typeId": 6, "label": "X PRIMARY"}]}]})), "deal", "ticket").first()
    assert (row["association_type_id"], row["association_category"], row["is_primary"]) == (6, "A", True)
    assert json.loads(row["association_labels_json"]) == ["x primary"]


def test_reverse_edges(pages):
    df = E.company_contact_edges(pages(
        batch({"from": {"id": 1}, "to": [{"id": "a"}, {"id": "b"}]}, {"from": "2", "to": ["c", 5]}),
        batch({"from": {"id": 1}, "to": [{"toObjectId": "z"}]}, {"id": "3", "to": [{"id": ""}]})))
    assert {tuple(r) for r in df.collect()} == {("1", "z"), ("2", "c"), ("2", "5")}
    twice = E.reverse_edges(E.reverse_edges(df))
    assert twice.count() == df.count()


def test_edges_or_reverse_and_union(spark):
    cols = "contact_source_id string, company_source_id string"
    none, some = spark.createDataFrame([], cols), spark.createDataFrame([("1", "2")], cols)
    assert E.edges_or_reverse(none, some).count() == 1
    assert E.edges_or_reverse(some, some.union(some)).count() == 1
    labelled = some.withColumn("label", F.lit("first"))
    both = E.union_edges(labelled, some.withColumn("label", F.lit("second"))).collect()
    assert [r["label"] for r in both] == ["first"]


def test_edge_lists_are_bounded_and_whole(spark):
    df = spark.range(2500).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    lists = E.edge_lists(df.union(df), "k", "v", span=1000).collect()
    assert max(len(r["ids"]) for r in lists) <= 1000
    assert sum(len(r["ids"]) for r in lists) == 2500


def test_embedded_edges_last_wins(objects):
    df = objects("contacts", {"id": "1", "associations": {"companies": {"results": [{"id": 5}]}}},
                 {"id": "1", "associations": {"companies": {"results": [{"id": 6}, {"id": ""}]}}},
                 {"id": "1", "associations": {"companies": {"results": []}}}, {"id": "2"})
    assert [tuple(r) for r in E.embedded_edges(df).collect()] == [("1", "6")]


def test_property_history(pages):
    items = [{"value": "OPEN", "timestamp": "2024-01-03T00:00:00Z", "source": "UI", "sourceId": "u"},
             {"value": "", "timestamp": "2024-01-02T00:00:00Z"}, {"value": "LOST", "timestamp": "?"},
             {"value": "NEW", "timestamp": "2024-01-01T00:00:00Z"}]
    df = L.history_payloads(pages({"id": 7, "propertiesWithHistory": {"p": items, "q": []}}), "contact")
    rows = H.property_history(df).orderBy("pos").collect()
    assert [(r["new_value"], r["old_value"]) for r in rows] == [(None, "OPEN"), ("OPEN", "NEW")]
    timed = H.property_history(df, order="time").orderBy("pos").collect()
    assert [(r["new_value"], r["old_value"]) for r in timed] == [(None, "OPEN"), ("OPEN", "NEW")]


def test_a_newest_first_list_and_single_changes_pair_alike(spark, pages):
    values = [("d", "2024-01-09 10:00:05"), ("c", "2024-01-09 10:00:01"), ("b", "2024-01-09 03:00:00"),
              ("a", "2024-01-02 00:00:00")]
    items = [{"value": v, "timestamp": t.replace(" ", "T") + "Z"} for v, t in values]
    payload = pages({"id": 7, "propertiesWithHistory": {"p": items}})
    listed = H.property_history(L.history_payloads(payload, "contact"))
    shuffled = pages({"id": 7, "propertiesWithHistory": {"p": items[::-1]}})
    timed = H.property_history(L.history_payloads(shuffled, "contact"), order="time")
    single = spark.createDataFrame([("7", v, t) for v, t in values], "object_id string, value string, t string").select(
        "object_id", "value", F.col("t").cast("timestamp").alias("change_date"))
    one_per_row = H.history_of_changes(single, ["object_id"])
    want = [("a", "b"), ("b", "c"), ("c", "d"), ("d", None)]
    for rows in (listed, timed, one_per_row):
        assert sorted((r["old_value"], r["new_value"]) for r in rows.collect()) == want


def test_history_of_changes_equals_a_plain_lead(spark):
    rows = [("a", f"2024-01-{day:02d} {h:02d}:00:00", f"v{(day * 7 + h) % 5}")
            for day in (1, 2, 5, 9) for h in (3, 9, 20)] + [("b", "2024-01-03 00:00:00", "x")]
    df = spark.createDataFrame(rows, "k string, t string, value string").select(
        "k", F.col("t").cast("timestamp").alias("change_date"), "value")
    got = {(r["k"], str(r["change_date"])): r["new_value"]
           for r in H.history_of_changes(df, ["k"]).collect()}
    after, expected = {}, {}
    for r in sorted(df.collect(), reverse=True):
        expected[r["k"], str(r["change_date"])] = after.get(r["k"])
        after[r["k"]] = r["value"]
    assert got == expected


def test_owner_and_option_lists(pages):
    owners = R.owners_dim(L.owner_rows(pages(batch(
        {"id": "A", "firstName": "Ada", "lastName": "B"}, {"id": 2, "email": "e@x"}, {"id": ""},
        {"id": "3", "firstName": " ", "lastName": None}), batch({"id": "a", "firstName": "Eve"}))))
    assert {tuple(r) for r in owners.collect()} == {("a", "Eve"), ("2", "e@x"), ("3", "3")}
    options = R.options_dim(L.option_rows(pages({"options": [
        {"value": "0", "label": "Zero"}, {"value": "x", "label": None}, {"value": " "}]}, {})))
    assert {tuple(r) for r in options.collect()} == {("0", "Zero"), ("x", "x")}


def test_resolving(spark):
    dim = spark.createDataFrame([("a", "Ann"), ("7", "seven")], "key string, name string")
    over = spark.createDataFrame([("B", "Bob"), ("A", "not used"), ("Seven", "7!")],
                                 "key string, name string")
    df = spark.createDataFrame([("A",), ("b",), ("7",), ("z",), (" ",), (None,)], "o string")
    got = [r["o"] for r in R.resolve_owner(df, "o", dim, over).collect()]
    assert sorted(map(str, got)) == sorted(map(str, ["Ann", "Bob", "seven", "z", " ", None]))
    stage = [r["o"] for r in R.resolve_stage(df, "o", dim, over).collect()]
    assert sorted(map(str, stage)) == sorted(map(str, ["Ann", "Bob", "7!", "z", " ", None]))
    zero = spark.createDataFrame([("0",), ("1",)], "p string")
    assert [r["p"] for r in R.resolve_pipeline(zero, "p", dim).collect()] == ["Support Pipeline", "1"]


def test_large_lookups_are_not_broadcast(spark):
    assert R.within_broadcast(spark.range(10).select(F.col("id").cast("string")))
    assert not R.within_broadcast(spark.range(11).select(F.col("id").cast("string")), rows=10)
    assert not R.within_broadcast(spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t")), size=500)
