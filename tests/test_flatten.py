import pytest
from pyspark.sql import functions as F

from crmlake.operators import edges as E, flatten as FL

AS_OF = "2024-01-15"


def rejects(df):
    return {r["seq"]: r["reject_reason"] for r in df.select("seq", "reject_reason").collect()}


def test_rejection_of_contacts(objects):
    df = FL.flatten_all(objects(
        "contacts", {"id": 101, "properties": {"firstname": "Ada", "lastname": None}},
        {"id": "", "properties": {}}, {"id": 1.5, "properties": {}}, {"properties": {}},
        {"id": "7"}, {"id": "8", "properties": {"email": 5}}, {"id": "9", "properties": None},
        "not json", {"id": "10", "properties": {"not_read": 5}}, {"id": "11", "properties": "x"},
        {"id": "12", "properties": {"email": 'looks like "x":5'}},
        {"id": "13", "properties": {"hs_object_id": True}}), "contacts")
    assert rejects(df) == {
        0: None, 1: "missing id", 2: "missing id", 3: "missing id", 4: "missing properties",
        5: "wrong type: email", 6: "missing properties", 7: "missing id", 8: None,
        9: "missing properties", 10: None, 11: "wrong type: hs_object_id"}
    ok, bad = FL.split_valid(df)
    assert ok.count() == 3 and bad.count() == 9
    first = ok.filter("source_id = '101'").first()
    assert (first["full_name"], first["record_id"]) == ("Ada", "101")


def test_wrong_type_counts_only_where_it_is_reached(objects):
    df = FL.flatten_all(objects(
        "companies", {"id": "1", "properties": {"cvr": "A", "company_registration_number": 5}},
        {"id": "2", "properties": {"company_registration_number": 5}},
        {"id": "3", "properties": {"hs_last_activity_date": "2024-01-01", "notes_last_updated": 1}},
        {"id": "4", "properties": {"hs_last_activity_date": "bad", "notes_last_updated": 1}}),
        "companies")
    assert [r is None for r in rejects(df).values()] == [True, False, True, False]


def test_fallbacks(objects):
    rows = {r["source_id"]: r for r in FL.flatten_tickets(objects(
        "tickets", {"id": "1", "properties": {"subject": "", "hs_ticket_subject": "x"}},
        {"id": "2", "properties": {"hs_ticket_subject": "x", "hs_ticket_status": "s"}},
        {"id": "3", "properties": {"created_by_source": "b", "hs_ticket_source": "c",
                                   "createdate": "nonsense"}})).collect()}
    assert rows["1"]["ticket_name"] == ""  # an empty string is a value, only null falls through
    assert (rows["2"]["ticket_name"], rows["2"]["ticket_status"]) == ("x", "s")
    assert (rows["3"]["source"], rows["3"]["created_at"]) == ("b", None)
    contact = FL.flatten_contacts(objects(
        "contacts", {"id": "1", "properties": {"contact-type": "a"}})).first()
    assert contact["contact_type"] == "a"


def test_email_and_activity_prefer_different_bodies(objects):
    payload = {"id": "1", "properties": {"hs_email_html": "<p>html</p>", "hs_email_text": "text"},
               "associations": {"contacts": {"results": []}}}
    email = FL.flatten_emails(objects("emails", payload)).first()
    assert (email["email_body"], email["associated_contact_id"]) == ("<p>html</p>", None)
    activity = FL.flatten_activities(objects("emails", payload), "EMAIL", AS_OF).first()
    assert (activity["body"], activity["status"]) == ("text", "completed")


def test_first_contact_and_source_object(objects):
    made = {"deals": {"results": [{"id": 5}]}, "contacts": {"results": [{"id": "7"}, {"id": "8"}]}}
    rows = [made, {"widgets": {"results": [{"id": "w"}]}}, {}, {"contacts": {}, "tickets":
            {"results": [{"id": 3}]}}, {"contacts": {"results": [{"name": "x"}]}, "companies":
            {"results": [{"id": "c"}]}}]
    df = FL.flatten_activities(objects("notes", *[
        {"id": i, "properties": {}, "associations": a} for i, a in enumerate(rows)]), "NOTE", AS_OF)
    got = [(r[0], r[1]) for r in df.orderBy("source_id").select(
        "source_object_type", "source_object_id").collect()]
    assert got == [("contacts", "7"), ("widgets", "w"), (None, None), ("tickets", "3"),
                   ("companies", "c")]
    note = {"id": "1", "properties": {}, "associations": made}
    assert FL.flatten_communications(objects("communications", note)).first()[
        "associated_contact_id"] == "7"


def test_sms_takes_first_filled(objects, spark):
    df = objects("sms", {"id": "1", "properties": {
        "hs_sms_direction": "", "hs_sms_message_direction": "IN", "hs_sms_text": "t",
        "hs_activity_assigned_to": "A1"}})
    names = spark.createDataFrame([("a1", "Someone")], "key string, name string")
    row = FL.sms_details(df, names).first()
    assert (row["direction"], row["message_body"], row["activity_assigned_to"]) == ("IN", "t", "Someone")
    assert row["raw_properties_json"].startswith('{"hs_sms_direction":""')


def test_unknown_activity_type(objects):
    with pytest.raises(ValueError):
        FL.flatten_activities(objects("notes"), "FAX", AS_OF)


def test_edges_stay_with_their_activity_after_a_rejection(objects):
    records = FL.split_valid(FL.flatten_activity_records(objects(
        "notes", {"id": 1.5, "properties": {}, "associations": {"deals": {"results": [{"id": "d1"}]}}},
        {"id": "2", "properties": {}, "associations": {"companies": {"results": [{"id": "c2"}]}}}),
        "NOTE", AS_OF))[0]
    row = E.activity_edges(records).first()
    assert (row["activity_source_id"], row["associated_object_type"], row["associated_object_id"]) \
        == ("2", "company", "c2")


def test_edge_types(objects):
    def types(*items):
        return {"results": [{"id": "x", "associationTypes": list(items)}]}

    cases = [
        (types({"label": None, "associationTypeId": 1, "category": "A"},
               {"label": "L", "typeId": 2}, {"label": "M", "typeId": 3}), ("L", 2, "A")),
        (types({"label": " ", "associationTypeId": "bad", "typeId": 9}), (" ", None, None)),
        (types(), (None, None, None)),
        ({"results": [{"id": "x", "types": [{"label": "P", "associationTypeId": 4, "category": None},
                                            {"label": "Q"}]}]}, ("P", 4, None)),
        ({"results": [{"id": "x", "type": "plain"}]}, ("plain", None, None)),
        ({"results": [{"id": "x"}]}, (None, None, None))]
    records = FL.flatten_activity_records(objects("notes", *[
        {"id": str(i), "properties": {}, "associations": {"deals": c}}
        for i, (c, _) in enumerate(cases)]), "NOTE", AS_OF)
    got = {r["activity_source_id"]: (r["association_label"], r["association_type_id"],
                                     r["association_category"])
           for r in E.activity_edges(records).collect()}
    assert got == {str(i): expected for i, (_, expected) in enumerate(cases)}


def test_flags(spark):
    df = FL.status_flags(spark.createDataFrame([("due",), (None,)], "status string"))
    assert [tuple(r)[1:] for r in df.collect()] == [(False, False, False, True), (False,) * 4]
    assert df.filter(F.col("is_due")).count() == 1
