import json
import os

import pytest
from pyspark.sql import functions as F

from crmlake.plans import loads as LD, timeline as TL, views as VW
from crmlake.operators.merge import to_table
from crmlake.sources import tables as ST

AS_OF = "2024-01-15"


def table(spark, name, *rows):
    names = sorted({k for r in rows for k in r})
    schema = ", ".join(f"{n} {'long' if n in ('id', 'activity_id') else 'string'}" for n in names)
    return to_table(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), name)


def link(activity, contact, kind="contact"):
    return {"activity_source_id": activity, "associated_object_type": kind, "associated_object_id": contact}


def events(df):
    return {(r["event_type"], r["contact_source_id"]): r for r in df.collect()}


def test_email_events(spark):
    acts = table(spark, "activities",
                 {"id": 1, "source_id": "A1", "activity_type": "EMAIL", "subject": "Hi", "activity_owner": "Ann"},
                 {"id": 2, "source_id": "2", "activity_type": "EMAIL", "subject": ""})
    details = {"EMAIL": table(spark, "activity_emails", {
        "activity_id": 1, "email_direction": "inbound", "status": "", "number_of_email_opens": " 3 ",
        "email_open_rate": '0"5', "number_of_email_clicks": "0"})}
    edges = table(spark, "activity_associations", link("a1", "c1"), link("a1", "c2"), link("2", "c1"))
    joined = TL.activities_of_contacts(TL.with_event_details(acts, details), edges)
    got = events(TL.activity_events(joined, AS_OF))
    assert set(got) == {("email_received", "c1"), ("email_received", "c2"), ("email_sent", "c1"),
                        ("email_opened", "c1"), ("email_opened", "c2")}
    first = got["email_received", "c1"]
    assert first["description"] == "Email received from contact: Hi by Ann"
    assert first["metadata"] == '{"direction":"inbound"}'
    assert (first["actor_id"], first["actor_name"]) == ("Ann", "Ann")
    opened = got["email_opened", "c1"]
    assert opened["description"] == 'Email opened 3 time(s): Hi (Open rate: 0"5)'
    assert json.loads(opened["metadata"]) == {"openCount": 3, "openRate": '0"5'}
    assert opened["actor_id"] is None
    assert got["email_sent", "c1"]["description"] == "Email sent to contact"
    assert got["email_sent", "c1"]["metadata"] is None
    assert str(got["email_sent", "c1"]["event_date"]) == "2024-01-15 00:00:00"
    separate = TL.union_events(TL.email_events(joined, AS_OF), TL.open_events(joined, AS_OF),
                               TL.click_events(joined, AS_OF))
    assert events(separate) == got


def test_other_activity_texts(spark):
    acts = table(
        spark, "activities",
        {"id": 1, "source_id": "1", "activity_type": "CALL", "subject": "S", "status": "due"},
        {"id": 2, "source_id": "2", "activity_type": "note", "body": "b" * 101},
        {"id": 3, "source_id": "3", "activity_type": "NOTE", "body": "b" * 100},
        {"id": 4, "source_id": "4", "activity_type": "SMS", "subject": "S", "status": "completed"},
        {"id": 5, "source_id": "5", "source_object_type": "contacts", "source_object_id": "c"},
        {"id": 6, "source_id": "6", "activity_type": "MEETING", "source_object_type": "deals",
         "source_object_id": "c"})
    details = {"CALL": table(spark, "activity_calls", {
        "activity_id": 1, "call_title": "Title", "status": "BUSY", "direction": "IN", "call_direction": "IN"})}
    edges = table(spark, "activity_associations", *[link(str(i), "c") for i in range(1, 5)], link("6", "d", "deal"))
    joined = TL.activities_of_contacts(TL.with_event_details(acts, details), edges)
    got = {r["related_object_id"]: r for r in TL.activity_events(joined, AS_OF).collect()}
    assert got["1"]["description"] == "Call: Title (IN) - Status: BUSY"
    assert (got["1"]["related_object_name"], got["1"]["metadata"]) == (
        "S", '{"direction":"IN","status":"BUSY","callDirection":"IN"}')
    assert got["2"]["description"] == "Note: " + "b" * 100 + "..."
    assert got["3"]["description"] == "Note: " + "b" * 100
    assert (got["4"]["event_type"], got["4"]["description"]) == ("sms_created", "SMS activity: S")
    assert (got["5"]["event_type"], got["5"]["related_object_type"]) == ("activity_created", "activity")
    assert "6" not in got
    apart = TL.contact_activities(acts, edges).unionByName(TL.source_fallback(acts, edges))
    assert apart.count() == joined.count()


def test_tickets_in_both_directions(spark):
    tickets = table(spark, "tickets", {"source_id": "t", "ticket_name": "N"})
    edges = table(spark, "object_associations",
                  {"source_object_type": "ticket", "source_object_id": "t", "target_object_type": "contact",
                   "target_object_id": "c"},
                  {"source_object_type": "contact", "source_object_id": "c", "target_object_type": "ticket",
                   "target_object_id": "t"})
    linked = TL.ticket_contacts(tickets, edges)
    assert linked.count() == 1
    history = table(spark, "property_histories", {
        "object_type": "ticket", "object_id": "t", "property_name": "hs_pipeline_stage",
        "old_value": "a", "new_value": "b", "change_date": "2024-01-02"})
    changed = TL.ticket_changes(linked, history).first()
    assert changed["description"] == "Ticket status changed from a to b: N"
    assert TL.change_events(history, "lifecyclestage").count() == 0


def test_contact_deal_bridge(spark):
    pairs = table(spark, "contact_company_associations",
                  {"contact_source_id": "1", "company_source_id": "9"},
                  {"contact_source_id": "2", "company_source_id": "8"})
    edges = table(spark, "activity_associations", link("a", "9", "deal"), link("b", "9", "deal"),
                  link("c", "8", "company"))
    assert [tuple(r) for r in VW.bridge_contact_deal(pairs, edges).collect()] == [("1", "9")]


@pytest.fixture
def landing(tmp_path):
    """A landing folder with one page file per type, and a second page for contacts."""

    def write(path, *payloads):
        folder = tmp_path / "landing" / path
        os.makedirs(folder, exist_ok=True)
        (folder / f"{len(os.listdir(folder))}.json").write_text("\n".join(map(json.dumps, payloads)))

    def contact(i, **properties):
        return {"id": i, "properties": {"firstname": f"N{i}", "hubspot_owner_id": "o"} | properties,
                "associations": {"companies": {"results": [{"id": "9"}]}}}

    write("objects/contacts", {"results": [contact(1), contact(2)]}, {"results": [contact(3, email=4)]})
    write("objects/contacts", {"paging": {}})
    write("objects/companies", {"results": [{"id": "9", "properties": {"name": "C"}}]})
    write("objects/deals", {"results": [{"id": "5", "properties": {"amount": "10.5"}}]})
    write("objects/tickets", {"results": [{"id": "6", "properties": {"subject": "T", "hs_pipeline": "0"}}]})
    write("objects/calls", {"results": [{"id": "70", "properties": {"hs_call_title": "Call me"}, "associations": {
        "contacts": {"results": [{"id": 1, "type": "x"}]}, "companies": {"results": [{"id": "9"}]}}}]})
    write("associations/ticket-contact", {"results": [{"from": {"id": "6"}, "to": [{"toObjectId": 2}]}]})
    write("history/contact", {"id": 1, "propertiesWithHistory": {"lifecyclestage": [
        {"value": "lead", "timestamp": "2024-01-02T00:00:00Z"}], "other": [
        {"value": "x", "timestamp": "2024-01-02T00:00:00Z"}]}})
    write("lists/owners", {"results": [{"id": "O", "firstName": "Olga"}]})
    return str(tmp_path / "landing")


def context(spark, landing, root):
    return LD.Context(spark, LD.Landed.below(spark, landing), AS_OF, tables=ST.Tables(spark, root))


def test_full_run_twice(spark, landing, tmp_path):
    ctx = context(spark, landing, str(tmp_path / "t"))
    first = {r["step"]: r for r in LD.run_full(ctx).collect()}
    assert {r["outcome"] for r in first.values()} == {"done"}
    assert (first["contacts"]["inserted"], first["contacts"]["failed"], first["contacts"]["total"]) == (2, 1, 3)
    assert first["contact_activity_timelines"]["inserted"] == 3
    contacts = ctx.read("contacts")
    assert {r["contact_owner"] for r in contacts.collect()} == {"Olga"}
    edge = ctx.read("activity_associations").filter("associated_object_type = 'company'").first()
    assert edge["activity_id"] == 70
    pair = ctx.read("contact_company_associations").filter("contact_source_id = '1'").first()
    assert (pair["contact_id"], pair["company_id"]) == (1, 9)
    assert {r["event_type"] for r in ctx.read("contact_activity_timelines").collect()} == {
        "call_created", "ticket_created", "lifecycle_changed"}
    before = ctx.read("contacts").orderBy("id").collect()
    second = {r["step"]: r for r in LD.run_full(context(spark, landing, str(tmp_path / "t"))).collect()}
    assert all(r["inserted"] == 0 for r in second.values())
    assert second["contacts"]["updated"] == 2
    assert ctx.read("contacts").orderBy("id").collect() == before


def test_critical_and_other_failures(spark, landing, tmp_path, monkeypatch):
    ctx = context(spark, landing, str(tmp_path / "t"))
    LD.run_full(ctx)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(LD, "load_object_edges", broken)
    outcome = {r["step"]: r["outcome"] for r in LD.run_full(context(spark, landing, ctx.tables.root)).collect()}
    assert outcome["object_associations"] == "failed" and outcome["activities"] == "done"
    versions = ctx.tables._versions("contacts", committed=True)
    monkeypatch.setattr(LD, "load_tickets", broken)
    with pytest.raises(LD.LoadFailed):
        LD.run_full(context(spark, landing, ctx.tables.root))
    assert ctx.tables._versions("contacts", committed=True) == versions


def landing_file(landing, path, payload):
    folder = os.path.join(landing, path)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "more.json"), "w") as f:
        f.write(json.dumps(payload))


def test_rejected_rows_are_stored_and_counted(spark, landing, tmp_path):
    landing_file(landing, "objects/tasks", {"results": [
        {"id": "80", "properties": {"hs_task_subject": "ok"}}, {"id": "81", "properties": {"hs_task_subject": 5}},
        {"properties": {"hs_task_subject": "no id"}}]})
    ctx = context(spark, landing, str(tmp_path / "t"))
    metrics = {r["step"]: r for r in LD.run_full(ctx).collect()}
    assert (metrics["activities"]["inserted"], metrics["activities"]["failed"]) == (2, 2)
    rows = [tuple(r) for r in ctx.read("rejected").select("table_name", "source_id", "reason").collect()]
    assert sorted(rows, key=str) == sorted([
        ("activities", None, "missing id"), ("activities", "81", "wrong type: hs_task_subject"),
        ("contacts", "3", "wrong type: email")], key=str)
    assert ctx.read("rejected").filter("raw is null").isEmpty()
    assert not os.listdir(tmp_path / "t" / "_staged")


def test_an_activity_type_fails_alone(spark, landing, tmp_path, monkeypatch):
    landing_file(landing, "objects/tasks", {"results": [{"id": "80", "properties": {}}]})
    whole = LD.flatten.flatten_activity_records

    def broken(df, kind, as_of):
        rows = whole(df, kind, as_of)
        return rows.withColumn("subject", F.raise_error(F.lit("bad task"))) if kind == "TASK" else rows

    monkeypatch.setattr(LD.flatten, "flatten_activity_records", broken)
    ctx = context(spark, landing, str(tmp_path / "t"))
    got = {r["step"]: r for r in LD.run_full(ctx).collect()}
    assert got["activity_tasks"]["outcome"] == "failed" and "bad task" in got["activity_tasks"]["message"]
    assert got["activity_calls"]["inserted"] == 1 and got["contact_activity_timelines"]["outcome"] == "done"
    assert not os.listdir(tmp_path / "t" / "_staged")


def test_a_family_of_events_fails_alone(spark, landing, tmp_path, monkeypatch):
    whole = LD.TL.ticket_created

    def broken(linked):
        return whole(linked).withColumn("description", F.raise_error(F.lit("bad ticket")).cast("string"))

    monkeypatch.setattr(LD.TL, "ticket_created", broken)
    ctx = context(spark, landing, str(tmp_path / "t"))
    got = {r["step"]: r for r in LD.run_full(ctx).collect()}
    assert got["contact_activity_timelines: tickets"]["outcome"] == "failed"
    assert got["contact_activity_timelines"]["inserted"] == 2


def test_a_failed_rebuild_keeps_what_was_stored(spark, landing, tmp_path, monkeypatch):
    ctx = context(spark, landing, str(tmp_path / "t"))
    LD.run_full(ctx)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(LD, "load_tickets", broken)
    with pytest.raises(LD.LoadFailed):
        LD.run_full(context(spark, landing, ctx.tables.root), rebuild=True)
    assert ctx.read("contacts").count() == 2 and ctx.read("contact_activity_timelines").count() == 3


def test_types_that_did_not_land_are_empty(spark, tmp_path):
    landing_file(str(tmp_path / "l"), "objects/contacts", {"results": [{"id": "1", "properties": {"firstname": "A"}}]})
    ctx = context(spark, str(tmp_path / "l"), str(tmp_path / "t"))
    got = {r["step"]: r for r in LD.run_full(ctx).collect()}
    assert {r["outcome"] for r in got.values()} == {"done"}
    assert got["contacts"]["inserted"] == 1 and got["tickets"]["total"] == 0


def test_partitioned_writes_open_few_files(spark, tmp_path):
    store = ST.Tables(spark, str(tmp_path / "s"))
    rows = spark.range(0, 400, 1, 16).select(
        F.col("id"), F.col("id").cast("string").alias("source_id"),
        F.element_at(F.array(F.lit("CALL"), F.lit("NOTE")), (F.col("id") % 2 + 1).cast("int")).alias("activity_type"))
    store.write(to_table(rows, "activities"), "activities")
    files = [f for _, _, names in os.walk(tmp_path / "s") for f in names if f.endswith(".parquet")]
    assert len(files) <= 4
    store.append(to_table(rows.filter("id % 2 = 0"), "activities"), "activities")  # only the calls' files are new
    assert store.read("activities").groupBy("activity_type").count().sort("count").collect() == [("NOTE", 200), ("CALL", 400)]


def test_tables(spark, tmp_path):
    store = ST.Tables(spark, str(tmp_path / "s"))
    assert store.ensure("deals", "notes") == ["deals", "notes"] and store.ensure("deals") == []
    store.append(table(spark, "deals", {"id": 1, "source_id": "1"}), "deals")
    merged = store.read("deals").unionByName(table(spark, "deals", {"id": 2, "source_id": "2"}))
    assert store.write(merged, "deals").count() == 2  # a table can be written from itself
    assert store.get("deals", 2).first()["source_id"] == "2" and store.get("deals", 3).count() == 0
    scan = store.find("deals", F.col("source_id") == "1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source_id,1)" in scan and "ReadSchema: struct<id:bigint,source_id:string>" in scan
    os.makedirs(tmp_path / "s" / "deals" / "v=99")  # a version whose write never ended
    assert store.read("deals").count() == 2
    store.recreate("deals")
    assert store.read("deals").count() == 0
    store.prune("deals", keep=1)
    assert len(store._versions("deals", committed=True)) == 1
