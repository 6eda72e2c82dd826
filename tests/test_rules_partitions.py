"""Rules at the write, merges of touched partitions, and events of what changed, on small stores."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from crmlake.model.tables import KEYS, PARTITIONS, key_tells_partition
from crmlake.operators import quality as Q
from crmlake.operators.merge import to_table, upsert
from crmlake.plans import loads as LD
from crmlake.sources import tables as ST


def raw(spark, *objects):
    return spark.createDataFrame([(json.dumps(o), str(i)) for i, o in enumerate(objects)], "raw string, seq string")


def pages(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p), "f", i) for i, p in enumerate(payloads)], "page string, file string, at long")


def batch(source, *targets, label=None):
    types = [{"typeId": 1, "category": "C", "label": label}]
    return {"results": [{"from": {"id": source}, "to": [{"toObjectId": t, "associationTypes": types} for t in targets]}]}


def files(root, table):
    found = {}
    for folder, _, names in os.walk(os.path.join(root, table)):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def values(df, *drop):
    names = [c for c in sorted(df.columns) if c not in ("id", *drop)]
    return sorted(map(str, (tuple(r) for r in df.select(*names).collect())))


# ---- touched partitions


def edge(source, target, number, label="x"):
    return {"source_object_type": source, "source_object_id": str(number), "target_object_type": target,
            "target_object_id": str(number + 1), "association_label": label}


def edges(spark, *rows):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    return to_table(df.withColumn("etl_date", F.lit("2024-01-01").cast("timestamp")), "object_associations")


def run(spark, root, as_of="2024-01-15", **landed):
    options = {k: landed.pop(k) for k in ("rules", "events", "check_references") if k in landed}
    ctx = LD.Context(spark, LD.Landed(**landed), as_of, tables=ST.Tables(spark, root), **options)
    return ctx, {r["step"]: r for r in LD.run_full(ctx).collect()}


def test_which_keys_tell_the_partition():
    assert {t for t in PARTITIONS if key_tells_partition(t)} == {
        "activity_associations", "object_associations", "property_histories", "contact_activity_timelines"}
    assert "activity_type" not in KEYS["activities"]  # an activity may change its type, so its table is merged whole


def test_one_landed_pair_writes_one_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    first = {("deal", "ticket"): pages(spark, batch("1", "10", "11", label="a"), batch("2", "10")),
             ("contact", "ticket"): pages(spark, batch("7", "10")), ("contact", "deal"): pages(spark, batch("7", "1"))}
    run(spark, root, associations=first)
    before, table = files(root, "object_associations"), "object_associations"
    second = {("deal", "ticket"): pages(spark, batch("1", "10", label="b"), batch("3", "12"))}
    ctx, metrics = run(spark, root, associations=second)
    after = files(root, table)
    gone, new = set(before) - set(after), set(after) - set(before)
    assert gone and new
    assert all("source_object_type=deal/target_object_type=ticket" in f for f in gone | new)
    assert all(after[f] == before[f] for f in set(before) & set(after)) and len(set(before) & set(after)) == 2
    m = metrics[table]
    assert (m["inserted"], m["updated"], m["kept"]) == (1, 1, 4)
    # a run in which nothing landed writes nothing and counts all rows as kept
    _, metrics = run(spark, root)
    assert files(root, table) == after and metrics[table]["kept"] == 6


def test_touched_partitions_equal_a_whole_rewrite(spark, tmp_path):
    rng = random.Random(2)
    types = ["contact", "deal", "ticket", "email"]
    make = lambda n: [edge(rng.choice(types), rng.choice(types), rng.randrange(30), rng.choice(["p", "q", None])) for _ in range(n)]
    store = ST.Tables(spark, str(tmp_path / "s"))
    table = "object_associations"
    base = edges(spark, *make(80)).dropDuplicates(list(KEYS[table]))
    store.write(base, table)
    for n, as_of in ((6, "2024-01-02"), (1, "2024-01-03"), (40, "2024-01-04")):
        new = edges(spark, *make(n)).dropDuplicates(list(KEYS[table])).cache()
        want = values(upsert(table, store.read(table), new, as_of), "action")
        within = store.partitions_of(new, table)
        store.replace(upsert(table, store.read(table, within), new, as_of), table)
        assert values(store.read(table)) == want
        assert store.read(table, within).count() + store.read(table, without=within).count() == store.read(table).count()


def test_only_touched_partitions_are_read(spark, tmp_path):
    store = ST.Tables(spark, str(tmp_path / "s"))
    store.write(edges(spark, edge("a", "b", 1), edge("c", "d", 2)), "object_associations")
    read = store.read("object_associations", [("c", "d")])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "c" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert read.count() == 1 and store.read("object_associations", []).count() == 0
    assert store.read("object_associations", without=[]).count() == 2


def test_more_partitions_than_are_listed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "MOST_PARTITIONS", 1)
    store = ST.Tables(spark, str(tmp_path / "s"))
    assert store.partitions_of(edges(spark, edge("a", "b", 1), edge("c", "d", 2)), "object_associations") is None
    assert store.partitions_of(edges(spark, edge("a", "b", 1)), "object_associations") == [("a", "b")]


# ---- appends and lookups


def numbered(spark, start, n, parts=4):
    return spark.range(start, start + n, 1, parts).select("id", F.col("id").cast("string").alias("source_id"),
                                                        F.lit("2024-01-01").cast("timestamp").alias("etl_date"))


def test_an_append_writes_its_own_rows_only(spark, tmp_path):
    store = ST.Tables(spark, str(tmp_path / "s"))
    store.write(numbered(spark, 0, 20_000), "contacts")
    before = files(store.root, "contacts")
    written = []
    for k in range(2):
        assert store.append(numbered(spark, 10**6 * (k + 1), 10, 1), "contacts").count() == 20_000 + 10 * (k + 1)
        new = set(files(store.root, "contacts")) - set(before) - set(written)
        written += new
        assert len(new) == 1 and os.path.getsize(*new) < 150_000  # two Bloom filters of 64 KB
    assert {f: t for f, t in files(store.root, "contacts").items() if f in before} == before
    store.begin()
    store.append(numbered(spark, 5 * 10**6, 10, 1), "contacts", batch="b")
    store.append(numbered(spark, 6 * 10**6, 5, 1), "contacts", batch="b")  # run again: replaces itself
    assert store.read("contacts").count() == 20_025 and "batch" not in store.read("contacts").columns
    store.roll_back()
    assert store.read("contacts").count() == 20_020
    assert store.write(store.read("contacts"), "contacts").count() == 20_020  # a whole write joins the batches
    assert {f.split("batch=")[1].split("/")[0] for f in files(store.root, "contacts") if "v=2" in f} == {ST.WHOLE}
    for bad in ("a/b", "", ST.WHOLE, ".. "):
        if bad:
            with pytest.raises(ValueError):
                store.append(numbered(spark, 0, 1), "contacts", batch=bad)
    first = ST.Tables(spark, str(tmp_path / "first"))
    assert first.append(numbered(spark, 0, 3), "contacts", batch="2024").count() == 3


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    store = ST.Tables(spark, str(tmp_path / "s"))
    # ids lie in no order, as after a merge, so the least and greatest of a file tell nothing
    store.write(numbered(spark, 0, 40_000, 1).repartition(8, F.hash("id")), "contacts")
    for lookup in (F.col("id") == 12_345, F.col("source_id") == "12345"):
        df = store.find("contacts", lookup)
        assert [r["id"] for r in df.collect()] == [12_345]
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert 0 < scan.metrics().apply("numOutputRows").value() <= 40_000 / 8 * 1.2
    assert store.get("contacts", 12_345).count() == 1 and store.get("contacts", -7).count() == 0


# ---- rules


def contact(number, **properties):
    return {"id": number, "properties": {"firstname": f"N{number}", **properties}}


def test_rows_that_break_rules_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "t")
    run(spark, root, rules=LD.QUARANTINE, objects={"contacts": raw(
        spark, contact("1", email="a@x"), contact("2", email="b@x"), contact("3"))})
    ctx, metrics = run(spark, root, as_of="2024-01-16", rules=LD.QUARANTINE, objects={"contacts": raw(
        spark, contact("1", email="a@x", phone="9" * 51, zip="z" * 51), contact("2", email="a@x"), contact("3", email="c@x"),
        contact("4", email="c@x"), contact("5", email="d@x"), contact("6", email="d@x", zip="z" * 51), contact("7"), contact("8"))})
    stored = {r["source_id"]: r for r in ctx.read("contacts").collect()}
    assert {k: r["email"] for k, r in stored.items()} == {
        "1": "a@x", "2": "b@x", "3": "c@x", "5": "d@x", "7": None, "8": None}
    assert stored["1"]["phone"] is None and str(stored["2"]["etl_date"])[:10] == "2024-01-15"
    rejected = {r["source_id"]: r["reason"] for r in ctx.read("rejected").collect()}
    assert rejected == {"1": "length: phone, length: postal_code", "2": "unique: email", "4": "unique: email",
                        "6": "length: postal_code"}
    m = metrics["contacts"]
    assert (m["inserted"], m["updated"], m["kept"], m["failed"]) == (3, 1, 2, 4)


def test_without_rules_every_row_is_loaded(spark, tmp_path):
    ctx, metrics = run(spark, str(tmp_path / "t"), objects={"contacts": raw(
        spark, contact("1", email="a@x", phone="9" * 51), contact("2", email="a@x"))})
    assert ctx.read("contacts").count() == 2 and metrics["contacts"]["failed"] == 0


def test_a_broken_rule_fails_the_step_before_it_writes(spark, tmp_path):
    root = str(tmp_path / "t")
    run(spark, root, rules=LD.FAIL, objects={"contacts": raw(spark, contact("1", email="a@x"))})
    before = files(root, "contacts")
    with pytest.raises(LD.LoadFailed) as failed:
        run(spark, root, rules=LD.FAIL, objects={"contacts": raw(spark, contact("2", email="a@x"))})
    assert failed.value.__cause__.rows == 1 and failed.value.__cause__.example == "unique: email"
    assert files(root, "contacts") == before
    # a step that is not critical is recorded, and the others go on
    ctx, metrics = run(spark, root, rules=LD.FAIL, associations={
        ("deal", "ticket"): pages(spark, batch("1", "9" * 51)), ("contact", "ticket"): pages(spark, batch("1", "2"))})
    assert metrics["object_associations"]["outcome"] == "failed"
    assert "length: target_object_id" in metrics["object_associations"]["message"]
    assert metrics["contact_activity_timelines"]["outcome"] == "done" and ctx.read("object_associations").count() == 0


def plain_refused(stored, incoming):
    """Who may not have a value: a loop over the rows, the last of a key counting."""
    last = {}
    for key, value in incoming:
        last[key] = value
    holder = {}
    for key, value in stored:
        if value is not None:
            holder[value] = min(holder.get(value, (0, key)), (0, key))
    for key, value in last.items():
        if value is not None:
            holder[value] = min(holder.get(value, (1, key)), (1, key))
    return sorted(k for k, v in last.items() if v is not None and holder[v][1] != k)


def test_unique_values_equal_a_plain_loop(spark):
    rng = random.Random(7)
    for hot in (False, True):
        value = lambda: None if rng.random() < 0.2 else ("hot" if hot and rng.random() < 0.4 else f"v{rng.randrange(60)}")
        stored = [(f"k{i:03}", f"v{i}" if i % 3 else None) for i in range(30)]
        incoming = [(f"k{rng.randrange(80):03}", value()) for _ in range(200)]
        old = spark.createDataFrame(stored, "source_id string, email string")
        new = spark.createDataFrame([(*r, i) for i, r in enumerate(incoming)], "source_id string, email string, seq long")
        got = Q.taken_values(new, old, "contacts", "email", ["seq"])
        refused = plain_refused(stored, incoming)
        assert sorted(r["source_id"] for r in got.collect()) == refused and refused
        # whatever was refused, values are unique after the merge
        last = {k: v for k, v in dict(incoming).items() if k not in refused and v}
        after = dict(stored) | last
        held = [v for v in after.values() if v]
        assert len(held) == len(set(held))


def test_required_and_references(spark):
    rows = spark.createDataFrame([(1, None, 5, "x" * 51), (2, "a", 9, "y"), (3, "b", None, None)],
                                 "id long, activity_source_id string, activity_id long, associated_object_id string")
    broken = Q.with_broken_rules(rows, rows.limit(0), "activity_associations", [])
    parents = spark.createDataFrame([(5,)], "id long")
    got = {r["id"]: r["broken_rules"] for r in Q.with_broken_references(broken, {"activity_id": parents}).collect()}
    assert got == {1: ["required: activity_source_id", "length: associated_object_id"], 2: ["reference: activity_id"],
                   3: ["required: associated_object_id"]}


# ---- events of what changed


def call(number, title, contact_id, **more):
    return {"id": number, "properties": {"hs_call_title": title, "hs_timestamp": "2024-01-02T00:00:00Z", **more},
            "associations": {"contacts": {"results": [{"id": contact_id, "type": "t"}]}} if contact_id else {}}


def history(number, name, *items):
    return {"id": number, "propertiesWithHistory": {name: [{"value": v, "timestamp": t} for v, t in items]}}


def changing_runs(spark, root, events):
    calls = [call(str(i), f"Call {i}", str(100 + i % 5)) for i in range(20)]
    tickets = [{"id": str(i), "properties": {"subject": f"T{i}", "createdate": "2024-01-01T00:00:00Z"}} for i in range(6)]
    stages = [history(str(i), "hs_pipeline_stage", ("2", "2024-01-03T00:00:00Z"), ("1", "2024-01-02T00:00:00Z")) for i in range(6)]
    lead = history("100", "lifecyclestage", ("lead", "2024-01-02T00:00:00Z"))
    run(spark, root, objects={"calls": raw(spark, *calls), "tickets": raw(spark, *tickets)},
        associations={("ticket", "contact"): pages(spark, *[batch(str(i), str(100 + i)) for i in range(6)])},
        history={"ticket": pages(spark, *stages), "contact": pages(spark, lead)})
    return run(
        spark, root, as_of="2024-01-20", events=events,
        objects={"calls": raw(spark, call("3", "Other title", "103"), call("4", "Call 4", "999"), call("50", "New", "100")),
                 "tickets": raw(spark, {"id": "5", "properties": {"subject": "T5 again"}})},
        associations={("contact", "ticket"): pages(spark, batch("777", "2"))},
        history={"ticket": pages(spark, history("1", "hs_pipeline_stage", ("3", "2024-01-05T00:00:00Z"))),
                 "contact": pages(spark, history("101", "lifecyclestage", ("customer", "2024-01-06T00:00:00Z")))})


def test_events_of_what_changed_equal_all_events(spark, tmp_path):
    table = "contact_activity_timelines"
    every, all_metrics = changing_runs(spark, str(tmp_path / "a"), LD.ALL_EVENTS)
    some, metrics = changing_runs(spark, str(tmp_path / "c"), LD.CHANGED_EVENTS)
    assert values(some.read(table), "etl_date") == values(every.read(table), "etl_date")
    assert metrics[table]["inserted"] == all_metrics[table]["inserted"] > 5
    # calls 3, 4 (two contacts) and 50, tickets 1, 2 and 5, one change of a contact
    assert metrics[table]["updated"] < 12 < all_metrics[table]["updated"]
    # the wide rows of the others are not made into events
    cut = LD.timeline_families(some)
    assert cut["activities"].count() == 4 and cut["lifecycle"].count() == 1


# ---- steps side by side


def test_all_tasks_end_before_an_error_is_raised(spark):
    import time

    ended = []

    def task(k):
        if k == 0:
            raise RuntimeError("first")
        time.sleep(0.2)
        ended.append(spark.range(k).count())
        return k

    with pytest.raises(RuntimeError):
        LD.side_by_side(spark, [lambda k=k: task(k) for k in range(4)], 2)
    assert sorted(ended) == [1, 2, 3]
    assert LD.side_by_side(spark, [lambda k=k: task(k) for k in (3, 1)], 4) == [3, 1]
