import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crmlake.model.tables import KEYS
from crmlake.operators import evolve as EV, merge as M, ordered as O, quality as Q

AS_OF = "2024-01-15"
SCHEMA = "source_id string, a string, b string, etl_date timestamp"
OLD = dt.datetime(2024, 1, 1)


def rows(df):
    return {r["source_id"]: tuple(r)[1:] for r in df.collect()}


def test_rules(spark):
    base = spark.createDataFrame([("1", "x", "y", OLD), ("2", "x", "y", OLD), ("3", None, None, OLD)], SCHEMA)
    new = spark.createDataFrame([("1", None, "n", None), ("3", " ", "n", None), ("4", " ", None, None)], SCHEMA)
    plain = M.merge_coalesce(base, new, ["source_id"], as_of=AS_OF)
    now = dt.datetime(2024, 1, 15)
    assert rows(plain) == {"1": ("x", "n", now, "updated"), "2": ("x", "y", OLD, "kept"),
                           "3": (" ", "n", now, "updated"), "4": (" ", None, now, "inserted")}
    other = M.merge_coalesce(base, new, ["source_id"], as_of=AS_OF, never=("b",), blank_is_null=("a",))
    assert rows(other)["1"][:2] == ("x", "y") and rows(other)["3"][:2] == (None, None)
    assert rows(other)["4"][:2] == (" ", None)
    replaced = M.merge_coalesce(base, new, ["source_id"], as_of=AS_OF, replace=("a",))
    assert rows(replaced)["1"][0] is None


def test_repeated_and_blank_keys(spark):
    base = spark.createDataFrame([("1", "x", "y", OLD), (None, "k", "k", OLD)], SCHEMA)
    new = spark.createDataFrame([("1", "late", None, 2), ("1", "early", "early", 1), (None, "p", "p", 1),
                                 (None, "p", "p", 1), (" ", "q", "q", 1)],
                                "source_id string, a string, b string, seq int")
    merged = M.merge_coalesce(base, new, ["source_id"], as_of=AS_OF, order_by="seq", blank_keys=True)
    counts = {(r["source_id"], r["action"]): r["count"]
              for r in merged.groupBy("source_id", "action").count().collect()}
    assert counts == {("1", "updated"): 1, (None, "kept"): 1, (None, "inserted"): 2, (" ", "inserted"): 1}
    assert merged.filter("source_id = '1'").first()["a"] == "late"


side = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from([None, "", "p"]),
                                                   st.sampled_from([None, "q", "r"])), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(base=side, new=side)
def test_laws(spark, base, new):
    def frame(d):
        return spark.createDataFrame([(str(k), *v, OLD) for k, v in d.items()], SCHEMA)

    once = M.merge_coalesce(frame(base), frame(new), ["source_id"], as_of=AS_OF).drop("action")
    twice = M.merge_coalesce(once, frame(new), ["source_id"], as_of=AS_OF).drop("action")
    assert rows(once) == rows(twice)
    expected = {}
    for k in base.keys() | new.keys():
        b, n = base.get(k, (None, None)), new.get(k, (None, None))
        expected[str(k)] = tuple(y if y is not None else x for x, y in zip(b, n))
    assert {k: v[:2] for k, v in rows(once).items()} == expected


def test_metrics_and_ids(spark):
    base = spark.createDataFrame([("1", "x", "y", OLD), ("2", "x", "y", OLD)], SCHEMA)
    new = spark.createDataFrame([("2", "n", None, None), ("3", "n", None, None)], SCHEMA)
    merged = M.merge_coalesce(base, new, ["source_id"], as_of=AS_OF)
    assert tuple(M.load_metrics(merged, "s", new.limit(1)).first()) == ("s", 3, 1, 1, 1, 1)
    ids = spark.createDataFrame([("7",), ("007",), ("a-1",)], "source_id string").select(
        M.surrogate_id(["source_id"]).alias("id")).collect()
    assert ids[0]["id"] == 7 and len({r["id"] for r in ids}) == 3 and ids[1]["id"] < 0


def test_every_table_merges_into_itself(spark):
    for table in KEYS:
        empty = M.empty_table(spark, table)
        assert M.upsert(table, empty, empty, AS_OF).columns == [*empty.columns, "action"]


def test_keep_and_first(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "b"), ("k", 3, "c"), ("m", 1, None)],
                               "k string, seq int, v string")
    assert {tuple(r) for r in O.keep_last(df, ["k"], "seq").collect()} == {("k", 3, "c"), ("m", 1, None)}
    assert {tuple(r) for r in O.keep_first(df, ["k"], "seq").collect()} == {("k", 1, "a"), ("m", 1, None)}
    assert O.exists(df, F.col("v") == "b") and not O.exists(df, F.col("v") == "z")
    assert O.first_match(df, F.col("v") == "z").count() == 0
    assert [r[0] for r in O.sample_ids(df, 2, "v").collect()] == [None, "a"]


def test_quality(spark):
    df = spark.createDataFrame([("1", "long one"), ("1", None), (None, "x")], "source_id string, v string")
    assert [tuple(r) for r in Q.check_unique(df, ["source_id"], F.col("source_id").isNotNull()).collect()] == [("1", 2)]
    assert {tuple(r) for r in Q.check_required(df, ["v"]).collect()} == {("1", "v")}
    assert {tuple(r) for r in Q.check_lengths(df, {"v": 3}).collect()} == {("1", "v")}
    parent = spark.createDataFrame([("x",)], "id string")
    assert [r["v"] for r in Q.check_references(df, "v", parent, "id").collect()] == ["long one"]
    contacts = M.to_table(spark.createDataFrame([("1", "e" * 300)], "source_id string, email string"), "contacts")
    assert {tuple(r) for r in Q.check_table(contacts, "contacts").collect()} == {
        ("required", "1", "etl_date"), ("length", "1", "email")}


def test_schema_changes(spark):
    df = spark.createDataFrame([(1, "o", "n")], "id int, old string, new string")
    assert tuple(EV.swap_columns(df, "old", "new").first()) == (1, "n", "o")
    assert EV.swap_columns(EV.swap_columns(df, "old", "new"), "old", "new").collect() == df.collect()
    assert EV.add_column_if_missing(df, "old", "int").columns == df.columns
