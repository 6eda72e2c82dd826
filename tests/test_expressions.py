from pyspark.sql import functions as F

from crmlake.functions import status as S, text as TX, values as V
from crmlake.model import tables as MT
from crmlake.model.objects import PROPERTIES, read_properties


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


def test_strip_html(spark):
    cases = {"a<br>b<BR/>c<br />d": "a\nb\nc\nd", " <p\nclass='x'>hi</p>\n": "hi", "  ": "  ",
             "": "", "a < b": "a < b", " <b>x</b> ": "x", None: None}
    for given, expected in cases.items():
        assert one(spark, given, TX.strip_html) == expected


def test_full_name(spark):
    rows = [("Ada", "B", "Ada B"), ("Ada", None, "Ada"), ("", "B", "B"), ("", None, None),
            (None, None, None), (" ", "", "")]
    df = spark.createDataFrame([r[:2] for r in rows], "f string, l string")
    got = [r["n"] for r in df.select(TX.full_name("f", "l").alias("n")).collect()]
    assert got == [r[2] for r in rows]


def test_blank_primary_singular(spark):
    assert one(spark, "\n\t", TX.not_blank) is False
    assert one(spark, " ", TX.not_blank) is False
    assert one(spark, None, TX.not_blank) is False
    assert one(spark, "x", TX.not_blank) is True
    assert one(spark, "My PRIMARY", TX.is_primary) is True
    assert one(spark, None, TX.is_primary) is False
    for given, expected in {"companies": "company", "Contacts": "contact", "sms": "sms",
                            "company": "company", "widgets": "widget", "line_item": "line_item"}.items():
        assert one(spark, given, TX.singular) == expected


def test_labels_json(spark):
    df = spark.createDataFrame([(["A", "b", "a", "B", "c"], "A"), ([], None), (["x"], " ")],
                               "labels array<string>, p string")
    got = [r["j"] for r in df.select(TX.labels_json(F.col("labels"), "p").alias("j")).collect()]
    assert got == ['["A","b","c"]', None, '["x"]']


def test_values(spark):
    assert one(spark, " 5 ", V.to_whole) == 5
    assert one(spark, "5.0", V.to_whole) is None
    assert one(spark, "99999999999", V.to_whole) is None
    assert str(one(spark, "1,234.555", V.to_money)) == "1234.56"
    assert one(spark, "abc", V.to_money) is None
    assert one(spark, "later", V.to_stamp) is None
    assert one(spark, "2024-01-01T00:00:00+02:00", lambda c: V.to_stamp(c).cast("string")) == \
        "2023-12-31 22:00:00"


def task(spark, status=None, done=None, overdue=None, due=None, start=None, at=None):
    df = spark.createDataFrame([(status, done, overdue, due, start, at)],
                               "s string, d string, o string, u string, b string, a string")
    stamp = [F.col(c).cast("timestamp") for c in ("d", "u", "b", "a")]
    return df.select(S.task_status(F.col("s"), stamp[0], F.col("o"), stamp[1], stamp[2], stamp[3],
                                   "2024-01-15").alias("x")).first()["x"]


def test_task_status(spark):
    past, future, soon = "2024-01-10", "2024-02-10", "2024-01-15 20:00:00"
    assert task(spark, done=past, due=past) == "completed"
    for word in ("Complete", "COMPLETED", "end"):
        assert task(spark, word, due=past) == "completed"
    assert task(spark, overdue="TRUE", due=future) == "overdue"
    assert task(spark, overdue="1", due=future) == "overdue"
    assert task(spark, overdue="no", due=past) == "overdue"
    assert task(spark, due=soon) == "due"
    assert task(spark, due="2024-01-15") == "due"
    assert task(spark, due="2024-01-16") == "due"
    assert task(spark, due=future) == "upcoming"
    assert task(spark, overdue="true") == "due"
    assert task(spark, start=future) == "upcoming"
    for word in ("WAITING", "not_started", "Deferred"):
        assert task(spark, word, at=future) == "upcoming"
        assert task(spark, word, at=past) == "due"
        assert task(spark, word) == "due"
    assert task(spark, "IN_PROGRESS", at=future) == "due"
    assert task(spark, "odd", at=past) == "completed"
    assert task(spark, at=future) == "upcoming"
    assert task(spark) == "due"


def test_other_statuses(spark):
    def at(day):
        return F.lit(day).cast("timestamp")

    def value(c):
        return spark.range(1).select(c.alias("x")).first()["x"]

    now, past, future, none = "2024-01-15", at("2024-01-01"), at("2024-02-01"), at(None)
    assert value(S.meeting_status(future, past, now)) == "upcoming"
    assert value(S.meeting_status(past, future, now)) == "completed"
    assert value(S.meeting_status(none, future, now)) == "upcoming"
    assert value(S.meeting_status(none, none, now)) == "completed"
    assert value(S.call_status(F.lit("scheduled"), future, now)) == "upcoming"
    assert value(S.call_status(F.lit("SCHEDULED"), none, now)) == "due"
    assert value(S.call_status(F.lit("BUSY"), future, now)) == "completed"
    assert value(S.call_status(F.lit(" "), future, now)) == "upcoming"
    assert value(S.call_status(F.lit(None).cast("string"), none, now)) == "completed"
    assert value(S.other_status(F.lit("NOTE"), future, now)) == "completed"
    assert value(S.other_status(F.lit("FAX"), future, now)) == "upcoming"


def test_tables_and_properties():
    assert len(MT.TABLES) == 20  # nineteen and the rejected rows
    assert MT.schema("deals")["amount"].dataType.simpleString() == "decimal(18,2)"
    assert MT.lengths("tickets")["ticket_name"] == 500
    assert "email_body" not in MT.lengths("emails")
    assert MT.required("activity_calls") == ["id", "activity_id", "raw_properties_json", "etl_date"]
    for table, keys in MT.KEYS.items():
        assert set(keys) <= set(MT.columns(table))
    for object_type, names in PROPERTIES.items():
        assert set(read_properties(object_type)) <= set(names)
    assert len(PROPERTIES) == 11


def test_labels_of_an_expression_are_read_once(spark):
    from crmlake.functions.associations import all_labels, primary_label

    df = spark.range(1).select(F.from_json(
        F.lit('[{"label": " "}, {"label": "b"}, {"label": "B"}, {"label": "c"}, {"label": 5}]'),
        "array<struct<label:variant>>").alias("types"))
    made = df.select(TX.labels_json(all_labels(F.col("types")), primary_label(F.col("types"))).alias("j"))
    assert made.first()["j"] == '["b","c"]'
    # once for the list and once for its first label, not again for every label that is compared
    rows = spark.range(2).select(F.from_json(F.concat(F.lit("["), F.lit("]")), "array<struct<label:variant>>").alias("types"), "id")
    plan = rows.select(TX.labels_json(all_labels(F.col("types")), primary_label(F.col("types"))).alias("j"))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.count("schema_of_variant(") == 2
