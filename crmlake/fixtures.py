"""The driver tables shaped as landed CRM payloads.

Everything is made by Spark from the whole tables, one payload per row and without grouping rows
to lists, so the queries built on it grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-01-15 00:00:00"
BEFORE = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its zoneless timestamps become timestamps once, here."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[
        F.col(n).cast("timestamp").alias(n) if t.startswith("timestamp") else F.col(n)
        for n, t in df.dtypes])


def iso(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_object(df: DataFrame, object_id: Column, properties: dict[str, Column],
               associations: dict[str, Column] | None = None, seq: Column | None = None) -> DataFrame:
    """One JSON object per row: raw, seq."""
    parts = [object_id.alias("id"),
             F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties")]
    if associations:
        parts.append(F.struct(*[
            F.when(c.isNotNull(), F.struct(c.alias("results"))).alias(n)
            for n, c in associations.items()]).alias("associations"))
    return df.select(F.to_json(F.struct(*parts)).alias("raw"),
                     (object_id if seq is None else seq).cast("string").alias("seq"))


def _one(object_id: Column, **more: Column) -> Column:
    return F.array(F.struct(object_id.alias("id"), *[c.alias(n) for n, c in more.items()]))


def contact_properties() -> dict[str, Column]:
    balance = F.col("c_acctbal")
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey"))
    return {
        "firstname": F.col("c_name"),
        "lastname": F.when(balance >= 1000, F.col("c_mktsegment")),
        "email": F.when(balance >= 0, F.concat(
            F.lower("c_mktsegment"), F.lit("."), text("c_nationkey"), F.lit("@example.com"))),
        "phone": F.concat(F.lit("+45 "), text("c_custkey")),
        "hubspot_owner_id": text("c_nationkey"),
        "notes_last_activity_date": F.when(balance < 5000, F.lit("no date")).otherwise(
            F.concat(text(day), F.lit("T10:00:00Z"))),
        "notes_last_updated": F.concat(text(day), F.lit("T12:30:00Z")),
        "hs_lead_status": F.when(balance > 3000, F.lit("OPEN")),
        "lifecyclestage": F.col("c_mktsegment"),
        "zip": text("c_nationkey"),
        "contact-type": F.lower("c_mktsegment"),
        "createdate": F.concat(text(day), F.lit("T00:00:00Z")),
        "unread_property": F.lit("unread"),
    }


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return raw_object(c, F.col("c_custkey"), contact_properties(),
                      {"companies": _one(F.col("c_nationkey"), type=F.lit("contact_to_company"))})


def unclean_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of which some have a number as phone, some no id and some no properties."""
    c = table(spark, sf_dir, "customer")
    good = contact_properties()
    number = good | {"phone": F.col("c_custkey")}

    def raw(properties: dict[str, Column] | None, with_id: bool = True) -> Column:
        parts = [text("c_custkey").alias("id")] if with_id else []
        if properties is not None:
            parts.append(F.struct(*[v.alias(k) for k, v in properties.items()]).alias("properties"))
        return F.to_json(F.struct(*parts))

    balance = F.col("c_acctbal")
    return c.select(
        F.when(balance < 1000, raw(number)).when(balance > 9000, raw(good, with_id=False))
        .when(balance > 8000, raw(None)).otherwise(raw(good)).alias("raw"),
        text("c_custkey").alias("seq"))


def own_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts each with an e-mail address of its own."""
    own = contact_properties() | {"email": F.concat(text("c_custkey"), F.lit("@example.com"))}
    return raw_object(table(spark, sf_dir, "customer"), F.col("c_custkey"), own)


def rule_breaking_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts by the last digit of their number: 1 have a name that is too long, 2 an address that the next
    contact has, 3 are new contacts of one address, 4 a name too long and that address; the others are as before."""
    c = table(spark, sf_dir, "customer")
    digit, number = F.col("c_custkey") % 10, F.col("c_custkey")
    shared = F.lit("shared@example.com")
    own = contact_properties() | {
        "firstname": F.when(digit.isin(1, 4), F.repeat(F.col("c_name"), F.lit(20))).otherwise(F.col("c_name")),
        "email": F.when(digit == 2, F.concat(text(number + 1), F.lit("@example.com"))).when(digit.isin(3, 4), shared)
        .otherwise(F.concat(text("c_custkey"), F.lit("@example.com")))}
    return raw_object(c, F.when(digit == 3, F.concat(F.lit("new-"), F.lpad(text(number), 12, "0"))).otherwise(text(number)), own)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    balance = F.col("s_acctbal")
    return raw_object(s, text("s_suppkey"), {
        "name": F.col("s_name"), "hubspot_owner_id": text("s_nationkey"),
        "phone": F.concat(F.lit("+46 "), text("s_suppkey")), "city": F.lit("City"),
        "cvr": F.when(balance >= 3000, F.concat(F.lit("A"), text("s_suppkey"))),
        "company_registration_number": F.concat(F.lit("B"), text("s_suppkey")),
        "zip": F.when(balance >= 6000, text("s_nationkey")),
        "postal_code": F.when(balance >= 1000, F.concat(F.lit("P"), text("s_nationkey"))),
        "type": F.when(balance >= 8000, F.lit("first")),
        "company_type": F.when(balance >= 5000, F.lit("second")),
        "hs_company_type": F.when(balance >= 2000, F.lit("third")),
        "hs_object_id": F.when(balance >= 0, F.concat(F.lit("R"), text("s_suppkey"))),
        "createdate": F.lit("2022-05-05T00:00:00Z"),
    })


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deals; a deal closes with its last shipment."""
    orders = table(spark, sf_dir, "orders")
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("closed"))
    o = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return raw_object(o, F.col("o_orderkey"), deal_properties(F.col("closed")))


def deal_properties(closed: Column) -> dict[str, Column]:
    return {
        "dealname": F.concat(F.lit("Order "), text("o_orderkey")),
        "dealstage": F.col("o_orderstatus"), "pipeline": F.col("o_orderpriority"),
        "closedate": iso(closed), "hubspot_owner_id": text("o_custkey"),
        "amount": F.format_string("%.2f", F.col("o_totalprice")),
        "dealtype": F.when(F.col("o_orderstatus") != "P", F.lit("newbusiness")),
        "createdate": iso("o_orderdate"),
    }


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return raw_object(p, F.col("p_partkey"), {
        "subject": F.when(size >= 5, F.col("p_name")),
        "hs_ticket_subject": F.when(size >= 3, F.col("p_brand")),
        "hs_pipeline": text(F.floor(size / 10)),
        "hs_pipeline_stage": F.when(size < 45, text("p_size")),
        "hs_ticket_status": F.lit("unstaged"),
        "hs_ticket_priority": F.when(size > 25, F.lit("HIGH")),
        "hubspot_owner_id": text("p_size"),
        "source_type": F.when(size > 40, F.lit("CHAT")),
        "created_by_source": F.when(size > 20, F.lit("FORM")),
        "hs_ticket_source": F.when(size > 10, F.lit("PHONE")),
        "createdate": F.when(size > 2, F.lit("2024-01-02T08:00:00Z")),
    })


def communications(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return raw_object(
        c, F.concat_ws("-", text("conv_id"), text("turn")), {
            "hs_communication_channel_type": F.when(F.col("role") != "system", F.col("role")),
            "hs_channel_type": F.lit("other"),
            "hs_communication_body": F.concat(F.lit("<p>"), F.col("text"), F.lit("<br/>end</p> ")),
            "hubspot_owner_id": text("turn"), "hs_createdate": F.lit("2024-01-03T00:00:00Z")},
        {"contacts": _one(F.col("conv_id"))})


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return raw_object(
        p, F.col("page_id"), {
            "hs_email_subject": F.col("url"), "hs_email_html": F.col("html"),
            "hs_email_text": F.lit("plain"), "hs_email_status": F.lit("SENT"),
            "hubspot_owner_id": text("page_id"), "hs_timestamp": F.lit("2024-01-04T00:00:00Z")},
        {"contacts": _one(F.col("page_id"))})


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return raw_object(d, F.col("doc_id"), {
        "hs_note_body": F.concat(F.lit("<div>"), F.col("text"), F.lit("</div>")),
        "hubspot_owner_id": F.col("lang"), "hs_timestamp": F.lit("2024-01-05T00:00:00Z")})


# event_type of the events table to activity type
ACTIVITY_OF = {"view": "CALL", "click": "EMAIL", "purchase": "MEETING", "signup": "TASK",
               "error": "NOTE"}


_NAME = "CASE WHEN value >= 10 THEN concat('{0} ', event_id) END"
_BODY = "concat('<p>k ', k, '<br/>done</p>')"


def _later(days: int) -> str:
    return f"date_format(ts + interval {days} day, {_ISO})"


_ISO = "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\""
_COMMON = {"hubspot_owner_id": "string(k)", "hs_timestamp": f"date_format(ts, {_ISO})",
           "hs_createdate": f"date_format(ts, {_ISO})"}

# What the properties of each activity type are made of.
ACTIVITY_PROPERTIES: dict[str, dict[str, str]] = {
    "CALL": {
        "hs_call_title": _NAME.format("Call"), "hs_call_body": _BODY,
        "hs_call_direction": "CASE WHEN value < 100 THEN 'INBOUND' ELSE 'OUTBOUND' END",
        "hs_call_status": "CASE WHEN value < 20 THEN 'SCHEDULED' WHEN value < 200 THEN 'COMPLETED' END"},
    "EMAIL": {
        "hs_email_subject": _NAME.format("Email"), "hs_email_html": _BODY,
        "hs_email_direction": "CASE WHEN k < 30 THEN 'Incoming' WHEN k < 90 THEN 'SENT' END",
        "hs_email_status": "CASE WHEN k < 95 THEN 'SENT' END",
        "hs_num_email_opens": "CASE WHEN k < 50 THEN string(k) WHEN k < 60 THEN 'n/a' END",
        "hs_email_open_rate": "CASE WHEN value > 50 THEN '0.5' END",
        "hs_num_email_clicks": "string(k div 10)",
        "hs_email_click_rate": "CASE WHEN value > 80 THEN '0.1' END"},
    "MEETING": {
        "hs_meeting_title": _NAME.format("Meeting"), "hs_meeting_body": _BODY,
        "hs_meeting_start_time": f"CASE WHEN value >= 100 THEN {_later(1)} END",
        "hs_meeting_end_time": f"CASE WHEN value >= 200 THEN {_later(2)} END",
        "hs_meeting_location": "CASE WHEN k < 50 THEN concat('Room ', k) END"},
    "TASK": {
        "hs_task_subject": _NAME.format("Task"), "hs_task_body": _BODY,
        "hs_task_status": """CASE WHEN k < 10 THEN 'COMPLETED' WHEN k < 30 THEN 'WAITING'
            WHEN k < 40 THEN 'in_progress' END""",
        "hs_task_completion_timestamp": f"CASE WHEN k >= 90 THEN {_later(0)} END",
        "hs_task_is_overdue": "CASE WHEN k BETWEEN 40 AND 50 THEN 'True' END",
        "hs_task_due_date": f"CASE WHEN k BETWEEN 45 AND 80 THEN {_later(2)} END",
        "hs_task_start_date": f"CASE WHEN k > 80 THEN {_later(3)} END",
        "hs_task_priority": "CASE WHEN value > 30 THEN 'HIGH' END",
        "hs_task_type": "CASE WHEN value > 60 THEN 'TODO' END"},
    "NOTE": {"hs_note_body": f"concat({_BODY}, repeat('word ', k))"},
}


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))


def activities(spark: SparkSession, sf_dir: str, activity_type: str) -> DataFrame:
    """Events of one kind as activities; SMS are made of the conversations."""
    if activity_type == "SMS":
        return sms(spark, sf_dir)
    kind = next(e for e, a in ACTIVITY_OF.items() if a == activity_type)
    rows = event_rows(spark, sf_dir).filter(F.col("event_type") == kind)
    made = _COMMON | ACTIVITY_PROPERTIES[activity_type]
    return raw_object(rows, F.col("event_id"), {n: F.expr(e) for n, e in made.items()},
                      event_associations())


def event_associations() -> dict[str, Column]:
    return {
        "companies": F.expr("CASE WHEN k >= 90 THEN "
                            "array(named_struct('id', k, 'type', 'to_company')) END"),
        "deals": F.expr("""CASE WHEN k < 20 THEN array(named_struct('id', event_id,
            'associationTypes', array(
              named_struct('label', '', 'associationTypeId', 5, 'category', 'SYSTEM'),
              named_struct('label', CASE WHEN k < 10 THEN 'Main deal' END,
                           'associationTypeId', 7, 'category', 'USER'),
              named_struct('label', 'Later', 'associationTypeId', 9,
                           'category', CAST(NULL AS STRING))))) END"""),
        "contacts": F.expr("CASE WHEN k < 80 THEN "
                           "array(named_struct('id', user_id, 'type', 'to_contact')) END"),
    }


def sms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return raw_object(
        c, F.concat_ws("-", text("conv_id"), text("turn")), {
            "hs_sms_title": F.when(F.col("turn") > 0, F.concat(F.lit("Turn "), text("turn"))),
            "hs_sms_text": F.col("text"),
            "hs_sms_direction": F.when(F.col("role") == "user", F.lit("")).otherwise("OUT"),
            "hs_sms_message_direction": F.lit("IN"),
            "hs_sms_message_body": F.when(F.col("role") == "system", F.col("text")),
            "hs_activity_assigned_to": text("turn"), "hubspot_owner_id": text("turn"),
            "hs_timestamp": F.lit("2024-01-06T00:00:00Z")},
        {"contacts": _one(F.col("conv_id"))})


def owner_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as owners, each landed twice: the second name is the valid one."""
    n = table(spark, sf_dir, "nation")

    def page(at: int, first: Column, last: Column, email: Column) -> DataFrame:
        owner = F.struct(text("n_nationkey").alias("id"), first.alias("firstName"),
                         last.alias("lastName"), email.alias("email"))
        return n.select(F.to_json(F.struct(F.array(owner).alias("results"))).alias("page"),
                        F.lit("owners").alias("file"), F.lit(at).cast("bigint").alias("at"))

    none = F.lit(None).cast("string")
    key = F.col("n_nationkey")
    return page(0, F.lit("Old"), F.col("n_name"), none).unionByName(page(
        1, F.when(key >= 10, F.lit("Owner")), F.when(key >= 10, F.col("n_name")),
        F.when(key >= 5, F.concat(F.lower("n_name"), F.lit("@example.com")))))


def owner_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual names for ids no owner list has, and one for an id it has."""
    r = table(spark, sf_dir, "region")
    return r.select(text(F.col("r_regionkey") + 23).alias("key"),
                    F.concat(F.lit("Manual "), F.col("r_name")).alias("name"))


def _option_page(rows: DataFrame, value: Column, label: Column) -> DataFrame:
    option = F.struct(value.alias("value"), label.alias("label"))
    return rows.select(F.to_json(F.struct(F.array(option).alias("options"))).alias("page"))


def pipeline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return _option_page(r, text(F.col("r_regionkey") + 1),
                        F.when(F.col("r_regionkey") > 0, F.col("r_name")))


def stage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return _option_page(n, text(F.col("n_nationkey") + 10), F.col("n_name"))


def stage_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides of stage ids, and of one label."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(F.when(key < 9, text(key + 1)).otherwise(F.lower("n_name")).alias("key"),
                    F.concat(F.lit("Stage "), F.col("n_name")).alias("name"))


def contact_company_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the suppliers they bought from, and what the flags of the lines say."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("o_custkey", "l_suppkey")
            .agg(F.max("l_returnflag").alias("flag"), F.min("l_linestatus").alias("state"),
                 F.max("l_linenumber").alias("line"), F.max("l_shipdate").alias("shipped")))


def edge_pages(pairs: DataFrame, source: Column, target: Column) -> DataFrame:
    """Pairs (with flag, state, line, shipped) as association batches, one pair per payload."""
    flag = F.col("flag")

    def kind(label: Column, category: str, **number: Column) -> Column:
        return F.struct(label.alias("label"), F.lit(category).alias("category"),
                        number.get("associationTypeId", F.lit(None).cast("int"))
                        .alias("associationTypeId"),
                        number.get("typeId", F.lit(None).cast("int")).alias("typeId"))

    none = F.lit(None).cast("string")
    kinds = F.array(
        kind(none, "SYSTEM", typeId=F.lit(1)),
        kind(F.when(flag == "A", F.lit("Primary")).when(flag == "R", F.lit("Returning")), "USER",
             associationTypeId=F.col("line")),
        kind(F.when(F.col("state") == "F", F.lit("primary")), "USER"))
    to = F.struct(target.alias("toObjectId"), kinds.alias("associationTypes"),
                  F.when(F.col("state") == "F", F.lit("API")).alias("source"),
                  F.when(flag == "R", iso("shipped")).alias("createdAt"))
    result = F.struct(F.struct(source.alias("id")).alias("from"), F.array(to).alias("to"),
                      F.lit("2024-01-01T00:00:00Z").alias("createdAt"))
    return pairs.select(F.to_json(F.struct(F.array(result).alias("results"))).alias("page"))


def contact_company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_pages(contact_company_pairs(spark, sf_dir), F.col("o_custkey"), F.col("l_suppkey"))


def reverse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as companies with two contacts each, after an older list with another contact."""
    o = table(spark, sf_dir, "orders")

    def page(at: int, *ids: Column) -> DataFrame:
        result = F.struct(F.struct(F.col("o_orderkey").alias("id")).alias("from"),
                          F.array(*[F.struct(i.alias("id")) for i in ids]).alias("to"))
        return o.select(F.to_json(F.struct(F.array(result).alias("results"))).alias("page"),
                        F.lit("reverse").alias("file"), F.lit(at).cast("bigint").alias("at"))

    key = F.col("o_custkey")
    return page(0, key + 2).unionByName(page(1, key, key + 1))


def deal_ticket_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as deal to ticket edges, repeats and all."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"), F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("shipped"))
    return edge_pages(lines, F.col("l_orderkey"), F.col("l_partkey"))


def contact_ticket_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the parts they bought as contact to ticket edges."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    pairs = (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
             .groupBy("o_custkey", "l_partkey")
             .agg(F.max("l_returnflag").alias("flag"), F.min("l_linestatus").alias("state"),
                  F.max("l_linenumber").alias("line"), F.max("l_shipdate").alias("shipped")))
    return edge_pages(pairs, F.col("o_custkey"), F.col("l_partkey"))


def _history_page(object_id: Column, name: str, *items: Column) -> Column:
    return F.to_json(F.struct(
        object_id.alias("id"),
        F.struct(F.array(*items).alias(name)).alias("propertiesWithHistory")))


def _item(value: Column, at: Column, source: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(value.alias("value"), at.alias("timestamp"),
                    (none if source is None else source).alias("source"),
                    none.alias("sourceId"))


def deal_history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deal stage history, newest first, with an empty and an undated item."""
    o = table(spark, sf_dir, "orders")
    day = F.expr("interval 1 day")
    return o.select(_history_page(
        F.col("o_orderkey"), "dealstage",
        _item(F.col("o_orderstatus"), iso(F.col("o_orderdate") + day), F.lit("CRM_UI")),
        _item(F.lit(""), iso("o_orderdate")),
        _item(F.lit("lost"), F.lit("no date")),
        _item(F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")), iso("o_orderdate")),
        _item(F.lit("new"), iso(F.col("o_orderdate") - day), F.lit("API"))).alias("page"))


def ticket_history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(_history_page(
        F.col("p_partkey"), "hs_pipeline_stage",
        _item(text("p_size"), F.lit("2024-01-03T00:00:00Z"), F.lit("CRM_UI")),
        _item(F.col("p_brand"), F.lit("2024-01-02T00:00:00Z"))).alias("page"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order states as changes of a contact's lead status, one per row."""
    return table(spark, sf_dir, "orders").select(
        F.lit("contact").alias("object_type"), text("o_custkey").alias("object_id"),
        F.lit("hs_lead_status").alias("property_name"), F.col("o_orderstatus").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("change_date"), F.lit("orders").alias("source"))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a contact's lifecycle stage, one per row."""
    return table(spark, sf_dir, "events").select(
        F.lit("contact").alias("object_type"), text("user_id").alias("object_id"),
        F.lit("lifecyclestage").alias("property_name"), F.col("event_type").alias("value"),
        F.col("ts").alias("change_date"), F.get_json_object("props", "$.k").alias("source"))
