"""Landed JSON: pages of objects, association batches, lookup lists and history payloads.

Every reader comes in two parts: ``read_*`` scans files, the function it calls works on a
DataFrame with one payload per row. ``seq`` orders repeated ids (the later one wins). It is built
from the file and the place inside the scan, so a task that is run again yields the same value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmlake.functions.associations import EMBEDDED, TYPE_ITEMS, target_id
from crmlake.functions.text import not_blank
from crmlake.functions.values import as_text, object_id, whole_number
from crmlake.model.objects import PROPERTIES, read_properties

_SEQ = "struct<file:string,at:bigint,item:int>"


def scan_payloads(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed payloads, one per line (splittable) or one per file, with their place."""
    return spark.read.text(path, wholetext=one_per_file).select(
        F.col("value").alias("page"),
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("at"))


def _placed(df: DataFrame) -> DataFrame:
    for name, kind in (("file", "string"), ("at", "bigint")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def page_objects(pages: DataFrame) -> DataFrame:
    """Pages (column ``page``) to single objects: raw, seq. A page without results is empty."""
    results = F.from_json("page", "struct<results:array<string>>").getField("results")
    return (_placed(pages).select("file", "at", F.posexplode(results).alias("item", "raw"))
            .select("raw", F.struct("file", "at", "item").cast(_SEQ).alias("seq")))


# Object types whose embedded associations no operator reads.
_UNLINKED = ("companies", "deals", "tickets")


# A JSON value that is neither a string nor null looks like this. Text inside a string can look like
# it too, so a match only says that the types have to be looked at.
_OTHER_VALUE = r'"\s*:\s*[^"n\s]'


def _fields(object_type: str, kind: str) -> str:
    return "struct<" + ",".join(f"`{n}`:{kind}" for n in read_properties(object_type)) + ">"


def parse_objects(objects: DataFrame, object_type: str) -> DataFrame:
    """Raw objects to raw, seq, id, properties, misfits, properties_json, associations.

    Only the properties some operator reads are parsed, as strings. A number where a string belongs
    must be noticed: ``misfits`` names the properties that hold something else. Types are looked at
    only in rows whose text shows such a value, which hardly any row does. ``associations`` is there
    for the object types that use them.
    """
    linked = "" if object_type in _UNLINKED else f",associations:{EMBEDDED}"
    parsed = objects.select("*", F.from_json(
        "raw", f"struct<id:variant,properties:string{linked}>").alias("_o"))
    text = F.col("_o.properties")
    typed = parsed.select(
        *objects.columns, "_o", text.startswith("{").alias("_given"),
        F.from_json(text, _fields(object_type, "string")).alias("_texts"))
    kinds = ", ".join(f"CASE WHEN schema_of_variant(v.`{n}`) NOT IN ('STRING', 'VOID') THEN '{n}' END"
                      for n in read_properties(object_type))
    looked_at = F.expr(f"flatten(transform(array(from_json(_o.properties, "
                       f"'{_fields(object_type, 'variant')}')), v -> array_compact(array({kinds}))))")
    row = [object_id(F.col("_o.id")).alias("id"),
           F.when(F.col("_given"), F.col("_texts")).alias("properties"),
           F.when(text.rlike(_OTHER_VALUE), looked_at).otherwise(
               F.array().cast("array<string>")).alias("misfits"),
           text.alias("properties_json")]
    if object_type not in _UNLINKED:
        row.append(F.col("_o.associations").alias("associations"))
    # A filter on parsed values would be pushed below a plain projection and the JSON parsed once
    # more for it. Nothing is pushed through a generator, so each payload is parsed one time.
    rows = typed.select(*objects.columns, F.struct(*row).alias("_row"))
    return rows.select(*objects.columns, F.inline(F.array("_row")))


def read_objects(spark: SparkSession, path: str, object_type: str,
                 one_per_file: bool = False) -> DataFrame:
    """All objects of one type from landed pages."""
    return parse_objects(page_objects(scan_payloads(spark, path, one_per_file)), object_type)


def select_properties(objects: DataFrame, object_type: str) -> DataFrame:
    """Raw objects with only the requested properties left in their ``properties``."""
    wanted = PROPERTIES[object_type]
    whole = F.from_json("raw", "struct<id:string,properties:map<string,string>>")
    return objects.withColumn("_o", whole).select(
        F.col("_o.id").alias("id"),
        F.map_filter("_o.properties", lambda k, _: k.isin(*wanted)).alias("properties"))


def raw_properties(raw: Column | str = "raw") -> Column:
    """The properties as they came, as text; ``{}`` where there are none."""
    text = F.get_json_object(F.col(raw) if isinstance(raw, str) else raw, "$.properties")
    return F.when(not_blank(text), text).otherwise("{}")


def owner_rows(pages: DataFrame) -> DataFrame:
    """Owner list pages to rows: id, name, seq. The name is "first last", else email, else id."""
    entry = "struct<results:array<struct<id:variant,firstName:string,lastName:string,email:string>>>"
    rows = _placed(pages).select("file", "at", F.posexplode(
        F.from_json("page", entry).getField("results")).alias("item", "o"))
    name = F.trim(F.concat_ws(" ", "o.firstName", "o.lastName"))
    return rows.select(
        object_id(F.col("o.id")).alias("id"),
        F.when(not_blank(name), name).otherwise(
            F.coalesce("o.email", object_id(F.col("o.id")))).alias("name"),
        F.struct("file", "at", "item").cast(_SEQ).alias("seq"))


def option_rows(pages: DataFrame) -> DataFrame:
    """Property-option payloads to rows: id, name, seq. The label defaults to the value."""
    entry = "struct<options:array<struct<value:string,label:string>>>"
    rows = _placed(pages).select("file", "at", F.posexplode(
        F.from_json("page", entry).getField("options")).alias("item", "o"))
    return rows.select(
        F.col("o.value").alias("id"), F.coalesce("o.label", "o.value").alias("name"),
        F.struct("file", "at", "item").cast(_SEQ).alias("seq"))


ASSOCIATION_BATCH = (
    "struct<results:array<struct<`from`:struct<id:variant>,createdAt:string,updatedAt:string,"
    f"`to`:array<struct<toObjectId:variant,id:variant,associationTypes:{TYPE_ITEMS},"
    f"types:{TYPE_ITEMS},source:string,sourceId:string,createdAt:string,updatedAt:string>>>>>")

# Reverse payloads also give bare ids, so both ends stay variants.
REVERSE_BATCH = ("struct<results:array<struct<`from`:variant,id:variant,`to`:array<variant>>>>")


def association_items(pages: DataFrame) -> DataFrame:
    """Association batches to one row per (from, to): from_id, to, created, updated, seq."""
    return _items(_placed(pages).select("file", "at", F.posexplode(
        F.from_json("page", ASSOCIATION_BATCH).getField("results")).alias("item", "r")), "created", "updated")


_UNFIT = "_unfit"
_PLAIN_TYPES = "array<struct<label:string,associationTypeId:bigint,typeId:bigint,category:string>>"
# once types are plain, the ids are all that is left of variants
_PLAIN_BATCH = ASSOCIATION_BATCH.replace(TYPE_ITEMS, _PLAIN_TYPES).replace("variant", "string")[:-1] + f",{_UNFIT}:string>"
_ENDS = "struct<results:array<struct<`from`:struct<id:variant>,`to`:array<struct<toObjectId:variant,id:variant>>>>>"
_PLAIN_ENDS = _ENDS.replace("variant", "string")

# A label or category that is neither a string nor null looks like this. Text inside a string can look like
# it too, so a match only says that the kinds have to be looked at. Each pattern starts with a word, which
# is searched far quicker than a choice of words.
_OTHER_TEXTS = (r"""label["']\s*+:\s*+[^"'n\s]""", r"""category["']\s*+:\s*+[^"'n\s]""")

# The same for an id that is neither a string nor a whole number as it is written when it is made a text.
_NO_PLAIN_ID = r"""["']\s*+:\s*+(?!["']|(?:0|-?[1-9]\d{0,17})\s*+[,}])"""
_OTHER_IDS = ("toObjectId" + _NO_PLAIN_ID, "id" + _NO_PLAIN_ID)


# Texts that leave no doubt: an id that reads the same whether it came as a string or as a whole number, and a label
# or category that can only have come as a string. The batch is searched for other kinds where a text leaves doubt.
_SURE_ID = r"^(?:0|-?[1-9]\d{0,17})$"
_UNSURE_TEXT = r"""^(?:["'{\[+\-0-9NI]|true$|false$)"""


def _shows(*patterns: str) -> Column:
    """Whether a batch has to be read by kind; names can be written with escapes, which no pattern would find."""
    return reduce(lambda a, b: a | b, [F.col("page").rlike(p) for p in patterns], F.col("page").contains("\\u"))


def _unsure_id(c: Column) -> Column:
    return ~F.coalesce(c.rlike(_SURE_ID), F.lit(False))


def _any(values: Column, unsure: Callable[[Column], Column], absent: bool) -> Column:
    """Whether any value is unsure; ``absent`` where there is no list."""
    return F.coalesce(F.exists(values, unsure), F.lit(absent))


def _unsure_ends(results: Column) -> Column:
    """Whether an end of a batch read as texts may have come as another kind of value, or is not there."""
    return _any(results, lambda r: _unsure_id(r["from"]["id"]) | _any(
        r["to"], lambda to: _unsure_id(to["toObjectId"]), True), True)


def _ends_by_kind(r: Column, far_end: Callable[[Column], list[Column]] = lambda to: []) -> list[Column]:
    """The ends of a result read as variants, as texts; null where an id is of another kind. The key that counts
    is chosen here, so the far end is in ``id``."""
    none = F.lit(None).cast("string").alias("toObjectId")
    return [F.struct(object_id(r["from"]["id"]).alias("id")).alias("from"), F.transform(r["to"], lambda to: F.struct(
        none, target_id(to).alias("id"), *far_end(to))).alias("to")]


def _by_kind(results: Column) -> Column:
    """Results read as variants with the texts and numbers of their ends and types; those of another kind are null."""

    def kinds(t: Column) -> Column:
        numbers = [whole_number(t[n]).cast("bigint").alias(n) for n in ("associationTypeId", "typeId")]
        return F.struct(as_text(t["label"]).alias("label"), *numbers, as_text(t["category"]).alias("category"))

    def far_end(to: Column) -> list[Column]:
        return [*[F.transform(to[n], kinds).alias(n) for n in ("associationTypes", "types")],
                *[to[n].alias(n) for n in ("source", "sourceId", "createdAt", "updatedAt")]]

    def result(r: Column) -> Column:
        start, to = _ends_by_kind(r, far_end)
        return F.struct(start, *[r[n].alias(n) for n in ("createdAt", "updatedAt")], to)

    return F.transform(results, result)


def plain_items(pages: DataFrame) -> DataFrame:
    """As :func:`association_items`, with ids and the types of an association as texts and numbers: from_id, to,
    created, updated, seq, pos. The far end is ``toObjectId`` where that is not null, else ``id``.

    A value of the wrong kind counts as absent. Batches are read as texts and numbers at once; they are read
    as variants only where a number does not fit or the text shows an id that is neither a string nor a whole
    number, or a label or category that is no string, which hardly any batch does. The text is searched only
    where a value read from it leaves doubt.
    """
    read = _placed(pages).withColumn("_batch", F.from_json("page", _PLAIN_BATCH, {"columnNameOfCorruptRecord": _UNFIT}))
    texts = F.col("_batch.results")
    others = _shows(*_OTHER_TEXTS) | (_unsure_ends(texts) & _shows(*_OTHER_IDS))
    results = F.when(F.col(f"_batch.{_UNFIT}").isNotNull() | others, _by_kind(
        F.from_json("page", ASSOCIATION_BATCH).getField("results"))).otherwise(texts)
    return _items(read.select("file", "at", F.posexplode(results).alias("item", "r")), "created", "updated",
                  from_id=F.col("r.from.id"))


def association_ends(pages: DataFrame) -> DataFrame:
    """As :func:`association_items`, only the ends are read: from_id, to, seq, pos."""
    return _items(_placed(pages).select("file", "at", F.posexplode(
        F.from_json("page", _ENDS).getField("results")).alias("item", "r")))


def plain_ends(pages: DataFrame) -> DataFrame:
    """The ends of association batches as texts, read by kind only where :func:`plain_items` does: from_id, to, seq, pos."""
    read = _placed(pages).withColumn("_texts", F.from_json("page", _PLAIN_ENDS).getField("results"))
    texts = F.col("_texts")
    results = F.when(_unsure_ends(texts) & _shows(*_OTHER_IDS), F.transform(
        F.from_json("page", _ENDS).getField("results"), lambda r: F.struct(*_ends_by_kind(r)))).otherwise(texts)
    return _items(read.select("file", "at", F.posexplode(results).alias("item", "r")), from_id=F.col("r.from.id"))


def _items(results: DataFrame, *times: str, from_id: Column | None = None) -> DataFrame:
    start = object_id(F.col("r.from.id")) if from_id is None else from_id
    return results.select(
        start.alias("from_id"), *[F.col(f"r.{t}At").alias(t) for t in times],
        F.struct("file", "at", "item").cast(_SEQ).alias("seq"), F.posexplode(F.col("r.to")).alias("pos", "to"))


def reverse_items(pages: DataFrame) -> DataFrame:
    """Reverse association batches: from_id, to_ids, seq."""
    results = _placed(pages).select("file", "at", F.posexplode(
        F.from_json("page", REVERSE_BATCH).getField("results")).alias("item", "r"))
    start = F.col("r.from")

    def inner(value: Column, key: str) -> Column:
        return F.try_variant_get(value, f"$.{key}", "variant")

    def bare(value: Column) -> Column:
        return F.coalesce(object_id(inner(value, "toObjectId")), object_id(inner(value, "id")),
                          object_id(value))

    return results.select(
        F.when(start.isNotNull(), bare(start)).otherwise(object_id(F.col("r.id"))).alias("from_id"),
        F.filter(F.transform(F.col("r.to"), bare), lambda x: not_blank(x)).alias("to_ids"),
        F.struct("file", "at", "item").cast(_SEQ).alias("seq"))


HISTORY = ("struct<id:variant,propertiesWithHistory:map<string,array<struct<value:variant,"
           "timestamp:variant,source:variant,sourceId:variant>>>>")


def history_payloads(payloads: DataFrame, object_type: str) -> DataFrame:
    """History payloads (column ``page``) to one row per object and property, items in order."""
    parsed = payloads.select(F.from_json("page", HISTORY).alias("_h"))

    def item(x: Column) -> Column:
        return F.struct(
            as_text(x["value"]).alias("value"), as_text(x["timestamp"]).alias("timestamp"),
            as_text(x["source"]).alias("source"), as_text(x["sourceId"]).alias("source_id"))

    # all columns come out of the generator, so no filter is pushed below the parsing
    rows = F.transform(F.map_entries("_h.propertiesWithHistory"), lambda e: F.struct(
        F.lit(object_type).alias("object_type"), object_id(F.col("_h.id")).alias("object_id"),
        e["key"].alias("property_name"), F.transform(e["value"], item).alias("items")))
    return parsed.select(F.inline(rows))


def read_property_history(spark: SparkSession, path: str, object_type: str) -> DataFrame:
    return history_payloads(scan_payloads(spark, path), object_type)
