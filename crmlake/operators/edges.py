"""Edge tables: explode association payloads, merge edge sources, attach surrogate ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crmlake.functions.associations import edge_type, last_plain_type, plain_target_id
from crmlake.functions.text import is_primary, labels_json, not_blank, singular
from crmlake.functions.values import object_id, to_stamp
from crmlake.operators.ordered import keep_first, keep_last
from crmlake.sources.landed import plain_ends, plain_items, reverse_items

_PAIR = ["contact_source_id", "company_source_id"]


def _edge_items(pages: DataFrame) -> DataFrame:
    """Association batches to edges with every detail of the pair; ends may still be blank."""
    to = F.col("to")
    kinds = F.coalesce(to["associationTypes"], to["types"])
    # type ids and categories are given by the first form only
    typed = last_plain_type(to["associationTypes"])
    # the labels are read once; what is made of them refers to the column
    items = plain_items(pages).select("*", F.filter(kinds["label"], lambda x: not_blank(x)).alias("labels"))
    return items.select(
        "from_id", plain_target_id(to).alias("to_id"),
        F.try_element_at("labels", F.lit(1)).alias("label"), "labels",
        typed["type_id"].alias("type_id"), typed["category"].alias("category"),
        F.coalesce(to_stamp(to["createdAt"]), to_stamp("created")).alias("created_at"),
        F.coalesce(to_stamp(to["updatedAt"]), to_stamp("updated")).alias("updated_at"),
        to["source"].alias("source"), to["sourceId"].alias("source_ref"), "seq", "pos")


def _both_ends(df: DataFrame) -> DataFrame:
    return df.filter(not_blank("from_id") & not_blank("to_id"))


def contact_company_details(pages: DataFrame) -> DataFrame:
    """Contact to company edges with label, labels, times and source, one row per listed pair."""
    items = _both_ends(_edge_items(pages))
    return items.select(
        F.col("from_id").alias("contact_source_id"), F.col("to_id").alias("company_source_id"),
        F.col("label").alias("association_type"),
        F.when(F.size("labels") > 0, F.to_json("labels")).alias("association_labels_json"),
        F.col("created_at").alias("association_created_at"),
        F.col("updated_at").alias("association_updated_at"),
        F.col("source").alias("association_source"),
        F.col("source_ref").alias("association_source_id"), "seq", "pos")


def contact_company_edges(pages: DataFrame) -> DataFrame:
    """Contact to company pairs, each once."""
    items = _both_ends(plain_ends(pages).select(
        "from_id", plain_target_id(F.col("to")).alias("to_id")))
    return items.select(F.col("from_id").alias("contact_source_id"),
                        F.col("to_id").alias("company_source_id")).distinct()


def company_contact_edges(pages: DataFrame) -> DataFrame:
    """Company to contact pairs from reverse batches; of repeated companies the last list counts.

    """
    rows = reverse_items(pages).filter(not_blank("from_id") & (F.size("to_ids") > 0))
    kept = keep_last(rows, ["from_id"], "seq")
    return kept.select(F.col("from_id").alias("company_source_id"),
                       F.explode("to_ids").alias("contact_source_id")).distinct()


def object_edges(pages: DataFrame, source_type: str, target_type: str) -> DataFrame:
    """Edges between two object types; blank ends are kept for :func:`split_edges` to reject."""
    return _edge_items(pages).select(
        F.lit(source_type).alias("source_object_type"), F.col("from_id").alias("source_object_id"),
        F.lit(target_type).alias("target_object_type"), F.col("to_id").alias("target_object_id"),
        F.col("label").alias("association_label"),
        labels_json(F.col("labels"), "label").alias("association_labels_json"),
        F.col("type_id").alias("association_type_id"),
        F.col("category").alias("association_category"),
        F.col("created_at").alias("association_created_at"),
        F.col("updated_at").alias("association_updated_at"),
        F.col("source").alias("association_source"),
        F.col("source_ref").alias("association_source_id"),
        is_primary("label").alias("is_primary"), "seq", "pos")


def has_ends(required: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [not_blank(c) for c in required])


def split_edges(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(edges with all required ends, rejected edges with the reason)."""
    reason = F.coalesce(*[F.when(~not_blank(c), f"{c} is required") for c in required])
    return df.filter(reason.isNull()), df.withColumn("reject_reason", reason).filter(
        F.col("reject_reason").isNotNull())


def _embedded(objects: DataFrame, target: str) -> DataFrame:
    """Objects with the ids they are associated with: id, ids (not empty), seq."""
    found = F.try_element_at("associations", F.lit(target)).getField("results")
    ids = F.filter(F.transform(found, lambda r: object_id(r["id"])), lambda x: not_blank(x))
    return objects.select("id", ids.alias("ids"), "seq").filter(not_blank("id") & (F.size("ids") > 0))


def embedded_edges(objects: DataFrame, target: str = "companies") -> DataFrame:
    """Pairs from the associations inside the object payload: source_id, target_id.

    Of repeated objects the last that has any pair counts, as for any keyed list of the run.
    """
    kept = keep_last(_embedded(objects, target), ["id"], "seq")
    return kept.select(F.col("id").alias("source_id"), F.explode("ids").alias("target_id")).distinct()


def edge_array(associations: Column) -> Column:
    """All edges in one payload as an array, for loads that keep them beside their activity."""

    def of_type(entry: Column) -> Column:
        return F.transform(entry["value"]["results"], lambda r, i: F.struct(
            entry["key"].alias("type"), object_id(r["id"]).alias("id"),
            edge_type(r).alias("kind"), i.alias("pos")))

    groups = F.filter(F.map_entries(associations), lambda e: e["value"]["results"].isNotNull())
    return F.transform(F.flatten(F.transform(groups, of_type)), lambda e: F.struct(
        singular(e["type"]).alias("associated_object_type"),
        e["id"].alias("associated_object_id"), e["kind"]["label"].alias("association_label"),
        e["kind"]["type_id"].alias("association_type_id"),
        e["kind"]["category"].alias("association_category"), e["pos"].alias("pos")))


def activity_edges(records: DataFrame) -> DataFrame:
    """Edges of activities to every object in their payload.

    Takes the edges from the row of the activity itself (``associations``, or an ``edges`` array
    made by :func:`edge_array`), so an edge cannot end up with another activity. No shuffle.
    """
    edges = F.col("edges") if "edges" in records.columns else edge_array(F.col("associations"))
    return records.select(
        F.col("source_id").alias("activity_source_id"), F.inline(edges), "seq",
    ).filter(not_blank("associated_object_id"))


def filter_edges(edges: DataFrame, object_type: str,
                 column: str = "associated_object_type") -> DataFrame:
    return edges.filter(F.lower(F.col(column)) == object_type)


def ids_in(rows: DataFrame, ids: DataFrame, column: str, id_column: str = "source_id") -> DataFrame:
    """The rows whose id is among those of ``ids``, however often it is there; case ignored.

    Ids are made distinct in the map tasks first, so a hot id is one row of the side that is joined.
    """
    wanted = ids.select(F.lower(id_column).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return rows.join(wanted, F.lower(F.col(column)) == F.col("_key"), "left_semi")


def distinct_pairs(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Each pair of ends once, pairs with a blank end left out; combined in the map tasks."""
    return rows.filter(not_blank(source) & not_blank(target)).select(source, target).distinct()


def filter_pairs(edges: DataFrame, source_type: str, target_type: str) -> DataFrame:
    """Object edges of one pair of types; both are partition columns of the stored table."""
    return edges.filter((F.col("source_object_type") == source_type)
                        & (F.col("target_object_type") == target_type))


def union_edges(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Set union of two edge sources. On one pair the first source's row is kept."""
    keys = list(keys or _PAIR)
    both = a.withColumn("_from", F.lit(0)).unionByName(b.withColumn("_from", F.lit(1)),
                                                       allowMissingColumns=True)
    return keep_first(both, keys, "_from").drop("_from")


merge_edges = union_edges


def reverse_edges(edges: DataFrame) -> DataFrame:
    """Swap the ends of contact-company edges; each pair once."""
    return edges.select(F.col("contact_source_id"), F.col("company_source_id")).distinct()


def edges_or_reverse(forward: DataFrame, reverse: DataFrame, present: bool | None = None) -> DataFrame:
    """The forward edges, or the reverse edges when there is not one forward edge.

    ``present`` says whether there is one, where the caller knows it from narrower rows.
    """
    if present is None:
        present = not forward.isEmpty()
    return forward if present else reverse_edges(reverse)


def any_contact_company(batch: DataFrame | None, contacts: DataFrame | None) -> bool:
    """Whether an association batch or a parsed contact holds a pair: scans that stop at the first."""
    if batch is not None and not _both_ends(plain_ends(batch).select(
            "from_id", plain_target_id(F.col("to")).alias("to_id"))).isEmpty():
        return True
    return contacts is not None and not _embedded(contacts, "companies").isEmpty()


def all_contact_company(batch: DataFrame | None, contacts: DataFrame | None) -> DataFrame | None:
    """Pairs of both sources, each once, with the details the batch lists first for it.

    The batch is parsed once for pairs and details, and one aggregate makes pairs unique.
    """
    parts = []
    if batch is not None:
        parts.append(contact_company_details(batch).withColumn("_from", F.lit(0)))
    if contacts is not None:
        found = embedded_edges(contacts, "companies").select(
            F.col("source_id").alias("contact_source_id"), F.col("target_id").alias("company_source_id"))
        parts.append(found.withColumn("_from", F.lit(1)))
    if not parts:
        return None
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    order = [c for c in ("_from", "seq", "pos") if c in both.columns]
    return keep_first(both, _PAIR, order).drop(*order)


def attach_edge_details(edges: DataFrame, details: DataFrame) -> DataFrame:
    """Add the first listed detail row of each pair."""
    first = keep_first(details, _PAIR, ["seq", "pos"]).drop("seq", "pos")
    return edges.join(first, _PAIR, "left")


def attach_keys(edges: DataFrame, contacts: DataFrame, companies: DataFrame) -> DataFrame:
    """Surrogate contact and company ids of edges; null where the object is not stored."""
    for side, parents in (("contact", contacts), ("company", companies)):
        keys = parents.select(F.lower("source_id").alias("_key"), F.col("id").alias(f"{side}_id"))
        edges = edges.join(keys, F.lower(f"{side}_source_id") == F.col("_key"), "left").drop("_key")
    return edges


def attach_activity_id(edges: DataFrame, activities: DataFrame) -> DataFrame:
    keys = activities.select(F.lower("source_id").alias("_key"), F.col("id").alias("activity_id"))
    return edges.join(keys, F.lower("activity_source_id") == F.col("_key"), "left").drop("_key")


def edge_lists(edges: DataFrame, key: str, value: str, span: int = 1000) -> DataFrame:
    """Edges grouped to lists of distinct far ids: key, span, ids.

    A key's list is cut by id range, so one list holds at most ``span`` ids and a key with very
    many edges is spread over many groups. Together the lists hold every edge. Ids that are not
    whole numbers are cut by hash.
    """
    part = F.coalesce(F.expr(f"try_cast({value} as bigint) div {int(span)}"),
                      -1 - F.pmod(F.xxhash64(value), F.lit(4096)))
    return edges.groupBy(key, part.alias("span")).agg(
        F.array_sort(F.collect_set(value)).alias("ids"))


def latest_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    """One row per edge key, the last listed."""
    return keep_last(edges, keys, ["seq", "pos"])

