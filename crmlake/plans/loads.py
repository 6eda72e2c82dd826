"""Loads: from landed payloads to merged tables, alone or as one full run."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from crmlake.model.objects import ACTIVITY_SOURCES, DETAIL_TABLES
from crmlake.model.tables import REFERENCES, TABLES, UNIQUE, key_tells_partition
from crmlake.operators import edges as E, flatten, resolve
from crmlake.operators.history import property_history
from crmlake.operators.merge import INSERTED, KEPT, UPDATED, absent_table, empty_table, upsert
from crmlake.operators.quality import edge_diagnostics, with_broken_references, with_broken_rules
from crmlake.plans import timeline as TL
from crmlake.sources import landed as L
from crmlake.sources.tables import FEW_PARTITIONS, Tables, shuffles_end_with_queries, together

log = logging.getLogger(__name__)

# The object pairs whose edges are loaded.
OBJECT_PAIRS = (
    ("contact", "deal"), ("contact", "ticket"), ("company", "deal"), ("company", "ticket"),
    ("deal", "ticket"), ("ticket", "call"), ("ticket", "email"), ("ticket", "note"),
    ("ticket", "task"), ("ticket", "meeting"), ("email", "deal"), ("email", "company"),
    ("email", "ticket"), ("meeting", "deal"), ("meeting", "company"), ("meeting", "ticket"),
    ("task", "deal"), ("task", "company"), ("task", "ticket"),
)

# The properties whose history is loaded. The timeline also reads lifecyclestage.
HISTORY_PROPERTIES = (
    ("contact", "hs_lead_status"), ("contact", "lifecyclestage"), ("deal", "dealstage"),
    ("ticket", "hs_pipeline_stage"), ("company", "meeting_invite"),
)


class LoadFailed(Exception):
    """A critical step failed."""


class RulesBroken(Exception):
    """Rows of a snapshot break rules of their table; nothing of it was written."""

    def __init__(self, table: str, rows: int, example: str):
        super().__init__(f"{table}: {rows} rows break rules, such as {example}")
        self.table, self.rows, self.example = table, rows, example


QUARANTINE, FAIL = "quarantine", "fail"
ALL_EVENTS, CHANGED_EVENTS = "all", "changed"


def _observed(seen: Observation) -> dict:
    """What a pass observed. A frame known to be empty is planned away with its metrics: nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


@dataclass
class Landed:
    """The payloads of one run. Pages hold one JSON payload per row in the column ``page``.

    objects       object type to raw objects (raw, seq)
    associations  (source type, target type) to association batches
    reverse       company to contact batches
    history       object type to history payloads
    """

    objects: dict[str, DataFrame] = field(default_factory=dict)
    associations: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    reverse: DataFrame | None = None
    history: dict[str, DataFrame] = field(default_factory=dict)
    owners: DataFrame | None = None
    pipelines: DataFrame | None = None
    stages: DataFrame | None = None

    @classmethod
    def below(cls, spark: SparkSession, root: str, one_per_file: bool = False) -> Landed:
        """Payloads in the landing layout: objects/<type>, associations/<source>-<target>,
        associations/company-contact, history/<type>, lists/owners, lists/pipelines, lists/stages.
        """

        def pages(path: str) -> DataFrame | None:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{path}")
            fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
            return L.scan_payloads(spark, f"{root}/{path}", one_per_file) if fs.exists(where) else None

        def found(paths: dict) -> dict:
            read = {key: pages(path) for key, path in paths.items()}
            return {key: df for key, df in read.items() if df is not None}

        objects = found({t: f"objects/{t}" for t in L.PROPERTIES})
        pairs = (*OBJECT_PAIRS, ("contact", "company"), ("ticket", "contact"))
        return cls(
            objects={t: L.page_objects(df) for t, df in objects.items()},
            associations=found({(a, b): f"associations/{a}-{b}" for a, b in pairs}),
            reverse=pages("associations/company-contact"),
            history=found({t: f"history/{t}" for t, _ in HISTORY_PROPERTIES}),
            owners=pages("lists/owners"), pipelines=pages("lists/pipelines"),
            stages=pages("lists/stages"))


@dataclass
class Context:
    """What a load needs: payloads, the stored tables, the load time and manual overrides.

    ``stored`` replaces the tables of that name, for loads that are not written back.

    ``rules`` says what becomes of rows that break a rule of their table (required columns, lengths, unique
    values). Without it they are loaded and the ``check_`` tables tell of them. They are set aside as rejected rows (``quarantine``), or the step fails before it
    writes anything (``fail``). Ids of other tables come out of joins with those tables, so a load cannot
    write one that is not there; ``check_references`` looks all the same, at the price of one more join each.

    ``events`` says which events of the timeline a run makes: all, or those of activities, tickets and
    changes that it has inserted or updated itself.
    """

    spark: SparkSession
    landed: Landed
    as_of: object
    tables: Tables | None = None
    stored: dict[str, DataFrame] = field(default_factory=dict)
    owner_overrides: DataFrame | None = None
    stage_overrides: DataFrame | None = None
    later_contacts: DataFrame | None = None
    rules: str | None = None
    check_references: bool = False
    events: str = ALL_EVENTS
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    watched: dict[str, list[Observation]] = field(default_factory=dict)
    shared: dict[str, DataFrame] = field(default_factory=dict)
    touched: dict[str, list[tuple]] = field(default_factory=dict)
    placed: set[str] = field(default_factory=set)
    lock: threading.RLock = field(default_factory=threading.RLock)

    def watch(self, df: DataFrame, name: str, bad: Column) -> DataFrame:
        """Count the bad rows of a frame in the pass that writes the good ones."""
        seen = Observation()
        self.watched.setdefault(name, []).append(seen)
        return df.observe(seen, F.count_if(bad).alias("failed"))

    def forget(self, name: str, keep: int = 0) -> None:
        """Drop what is watched under a name beyond the first ``keep``: a pass that failed never ends."""
        del self.watched.get(name, [])[keep:]

    def failed(self, name: str) -> int:
        return sum(int(_observed(seen).get("failed") or 0) for seen in self.watched.get(name, ()))

    def reject(self, table: str, rows: DataFrame) -> None:
        """Keep rows that a table cannot take, with ``reject_reason``, for the table of rejected rows."""
        source = F.col("source_id") if "source_id" in rows.columns else F.lit(None)
        raw = F.col("raw") if "raw" in rows.columns else F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
        kept = rows.select(F.lit(table).alias("table_name"), source.cast("string").alias("source_id"),
                           F.col("reject_reason").alias("reason"), raw.cast("string").alias("raw"),
                           F.lit(self.as_of).cast("timestamp").alias("etl_date"))
        known = self.rejected.get(table)
        self.rejected[table] = kept if known is None else known.unionByName(kept)

    def read(self, table: str) -> DataFrame:
        if table in self.stored:
            return self.stored[table]
        return absent_table(self.spark, table) if self.tables is None else self.tables.read(table)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return df if self.tables is None else self.tables.stage(df, name)

    def objects(self, object_type: str) -> DataFrame:
        """Parsed objects of one type; a type that has not landed is an empty snapshot."""
        raw = self.landed.objects.get(object_type)
        if raw is None:
            raw = self.spark.createDataFrame([], "raw string, seq string")
        return L.parse_objects(raw, object_type)

    def usable(self, object_type: str, watched: bool = False) -> DataFrame:
        """Usable rows of one type; the others are kept as ``rejected``."""
        rows = flatten.flatten_all(self.objects(object_type), object_type)
        if watched:
            rows = self.watch(rows, object_type, F.col("reject_reason").isNotNull())
        ok, bad = flatten.split_valid(rows)
        if watched:
            self.reject(object_type, bad)
        return ok

    def run_contacts(self) -> DataFrame:
        """Ids, names and emails of this run's contacts, parsed once for all loads that look them up."""
        with self.lock:  # steps that run side by side wait for the one that stages it
            if "contacts" not in self.shared:
                rows = self.usable("contacts").select("source_id", "record_id", "full_name", "email", "seq")
                self.shared["contacts"] = self.stage(rows, "run-contacts")
            return self.shared["contacts"]

    def obeying(self, rows: DataFrame, table: str, order: list[str]) -> DataFrame:
        """Rows that keep the rules of their table; the others are set aside, or fail the step.

        Rules of a row alone are looked at in the pass that writes the table. Where values have to be
        unique, and where the step is to fail, the rows are staged first: they are read twice, or must be
        known to be good before anything is written.
        """
        if self.rules is None:
            return rows
        failing = self.rules == FAIL and self.tables is not None
        if UNIQUE.get(table) and self.tables is not None:
            rows = self.stage(rows, f"new-{table}")
        rows = with_broken_rules(rows, self.read(table), table, order, kept=self.stage)
        if self.check_references:
            rows = with_broken_references(rows, {
                c: self.read(t) for c, t in REFERENCES.get(table, {}).items() if c in rows.columns})
        bad = F.size("broken_rules") > 0
        if failing:
            each = Observation()
            rows = self.stage(rows.observe(each, F.count_if(bad).alias("n"), F.first(
                F.when(bad, F.array_join("broken_rules", ", ")), ignorenulls=True).alias("example")), f"good-{table}")
            found = _observed(each)
            if found.get("n"):
                raise RulesBroken(table, int(found["n"]), found["example"])
            return rows.drop("broken_rules")
        rows = self.watch(rows, table, bad)
        self.reject(table, rows.filter(bad).withColumn("reject_reason", F.array_join("broken_rules", ", ")).drop("broken_rules"))
        return rows.filter(~bad).drop("broken_rules")

    def merged(self, table: str, rows: DataFrame, order_by=("seq",), within: list[tuple] | None = None,
               **options) -> DataFrame:
        """Rows merged into the stored table.

        Where the key tells the partition, only the partitions are read that the rows are in, and
        :func:`_save` replaces only those. ``within`` names them where they are known beforehand;
        otherwise the rows are staged and asked. A table that is not there yet is not merged with.
        """
        order = [c for c in order_by if c in rows.columns]
        if within != []:  # nothing has landed: no pass will be made, and nothing may wait for its counts
            rows = self.obeying(rows, table, order)
        base = self.stored.get(table)
        if base is None and self.tables is not None and self.tables.exists(table) and key_tells_partition(table):
            if within is None:
                rows = self.stage(rows, f"new-{table}")
                within = self.tables.partitions_of(rows, table)
            if within is not None:
                self.touched[table] = within
                base = self.tables.read(table, within)
        if within is not None and len(within) <= FEW_PARTITIONS:
            self.placed.add(table)
        return upsert(table, self.read(table) if base is None else base, rows, self.as_of, order_by=order, **options)

    def owned(self, df: DataFrame, column: str) -> DataFrame:
        if self.landed.owners is None:
            if self.owner_overrides is None:
                return df
            return resolve.resolve_label(df, column, resolve.label_dim(None, self.owner_overrides))
        with self.lock:
            if "owners" not in self.shared:  # made and counted once per run
                dim = resolve.owner_label_dim(
                    resolve.owners_dim(L.owner_rows(self.landed.owners)), self.owner_overrides)
                self.shared["owners"] = resolve.sized(self.stage(dim, "owners"))
        return resolve.resolve_label(df, column, self.shared["owners"])

    def options(self, pages: DataFrame | None) -> DataFrame:
        if pages is None:
            return self.spark.createDataFrame([], "key string, name string")
        return resolve.options_dim(L.option_rows(pages))


def _simple(ctx: Context, table: str, owner: str) -> DataFrame:
    return ctx.merged(table, ctx.owned(ctx.usable(table, watched=True), owner))


def load_contacts(ctx: Context) -> DataFrame:
    return _simple(ctx, "contacts", "contact_owner")


def load_companies(ctx: Context) -> DataFrame:
    return _simple(ctx, "companies", "company_owner")


def load_deals(ctx: Context) -> DataFrame:
    return _simple(ctx, "deals", "deal_owner")


def load_tickets(ctx: Context) -> DataFrame:
    rows = ctx.owned(ctx.usable("tickets", watched=True), "ticket_owner")
    rows = resolve.resolve_pipeline(rows, "pipeline", ctx.options(ctx.landed.pipelines))
    rows = resolve.resolve_stage(rows, "ticket_status", ctx.options(ctx.landed.stages),
                                 ctx.stage_overrides)
    return ctx.merged("tickets", rows)


def load_communications(ctx: Context) -> DataFrame:
    """Contacts are looked up in this run, then the stored table, then a later snapshot."""
    rows = ctx.owned(ctx.usable("communications", watched=True), "activity_assigned_to")
    tiers = [ctx.run_contacts()] if "contacts" in ctx.landed.objects else []
    tiers += [ctx.read("contacts")]
    tiers += [] if ctx.later_contacts is None else [ctx.later_contacts]
    rows = resolve.enrich_contact(rows, "associated_contact_id", *tiers)
    return ctx.merged("communications", rows)


def load_emails(ctx: Context) -> DataFrame:
    """Contacts are looked up in this run only."""
    rows = ctx.owned(ctx.usable("emails", watched=True), "activity_assigned_to")
    if "contacts" in ctx.landed.objects:
        rows = resolve.enrich_contact(rows, "associated_contact_id", ctx.run_contacts())
    return ctx.merged("emails", rows)


def load_notes(ctx: Context) -> DataFrame:
    return _simple(ctx, "notes", "activity_assigned_to")


def _pairs_of_run(ctx: Context) -> dict[str, DataFrame]:
    """The contact-company pairs of the run by method."""
    empty = ctx.spark.createDataFrame([], "contact_source_id string, company_source_id string")
    batch = ctx.landed.associations.get(("contact", "company"))
    found = {"batch": empty if batch is None else E.contact_company_edges(batch), "embedded": empty}
    if "contacts" in ctx.landed.objects:
        found["embedded"] = E.embedded_edges(ctx.objects("contacts"), "companies").select(
            F.col("source_id").alias("contact_source_id"),
            F.col("target_id").alias("company_source_id"))
    return found


def contact_company_diagnostics(ctx: Context) -> DataFrame:
    found = _pairs_of_run(ctx)
    if ctx.landed.reverse is not None:
        found["reverse"] = E.company_contact_edges(ctx.landed.reverse)
    return edge_diagnostics(**found)


def load_contact_company_edges(ctx: Context) -> DataFrame:
    batch = ctx.landed.associations.get(("contact", "company"))
    contacts = ctx.objects("contacts") if "contacts" in ctx.landed.objects else None
    pairs = E.all_contact_company(batch, contacts)
    if pairs is None:
        pairs = ctx.spark.createDataFrame([], "contact_source_id string, company_source_id string")
    if ctx.landed.reverse is not None:
        pairs = E.edges_or_reverse(pairs, E.company_contact_edges(ctx.landed.reverse),
                                   E.any_contact_company(batch, contacts))
    table, ends = "contact_company_associations", ["contact_source_id", "company_source_id"]
    pairs, bad = E.split_edges(ctx.watch(pairs, table, ~E.has_ends(ends)), ends)
    ctx.reject(table, bad)
    pairs = E.attach_keys(pairs, ctx.read("contacts"), ctx.read("companies"))
    return ctx.merged(table, pairs, unique=True)


def load_object_edges(ctx: Context, source: str | None = None,
                      target: str | None = None) -> DataFrame:
    """Edges of one pair of types, or of every landed pair.

    All pairs go into the table in one merge, not in one rewrite of the table per pair.
    """
    pairs = [(source, target)] if source else [
        p for p in ctx.landed.associations if p != ("contact", "company")]
    edges = None
    for a, b in pairs:
        rows = E.object_edges(ctx.landed.associations[a, b], a, b)
        edges = rows if edges is None else edges.unionByName(rows)
    table = "object_associations"
    if edges is None:
        return ctx.merged(table, empty_table(ctx.spark, table), within=[])
    ends = ["source_object_type", "source_object_id", "target_object_type", "target_object_id"]
    edges = ctx.watch(edges, table, ~E.has_ends(ends))
    edges, bad = E.split_edges(edges, ends)
    ctx.reject(table, bad)
    return ctx.merged(table, edges, ("seq", "pos"), within=pairs)


def side_by_side(spark: SparkSession, tasks: list[Callable[[], object]], most: int) -> list:
    """Run tasks on up to ``most`` threads that share the session. All have ended when the first error is raised."""
    with ThreadPoolExecutor(max(1, min(most, len(tasks)))) as pool:
        made = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        wait(made)
    return [m.result() for m in made]


def activity_records(ctx: Context, on_error: Callable[[str, Exception], None] | None = None,
                     most: int = 1) -> dict[str, DataFrame]:
    """Records per landed activity type, each payload parsed once and kept with its edges.

    A type that cannot be read is given to ``on_error`` and left out; without it the error is raised.
    ``most`` types are read at a time.
    """
    def read(kind: str, object_type: str) -> tuple | None:
        seen = None
        try:
            rows = flatten.flatten_activity_records(ctx.objects(object_type), kind, ctx.as_of)
            rows = rows.withColumn("edges", E.edge_array(F.col("associations"))).drop("associations")
            if ctx.tables is not None:
                seen = Observation()
                rows = rows.observe(seen, F.count_if(F.col("reject_reason").isNotNull()).alias("failed"))
            return kind, ctx.stage(rows, f"records-{kind.lower()}"), seen
        except Exception as error:  # noqa: BLE001 - a type may fail for any reason
            if on_error is None:
                raise
            on_error(kind, error)
            return None

    landed = [(kind, t) for kind, t in ACTIVITY_SOURCES.items() if t in ctx.landed.objects]
    records = {}
    for kind, rows, seen in filter(None, side_by_side(ctx.spark, [lambda one=one: read(*one) for one in landed], most) if landed else ()):
        if seen is not None:
            ctx.watched.setdefault("activities", []).append(seen)
        records[kind], bad = flatten.split_valid(rows)
        ctx.reject("activities", bad)
    return records


def _activities_of(ctx: Context, records: dict[str, DataFrame]) -> DataFrame:
    rows = flatten.all_activities(**{k: r.drop("detail", "edges") for k, r in records.items()})
    rows = ctx.owned(rows, "activity_owner")
    if "contacts" in ctx.landed.objects:
        rows = resolve.enrich_source(rows, ctx.run_contacts())
    return rows


def load_activities(ctx: Context, records: dict[str, DataFrame] | None = None) -> DataFrame:
    rows = _activities_of(ctx, records or activity_records(ctx))
    return ctx.merged("activities", rows)


def load_details(ctx: Context, kind: str, records: dict[str, DataFrame],
                 activities: DataFrame) -> DataFrame:
    rows = records[kind].select("source_id", "detail.*", "seq")
    if kind == "SMS" and ctx.owner_overrides is not None:
        rows = resolve.resolve_label(rows, "activity_assigned_to",
                                     resolve.label_dim(None, ctx.owner_overrides))
    rows = flatten.attach_activity(rows, activities)
    return ctx.merged(DETAIL_TABLES[kind], rows)


def load_activity_edges(ctx: Context, records: dict[str, DataFrame],
                        activities: DataFrame) -> DataFrame:
    edges = None
    for rows in records.values():
        one = E.activity_edges(rows)
        edges = one if edges is None else edges.unionByName(one)
    edges = E.attach_activity_id(edges, activities)
    return ctx.merged("activity_associations", edges, ("seq", "pos"))


def load_property_history(ctx: Context, pairs=HISTORY_PROPERTIES) -> DataFrame:
    rows, within = None, []
    for object_type, payloads in ctx.landed.history.items():
        names = [p for t, p in pairs if t == object_type]
        within += [(object_type, name) for name in names]
        read = L.history_payloads(payloads, object_type).filter(F.col("property_name").isin(names))
        one = property_history(read)
        rows = one if rows is None else rows.unionByName(one)
    table = "property_histories"
    if rows is None:
        rows = empty_table(ctx.spark, table)
    return ctx.merged(table, rows, ("pos",), within=within)


def timeline_families(ctx: Context, apart: bool = False, once: bool = False) -> dict[str, DataFrame]:
    """The event families; with ``events`` set to ``changed`` of what this run inserted or updated alone.

    Families that share their joins come as one, unless they are to be made ``apart``. ``once``, the events of
    tickets do not repeat a key of the timeline.
    """
    details = {kind: ctx.read(table) for kind, table in DETAIL_TABLES.items()}
    tables = (ctx.read("activities"), details, ctx.read("activity_associations"), ctx.read("tickets"),
              ctx.read("object_associations"), ctx.read("property_histories"))
    if ctx.events == CHANGED_EVENTS:
        tables = TL.only_changed(*tables, ctx.as_of, lambda keys, name: resolve.sized(ctx.stage(keys, name)))
    return TL.build_events(*tables, ctx.as_of, apart, once)


def timeline_events(ctx: Context, placed: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The events of all families, one per key of the timeline. ``placed`` is given events of many kinds; those of
    tickets, by far the most, are of two."""
    if TL.tickets_stand_apart(ctx.read("activities")):
        return TL.events_once(timeline_families(ctx, once=True), placed)
    return placed(TL.each_once(TL.union_events(*timeline_families(ctx).values())))


def _timeline(ctx: Context, families) -> DataFrame:
    return ctx.merged("contact_activity_timelines", TL.union_events(*families.values()))


def build_timeline(ctx: Context) -> DataFrame:
    if ctx.rules is not None:  # of events of one key, only those that obey may be chosen from
        return _timeline(ctx, timeline_families(ctx))
    table = "contact_activity_timelines"
    if ctx.tables is None or ctx.tables.exists(table):
        return ctx.merged(table, timeline_events(ctx), unique=True)
    ctx.placed.add(table)  # the first timeline is not merged, and its tasks hold the events of one family
    return ctx.merged(table, timeline_events(ctx, lambda rows: together(rows, table)), unique=True)


METRICS = T.StructType([
    T.StructField("step", T.StringType()), T.StructField("outcome", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in ("total", "inserted", "updated", "kept", "failed")],
    T.StructField("message", T.StringType())])


def _save(ctx: Context, table: str, merged: DataFrame) -> dict[str, int]:
    """Write a merged table; the counts are taken while it is written, not in a second pass.

    Of a table of which only some partitions were merged, those are replaced. Rows of the others count as
    kept; their number is in the footers of the files.
    """
    seen = Observation()
    counts = {name: F.count_if(F.col("action") == name).alias(name)
              for name in (INSERTED, UPDATED, KEPT)}
    within, spread = ctx.touched.pop(table, None), table not in ctx.placed
    ctx.placed.discard(table)
    if within is None or not ctx.tables.exists(table):
        ctx.tables.write(merged.observe(seen, *counts.values()), table, spread)
        others = 0
    else:
        if within:
            ctx.tables.replace(merged.observe(seen, *counts.values()), table, spread)
        others = ctx.tables.read(table, without=within).count()
    found = _observed(seen) if within != [] else {}
    return {name: int(found.get(name) or 0) + (others if name == KEPT else 0) for name in counts}


def _text(error: Exception) -> str:
    return str(error) or type(error).__name__


class _Run:
    """The metrics of a full run, and its steps."""

    def __init__(self, ctx: Context, most: int = 1):
        self.ctx, self.metrics, self.most = ctx, [], most

    def note_failure(self, name: str, error: Exception) -> None:
        log.warning("step %s failed", name, exc_info=error)
        self.metrics.append((name, "failed", 0, 0, 0, 0, 0, _text(error)))

    def step(self, name: str, build: Callable[[], DataFrame], critical: bool = False) -> None:
        try:
            counts = _save(self.ctx, name, build())
            failed = self.ctx.failed(name)
        except Exception as error:  # noqa: BLE001 - a step may fail for any reason
            self.ctx.touched.pop(name, None)
            self.ctx.placed.discard(name)
            if name != "activities":  # those were counted when they were staged
                self.ctx.rejected.pop(name, None)
                self.ctx.forget(name)
            if critical:
                log.warning("step %s failed", name, exc_info=True)
                raise LoadFailed(name) from error
            self.note_failure(name, error)
            return
        done = counts[INSERTED] + counts[UPDATED]
        self.metrics.append((name, "done", done + failed, counts[INSERTED], counts[UPDATED],
                             counts[KEPT], failed, None))

    def activities(self) -> None:
        """Every type alone: one that cannot be read is recorded and the others are loaded."""
        ctx = self.ctx
        records = activity_records(ctx, lambda kind, error: self.note_failure(DETAIL_TABLES[kind], error), self.most)
        if not records:
            return
        self.step("activities", lambda: load_activities(ctx, records))
        stored = ctx.read("activities")
        side_by_side(ctx.spark, [lambda: self.step("activity_associations", lambda: load_activity_edges(ctx, records, stored)), *[
            lambda kind=kind: self.step(DETAIL_TABLES[kind], lambda: load_details(ctx, kind, records, stored))
            for kind in records]], self.most)

    def timeline(self) -> None:
        """All families in one pass; if that fails, each alone, and those that can be made are merged."""
        ctx, table = self.ctx, "contact_activity_timelines"

        def alone() -> DataFrame:
            made = {}
            for name, events in timeline_families(ctx, apart=True).items():
                try:
                    made[name] = ctx.stage(events, f"events-{name}")
                except Exception as error:  # noqa: BLE001 - a family may fail for any reason
                    self.note_failure(f"{table}: {name}", error)
            return _timeline(ctx, made)

        before = len(self.metrics)
        self.step(table, lambda: build_timeline(ctx))
        if self.metrics[-1][1] == "failed":
            del self.metrics[before:]
            self.step(table, alone)

    def rejects(self) -> None:
        """Write what this run rejected, from the steps that counted any."""
        ctx, rows = self.ctx, empty_table(self.ctx.spark, "rejected")
        for name, bad in ctx.rejected.items():
            if ctx.failed(name):
                rows = rows.unionByName(bad)
        ctx.tables.write(rows, "rejected")


def _steps(ctx: Context, run: _Run, rebuild: bool) -> None:
    """All steps of a full run, as :func:`run_full` says."""
    tables = ctx.tables
    if rebuild:
        tables.recreate()
    try:
        side_by_side(ctx.spark, [lambda name=name, load=load: run.step(name, lambda: load(ctx), critical=True)
                                 for name, load in (("contacts", load_contacts), ("companies", load_companies),
                                                    ("deals", load_deals), ("tickets", load_tickets))], run.most)
    except LoadFailed:
        tables.roll_back()
        raise
    tables.begin()  # what is done so far stays, whatever follows
    loads = [("contact_company_associations", load_contact_company_edges), ("object_associations", load_object_edges),
             ("property_histories", load_property_history)]
    loads += [(name, load) for name, load in (("communications", load_communications), ("emails", load_emails),
                                              ("notes", load_notes)) if name in ctx.landed.objects]
    side_by_side(ctx.spark, [run.activities, *[lambda name=name, load=load: run.step(name, lambda: load(ctx))
                                    for name, load in loads]], run.most)
    run.timeline()
    run.rejects()


def run_full(ctx: Context, rebuild: bool = False, keep: int = 2, most: int = 4) -> DataFrame:
    """One full run over the stored tables. Returns one metrics row per step.

    Steps that do not need each other's tables run side by side, ``most`` at a time: first contacts,
    companies, deals and tickets, then all others, activities before their details and edges, and the timeline
    last. A type that has not landed is an empty snapshot. If contacts, companies, deals or tickets fail, what
    the run has written is taken back, emptied tables of a rebuild included, and :class:`LoadFailed` is raised;
    any other step, activity type or family of events that fails is recorded and the run goes on. Rejected rows
    are stored in the table ``rejected``. ``keep`` versions of every table stay.
    """
    tables, run = ctx.tables, _Run(ctx, most)
    tables.begin()
    try:
        with shuffles_end_with_queries(ctx.spark):
            _steps(ctx, run, rebuild)
        for table in TABLES:
            tables.prune(table, keep)
    finally:
        ctx.shared.clear()
        tables.drop_staged()
    place = {name: k for k, name in enumerate(TABLES)}
    run.metrics.sort(key=lambda m: place.get(m[0].split(":")[0], len(place)))
    return ctx.spark.createDataFrame(run.metrics, METRICS)


__all__ = ["ALL_EVENTS", "CHANGED_EVENTS", "Context", "FAIL", "HISTORY_PROPERTIES", "Landed", "LoadFailed", "OBJECT_PAIRS", "QUARANTINE", "RulesBroken",
           "activity_records", "build_timeline", "contact_company_diagnostics", "load_activities",
           "load_activity_edges", "load_communications", "load_companies",
           "load_contact_company_edges", "load_contacts", "load_deals", "load_details",
           "load_emails", "load_notes", "load_object_edges", "load_property_history",
           "load_tickets", "run_full", "timeline_events", "timeline_families"]
