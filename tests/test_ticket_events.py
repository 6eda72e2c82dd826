"""The events of tickets made together equal those made apart, and read the pairs once."""

from crmlake import fixtures as X
from crmlake.operators.merge import empty_table
from crmlake.plans import loads as LD, timeline as TL


def rows(df):
    return sorted(map(str, df.collect()))


def test_ticket_events_together_equal_those_apart(spark):
    tickets = spark.sql("select * from values ('T1', 'one', 'open', 'o', timestamp '2024-01-01', timestamp '2024-01-02'), "
                        "('t2', null, '', null, null, timestamp '2024-01-02'), (null, 'x', 'y', 'z', null, null), "
                        "('t3', 'no contact', 's', 'o', null, null) "
                        "as t(source_id, ticket_name, ticket_status, ticket_owner, created_at, etl_date)")
    edges = spark.sql("select * from values ('contact', 'c1', 'ticket', 't1'), ('ticket', 'T1', 'contact', 'c1'), "
                      "('ticket', 'T2', 'contact', 'C2'), ('contact', 'c3', 'ticket', 't1'), ('deal', 'd', 'ticket', 't3'), "
                      "('contact', null, 'ticket', 't2'), ('contact', 'c4', 'ticket', null) "
                      "as t(source_object_type, source_object_id, target_object_type, target_object_id)")
    history = spark.sql("select 'ticket' as object_type, 'hs_pipeline_stage' as property_name, * from values "
                        "('t1', 'a', 'b', timestamp '2024-01-03'), ('T1', 'b', null, timestamp '2024-01-04'), "
                        "('t1', 'b', null, timestamp '2024-01-04'), ('t9', 'a', 'b', timestamp '2024-01-03'), "
                        "(null, 'a', 'b', timestamp '2024-01-03') as t(object_id, old_value, new_value, change_date)")
    linked = TL.ticket_contacts(tickets, edges)
    apart = TL.ticket_created(linked).unionByName(TL.ticket_changes(linked, history))
    assert apart.count() == 10
    assert rows(TL.ticket_events(tickets, edges, history)) == rows(apart)


def test_a_timeline_reads_the_pairs_once(spark):
    names = ("activities", "activity_associations", "tickets", "object_associations", "property_histories")
    stored = {n: empty_table(spark, n) for n in names}
    ctx = LD.Context(spark, LD.Landed(), X.AS_OF, stored=stored)
    assert set(LD.timeline_families(ctx)) == {"activities", "tickets", "lifecycle", "lead status"}
    assert set(LD.timeline_families(ctx, apart=True)) == {"activities", "tickets", "ticket changes", "lifecycle", "lead status"}
