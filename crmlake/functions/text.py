"""Text expressions: blanks, markup, names, optional suffixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from crmlake.model.objects import SINGULAR

_EDGES = r"(?U)^\s+|\s+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, also where ``then`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), then), 0)


def not_blank(c: Column | str) -> Column:
    """True where the value holds a non-space character; never null."""
    return F.coalesce(col(c).rlike(r"(?U)\S"), F.lit(False))


def not_empty(c: Column | str) -> Column:
    """True where the value is neither null nor the empty string; never null."""
    return F.coalesce(F.length(col(c)) > 0, F.lit(False))


def trimmed(c: Column | str) -> Column:
    """Trim white space of every kind; Spark's own trim removes spaces only."""
    return F.regexp_replace(col(c), _EDGES, "")


def strip_html(c: Column | str) -> Column:
    """Line-break tags to newlines, other tags removed, then trimmed. Blank passes through."""
    lines = F.regexp_replace(col(c), r"<(br|BR)\s*/?>", "\n")
    plain = trimmed(F.regexp_replace(lines, r"(?s)<.*?>", ""))
    return F.when(not_blank(c), plain).otherwise(col(c))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Null where both parts are empty, else the trimmed pair."""
    pair = trimmed(F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "),
                            F.coalesce(col(last), F.lit(""))))
    return F.when(not_empty(first) | not_empty(last), pair)


def suffix(before: str, c: Column | str, after: str = "") -> Column:
    """An optional piece of a sentence: empty where the value is null or empty."""
    return F.when(not_empty(c), F.concat(F.lit(before), col(c), F.lit(after))).otherwise("")


def is_primary(label: Column | str) -> Column:
    return F.coalesce(F.lower(col(label)).contains("primary"), F.lit(False))


def singular(object_type: Column | str) -> Column:
    """Singular object type. Known names by table, others lose a trailing "s"."""
    name = F.lower(col(object_type))
    known = F.create_map(*[F.lit(x) for pair in SINGULAR.items() for x in pair])
    # "sms" is its own singular, so only the names outside the table are shortened
    shortened = F.when(name.isin(*SINGULAR.values()), name).otherwise(
        F.regexp_replace(col(object_type), "[sS]$", ""))
    return F.coalesce(known[name], shortened)


def label_list(labels: Column, primary: Column | str) -> Column:
    """Primary label first, then the others; a label that differs only in case comes once."""
    head = col(primary).cast("string")
    # a primary label that already stands first is not put before itself: most lists then hold one label,
    # which has nothing to compare
    first = not_blank(head) & ~F.coalesce(head == F.get(labels, F.lit(0)), F.lit(False))
    all_ = F.when(first, F.concat(F.array(head), labels)).otherwise(labels)
    return let(all_, lambda all_: F.when(F.size(all_) <= 1, all_).otherwise(F.filter(
        all_, lambda x, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda seen: F.lower(seen) == F.lower(x)))))


def labels_json(labels: Column, primary: Column | str) -> Column:
    """JSON array of :func:`label_list`; null where it is empty."""
    return let(label_list(labels, primary), lambda merged: F.when(F.size(merged) > 0, F.to_json(merged)))
