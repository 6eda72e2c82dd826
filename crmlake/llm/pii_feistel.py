"""Format-preserving pseudonyms of personal data, with DataFrame functions only.

Validated numbers and dates are permuted under a key within their format by a Feistel network over
two residues: each of ``ROUNDS`` rounds adds to one residue a keyed digest of the other. The network
is a permutation, so different values stay different, and equal values get equal pseudonyms in all
documents.

    payment card   13-19 digits that pass the Luhn test, alone or among other numbers of a run of digit
                   groups; the pseudonym passes it too
    phone          North American numbers, and +country numbers of 8-15 digits (country code kept)
    social number  ddd-dd-dddd with a valid area, group and serial
    IPv4 address   four octets
    date           yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy or dd/mm/yyyy from 1900-01-01 to 2100-06-16

E-mail addresses and credentials (access key ids, values assigned to a password, token, secret or API
key, its name in any case) have no numeric format; they get a keyed digest of a fixed shape, which also links equal values.
Digits that fail the validation are left as they are.

Defined cases: a null text stays null, an empty one empty; a text without a find is returned as it
is; texts are of any length; repeated rows get equal rows; all other columns are kept, whatever their
names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
KEY = "a key that the owner of the data keeps"

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"
_ASSIGNED = r"(?i:password|passwd|token|secret|api_key|apikey) {0,2}[=:] {0,2}[\"']?"
_SECRET = (r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
           rf"|(?<={_ASSIGNED})[A-Za-z0-9+/_-]{{12,}}+")
_IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
_ISO = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
_DOTTED = r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9])"
_SLASHED = r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])"
_SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_NANP = (r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])"
         r"[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])")
#: A run of digit groups one separator apart, up to the next group that starts another find. Which groups
#: are cards is told in :func:`_cards`.
_RUN = (r"(?<![0-9A-Za-z])(?![0-9]{20})(?=[0-9](?:[ -]?[0-9]){12})[0-9]++"
        rf"(?:[ -](?!{'|'.join((_EMAIL, _IPV4, _ISO, _DOTTED, _SLASHED, _SOCIAL, _NANP))})[0-9]++)*+")
#: How cards are printed: unbroken, or in groups of 4-4-4-4, 4-6-5 or 4-6-4.
_PRINTED = r"^[ -]?(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
_ABROAD = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9])"
PATTERN = "|".join((_EMAIL, _SECRET, _IPV4, _ISO, _DOTTED, _SLASHED, _SOCIAL, _NANP, _RUN, _ABROAD))
#: What a text must hold to be searched at all.
HINT = "[0-9@]|AKIA|(?i:password|passwd|token|secret|api_key|apikey)"

_FIRST_DAY = "1900-01-01"
_DAYS = (256, 286)


def _digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]), 256)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """The pair (a, b) permuted within [0, left_size) x [0, right_size)."""
    def step(s: Column, i: Column) -> Column:
        f = F.conv(F.substring(_digest(key, kind, s["ma"], s["mb"], i, s["b"]), 1, 15), 16, 10).cast("long")
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(f, s["ma"]), s["ma"]).alias("b"),
                        s["mb"].alias("ma"), s["ma"].alias("mb"))

    zero = F.struct(*[c.cast("long").alias(n) for n, c in (
        ("a", left), ("b", right), ("ma", left_size), ("mb", right_size))])
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), zero, step)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("0")).cast("long")


def _pad(c: Column, width: Column) -> Column:
    return F.lpad(c.cast("string"), width, F.lit("0"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    u = F.floor(F.length(digits) / 2).cast("int")
    v = F.length(digits) - u
    ten = lambda n: F.pow(F.lit(10.0), n).cast("long")
    return _let(feistel(_number(F.substr(digits, F.lit(1), u)), _number(F.substr(digits, u + 1, v)),
                        ten(u), ten(v), key, kind),
                lambda s: F.concat(_pad(s["a"], u), _pad(s["b"], v)))


def _fill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    is_digit = lambda c: (c >= "0") & (c <= "9")
    return F.aggregate(
        F.split(m, ""), start,
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(is_digit(c), F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(is_digit(c), s["k"] + 1).otherwise(s["k"]).alias("k")),
        lambda s: s["out"])


def _luhn_sum(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b)


def _card(m: Column, key: str) -> Column:
    def replaced(digits: Column) -> Column:
        body = F.substr(digits, F.lit(1), F.length(digits) - 1)
        return _let(permute_digits(body, key, "card"), lambda new: _fill(m, F.concat(
            new, ((10 - _luhn_sum(F.concat(new, F.lit("0"))) % 10) % 10).cast("string"))))

    return _let(_digits(m), replaced)


def _is_card(m: Column) -> Column:
    return _let(_digits(m), lambda d: F.length(d).between(13, 19) & (_luhn_sum(d) % 10 == 0))


def _cards(m: Column, key: str) -> Column:
    """A run of digit groups with its cards replaced, the leftmost first.

    Groups as cards are printed go before other groupings, of which the longest is taken; these start with
    an issuer's digit or the run. Work grows with the length of the run: a card is at most 19 groups.
    """
    def spans(parts: Column, i: Column) -> Column:
        """[(groups, text)] of what starts at group i and has the digits of a card."""
        near = F.transform(F.slice(parts, i, 19), lambda x: F.substring(x, 1, 21))
        texts = F.transform(F.sequence(F.lit(1), F.size(near)), lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice(near, F.lit(1), k), "").alias("text")))
        return F.filter(texts, lambda x: (F.length(x["text"]) <= 38) & _is_card(x["text"]))

    def most(found: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(found, lambda x: x["k"])), F.lit(0))

    def judged(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: _let(spans(parts, i), lambda found: F.struct(
            most(F.filter(found, lambda x: x["text"].rlike(_PRINTED))).alias("printed"),
            F.transform(F.filter(found, lambda x: (i == 1) | x["text"].rlike("^[ -]?[2-6]")),
                        lambda x: x["k"]).alias("other"))))

    def chosen(groups: Column) -> Column:
        """[(first, last)] of the cards; an other grouping gives way to a printed one that starts in it."""
        printed = F.transform(groups, lambda g: g["printed"])

        def step(s: Column, i: Column) -> Column:
            g = F.element_at(groups, i)
            other = F.coalesce(F.array_max(F.filter(g["other"], lambda k: ~F.exists(
                F.slice(printed, i + 1, k - 1), lambda n: n > 0))), F.lit(0))
            size = F.when(i < s["free"], 0).when(g["printed"] > 0, g["printed"]).otherwise(other)
            return _let(size, lambda n: F.when(n == 0, s).otherwise(F.struct(
                (i + n).alias("free"), F.concat(s["taken"], F.array(F.struct(
                    i.alias("first"), (i + n - 1).alias("last")))).alias("taken"))))

        none = F.array().cast("array<struct<first:int,last:int>>")
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), F.struct(F.lit(1).alias("free"), none.alias("taken")),
                           step, lambda s: s["taken"])

    def written(parts: Column, taken: Column) -> Column:
        text = lambda a, b: F.array_join(F.slice(parts, a, F.greatest(b - a + 1, F.lit(0))), "")
        free = lambda i: F.coalesce(F.get(taken, i)["last"], F.lit(0)) + 1
        cards = F.transform(taken, lambda t, i: F.concat(
            text(free(i - 1), t["first"] - 1), _let(text(t["first"], t["last"]), lambda c: _card(c, key))))
        return F.concat(F.array_join(cards, ""), text(free(F.size(taken) - 1), F.size(parts)))

    return _let(F.regexp_extract_all(m, F.lit("[ -]?[0-9]+"), F.lit(0)), lambda parts: _let(
        _let(judged(parts), chosen), lambda taken: F.when(F.size(taken) == 0, m).otherwise(written(parts, taken))))


def _nanp(m: Column, key: str) -> Column:
    def replaced(ten: Column, head: Column) -> Column:
        area = _number(F.substr(ten, F.lit(1), F.lit(3))) - 200
        rest = (_number(F.substr(ten, F.lit(4), F.lit(3))) - 200) * 10000 + _number(F.substr(ten, F.lit(7), F.lit(4)))
        return _let(feistel(area, rest, F.lit(800), F.lit(8_000_000), key, "phone"), lambda s: _fill(m, F.concat(
            head, (s["a"] + 200).cast("string"), (F.floor(s["b"] / 10000) + 200).cast("string"),
            _pad(s["b"] % 10000, F.lit(4)))))

    return _let(_digits(m), lambda d: replaced(F.right(d, F.lit(10)), F.left(d, F.length(d) - 10)))


def _abroad(m: Column, key: str) -> Column:
    country = F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})", 1))
    kept = F.when(country > 2, 2).otherwise(country)
    return _let(_digits(m), lambda d: F.when(F.length(d).between(8, 15), _fill(m, F.concat(
        F.left(d, kept), permute_digits(F.substr(d, kept + 1, F.length(d)), key, "phone"))))
        .otherwise(m))


def _social(m: Column, key: str) -> Column:
    area, group, serial = (F.regexp_extract(m, r"^([0-9]{3})-([0-9]{2})-([0-9]{4})$", i).cast("long") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - F.when(area > 666, 2).otherwise(1)
    new = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "social")
    return F.when(valid, _let(new, lambda s: F.concat_ws(
        "-", _pad(s["a"] + F.when(s["a"] >= 665, 2).otherwise(1), F.lit(3)),
        _pad(F.floor(s["b"] / 9999) + 1, F.lit(2)), _pad(s["b"] % 9999 + 1, F.lit(4))))).otherwise(m)


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda c: c.cast("long"))
    return _let(octets, lambda o: _let(
        feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ipv4"),
        lambda s: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)])))


def _date(m: Column, key: str) -> Column:
    """The pseudonym keeps the order, the separator and the zero padding of the date."""
    p = F.transform(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), lambda c: c.cast("int"))

    def parts(n: Column) -> Column:
        us = m.contains("/") & (n[0] <= 12)
        return F.when(m.rlike("^[0-9]{4}-"), F.struct(n[0].alias("y"), n[1].alias("m"), n[2].alias("d"), F.lit(0).alias("o"))) \
            .when(us, F.struct(n[2].alias("y"), n[0].alias("m"), n[1].alias("d"), F.lit(1).alias("o"))) \
            .otherwise(F.struct(n[2].alias("y"), n[1].alias("m"), n[0].alias("d"), F.lit(2).alias("o")))

    def valid(s: Column) -> Column:
        leap = ((s["y"] % 4 == 0) & (s["y"] % 100 != 0)) | (s["y"] % 400 == 0)
        most = F.when(s["m"].isin(4, 6, 9, 11), 30).when(s["m"] != 2, 31).when(leap, 29).otherwise(28)
        return (s["m"].between(1, 12) & s["d"].between(1, most) & (s["y"] >= 1900)
                & (s["y"] * 10000 + s["m"] * 100 + s["d"] <= 21000616))

    def written(day: Column, s: Column) -> Column:
        padded = ~m.rlike("(?:^|[./])[0-9](?:[./]|$)")
        form = lambda f, g: F.when(padded, F.date_format(day, f)).otherwise(F.date_format(day, g))
        return F.when(s["o"] == 0, F.date_format(day, "yyyy-MM-dd")) \
            .when(s["o"] == 1, form("MM/dd/yyyy", "M/d/yyyy")) \
            .when(m.contains("/"), form("dd/MM/yyyy", "d/M/yyyy")).otherwise(form("dd.MM.yyyy", "d.M.yyyy"))

    def replaced(s: Column) -> Column:
        first = F.lit(_FIRST_DAY).cast("date")
        at = F.datediff(F.make_date(s["y"], s["m"], s["d"]), first)
        new = feistel(F.floor(at / _DAYS[1]), at % _DAYS[1], F.lit(_DAYS[0]), F.lit(_DAYS[1]), key, "date")
        return _let(new, lambda x: written(F.date_add(first, (x["a"] * _DAYS[1] + x["b"]).cast("int")), s))

    return _let(p, lambda n: _let(parts(n), lambda s: F.when(valid(s), replaced(s)).otherwise(m)))


def _whole(pattern: str) -> str:
    """The pattern for a string that is all of a find; what stood around the find is gone."""
    return f"^(?:{pattern})$"


def pseudonym(m: Column, key: str = KEY, assigned: Column | None = None) -> Column:
    """The pseudonym of one find of :data:`PATTERN`; ``assigned`` tells that it follows a credential's key word."""
    run = m.rlike(r"^[0-9](?:[ -]?[0-9]){12,}+$")
    if assigned is not None:
        run = run & (~assigned | _is_card(m))
    email = F.concat(F.lit("u"), F.substring(_digest(key, "email", F.lower(m)), 1, 16), F.lit("@example.invalid"))
    kinds = [(m.contains("@"), email), (m.rlike(_whole(_IPV4)), _ipv4(m, key)),
             (m.rlike(_whole("|".join((_ISO, _DOTTED, _SLASHED)))), _date(m, key)),
             (m.rlike(_whole(_SOCIAL)), _social(m, key)), (m.rlike(_whole(_NANP)), _nanp(m, key)),
             (run, _cards(m, key)), (m.rlike(_whole(_ABROAD)), _abroad(m, key))]
    out = F.when(*kinds[0])
    for condition, value in kinds[1:]:
        out = out.when(condition, value)
    return out.otherwise(F.concat(F.lit("secret"), F.substring(_digest(key, "secret", m), 1, 16)))


def pseudonymise(docs: DataFrame, text_column: str = "text", key: str = KEY,
                 count_column: str | None = None, changed_column: str | None = None) -> DataFrame:
    """The rows with every find in ``text_column`` replaced, over whole texts.

    ``count_column`` names a further column for the number of changed finds, ``changed_column`` one
    for whether the text was changed.
    """
    from crmlake.llm.shared import temporary

    text = F.col(f"`{text_column}`").cast("string")
    finds, new, gaps = temporary("finds", "new", "gaps", avoid=docs.columns)
    pattern = F.lit(PATTERN)
    has = F.size(F.col(finds)) > 0
    assigned = lambda i: F.coalesce(F.right(F.get(F.col(gaps), i), F.lit(24)).rlike(f"{_ASSIGNED}$"), F.lit(False))
    searched = docs.withColumn(finds, F.when(text.rlike(HINT), F.regexp_extract_all(text, pattern, F.lit(0)))) \
        .withColumn(gaps, F.when(has, F.split(text, PATTERN, -1))) \
        .withColumn(new, F.transform(F.col(finds), lambda m, i: pseudonym(m, key, assigned(i))))
    joined = F.array_join(F.flatten(F.transform(F.col(gaps), lambda g, i: F.array(
        g, F.coalesce(F.get(F.col(new), i), F.lit(""))))), "")
    out = searched
    changed = F.coalesce(F.size(F.filter(F.arrays_zip(F.col(finds).alias("a"), F.col(new).alias("b")),
                                         lambda z: z["a"] != z["b"])), F.lit(0))
    if count_column:
        out = out.withColumn(count_column, F.greatest(changed, F.lit(0)))
    if changed_column:
        out = out.withColumn(changed_column, changed > 0)
    return out.withColumn(text_column, F.when(has, joined).otherwise(text)).drop(finds, new, gaps)
