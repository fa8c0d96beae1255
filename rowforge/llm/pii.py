"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Numbers and dates that pass validation (card numbers by their check digit, telephone numbers by their grouping, social security
numbers, IPv4 addresses, calendar dates, e-mail addresses) go through a keyed Feistel
permutation of their own domain: the result has the same format and passes the same
validation, and equal values become equal pseudonyms in every document. Separators
stay, so one number written in two formats keeps the link.

Null texts stay null, empty ones empty, and text without such values is unchanged. Every row is handled by
itself, repeated rows alike; all other columns are kept, but n_candidates is replaced.

Formats covered are the patterns below: telephone numbers of ten digits in groups of 3-3-4, with or without a country code
(known by that shape, as they have no check digit), dates as year-month-day or day first with points or slashes.
Other spellings, such as dates with the month first or ten digits in one run, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# What candidates look like, most specific first.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
DATE = r"(?<![\d.-])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])|(?<![\d./])(?:0[1-9]|[12]\d|3[01])[./](?:0[1-9]|1[0-2])[./](?:19|20)\d\d(?!\d)"
ADDRESS = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
SOCIAL = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
# a run of digit groups that may hold cards beside other numbers, up to where another kind begins
CARD = rf"(?<!\d)\d(?:[ -]?+(?!{DATE}|{ADDRESS}|{SOCIAL}|{PHONE}|(?<!\d)[A-Za-z0-9._%+-]++@)\d){{12,}}+"
GROUPED = r"^(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19})$"
LOOSE = r"^\d{3,}(?:[ -]\d{3,})*$"
ANY = "|".join((EMAIL, DATE, ADDRESS, SOCIAL, PHONE, CARD))


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the pairs (left, right), left below left_size and right below right_size.

    Sides take turns in having a keyed hash of the other added, modulo their size.
    """

    def noise(k: Column, other: Column, size: Column) -> Column:
        text = F.concat_ws(":", F.lit(key), F.lit(kind), k.cast("string"), left_size.cast("string"), right_size.cast("string"), other.cast("string"))
        return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("bigint"), size)

    def step(s, k):
        even = k % 2 == 0
        l = F.when(even, F.pmod(s["l"] + noise(k, s["r"], left_size), left_size)).otherwise(s["l"])  # noqa: E741
        r = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + noise(k, s["l"], right_size), right_size))
        return F.struct(l.cast("bigint").alias("l"), r.cast("bigint").alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), start, step)


def digits(number: Column, key: str, kind: str) -> Column:
    """A digit string permuted among those of its length (2 to 36 digits)."""
    n = F.length(number)
    half = F.floor(n / 2).cast("int")
    sizes = [F.rpad(F.lit("1"), m + 1, "0").cast("bigint") for m in (half, n - half)]
    out = feistel(F.substr(number, F.lit(1), half).cast("bigint"), F.substr(number, half + 1).cast("bigint"), sizes[0], sizes[1], key, kind)
    return F.concat(F.lpad(out["l"].cast("string"), half, "0"), F.lpad(out["r"].cast("string"), n - half, "0"))


def luhn_sum(number: Column) -> Column:
    """The weighted digit sum, the last digit counting once."""
    chars = F.split(F.reverse(number), "")
    weighed = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x.cast("int"))


def refilled(shape: Column, new: Column) -> Column:
    """``shape`` with its digits replaced in order by those of ``new``."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct((s["at"] + 1).alias("at"), F.concat(s["out"], F.substr(new, s["at"], F.lit(1))).alias("out"))).otherwise(F.struct(s["at"].alias("at"), F.concat(s["out"], c).alias("out")))
    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def valid(number: Column) -> Column:
    plain = F.regexp_replace(number, r"[^0-9]", "")
    return F.when(F.length(plain).between(13, 19), luhn_sum(plain) % 10 == 0).otherwise(False)


def permuted(number: Column, key: str) -> Column:
    plain = F.regexp_replace(number, r"[^0-9]", "")
    body = digits(F.substr(plain, F.lit(1), F.length(plain) - 1), key, "card")
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return refilled(number, F.concat(body, check))


def cards_within(found: Column, key: str, shape: str) -> Column:
    """``found`` with each valid number of the shape, made of whole groups of digits, permuted; the leftmost and longest first."""
    groups = F.regexp_extract_all(found, F.lit(r"[0-9]+[ -]?"), F.lit(0))

    def scan(g):
        def step(s, i):
            spans = F.transform(F.sequence(F.lit(6), F.lit(1), F.lit(-1)), lambda k: F.regexp_replace(F.array_join(F.slice(g, i, k), ""), "[ -]$", ""))
            number = F.get(F.filter(spans, lambda x: F.when(x.rlike(shape), valid(x)).otherwise(False)), F.lit(0))

            def put(x):
                after = i + F.size(F.split(x, "[ -]"))
                behind = F.regexp_extract(F.element_at(g, after - 1), "[ -]$", 0)
                found = F.struct(after.alias("at"), F.concat(s["out"], permuted(x, key), behind).alias("out"))
                return F.when(x.isNull(), F.struct((i + 1).alias("at"), F.concat(s["out"], F.element_at(g, i)).alias("out"))).otherwise(found)

            return F.when(i < s["at"], s).otherwise(F.transform(F.array(number), put)[0])

        return F.aggregate(F.sequence(F.lit(1), F.size(g)), F.struct(F.lit(1).alias("at"), F.lit("").alias("out")), step, lambda s: s["out"])

    return F.transform(F.array(groups), scan)[0]


def card(found: Column, key: str) -> Column:
    """Numbers grouped as cards are, or else the whole run, or else any valid part of groups of three digits or more."""
    def pick(grouped):
        return F.when(grouped != found, grouped).when(valid(found), permuted(found, key)).otherwise(cards_within(found, key, LOOSE))

    return F.transform(F.array(cards_within(found, key, GROUPED)), pick)[0]


def phone(found: Column, key: str) -> Column:
    """The last ten digits change; a country code stays."""
    plain = F.regexp_replace(found, r"[^0-9]", "")
    code = F.substr(plain, F.lit(1), F.length(plain) - 10)
    return refilled(found, F.concat(code, digits(F.substr(plain, F.length(plain) - 9), key, "phone")))


def social(found: Column, key: str) -> Column:
    """The serial numbers 0001 to 9999 and groups 01 to 99 change, the area stays."""
    out = feistel(F.substring(found, 5, 2).cast("bigint") - 1, F.substring(found, 8, 4).cast("bigint") - 1, F.lit(99), F.lit(9999), key, "social")
    return F.concat(F.substring(found, 1, 4), F.lpad((out["l"] + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((out["r"] + 1).cast("string"), 4, "0"))


def address(found: Column, key: str) -> Column:
    part = lambda k: F.element_at(F.split(found, r"\."), k).cast("bigint")
    out = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, "address")
    return F.concat_ws(".", *[x.cast("string") for side in ("l", "r") for x in (F.floor(out[side] / 256), out[side] % 256)])


def date(found: Column, key: str) -> Column:
    """Days from 1900-01-01 to 2099-12-31: 73,049 of them, 319 times 229."""
    iso = found.rlike(r"^\d{4}-")
    sep = F.substring(found, 3, 1)
    day = F.try_to_date(F.when(iso, found).otherwise(F.concat_ws("-", F.substring(found, 7, 4), F.substring(found, 4, 2), F.substring(found, 1, 2))), "yyyy-MM-dd")
    n = F.date_diff(day, F.lit("1900-01-01").cast("date"))
    out = feistel(F.floor(n / 229), n % 229, F.lit(319), F.lit(229), key, "date")
    new = F.date_add(F.lit("1900-01-01").cast("date"), (out["l"] * 229 + out["r"]).cast("int"))
    european = F.concat_ws("", F.date_format(new, "dd"), sep, F.date_format(new, "MM"), F.substring(found, 6, 1), F.date_format(new, "yyyy"))
    return F.when(day.isNull(), found).when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(european)


def email(found: Column, key: str) -> Column:
    """Letters of the local part shift in their alphabet, digits among digits, by a keyed permutation of the whole."""
    local, host = F.lower(F.substring_index(found, "@", 1)), F.substring_index(found, "@", -1)
    chars = F.split(local, "")
    n = F.size(chars)

    def step(out, k):
        # each side of the name is shifted by a keyed hash of the other side: a Feistel round on symbols
        half = F.floor(n / 2).cast("int")
        own = (k % 2 == 0)
        other = F.array_join(F.when(own, F.slice(out, half + 1, n - half + 1)).otherwise(F.slice(out, 1, half)), "")
        mark = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), k.cast("string"), n.cast("string"), other), 256)

        def shift(c, i):
            by = F.conv(F.substring(F.sha2(F.concat_ws(":", mark, i.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
            place = F.ascii(c)
            moved = F.when(place.between(97, 122), F.char((F.pmod(place - 97 + by, F.lit(26)) + 97).cast("bigint"))).when(place.between(48, 57), F.char((F.pmod(place - 48 + by, F.lit(10)) + 48).cast("bigint"))).otherwise(c)
            return F.when(own == (i < half), moved).otherwise(c)

        return F.transform(out, shift)

    mixed = F.aggregate(F.array(*[F.lit(k) for k in range(4)]), chars, step)
    # a name of one symbol is moved on by a keyed hash of its host, never to itself
    turn = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), host), 256), 1, 8), 16, 10).cast("bigint")
    on = lambda c, low, many: F.char((F.pmod(F.ascii(c) - low + 1 + F.pmod(turn, F.lit(many - 1)), F.lit(many)) + low).cast("bigint"))
    single = F.transform(chars, lambda c: F.when(F.ascii(c).between(97, 122), on(c, 97, 26)).when(F.ascii(c).between(48, 57), on(c, 48, 10)).otherwise(c))
    return F.concat(F.array_join(F.when(n > 1, mixed).otherwise(single), ""), F.lit("@"), host)


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one candidate, or the candidate itself where it is not valid."""
    whole = lambda pattern: found.rlike(f"^(?:{pattern})$")
    return (
        F.when(found.contains("@"), email(found, key))
        .when(whole(DATE), date(found, key))
        .when(whole(ADDRESS), address(found, key))
        .when(whole(SOCIAL), social(found, key))
        .when(whole(PHONE), phone(found, key))
        .otherwise(card(found, key))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, plus n_candidates."""
    held = F.col(text).rlike("[0-9@]")
    found = "_found"
    while found in docs.columns:
        found += "_"
    out = docs.withColumn(found, F.when(held, F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))))
    parts = F.split(F.col(text), ANY, -1)
    new = F.transform(found, lambda m: pseudonym(m, key))
    clean = F.array_join(F.zip_with(parts, new, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    out = out.withColumn("n_candidates", F.coalesce(F.size(found), F.lit(0)))
    return out.withColumn(text, F.when(F.size(found) > 0, clean).otherwise(F.col(text))).drop(found)
