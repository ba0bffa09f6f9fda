"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Main path: DataFrame functions only. One pattern finds candidates; each is validated by kind (octet
range, Luhn, IBAN modulo 97, calendar date, digit counts) and, if valid, its symbols are permuted by
a Feistel network of ROUNDS rounds keyed with SHA-256, each symbol in its own radix: digits by 10,
letters of an e-mail's local part by 26, octets by 256, days of a two-century window by 270 * 270,
the three parts of a social security number by the number of values that are valid for each.
Punctuation, case, length, country codes and domains stay; check digits are made anew. The
permutation depends on kind, key and value only, so equal values get equal pseudonyms in every
document and different values different ones (per kind and length), and valid ones stay valid.
Dates of all forms have one permutation of days. Dates with slashes are read day first, or month
first where only that can be; so that such a one can be written, and read, month first again, the
permutation walks on until it meets a day after the 12th for one after the 12th, and another for the
others. Country codes are told by the world's
numbering plan, so spaces in a number do not matter; a national number keeps its leading zero.

The key is given at run time: by argument, or for the registered queries by the session setting
KEY_SETTING. Without it a known key is used with a warning; its pseudonyms protect nobody.

A null text stays null with counts of 0; an empty one stays empty; invalid candidates stay as they
are; repeated rows are treated alike; other columns are kept, whatever their names, but for one
named like the added map of counts (out_col), which it replaces.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm.common import fresh

ROUNDS, WALK = 8, 128  # a walk ends by chance after two or three steps; the chance of more than WALK is below 1e-27
KEY_SETTING = "spark.leadflow.pseudonymKey"
DAYS, SIDE = 72_900, 270  # 1900-01-01 and the 72,899 days after it

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)(?![A-Za-z_])"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w.+-])(?:\d{13,19}|\d{4}([ -])\d{4}\g\d{4}\g\d{1,7}|\d{4}([ -])\d{6}\h\d{5})(?![\w-])"
PHONE = r"(?<![\w+(])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|0\d{2,4}[ -]\d{3,4}[ -]?\d{3,4})(?![\w-])"
# Forms of the country codes of the world's telephone numbering plan; all others have three digits.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD = CARD.replace(r"\g", r"\1").replace(r"\h", r"\2")  # the pattern's own groups come first below
ANY = "|".join((CARD, EMAIL, IP, DATE, SSN, IBAN, PHONE))
KINDS = ("email", "ip", "date", "ssn", "card", "iban", "phone")


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def chars(c: Column) -> Column:
    return F.split(c, "")


def luhn_sum(number: Column, shift: int) -> Column:
    """Luhn sum of a digit string; shift 1 if its check digit is missing."""
    worth = lambda d, i: F.when((i + shift) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    values = F.transform(chars(F.reverse(number)), lambda ch, i: worth(ch.cast("int"), i))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def mod97(text: Column) -> Column:
    """A string of digits and capitals (A = 10 ...) as a number, modulo 97."""
    step = lambda a, ch: F.when(ch.rlike("[0-9]"), (a * 10 + ch.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97)
    return F.aggregate(chars(text), F.lit(0), step)


def feistel(symbols: Column, radixes: Column, key: str, kind: Column) -> Column:
    """Permute an array of symbols, each within its radix; the halves change in turns."""
    half = F.floor(F.size(symbols) / 2).cast("int")

    def turn(acc, k):
        first = k % 2 == 0
        other = F.when(first, F.slice(acc, half + 1, F.size(symbols))).otherwise(F.slice(acc, F.lit(1), half))
        seed = F.concat_ws(":", F.lit(key), kind, k.cast("string"), F.size(symbols).cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ","))
        move = lambda h, x, i: F.pmod(x + F.conv(F.substr(h, (4 * (i % 16) + 1).cast("int"), F.lit(4)), 16, 10).cast("int"), F.get(radixes, i))
        return let(F.sha2(seed, 256), lambda h: F.transform(acc, lambda x, i: F.when((i < half) == first, move(h, x, i)).otherwise(x)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, turn)


def permuted_chars(match: Column, movable: Column, key: str, kind: Column) -> Column:
    """The match with its movable characters (an array of flags) permuted in their classes."""

    def with_flags(on):
        c = chars(match)
        picked = F.filter(F.arrays_zip(c.alias("c"), on.alias("on")), lambda z: z["on"])
        letter = lambda ch: ch.rlike("[A-Za-z]")
        symbol = F.transform(picked, lambda z: F.when(letter(z["c"]), F.ascii(F.lower(z["c"])) - 97).otherwise(F.ascii(z["c"]) - 48))
        radix = F.transform(picked, lambda z: F.when(letter(z["c"]), 26).otherwise(10))

        def fill(new):
            rank = lambda i: F.size(F.filter(F.slice(on, F.lit(1), i + 1), lambda x: x)) - 1
            put = lambda ch, v: F.when(ch.rlike("[a-z]"), F.char(v + 97)).when(ch.rlike("[A-Z]"), F.char(v + 65)).otherwise(F.char(v + 48))
            return F.array_join(F.transform(c, lambda ch, i: F.when(F.get(on, i), put(ch, F.get(new, rank(i)))).otherwise(ch)), "")

        return let(feistel(symbol, radix, key, kind), fill)

    return let(movable, with_flags)


def _flags(match: Column, movable, first: Column | int = 0, last: Column | None = None) -> Column:
    """Flags of the characters that `movable` accepts, from place first up to place last."""
    inside = lambda i: (i >= first) if last is None else (i >= first) & (i < last)
    return F.transform(chars(match), lambda ch, i: ch.rlike(movable) & inside(i))


def kind_of(m: Column) -> Column:
    """The kind of a candidate if it is valid, else null."""
    n = F.length(digits(m))
    octets = F.forall(F.split(m, r"\."), lambda o: o.try_cast("int") <= 255)
    bban = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substr(bban, F.lit(5), F.length(bban)), F.substr(bban, F.lit(1), F.lit(4)))
    day = days_of(m)
    return (
        F.when(m.contains("@"), F.when(F.split_part(m, F.lit("@"), F.lit(1)).rlike("[A-Za-z0-9]"), "email"))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(octets, "ip"))
        .when(m.rlike(r"^(\d{4}([-/])\d{2}\2\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{2}\.\d{2}\.\d{4})$"), F.when((day >= 0) & (day < DAYS), "date"))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(~m.rlike(r"^(000|666|9)") & ~m.rlike(r"-00-|-0000$"), "ssn"))
        .when(m.rlike(r"^[A-Z]{2}\d{2}"), F.when(F.length(bban).between(15, 34) & (mod97(turned) == 1), "iban"))
        .when(m.rlike(r"^\d[\d -]*$") & n.between(13, 19), F.when(luhn_sum(digits(m), 0) % 10 == 0, "card"))
        .when(n.between(7, 15), "phone")
    )


def month_first(m: Column) -> Column:
    """Whether a date with slashes can only be read month first."""
    return m.rlike(r"^(0?[1-9]|1[0-2])/(1[3-9]|2[0-9]|3[01])/")


def days_of(m: Column) -> Column:
    day = F.coalesce(
        F.when(m.rlike(r"^\d{4}-"), F.try_to_timestamp(m, F.lit("yyyy-MM-dd"))),
        F.when(m.rlike(r"^\d{4}/"), F.try_to_timestamp(m, F.lit("yyyy/MM/dd"))),
        F.when(month_first(m), F.try_to_timestamp(m, F.lit("M/d/yyyy"))),
        F.when(m.rlike(r"^\d{1,2}/"), F.try_to_timestamp(m, F.lit("d/M/yyyy"))),
        F.when(m.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.try_to_timestamp(m, F.lit("dd.MM.yyyy"))),
    )
    return F.datediff(day.cast("date"), F.lit("1900-01-01").cast("date"))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid candidate of a kind."""
    num = permuted_chars

    def card(x):
        body = num(x, _flags(x, "[0-9]", 0, F.length(x) - 1), key, kind)
        part = F.substr(body, F.lit(1), F.length(body) - 1)
        return let(part, lambda p: F.concat(p, F.pmod(-luhn_sum(digits(p), 1), F.lit(10)).cast("string")))

    def iban(x):
        body = num(x, _flags(x, "[0-9]", 4), key, kind)

        def check(b):
            plain = F.regexp_replace(b, " ", "")
            rest = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(2)), F.lit("00"))
            return F.concat(F.substr(b, F.lit(1), F.lit(2)), F.lpad((98 - mod97(rest)).cast("string"), 2, "0"), F.substr(b, F.lit(5), F.length(b)))

        return let(body, check)

    def ip(x):
        octets = F.transform(F.split(x, r"\."), lambda o: o.try_cast("int"))
        return F.array_join(F.transform(feistel(octets, F.array_repeat(F.lit(256), 4), key, kind), lambda o: o.cast("string")), ".")

    def date(x):
        def moved(d):
            parts = F.array(F.floor(d / SIDE).cast("int"), (d % SIDE).cast("int"))
            return let(feistel(parts, F.array_repeat(F.lit(SIDE), 2), key, kind), lambda v: (F.get(v, F.lit(0)) * SIDE + F.get(v, F.lit(1))).cast("int"))

        on = lambda d: F.date_add(F.lit("1900-01-01").cast("date"), d)
        late = lambda d: F.dayofmonth(on(d)) > 12
        walk = lambda start: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), moved(start), lambda d, _: F.when(late(d) == late(start), d).otherwise(moved(d)))
        day = on(let(days_of(x), walk))
        wide, first = x.rlike(r"^\d{2}/\d{2}/"), month_first(x)
        return (
            F.when(x.rlike(r"^\d{4}-"), F.date_format(day, "yyyy-MM-dd"))
            .when(x.rlike(r"^\d{4}/"), F.date_format(day, "yyyy/MM/dd"))
            .when(x.contains("/") & wide, F.when(first, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd/MM/yyyy")))
            .when(x.contains("/"), F.when(first, F.date_format(day, "M/d/yyyy")).otherwise(F.date_format(day, "d/M/yyyy")))
            .otherwise(F.date_format(day, "dd.MM.yyyy"))
        )

    def ssn(x):
        """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
        area = F.substr(x, F.lit(1), F.lit(3)).try_cast("int")
        parts = F.array(area - 1 - (area > 666).cast("int"), F.substr(x, F.lit(5), F.lit(2)).try_cast("int") - 1, F.substr(x, F.lit(8), F.lit(4)).try_cast("int") - 1)
        radixes = F.array(F.lit(898), F.lit(99), F.lit(9999))
        shown = lambda v: F.format_string("%03d-%02d-%04d", F.get(v, F.lit(0)) + 1 + (F.get(v, F.lit(0)) >= 665).cast("int"), F.get(v, F.lit(1)) + 1, F.get(v, F.lit(2)) + 1)
        return let(feistel(parts, radixes, key, kind), shown)

    country = F.when(m.startswith("+"), F.length(F.regexp_extract(m, COUNTRY, 0))).when(m.startswith("0"), 1).otherwise(0)
    return (
        F.when(kind == "email", num(m, _flags(m, "[0-9A-Za-z]", 0, F.locate("@", m) - 1), key, kind))
        .when(kind == "ip", ip(m))
        .when(kind == "date", date(m))
        .when(kind == "card", card(m))
        .when(kind == "iban", iban(m))
        .when(kind == "ssn", ssn(m))
        .when(kind == "phone", num(m, _flags(m, "[0-9]", country), key, kind))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """docs with the text's personal data replaced, and in out_col a map of kind to count."""
    text = F.col(text_col)
    may = text.rlike("[0-9@]")
    values, kinds, hit = fresh(docs, "values", "kinds", "hit")
    found = docs.withColumn(values, F.when(may, F.regexp_extract_all(text, F.lit(ANY), 0)))
    found = found.withColumn(kinds, F.transform(values, kind_of))
    found = found.withColumn(hit, F.coalesce(F.exists(F.col(kinds), lambda k: k.isNotNull()), F.lit(False)))
    new = F.transform(values, lambda m, i: F.coalesce(pseudonym(m, F.get(F.col(kinds), i), key), m))
    between = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(between, F.array_append(new, F.lit("")), lambda a, b: F.concat(a, b)), "")
    found = found.withColumn(text_col, F.when(F.col(hit), joined).otherwise(text))
    is_kind = lambda k: lambda v: v == k
    counts = F.create_map(*[x for k in KINDS for x in (F.lit(k), F.when(F.col(hit), F.size(F.filter(kinds, is_kind(k)))).otherwise(0).cast("long"))])
    return found.withColumn(out_col, counts).drop(values, kinds, hit)


def session_key(spark: SparkSession) -> str:
    """The key of the session setting."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are made with a known key", stacklevel=2)
    return key or "known"


def op8_query(docs: DataFrame, key: str | None = None) -> DataFrame:
    """(doc_id, text, n_chars, n_found and n_<kind>): the pseudonymised whole text per document."""
    out = pseudonymise(docs.select("doc_id", "text"), key or session_key(docs.sparkSession))
    kinds = [F.col("pii")[k].alias(f"n_{k}") for k in KINDS]
    total = F.aggregate(F.map_values("pii"), F.lit(0).cast("long"), lambda a, b: a + b)
    return out.select("doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), total.alias("n_found"), *kinds)
