"""Format-preserving pseudonyms by a keyed Feistel network, in native expressions.

Validated numbers and dates are permuted within their format, so equal values stay linked across
documents: card numbers of 13 to 19 digits that pass the mod-10 check keep their length, separators and check,
account numbers that pass the mod-97 check keep country, letters, length and spaces and get valid check digits,
telephone and personal numbers keep their length and separators, dates keep their layout and stay calendar
dates, host addresses (four octets up to 255 without leading zeros) are permuted as 32-bit values.  A value that
fails the check of its format (card, account number, date of no calendar, octet above 255) is no such value: it stays
and is not counted.  Mail addresses keep a keyed digest as name, so they stay linked too; as a digest
of 60 bits this is no permutation, and two of a million names meet with odds below 1e-6.

A text is cut into matches and the pieces between them; matches are mapped by one expression.
Defined cases: null stays null, empty stays empty; equal rows give equal results; extra columns pass
through and a column named like the result is replaced; long texts are mapped whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .text import let

ROUNDS = 8
#: Formats in the order in which alternatives are tried.
FORMATS = (
    # A name starts where its characters start, so a long run without @ is read once.
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    r"\b(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])\b",
    r"\b(?:\d{4}[ -]?){3}\d{1,7}\b",
    r"\b\d{3}-\d{2}-\d{4}\b",
    r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    r"(?<![\d\w])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}\b",
)
PATTERN = "|".join(f"(?:{x})" for x in FORMATS)


def _mix(key: str, round_: int, value: Column, low: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{key}:{round_}:"), low, F.lit(":"), value), 256)
    return F.conv(F.substring(digest, 1, 14), 16, 10).cast("decimal(20,0)")


def permute_digits(digits: Column, key: str) -> Column:
    """A keyed permutation of the digit strings of each length (two digits or more)."""
    left_n = (F.length(digits) / 2).cast("int")
    right_n = F.length(digits) - left_n
    state = F.struct(F.substr(digits, F.lit(1), left_n).alias("l"), F.substr(digits, left_n + 1).alias("r"))

    def step(s: Column, k: Column) -> Column:
        def turn(target: Column, by: Column, n: Column, name: int) -> Column:
            power = F.pow(F.lit(10.0), n).cast("decimal(20,0)")
            return F.lpad(F.pmod(target.cast("decimal(20,0)") + _mix(key, name, by, k.cast("string")), power).cast("decimal(20,0)").cast("string"), n, "0")

        even = F.struct(turn(s["l"], s["r"], left_n, 0).alias("l"), s["r"].alias("r"))
        odd = F.struct(s["l"].alias("l"), turn(s["r"], s["l"], right_n, 1).alias("r"))
        return F.when(k % 2 == 0, even).otherwise(odd)

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, step, lambda s: F.concat(s["l"], s["r"]))
    return F.when(F.length(digits) < 2, digits).otherwise(done)


def _check_sum(digits: Column) -> Column:
    """Mod-10 sum with the last digit undoubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def _card(digits: Column, key: str) -> Column:
    """A card number permuted but for its last digit, which is made to fit the check."""
    checked = lambda new: F.concat(new, ((10 - _check_sum(F.concat(new, F.lit("0")))) % 10).cast("string"))
    return let(permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key), checked)


def _mod97(account: Column) -> Column:
    """The account number, country and check digits last, read as a decimal number (A is 10), modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (a * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c)) % 97)


def _account(value: Column, key: str) -> Column:
    """An account number: its digits permuted, then its letters shifted by them, then new check digits."""

    def refilled(parts: Column) -> Column:
        def put(a: Column, c: Column) -> Column:
            number = c.rlike("^[0-9]$")
            by = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{key}:letter:"), parts["new"], F.lit(":"), F.length(a["out"]).cast("string")), 256), 1, 8), 16, 10).cast("bigint")
            letter = F.char(65 + (F.ascii(c) - 65 + by) % 26)
            new = F.when(number, F.substr(parts["new"], a["at"], F.lit(1))).otherwise(letter)
            return F.struct((a["at"] + number.cast("int")).alias("at"), F.concat(a["out"], new).alias("out"))

        body = F.aggregate(F.split(parts["body"], ""), F.struct(F.lit(1).alias("at"), F.lit("").alias("out")), put, lambda a: a["out"])
        country = F.substr(value, F.lit(1), F.lit(2))
        check = lambda b: F.lpad((98 - _mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0")
        return let(body, lambda b: F.concat(country, check(b), b))

    plain = F.replace(value, F.lit(" "), F.lit(""))
    body = F.substr(plain, F.lit(5))
    parts = F.struct(body.alias("body"), permute_digits(F.regexp_replace(body, "[^0-9]", ""), f"{key}:account").alias("new"))
    spaced = lambda new: F.aggregate(
        F.split(value, ""),
        F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
        lambda a, c: F.when(c == " ", F.struct(a["at"].alias("at"), F.concat(a["out"], c).alias("out"))).otherwise(F.struct((a["at"] + 1).alias("at"), F.concat(a["out"], F.substr(new, a["at"], F.lit(1))).alias("out"))),
        lambda a: a["out"],
    )
    return let(let(parts, refilled), spaced)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one, by ``digits``."""
    zero = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def put(a: Column, c: Column) -> Column:
        number = c.rlike("^[0-9]$")
        return F.struct((a["at"] + number.cast("int")).alias("at"), F.concat(a["out"], F.when(number, F.substr(digits, a["at"], F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.split(shape, ""), zero, put, lambda a: a["out"])


#: The dates that the pattern accepts, 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = "1900-01-01", 73049
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ADDRESS = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"


def _walked(value: Column, once: Callable[[Column], Column], outside: Callable[[Column], Column], steps: int) -> Column:
    """``once(value)``, and again while ``outside`` holds: the permutation within the values inside."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), once(value), lambda v, _: F.when(outside(v), once(v)).otherwise(v))


def _date(value: Column, key: str) -> Column:
    """A date permuted within the days of the pattern."""
    start = F.lit(FIRST_DAY).cast("date")
    days = F.datediff(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"), start)
    permuted = lambda d: permute_digits(d, f"{key}:date")
    # A step leaves the range with odds of 0.27, so 80 steps end inside but for odds below 1e-45.
    return F.date_add(start, _walked(F.lpad(days.cast("string"), 5, "0"), permuted, lambda x: x.cast("int") >= DAYS, 80).cast("int")).cast("string")


def _address(value: Column, key: str) -> Column:
    """A host address under a Feistel network over its 16-bit halves."""
    parts = F.transform(F.split(value, "\\."), lambda x: x.cast("bigint"))
    halves = let(parts, lambda p: F.struct((p[0] * 256 + p[1]).alias("l"), (p[2] * 256 + p[3]).alias("r")))

    def step(s: Column, k: Column) -> Column:
        turn = lambda target, by: F.pmod(target + _mix(f"{key}:ip", 0, by.cast("string"), k.cast("string")), F.lit(65536)).cast("bigint")
        return F.when(k % 2 == 0, F.struct(turn(s["l"], s["r"]).alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), turn(s["r"], s["l"]).alias("r")))

    octets = lambda s: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.shiftright(s[h], 8), s[h] % 256)])
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, step, octets)


def _personal(value: Column, key: str) -> Column:
    """A personal number permuted among the valid ones."""
    once = lambda v: _refill(v, permute_digits(F.regexp_replace(v, "-", ""), f"{key}:person"))
    # A step leaves the valid numbers with odds of 0.12, so 24 steps end inside but for odds below 1e-21.
    return _walked(value, once, lambda v: ~v.rlike(_PERSON), 24)


#: Kinds of a matched value, by its layout; the last one is every other value.
_LAYOUTS = (
    ("mail", "@"),
    ("date", r"^\d{4}-\d\d-\d\d$"),
    ("address", r"^(?:\d{1,3}\.){3}\d{1,3}$"),
    ("person", r"^\d{3}-\d{2}-\d{4}$"),
    ("account", r"^[A-Z]{2}\d{2}"),
    ("card", r"^(?:\d{4}[ -]?){3}\d{1,7}$"),
)
#: Personal numbers that are given out.
_PERSON = r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"


def _by_layout(value: Column, cases: dict[str, Column], other: Column) -> Column:
    chosen = F
    for kind, layout in _LAYOUTS:
        chosen = chosen.when(value.rlike(layout), cases[kind])
    return chosen.otherwise(other)


def is_valid(value: Column) -> Column:
    """Whether a matched value passes the check of its format."""
    cases = {
        "mail": F.lit(True),
        "date": F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).isNotNull(),
        "address": value.rlike(_ADDRESS),
        "person": value.rlike(_PERSON),
        "account": _mod97(F.replace(value, F.lit(" "), F.lit(""))) == 1,
        "card": _check_sum(F.regexp_replace(value, "[^0-9]", "")) == 0,
    }
    return _by_layout(value, cases, F.lit(True))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one matched value; a value that fails its check stays."""
    mail = F.concat(F.lit("u"), F.substring(F.sha2(F.concat(F.lit(f"{key}:mail:"), F.lower(value)), 256), 1, 15), F.lit("@example.com"))
    filled = lambda made: let(F.regexp_replace(value, "[^0-9]", ""), lambda d: let(made(d), lambda n: _refill(value, n)))
    cases = {
        "mail": mail,
        "date": _date(value, key),
        "address": _address(value, key),
        "person": _personal(value, key),
        "account": _account(value, key),
        "card": filled(lambda d: _card(d, f"{key}:card")),
    }
    return F.when(is_valid(value), _by_layout(value, cases, filled(lambda d: permute_digits(d, key)))).otherwise(value)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", out: str = "text") -> DataFrame:
    """``docs`` with ``out`` holding the pseudonymised text and ``n_values`` the valid matches, which are replaced."""
    t = F.col(text)
    (found,) = fresh(docs, "_found")
    # Matches are a column of their own, so that the pattern runs once over a text; only texts with matches are cut.
    first = docs.withColumn(found, F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)))
    zipped = F.arrays_zip(F.split(t, PATTERN).alias("piece"), F.transform(found, lambda m: pseudonym(m, key)).alias("new"))
    joined = F.array_join(F.transform(zipped, lambda z: F.concat(F.coalesce(z["piece"], F.lit("")), F.coalesce(z["new"], F.lit("")))), "")
    n_valid = F.when(F.size(found) > 0, F.size(F.filter(found, is_valid))).otherwise(0).cast("bigint")
    done = first.withColumn("n_values", n_valid).withColumn(out, F.when(F.col("n_values") > 0, joined).otherwise(t))
    return done.drop(found)
