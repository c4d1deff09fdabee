"""Parcel ids, postal codes and addresses as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .readers import SPACE, let, text

#: Directions and their short forms.
DIRECTIONS = {"NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW"}
#: Street suffixes and their short forms.
SUFFIXES = {
    "AVENUE": "AVE", "BOULEVARD": "BLVD", "CIRCLE": "CIR", "COURT": "CT", "DRIVE": "DR", "HIGHWAY": "HWY", "LANE": "LN",
    "PARKWAY": "PKWY", "PLACE": "PL", "ROAD": "RD", "STREET": "ST", "TERRACE": "TER", "TRAIL": "TRL", "WAY": "WAY",
}
#: Tokens that end a street name, and single words that are no street.
STREET_ENDS = "aly ave av blvd bnd cir ct cv dr expy hwy ln loop pkwy pl plz rd row sq st ter trl way".split()


def parcel_id(value: Column) -> Column:
    """The digits of a parcel id; without digits its text in upper case without blanks."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(text(value).isNotNull(), F.coalesce(F.nullif(digits, F.lit("")), F.upper(F.regexp_replace(value, SPACE, ""))))


def parcel_digits(value: Column) -> Column:
    """The digits of a parcel id, the empty text if it has none."""
    return F.regexp_replace(value, "[^0-9]", "")


def usable_parcel(value: Column) -> Column:
    return value.rlike(r"^[0-9]{13,17}$")


def postal_code(value: Column) -> Column:
    """The first five digits, if there are five."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))


def postal_code_in(value: Column) -> Column:
    """The ZIP behind the state, else at the end of the text; a street number is none."""
    state, last = r"(?i)\b(?:FL|FLORIDA)\s+(\d{5})(?:-\d{4})?\b", r"(?i)(?:^|\D)(\d{5})(?:-\d{4})?\s*(?:US|USA)?\s*$"
    return let(text(value), lambda t: F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (state, last)]))


def address(value: Column) -> Column:
    """Upper case, ``#``, point and comma as blanks, single blanks, short directions and suffixes."""
    short = F.create_map(*[F.lit(x) for pair in (DIRECTIONS | SUFFIXES).items() for x in pair])
    cut = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.upper(text(value)), "[#.,]", " "), f"{SPACE}+", " ")), " ")
    return F.array_join(F.transform(cut, lambda w: F.coalesce(short[w], w)), " ")


def address_key(value: Column) -> Column:
    return F.lower(address(value))


def address_hash(key: Column) -> Column:
    return F.sha2(F.lower(key), 256)


def street_base(value: Column) -> Column:
    """House number to street suffix (or ``us`` and its number) of an address, without unit, city and state."""
    return base_of_key(address_key(value))


def base_of_key(key: Column) -> Column:
    def cut(ws: Column) -> Column:
        at = lambda keep: F.array_min(F.filter(F.transform(ws, lambda w, k: F.when((k > 0) & keep(w, k), k)), lambda k: k.isNotNull()))
        end, road = at(lambda w, k: w.isin(STREET_ENDS)), at(lambda w, k: (w == "us") & (k + 1 < F.size(ws)))
        length = F.when(end >= 2, end + 1).when(road >= 1, road + 2)
        return F.when((F.size(ws) >= 3) & F.get(ws, F.lit(0)).rlike("^[0-9]+[a-z]?$") & length.isNotNull(), F.array_join(F.slice(ws, F.lit(1), length), " "))

    return let(F.filter(F.split(key, r"\s+"), lambda w: w != ""), cut)


def street_number(key: Column) -> Column:
    return F.split_part(key, F.lit(" "), F.lit(1))


def _segments(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, ","), lambda x: F.coalesce(text(x), F.lit(""))), lambda x: x != "")


def free_text_address(value: Column) -> Column:
    """(street, city, postal_code) of ``STREET, CITY, STATE ZIP``; the state is not read."""
    state_zip, bare_zip = r"\b[A-Za-z]{2}\s+(\d{5})(?:-\d{4})?\s*$", r"\b(\d{5})(?:-\d{4})?\s*$"

    def read(parts: Column) -> Column:
        last = F.try_element_at(parts, F.lit(-1))
        pattern = F.when(last.rlike(state_zip), F.lit(state_zip)).when(last.rlike(bare_zip), F.lit(bare_zip))
        code = F.coalesce(*[F.nullif(F.regexp_extract(last, p, 1), F.lit("")) for p in (state_zip, bare_zip)])
        head = F.trim(F.regexp_replace(last, pattern, F.lit("")))
        front = F.slice(parts, F.lit(1), F.size(parts) - 1)
        kept = F.when(pattern.isNull(), parts).otherwise(F.concat(front, F.when(head != "", F.array(head)).otherwise(F.array().cast("array<string>"))))
        city = lambda k: F.nullif(F.array_join(F.slice(k, F.lit(2), F.greatest(F.size(k) - 1, F.lit(0))), ", "), F.lit(""))
        return let(kept, lambda k: F.struct(F.get(k, F.lit(0)).alias("street"), city(k).alias("city"), code.alias("postal_code")))

    none = F.struct(*[F.lit(None).cast("string").alias(c) for c in ("street", "city", "postal_code")])
    return let(_segments(F.coalesce(value, F.lit(""))), lambda p: F.when(F.size(p) > 0, read(p)).otherwise(none))


def site_address(value: Column) -> Column:
    """(street, city, state, postal_code) of three parts or more that end in ``ST ZIP``; otherwise the whole text is the street."""
    tail = r"^([A-Z]{2})\s+(\d{5}(?:-\d{4})?)$"

    def read(parts: Column) -> Column:
        last = F.try_element_at(parts, F.lit(-1))
        good = (F.size(parts) >= 3) & last.rlike(tail)
        street = F.when(good, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), ", ")).otherwise(text(value))
        only = lambda c: F.when(good, c)
        return F.struct(street.alias("street"), only(F.try_element_at(parts, F.lit(-2))).alias("city"), only(F.regexp_extract(last, tail, 1)).alias("state"), only(F.regexp_extract(last, tail, 2)).alias("postal_code"))

    none = F.struct(*[F.lit(None).cast("string").alias(c) for c in ("street", "city", "state", "postal_code")])
    return let(_segments(F.coalesce(value, F.lit(""))), lambda p: F.when(F.size(p) > 0, read(p)).otherwise(none))


def situs(full: Column, number: Column, name: Column, suffix: Column, city: Column, zip_code: Column, loose: Column) -> Column:
    """(street, city, zip): each field from the situs text, else from the structured columns, else from the loose text."""
    blank = lambda c: F.nullif(c, F.lit(""))

    def pick(both: Column) -> Column:
        a, b = both["a"], both["b"]
        some = a["city"].isNotNull() | a["postal_code"].isNotNull() | F.coalesce(a["street"].rlike(r"\d"), F.lit(False))
        built = blank(F.concat_ws(" ", blank(number), blank(name), blank(suffix)))
        first = lambda f, own: F.coalesce(F.when(some, a[f]), own, b[f])
        return F.struct(first("street", built).alias("street"), first("city", blank(city)).alias("city"), first("postal_code", blank(zip_code)).alias("zip"))

    return let(F.struct(free_text_address(full).alias("a"), free_text_address(loose).alias("b")), pick)


def agent_line(street: Column, city: Column, state: str, zip_code: Column, plus_four: Column) -> Column:
    """(line, key, hash) of an agent's address; null without street or city."""
    line = F.concat_ws(" ", street, city, F.lit(state), F.concat(zip_code, F.coalesce(F.concat(F.lit("-"), plus_four), F.lit(""))))
    made = let(line, lambda x: F.struct(x.alias("line"), address_key(x).alias("key"), address_hash(address_key(x)).alias("hash")))
    return F.when(street.isNotNull() & city.isNotNull(), made)


def strap(value: Column) -> Column:
    """13 to 17 digits as ``NN-NN-NN-NN-NNNNN.NNNN``, filled up with zeros on the right."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits).between(13, 17), _strapped(F.rpad(digits, 17, "0")))


def strap_left(value: Column) -> Column:
    """14 to 16 digits with the last segment filled up on the left; null where ``strap`` is the same."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    other = _strapped(F.concat(F.substring(digits, 1, 13), F.lpad(F.substring(digits, 14, 4), 4, "0")))
    return F.when(F.length(digits).between(14, 16) & (other != strap(value)), other)


def _strapped(d: Column) -> Column:
    return F.concat(F.concat_ws("-", *[F.substring(d, a, n) for a, n in ((1, 2), (3, 2), (5, 2), (7, 2), (9, 5))]), F.lit("."), F.substring(d, 14, 4))
