"""Text expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from moneyflow import codes


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def key(c: Column) -> Column:
    """Upper case, stripped: the key of employers and other free text."""
    return F.upper(strip(c))


def matches_any(c: Column, patterns: list[str], ignore_case: bool = True) -> Column:
    if not patterns:
        return F.lit(False)
    return c.rlike(("(?i)" if ignore_case else "") + "|".join(f"(?:{p})" for p in patterns))


def normalize_name(c: Column) -> Column:
    """Upper case, & as AND, other signs as single spaces."""
    plain = F.regexp_replace(F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9]+", " ")
    return F.trim(plain)


def core_name(normal: Column) -> Column:
    """A normal name without the legal forms at its end."""
    words = "|".join(codes.NAME_SUFFIXES)
    return F.trim(F.regexp_replace(normal, rf"(?:(?:^| )(?:{words}))+$", ""))


def compact(normal: Column) -> Column:
    return F.replace(normal, F.lit(" "), F.lit(""))


def contains_digit(c: Column) -> Column:
    return c.rlike("[0-9]")


def long_enough_to_contain(normal: Column) -> Column:
    """Aliases that may be looked for inside names: six characters, or a digit."""
    return (F.length(compact(normal)) >= 6) | contains_digit(compact(normal))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def clean_code(c: Column) -> Column:
    """Stripped, upper case; null, NAN and NONE are blank, a trailing .0 goes."""
    t = key(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(t.isin("", "NAN", "NONE"), "").otherwise(F.regexp_replace(t, r"\.0$", ""))


def house_district(c: Column) -> Column:
    """0 is AL (at large), other numbers have two digits, other text stays."""
    t = clean_code(c)
    n = t.try_cast("double")
    whole = n.cast("int")
    return F.when(t == "", "").when(n.isNull(), t).when(whole == 0, "AL").otherwise(F.lpad(whole.cast("string"), 2, "0"))


def valid_house_district(state: Column, district: Column) -> Column:
    """By the state's seats: one seat means AL, more mean 1 to n, unknown states take any code."""
    seats = F.try_element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.HOUSE_SEATS.items())), state)
    number = F.coalesce(district.try_cast("int"), F.lit(0))
    ok = F.when(seats.isNull(), district != "").when(seats == 1, district == "AL").otherwise((number >= 1) & (number <= seats))
    return F.coalesce(ok, F.lit(False))


def district_order(c: Column) -> Column:
    d = house_district(c)
    return F.when(d == "AL", 0).otherwise(F.coalesce(d.try_cast("int"), F.lit(999)))


def race_key(office: Column, state: Column, district: Column) -> Column:
    return (
        F.when(office == "P", "PRES")
        .when(office == "S", F.concat(F.lit("SEN-"), state))
        .when(office == "H", F.concat(F.lit("HOUSE-"), state, F.lit("-"), district))
        .otherwise(F.concat(office, F.lit("-"), state, F.lit("-"), district))
    )


def state_name(code: Column) -> Column:
    """A state's name, or the code itself."""
    names = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.STATE_NAMES.items()))
    own = F.upper(F.coalesce(code, F.lit("")))
    return F.coalesce(F.try_element_at(names, own), own)


def party_badge(label: Column) -> Column:
    """The style class of a party label."""
    return F.concat(F.lit("party-"), F.lower(F.coalesce(F.nullif(label, F.lit("")), F.lit("Unknown"))))


def join_parts(*parts: Column) -> Column:
    """Non-empty parts with single spaces between."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), " ")


def truthy(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin("1", "true", "t", "yes", "y")


def label(c: Column) -> Column:
    """Underscores as spaces, words capitalised."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def truncate(c: Column, limit: int) -> Column:
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.rtrim(F.substring(c, 1, limit - 1)), F.lit("…")))


def money_label(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.concat(F.when(c < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(c), 0)))


def pct_label(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.concat(F.format_number(c, 1), F.lit("%")))


def substring_count(c: Column, part: str) -> Column:
    return F.size(F.split(c, F.lit("\\Q" + part + "\\E"), -1)) - 1


def row_contains(columns: list[str], query: str) -> Column:
    """Free-text filter over a whole row."""
    return F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])).contains(query.lower())


def parsed_number(c: Column) -> Column:
    """1.2k, 3M, $4b and the like as numbers, for sorting."""
    t = F.regexp_replace(F.lower(c), r"[$,%\s]", "")
    scale = F.when(t.endswith("k"), 1e3).when(t.endswith("m"), 1e6).when(t.endswith("b"), 1e9).otherwise(1.0)
    return F.regexp_replace(t, "[kmb]$", "").try_cast("double") * scale
