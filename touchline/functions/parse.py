"""Parsing of numbers, money, dates, ages and flags from source text. Bad input gives null unless said otherwise."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Words that count as a missing text, and words that mean true.
BLANK_WORDS = ["", "nan", "none", "null"]
TRUE_WORDS = ["true", "1", "t", "yes", "y"]
THIN_SPACE, HARD_SPACE = "\u2009", "\u00a0"

# League code -> competition name in the statistics source.
STAT_LEAGUES = {
    "ARG1": "Primera Division Argentina",
    "LPA": "Primera Division Argentina",
    "BRA1": "Brasileirao",
    "ENG1": "Premier League",
    "ESP1": "La Liga",
    "FRA1": "Ligue 1",
    "GER1": "Bundesliga",
    "ITA1": "Serie A",
    "POR1": "Primeira Liga Portugal",
}

# League code -> name shown to users.
LEAGUE_TITLES = {
    "arg": "Primera División Argentina",
    "bra": "Brasileirão Serie A",
    "mls": "Major League Soccer",
    "pl": "Premier League",
    "esp": "LaLiga",
    "ita": "Serie A",
    "fra": "Ligue 1",
    "ger": "Bundesliga",
    "por": "Primeira Liga",
    "ned": "Eredivisie",
    "bel": "Belgian Pro League",
    "sau": "Saudi Pro League",
}


def _finite(number: Column) -> Column:
    """A double with NaN read as null."""
    return F.when(~F.isnan(number), number)


def number_or_null(c: Column) -> Column:
    return _finite(F.trim(c.cast("string")).try_cast("double"))


def number_or_zero(c: Column) -> Column:
    """Strip percent signs, commas and thin spaces; anything that is still no number is 0."""
    return F.coalesce(number_or_null(F.translate(c.cast("string"), "%," + THIN_SPACE, "")), F.lit(0.0))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def age_in_years(c: Column) -> Column:
    """``YY-DDD`` to years with two decimals, half to even; plain numbers pass through."""
    text = c.cast("string")
    years = F.trim(F.substring_index(text, "-", 1)).try_cast("int")
    days = F.regexp_replace(F.regexp_extract(text, r"^[^-]*-(.*)$", 1), r"\D", "")
    days = F.when(days == "", F.lit(0)).otherwise(days.try_cast("int"))
    return F.when(F.contains(text, F.lit("-")), F.bround(years + days / F.lit(365), 2)).otherwise(number_or_null(text))


def leading_int(c: Column) -> Column:
    """The whole number before the first dash: ``25-123`` and ``25.7`` are 25."""
    value = number_or_null(F.substring_index(c.cast("string"), "-", 1))
    return value.try_cast("int")


def iso_date_loose(c: Column) -> Column:
    """Dates of the statistics source: ``d/m/Y`` and ``d.m.Y`` become ISO, all else stays as written."""
    text = F.trim(F.replace(text_or_empty(c), F.lit(HARD_SPACE), F.lit(" ")))
    pattern = r"(\d{1,2})[/.](\d{1,2})[/.](\d{4})"
    part = lambda i, n: F.lpad(F.regexp_extract(text, pattern, i), n, "0")
    return (
        F.when(F.rlike(text, F.lit(r"\d{4}-\d{2}-\d{2}$")), text)
        .when(F.rlike(text, F.lit(pattern)), F.concat_ws("-", part(3, 4), part(2, 2), part(1, 2)))
        .otherwise(text)
    )


def iso_date_strict(c: Column) -> Column:
    """Dates of the value source: ``d/m/Y`` (``/ . -``) or ``Month d, Y``; no such calendar day gives ``""``."""
    text = F.trim(text_or_empty(c))
    numeric = r"(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})"
    worded = r"([A-Za-z]{3,})\s+(\d{1,2}),\s*(\d{4})"
    part = lambda i: F.regexp_extract(text, numeric, i)
    word = lambda i: F.regexp_extract(text, worded, i)
    by_number = F.try_to_date(F.concat_ws("-", part(3), part(2), part(1)), "yyyy-M-d")
    month = F.initcap(word(1))
    by_word = F.coalesce(
        F.try_to_date(F.concat_ws("-", word(3), month, word(2)), "yyyy-MMMM-d"),
        F.try_to_date(F.concat_ws("-", word(3), month, word(2)), "yyyy-MMM-d"),
    )
    day = F.when(F.rlike(text, F.lit(numeric)), by_number).when(F.rlike(text, F.lit(worded)), by_word)
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def iso_date_or_null(c: Column) -> Column:
    """ISO text only when it is a real calendar day, for use as an exact join key."""
    text = iso_date_loose(c)
    return F.date_format(F.try_to_date(F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}$")), text), "yyyy-MM-dd"), "yyyy-MM-dd")


def year_in(c: Column) -> Column:
    """The first run of four digits."""
    return F.regexp_extract(c.cast("string"), r"(\d{4})", 1).try_cast("int")


def birth_year(dob: Column, age: Column, season_year: int | Column) -> Column:
    """Year of the date of birth, else season year minus age."""
    season = F.lit(season_year) if isinstance(season_year, int) else season_year
    return F.coalesce(year_in(dob), season - leading_int(age))


def age_on(dob: Column, as_of: Column, fallback_year: Column | None = None) -> Column:
    """Full years from birth to ``as_of``; with a year of birth only, 1 July stands in."""
    born = F.try_to_date(F.when(F.rlike(dob.cast("string"), F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), dob.cast("string")), "yyyy-M-d")
    if fallback_year is not None:
        born = F.when(dob.isNotNull(), born).otherwise(F.try_make_timestamp_ntz(
            fallback_year.cast("int"), F.lit(7), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
        ).cast("date"))
    return F.floor(F.months_between(as_of, born, False) / 12).cast("int")


# Units of written amounts.
MONEY_UNITS = {"bn": 10**9, "mill.": 10**6, "mio.": 10**6, "m": 10**6, "mil": 10**3, "mil.": 10**3, "k": 10**3, "th.": 10**3}


def money_to_eur(c: Column) -> Column:
    """Written amounts such as ``20,00 mill. €``, ``800 mil €``, ``€800k``, ``1.2bn``, ``1,200,000`` in whole euros.

    An amount is a number and perhaps a unit. A separator that occurs once is the decimal one, one that parts groups of
    three twice or more marks thousands. Decimals are exact, so ``8.2m`` is 8,200,000; fractions of a euro are cut.
    """
    bare = F.regexp_replace(F.lower(c), r"[\s\u00a0\u2009€]|eur", "")
    units = "|".join(sorted((re.escape(u) for u in MONEY_UNITS), key=len, reverse=True))
    part = lambda i: F.regexp_extract(bare, rf"^([+-]?[0-9.,]+)({units})?$", i)
    number = part(1)
    grouped = F.rlike(number, F.lit(r"^[+-]?\d{1,3}(?:(?:,\d{3}){2,}|(?:\.\d{3}){2,})$"))
    plain = F.when(grouped, F.translate(number, ",.", "")).otherwise(F.translate(number, ",", "."))
    factor = lookup(part(2), MONEY_UNITS, F.lit(1).cast("long"))
    return (plain.try_cast("decimal(28,9)") * factor.cast("decimal(10,0)")).try_cast("long")


def money_loose(c: Column) -> Column:
    """Joined-file money: the digits of the text, whatever stands between them.

    The decimal mark is the comma where there is one, else the dot, if it occurs once; all other separators mark thousands.
    """
    raw = F.trim(F.replace(c.cast("string"), F.lit(HARD_SPACE), F.lit(" ")))
    digits = lambda part: F.regexp_replace(part, r"[^0-9]", "")
    mark = F.when(F.contains(raw, F.lit(",")), ",").otherwise(".")
    whole, fraction = (digits(F.call_function("substring_index", raw, mark, F.lit(n))) for n in (1, -1))
    once = F.length(raw) - F.length(F.replace(raw, mark, F.lit(""))) == 1
    amount = F.when(once, F.concat(whole, F.lit("."), fraction)).otherwise(digits(raw))
    return F.when(~is_blank(raw), number_or_null(amount))


def is_blank(c: Column) -> Column:
    """Null, empty, or one of the words for nothing."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*BLANK_WORDS), F.lit(True))


def first_filled(*columns: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*[F.when(~is_blank(c), c.cast("string")) for c in columns])


def flag(c: Column) -> Column:
    """True words are true, other words false; blank stays null so that the position can decide."""
    text = c.cast("string")
    return F.when(~is_blank(text), F.lower(F.trim(text)).isin(*TRUE_WORDS))


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def season_start(c: Column) -> Column:
    """``2024-2025``, ``2024/2025`` and ``2024`` give 2024; anything else gives null."""
    return F.regexp_extract(F.trim(c.cast("string")), r"^(\d{4})(\s*[-/]\s*\d{4})?$", 1).try_cast("int")


def checked_season_start(season: str | int) -> int:
    """``season_start`` for one request argument; an unreadable season is an error."""
    import re

    found = re.fullmatch(r"(\d{4})(\s*[-/]\s*\d{4})?", str(season).strip())
    if not found:
        raise ValueError(f"season {season!r} is neither YYYY nor YYYY-YYYY")
    return int(found.group(1))


def lookup(c: Column, table: dict, default: Column | None = None) -> Column:
    """Small fixed table as a map literal; unknown keys give the default."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
    return found if default is None else F.coalesce(found, default)


def league_title(code: Column) -> Column:
    return F.coalesce(lookup(F.lower(code), LEAGUE_TITLES, F.upper(code)), F.lit(""))


def stat_league(code: Column) -> Column:
    return lookup(F.upper(code), STAT_LEAGUES, code)


def file_slug(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
