import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.functions import parse
from touchline.sources import pages


def test_money_to_eur(one):
    cases = {
        "20,00 mill. €": 20000000, "800 mil €": 800000, "€20.0m": 20000000, "€800k": 800000, "500 Th. €": 500000, "1.2bn": 1200000000,
        "-": None, "": None, "1,200,000": 1200000, "12,5 mio. €": 12500000, "abc": None, None: None, "3.456.789": 3456789,
    }
    assert one(parse.money_to_eur, list(cases)) == list(cases.values())


def test_money_loose(one):
    cases = {"€ 1.200.000,50": 1200000.5, "1.200.000": 1200000.0, "1,5": 1.5, "1,200": 1.2, "-5": 5.0, "abc": None, "nan": None, "20m": 20.0, None: None}
    assert one(parse.money_loose, list(cases)) == list(cases.values())


def test_dates(one):
    written = ["05/03/1999", "5.3.1999", "5-3-1999", "March 5, 1999", "Mar 5, 1999", "31/02/2000", "1999-03-05", "", None]
    good = "1999-03-05"
    assert one(parse.iso_date_strict, written) == [good, good, good, good, good, "", "", "", ""]
    assert one(parse.iso_date_loose, written) == [good, good, "5-3-1999", "March 5, 1999", "Mar 5, 1999", "2000-02-31", good, "", ""]
    assert one(parse.iso_date_or_null, written) == [good, good, None, None, None, None, good, None, None]
    assert one(parse.year_in, ["1999", "05/03/1999", "x", None, "1999.0"]) == [1999, 1999, None, None, 1999]


def test_ages(one):
    written = ["25-123", "25", "25.7", None, "x-1", "25-", "nan"]
    assert one(parse.age_in_years, written) == [25.34, 25.0, 25.7, None, None, 25.0, None]
    assert one(parse.leading_int, written) == [25, 25, 25, None, None, 25, None]
    at = lambda day: lambda c: parse.age_on(c, F.lit(day).cast("date"))
    assert one(at("2021-02-28"), ["2000-02-29", "2000-03-01", "bad", None]) == [21, 20, None, None]
    assert one(at("2021-02-27"), ["2000-02-29"]) == [20]
    by_year = lambda c: parse.age_on(F.lit(None).cast("string"), F.lit("2024-06-30").cast("date"), c)
    assert one(by_year, [2000, None], "int") == [23, None]


def test_half_even(one):
    assert one(lambda c: F.bround(c, 2), [0.125, 0.375], "double") == [0.12, 0.38]


def test_numbers(one):
    written = ["1,234", "45.3%", "1 000", None, "x", "nan", "7"]
    assert one(parse.number_or_zero, written) == [1234.0, 45.3, 1000.0, 0.0, 0.0, 0.0, 7.0]
    assert one(parse.number_or_null, written) == [None, None, None, None, None, None, 7.0]


def test_blank_and_flags(one):
    assert one(parse.is_blank, ["", " NaN ", "None", "null", None, "x", "0"]) == [True, True, True, True, True, False, False]
    assert one(parse.flag, ["True", "1", "t", "YES", "y", "false", "0", " ", None, "nan"]) == [True] * 5 + [False, False, None, None, None]


def test_seasons(one):
    assert one(parse.season_start, ["2024-2025", "2024/2025", "2024", "24", None, "2024 - 2025"]) == [2024, 2024, 2024, None, None, 2024]
    assert parse.checked_season_start("2024-2025") == 2024
    with pytest.raises(ValueError):
        parse.checked_season_start("24/25")
    assert one(parse.league_title, ["ARG", "pl", "xyz"]) == ["Primera División Argentina", "Premier League", "XYZ"]
    assert one(parse.stat_league, ["eng1", "Serie X"]) == ["Premier League", "Serie X"]


def test_birth_year(one):
    assert one(lambda c: parse.birth_year(F.lit(None).cast("string"), c, 2024), ["25-100", "x"]) == [1999, None]
    assert one(lambda c: parse.birth_year(c, F.lit("9"), 2024), ["05/03/1999", None]) == [1999, 2015]
    assert datetime.date(1999, 3, 5).year == 1999


def test_every_two_decimal_amount_is_exact(spark):
    df = spark.range(1, 20_000).withColumn("eur", parse.money_to_eur(F.format_string("€%s.%02dm", F.floor(F.col("id") / 100), F.col("id") % 100)))
    assert df.filter(F.col("eur") != F.col("id") * 10_000).count() == 0


def test_exact_amounts(one):
    written = {"€8.2m": 8_200_000, "€32.05m": 32_050_000, "€2.01m": 2_010_000, "€1.001m": 1_001_000, "0,0000015m": 1, "-5m": -5_000_000, "m": None}
    assert one(parse.money_to_eur, list(written)) == list(written.values())


def test_money_loose_marks(one):
    cases = {"1,200,300": 1200300.0, "1.200,5": 1200.5, "12.": 12.0, ".5": 0.5, ",": None, "1.2.3": 123.0, "€ 7": 7.0, "": None}
    assert one(parse.money_loose, list(cases)) == list(cases.values())


def test_squad_rows_are_handed_over_in_frames(monkeypatch):
    """A batch of pages becomes frames of bounded length, whatever the number of its rows."""
    monkeypatch.setattr(pages, "FRAME_ROWS", 2)
    row = '<tr><td><a href="/n/profil/spieler/{0}">P {0}</a></td><td class="rechts hauptlink">x{0}</td></tr>'
    html = [f'<table class="items">{"".join(row.format(10 * p + i) for i in range(n))}</table>' for p, n in enumerate((3, 0, 2))]
    frames = list(pages._squad_rows(iter([pd.DataFrame({"page_id": [0, 1, 2], "html": html})])))
    assert [len(f) for f in frames] == [2, 2, 1]
    assert [(r.page_id, r.row, r.player_id) for f in frames for r in f.itertuples()] == [(0, 0, "0"), (0, 1, "1"), (0, 2, "2"), (2, 0, "20"), (2, 1, "21")]
