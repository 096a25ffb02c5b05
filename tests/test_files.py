import pytest
from pyspark.sql import functions as F, types as T

from gathered import rows
from touchline import session
from touchline.plans import season_build
from touchline.sources import pages, readers, writers


def test_file_names(one):
    paths = ["x/join_bel_2025_2026_mv.csv", "join_BRA_2025_mv.csv", "other.csv", "join_arg_2025.csv", "x/join_pl_2024_mv.csv/part-0.csv"]
    assert one(readers.file_league, paths) == ["bel", "bra", None, None, "pl"]
    assert one(readers.file_season, paths) == ["2025-2026", "2025", None, None, "2024"]
    assert readers.unprocessed(["join_a.csv", "join_a_mv.csv", "join_b.csv"]) == ["join_b.csv"]


@pytest.mark.parametrize(("sep", "encoding", "mark"), [(";", "utf-8-sig", True), (",", "utf-8", False), (";", "latin-1", False), (",", "latin-1", False)])
def test_csv_dialects(spark, tmp_path, sep, encoding, mark):
    (tmp_path / "a.csv").write_text(sep.join(["Player", "Age", "age"]) + "\n" + sep.join(["José", "1", "2"]) + "\n", encoding=encoding)
    df = readers.read_csv(spark, f"{tmp_path}/a.csv")
    assert df.columns == ["Player", "Age", "age__dup1"] and rows(df) == [("José", "1", "2")]


def test_joined_files(spark, tmp_path):
    (tmp_path / "join_bel_2025_2026_mv.csv").write_text("a\n1\n2\n")
    (tmp_path / "join_zz_mv.csv").write_text("b,a\n9,3\n")
    (tmp_path / "join_zz.csv").write_text("a\n4\n")
    got = readers.read_joined_files(spark, str(tmp_path)).select("a", "b", "league_code", "season_code")
    assert rows(got) == [("1", None, "bel", "2025-2026"), ("2", None, "bel", "2025-2026"), ("3", "9", "zz", "")]
    with pytest.raises(FileNotFoundError):
        readers.read_joined_files(spark, str(tmp_path), "nothing_*.csv")


def test_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,x\nb,y\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.StringType())])
    good, bad = readers.read_csv_reporting(spark, f"{tmp_path}/a.csv", schema)
    assert rows(good) == [(1, "x")] and bad.count() == 1 and bad.first()._file.endswith("a.csv")
    assert rows(good.select("n")) == [("x",)]


def test_work_list(spark):
    got = readers.work_list(spark, {"ARG1": [2022, 2023], "ENG1": ["2024-2025"]}, ["fbref"])
    assert rows(got) == [("ARG1", "2022", 2022, "fbref"), ("ARG1", "2023", 2023, "fbref"), ("ENG1", "2024-2025", 2024, "fbref")]
    with pytest.raises(ValueError):
        readers.work_list(spark, {"ARG1": ["last"]})


def test_refresh_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "x int, league_code string, season_code string"
    writers.refresh_partitions(spark.createDataFrame([(1, "a", "2023"), (2, "a", "2024"), (3, "b", "2024")], schema), path)
    new = spark.createDataFrame([(9, "a", "2024")], schema)
    loaded = spark.createDataFrame([("a", "2024"), ("b", "2024")], "league_code string, season_code string")
    for _ in range(2):
        writers.refresh_partitions(new, path, loaded)
        assert rows(spark.read.parquet(path).selectExpr("x")) == [(1,), (9,)]


def test_safe_parquet(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"ab\xff"), [1])], "b binary, a array<int>")
    writers.write_parquet(df, f"{tmp_path}/p")
    assert rows(spark.read.parquet(f"{tmp_path}/p")) == [("ab", "[1]")]


def test_empty_table_keeps_its_schema(spark, tmp_path):
    writers.replace_table(spark.createDataFrame([], "a int, b string"), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").columns == ["a", "b"]


def test_counts_while_writing(spark, tmp_path):
    df, watch = writers.observed(spark.createDataFrame([(True,), (False,), (None,)], "IsGK boolean"), "load")
    df.write.parquet(f"{tmp_path}/p")
    assert watch.get == {"n_rows": 3, "n_keepers": 1, "n_field": 1}


def test_ids_and_teams(spark, tmp_path):
    (tmp_path / "ids.json").write_text('["7", "8",\n "7"]')
    assert rows(readers.read_ids(spark, f"{tmp_path}/ids.json")) == [(0, "7"), (1, "8"), (2, "7")]
    (tmp_path / "teams.csv").write_text("league_code,season,team_id,team_name\nARG1,2024,209,CA River Plate\n")
    assert rows(readers.team_dimension(spark, f"{tmp_path}/teams.csv")) == [("ARG1", "2024", 209, "CA River Plate")]


def test_scratch_tables_are_discarded(spark):
    df = session.materialize(spark.range(3), "test")
    assert df.count() == 3 and session.discard_scratch(spark) >= 1 and session.discard_scratch(spark) == 0


SQUAD = """<html><h1> CA <b>Boca</b>
 Juniors</h1><table class="items"><thead><tr><th>x</th></tr></thead><tbody>
<tr class="odd"><td>7</td><td><table class="inline-table"><tr><td><a href="/jose/profil/spieler/77">José &amp; Co</a></td></tr><tr><td>FW</td></tr></table></td>
<td>Mar 5, 1999 (25)</td><td class="rechts hauptlink"><a href="#">20,00 mill. €</a></td></tr>
<tr><td><a href="/x/profil/spieler/78">B</a></td><td data-sort="2000-01-02">sometime (24)</td><td class="rechts hauptlink">-</td></tr>
<tr><td>no link</td><td class="rechts hauptlink">€1m</td></tr>
<tr><td><a href="/profil/spieler/">C</a></td><td data-sort="2000-01-02">31/02/2001</td><td class="hauptlink rechts">€800k</td></tr>
</tbody></table></html>"""


def test_squad_page(spark):
    table = spark.createDataFrame([(1, "u", SQUAD), (2, "u", "<html></html>"), (3, "u", SQUAD)], "page_id long, url string, html string")
    assert rows(pages.distinct_roster(pages.squad_rows(table))) == [
        ("C", "CA Boca Juniors", 800000, None, "2000-01-02", None),
        ("José & Co", "CA Boca Juniors", 20000000, 77, "1999-03-05", 25),
    ]


def test_club_links(spark):
    html = """<a class=x href='/boca/startseite/verein/189/saison_id/2023'></a><A HREF="/boca/startseite/verein/189"><img alt=" Boca "></A>
    <a href="https://o.test/river/startseite/verein/209"><img alt="River"></a><a href="/lanus/startseite/verein/333"><i>Lan&amp;s</i></a><a href="/n/kader/verein/5">x</a>"""
    df = spark.createDataFrame([(1, "https://www.site.test/a/b?c", html)], "page_id long, url string, html string")
    assert rows(pages.club_links(df)) == [
        (1, "189", "club_189", "https://www.site.test/boca/startseite/verein/189/saison_id/2023"),
        (1, "209", "River", "https://o.test/river/startseite/verein/209"),
        (1, "333", "Lan&s", "https://www.site.test/lanus/startseite/verein/333"),
    ]


def test_addresses(one):
    root = "https://www.transfermarkt.com"
    assert one(lambda c: pages.league_url(c, F.lit(2024)), ["eng1", "zzz"]) == [f"{root}/premier-league/startseite/wettbewerb/GB1?saison_id=2024", None]
    starts = [f"{root}/x/startseite/verein/1/saison_id/2020?saison_id=3#a", f"{root}/x/other/1"]
    assert one(lambda c: pages.squad_url(c, F.lit(2024)), starts) == [f"{root}/x/kader/verein/1/saison_id/2024/plus/1/galerie/0", starts[1]]
    assert one(lambda c: pages.season_url(c, F.lit(2024)), ["//h.test/a?b=1", f"{root}/a"]) == ["https:////h.test/a?saison_id=2024", f"{root}/a?saison_id=2024"]


def test_from_landed_tables_to_opportunities(spark, tmp_path):
    """Landing zone, player table, value matching, consolidated tables, view, neighbours and opportunities in one go."""
    key = "source string, league string, season string, Player string"
    names = [f"Player{chr(97 + i // 26)}{chr(97 + i % 26)} Sur{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(80)]
    stats = [("fbref", "pl", "2024-2025", n, "GK" if i % 8 == 0 else "FW", f"Club {i % 5}", f"{20 + i % 9}-100", str(5 + i % 30), str(i % 13)) for i, n in enumerate(names)]
    keepers = [("fbref", "pl", "2024-2025", n, str(i), str(i + 9)) for i, n in enumerate(names)]
    root = str(tmp_path)
    writers.write_raw(spark.createDataFrame(stats, f"{key}, Pos string, Squad string, Age string, `90s` string, Gls string"), f"{root}/raw", "stats")
    writers.write_raw(spark.createDataFrame(keepers, f"{key}, Saves string, SoTA string"), f"{root}/raw", "keepers")
    tables = {k: df.drop("source") for k, df in readers.read_stat_tables(spark, f"{root}/raw", ["stats", "keepers"], "fbref").items()}
    _, players = season_build.build_player_table(tables)
    assert players.count() == 80
    roster = spark.createDataFrame([(n.upper(), f"Club {i % 5}", 150000 + 1000 * i, i, None, 20 + i % 9, "pl", "2024-2025") for i, n in enumerate(names)],
                                   "player_name string, club_name string, market_value_eur long, player_id long, dob string, age int, league string, season string")
    joined = season_build.match_values(players, roster, 2024, fuzzy=False)
    assert joined.filter("join_method = 'key+birth_year'").count() == 80
    ready = joined.withColumnsRenamed({"league": "league_code", "season": "season_code"}).withColumn("league_name", F.lit("Premier League"))
    undecided = season_build.load_consolidated(ready, f"{root}/out", ["row_id"])
    assert undecided.count() == 0
    view = season_build.player_view(spark, f"{root}/out")
    assert view.count() == 80 and view.filter("GK_Saves is not null").count() == 10
    field = spark.read.parquet(f"{root}/out/field_players_all")
    near = season_build.build_neighbours(field, ["MatchesPlayed", "Gls"], 3)
    assert near.count() == 70 * 3
    for mode in ("in_sample", "out_of_fold"):
        best = season_build.build_opportunities(view, field, mode=mode, depth=3, n=10)
        assert 0 < best.count() <= 10 and "team_name" in best.columns
    with pytest.raises(ValueError):
        season_build.build_opportunities(view, field, mode="x")
