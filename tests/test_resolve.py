import random

import pytest
from pyspark.sql import functions as F

from gathered import rows
from touchline.operators import resolve
from touchline.operators.resolve import STAGES

ROSTER = "player_name string, club_name string, market_value_eur long, player_id long, dob string, age int"


@pytest.fixture(scope="module")
def cascade(spark):
    """One row per step, and the traps."""
    left = [
        ("L10", "Juan Pérez", "CA River Plate", "1999-03-05", None),
        ("L20", "Carlos Alberto Gómez", "Boca", "1998", None),
        ("L21", "Luis de la Cruz", "Lanús", "1997", None),
        ("L22", "Pablo Ruiz", "Lanús", "1997", None),
        ("Lamb", "Igual Doble", "Tigre", "1990", None),
        ("L30", "Mario Sosa", "Other", "01/02/1995", None),
        ("L40", "Diego Vera", "Nowhere", "1993", None),
        ("L41", "Hugo Paz", "Nowhere", "1991", None),
        ("L50", "Sin Año", "Banfield", None, None),
        ("L60", "Ezequiel Fernandez", "Huracán", "1970", None),
        ("L70", "Maximiliano Gonzalezz", "Elsewhere", "1996", None),
        ("Lno", "Nobody Here", "Nowhere", "1980", None),
    ]
    right = [
        ("Juan Perez", "River", 100, 1, "1999-03-05", 25),
        ("Juan Perez", "River", 900, 2, "1999-01-01", 25),
        ("Carlos Gomez", "Boca Juniors", 200, 3, "1998-05-05", 26),
        ("Luis Cruz", "CA Lanús", 300, 4, "1998-05-05", 26),
        ("Pablo Ruiz", "Lanus", 300, 5, "1996-05-05", 28),
        ("Igual Doble", "Tigre", 1, 6, "1991-01-01", 33),
        ("Igual Doble", "Tigre", 2, 7, "1991-06-01", 33),
        ("Mario Sosa", "Platense", 400, 8, "1995-02-01", 29),
        ("Diego Vera", "Platense", 500, 9, "1993-05-05", 31),
        ("Hugo Paz", "Platense", 600, 10, "1992-05-05", 32),
        ("Sin Año", "Banfield", 700, 11, None, None),
        ("Esequiel Fernandez", "Huracan (BA)", 800, 12, "1999-05-05", 25),
        ("Maximiliano Gonzalez", "Platense", 900, 13, "1997-05-05", 27),
        ("Worthless Man", "Platense", None, 14, "1997-05-05", 27),
    ]
    df = spark.createDataFrame(left, "row_id string, Player string, Squad string, Born string, Age string")
    l = resolve.add_keys(df, "Player", "Squad", "Born", "Age", 2024)
    r = resolve.add_keys(spark.createDataFrame(right, ROSTER), "player_name", "club_name", "dob", "age", 2024)
    return l, r


def test_every_step(cascade):
    left, right = cascade
    found = {r.row_id: (r.stage, r.player_id) for r in resolve.resolve(left, right).collect()}
    assert found == {
        "L10": (10, 2), "L20": (20, 3), "L21": (21, 4), "L22": (22, 5), "Lamb": (50, 7), "L30": (30, 8), "L40": (40, 9),
        "L41": (41, 10), "L50": (50, 11), "L60": (60, 12), "L70": (70, 13), "Lno": (None, None),
    }


def test_labels_breakdown_and_unmatched(cascade):
    left, right = cascade
    resolved = resolve.resolve(left, right).cache()
    labels = {r.row_id: r.join_method for r in resolved.collect()}
    assert labels["L10"] == "key+birth_year" and labels["L21"] == "first+last+club+birth_year±1"
    assert labels["L41"] == "first+last+birth_year±1(unique)" and labels["L60"].startswith("fuzzy_club(9")
    counted = {r.join_method: r.n_rows for r in resolve.breakdown(resolved).collect()}
    assert counted["key_no_year"] == 2 and counted["fuzzy_global"] == 1 and counted[""] == 1
    assert tuple(resolve.match_totals(resolved).first()) == (12, 11, 1)
    assert rows(resolve.unmatched(resolved, ["row_id", "absent"])) == [("Lno",)]


def test_missing_year_matches_only_on_request(cascade):
    left, right = cascade
    row = left.filter("row_id = 'L50'")
    assert resolve.resolve(row, right, fuzzy=False).first().stage == 50
    assert resolve.resolve(row, right, fuzzy=False, null_safe_year=True).first().stage == 10


def test_one_to_one(spark, cascade):
    left, right = cascade
    twice = left.filter("row_id = 'L10'").unionByName(left.filter("row_id = 'L10'").withColumn("row_id", F.lit("L00")))
    assert {r.row_id: r.player_id for r in resolve.resolve(twice, right, fuzzy=False).collect()} == {"L10": 2, "L00": 2}
    assert {r.row_id: r.player_id for r in resolve.resolve(twice, right, fuzzy=False, one_to_one=True).collect()} == {"L10": None, "L00": 2}


def test_crosswalk_shares_the_uuid(cascade):
    left, right = cascade
    pairs = resolve.crosswalk(resolve.resolve(left, right, fuzzy=False), "row_id").collect()
    uuid = {(p.source, p.source_player_id): p.player_uuid for p in pairs}
    assert len(uuid) == len(pairs) and uuid["fbref", "L10"] == uuid["transfermarkt", "2"] and uuid["fbref", "Lno"] not in {
        v for k, v in uuid.items() if k != ("fbref", "Lno")
    }


def test_scope_keeps_seasons_apart(spark, cascade):
    left, right = (df.withColumn("season", F.lit("2024")) for df in cascade)
    other = right.withColumn("season", F.lit("2023"))
    assert resolve.resolve(left, other, ["season"]).filter("player_id is not null").count() == 0
    assert resolve.resolve(left, right, ["season"]).filter("player_id is not null").count() == 11


def step_by_step(left, right):
    """The cascade as a loop over the steps, filling what is still open."""
    norm = {"norm_club_year": ("norm", "club", "year"), "fl_club_year": ("fl", "club", "year"), "fl_dob": ("fl", "dob"), "fl_year": ("fl", "year"), "norm_club": ("norm", "club")}
    result = {}
    for stage, family, shift, _ in STAGES:
        cols = norm[family.removesuffix("_once")]
        for row in left:
            if row["id"] in result:
                continue
            key = [row[c] + shift if c == "year" and row[c] is not None else row[c] for c in cols]
            if None in key:
                continue
            same = [r for r in right if [r[c] for c in cols] == key]
            if family.endswith("_once") and len(same) != 1:
                continue
            same = [r for r in same if r["value"] is not None]
            if same:
                result[row["id"]] = (stage, min((-r["value"], r["id"]) for r in same)[1])
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_one_join_equals_step_by_step(spark, seed):
    rnd = random.Random(seed)

    def row(i):
        first, last = rnd.choice("abc"), rnd.choice("xy")
        middle = rnd.choice(["", "m "])
        return {
            "id": i, "norm": f"{first} {middle}{last}", "fl": f"{first} {last}", "club": rnd.choice(["p", "q", "r", None]),
            "year": rnd.choice([1990, 1991, 1992, 1993, 1994, None]), "dob": rnd.choice([None, None, "1990-01-01", "1991-02-02"]), "value": rnd.choice([None, 1, 2, 3]),
        }

    left, right = [row(i) for i in range(80)], [row(i) for i in range(25)]
    schema = "id int, norm string, fl string, club string, year int, dob string, value long"
    names = {"norm": "player_norm", "fl": "player_fl", "club": "club_norm", "year": "birth_year", "dob": "dob_iso"}
    frame = lambda data: spark.createDataFrame([tuple(r.values()) for r in data], schema).withColumnsRenamed(names)
    l = frame(left).withColumnRenamed("id", "row_id").drop("value")
    r = frame(right).withColumnsRenamed({"id": "player_id", "value": "market_value_eur"}).withColumns({"dob": F.col("dob_iso"), "age": F.lit(1)})
    got = resolve.resolve(l, r, fuzzy=False).collect()
    assert len(got) == len(left)
    assert {g.row_id: (g.stage, g.player_id) for g in got if g.stage} == step_by_step(left, right)


def test_exact_steps_stay_in_the_jvm(cascade):
    plan = resolve.resolve(*cascade, fuzzy=False)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_side_that_grows_is_broadcast(cascade):
    """The keys of the left rows, and what was found for them, are merged by a shuffle whatever Spark takes their size for."""
    left, right = cascade
    plan = resolve.resolve(left, right, fuzzy=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == 2
