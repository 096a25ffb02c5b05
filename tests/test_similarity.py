import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from touchline.functions.similarity import common_subsequence, token_set_ratio, token_set_score
from touchline.operators import fuzzy, skew
from touchline.operators.resolve import PAYLOAD

words = st.lists(st.text("abcde", min_size=1, max_size=6), max_size=4).map(" ".join)


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_subsequence(x, y):
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x, 1):
        for j, b in enumerate(y, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if a == b else max(table[i - 1][j], table[i][j - 1])
    assert common_subsequence(x, y) == table[-1][-1]


@settings(max_examples=200)
@given(words, words)
def test_score_properties(a, b):
    score = token_set_score(a, b)
    assert 0 <= score <= 100 and score == token_set_score(b, a)
    if a:
        assert token_set_score(a, a) == 100 and token_set_score(a, (a + " " + b).strip()) == 100
    else:
        assert score == 0


def test_udf(spark):
    df = spark.createDataFrame([("juan perez", "perez juan"), ("ab", "cd"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(token_set_ratio("a", "b")).collect()] == [100.0, 0.0, 0.0]


VOCABULARY = "juan perez gonzalez de la cruz maria a lopez lopes rodriguez martinez martin silva santos joao jo".split()


def some_names(rnd, n):
    def one():
        out = []
        for word in (rnd.choice(VOCABULARY) for _ in range(rnd.randint(1, 4))):
            if rnd.random() < 0.4:
                at = rnd.randrange(len(word) + 1)
                word = word[:at] + rnd.choice("abz") + word[at:]
            if rnd.random() < 0.2 and len(word) > 2:
                at = rnd.randrange(len(word))
                word = word[:at] + word[at + 1 :]
            out.append(word)
        return " ".join(out)

    return [(rnd.choice("pq"), one()) for _ in range(n)]


def check_pairs(spark, threshold):
    rnd = random.Random(threshold)
    left, right = sorted(set(some_names(rnd, 200))), sorted(set(some_names(rnd, 200)))
    pairs = fuzzy.candidate_pairs(
        spark.createDataFrame(left, "club string, name string"), spark.createDataFrame(right, "club string, name string"), ["club"], threshold
    )
    got = [tuple(r) for r in pairs.select("club", "a", "b").collect()]
    wanted = {(c, a, b) for c, a in left for d, b in right if c == d and token_set_score(a, b) >= threshold}
    assert len(got) == len(set(got)) and wanted <= set(got)
    assert len(got) < sum(c == d for c, _ in left for d, _ in right) / 3


def test_no_pair_is_missed(spark):
    check_pairs(spark, 88)


def test_no_pair_is_missed_when_keys_are_cut(spark, monkeypatch):
    monkeypatch.setattr(skew, "LIGHT_ROWS", 4)
    check_pairs(spark, 90)


def rosters(spark, rnd):
    left = [(i, n, rnd.choice(["x", "y", None]), rnd.choice([None, 1990, 1991, 1992, 1995])) for i, (_, n) in enumerate(some_names(rnd, 60))]
    right = [
        (i, n, n.split()[0] + " " + n.split()[-1], rnd.choice(["x", "y"]), rnd.choice([None, 1990, 1991, 1993]), rnd.choice([100, 200, 300]))
        for i, (_, n) in enumerate(some_names(rnd, 60))
    ]
    l = spark.createDataFrame(left, "row_id int, player_norm string, club_norm string, birth_year int")
    r = spark.createDataFrame(right, "player_id int, player_norm string, player_fl string, club_norm string, birth_year int, market_value_eur long")
    return left, right, l, r.withColumns({"dob": F.lit("d"), "age": F.lit(1)})


def test_similar_in_club_against_brute_force(spark):
    left, right, l, r = rosters(spark, random.Random(5))
    got = {x.row_id: (x.player_id, round(x.score, 6)) for x in fuzzy.similar_in_club(l, r, PAYLOAD, threshold=90).collect()}
    wanted = {}
    for i, name, club, _ in left:
        scored = [(-token_set_score(name, n), -value, pid) for pid, n, _, c, _, value in right if c == club and club]
        if scored and -min(scored)[0] >= 90:
            wanted[i] = (min(scored)[2], round(-min(scored)[0], 6))
    assert wanted and got == wanted


def test_similar_near_year_against_brute_force(spark):
    left, right, l, r = rosters(spark, random.Random(6))
    got = {x.row_id: x.player_id for x in fuzzy.similar_near_year(l, r, PAYLOAD, threshold=85).collect()}
    once = {}
    for pid, n, fl, _, year, value in right:
        if year is not None:
            once[fl, year] = min(once.get((fl, year), (0, 0, "")), (-value, pid, n)) if (fl, year) in once else (-value, pid, n)
    wanted = {}
    for i, name, _, year in left:
        if year is None:
            continue
        scored = sorted((-token_set_score(name, n), v, pid) for (_, y), (v, pid, n) in once.items() if abs(y - year) <= 1)
        if scored and -scored[0][0] >= 85 and (len(scored) == 1 or scored[1][0] - scored[0][0] >= 5):
            wanted[i] = scored[0][2]
    assert wanted and got == wanted
