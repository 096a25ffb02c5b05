"""Entity resolution on the part table against a perturbed copy of itself, so that every step fires."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.similarity import token_set_ratio
from touchline.functions.text import club_key, first_last, match_text
from touchline.operators import closure, resolve, stable
from touchline.operators.resolve import STAGES
from touchline.plans.catalogue.tables import read, rounded
from touchline.session import materialize


def _key(name):
    return {"player_norm": match_text(name), "player_fl": first_last(match_text(name))}


def _dob():
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("p_partkey").cast("int")), "yyyy-MM-dd")


def _right(spark, folder):
    """Two of three parts: name, brand as club, size as year of birth, price as value."""
    part = read(spark, folder, "part").filter(F.col("p_partkey") % 3 != 0)
    return part.select(
        F.col("p_partkey").alias("player_id"),
        *[c.alias(n) for n, c in _key(F.col("p_name")).items()],
        club_key(F.col("p_brand")).alias("club_norm"),
        F.col("p_size").alias("birth_year"),
        _dob().alias("dob_iso"),
        _dob().alias("dob"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("market_value_eur"),
        F.col("p_size").alias("age"),
    )


def _left(spark, folder):
    """All parts: a middle word for every fourth, missing clubs, shifted years, exact dates for some."""
    part, n = read(spark, folder, "part"), F.col("p_partkey")
    words = F.split("p_name", " ")
    name = F.when(n % 4 == 0, F.concat_ws(" ", words[0], F.lower("p_type"), words[1])).otherwise(F.col("p_name"))
    year = (
        F.when(n % 13 == 0, F.lit(None).cast("int"))
        .when(n % 11 == 0, F.col("p_size") + 200)
        .when(n % 5 == 0, F.col("p_size") + 1)
        .when(n % 6 == 1, F.col("p_size") - 1)
        .otherwise(F.col("p_size"))
    )
    return part.select(
        n.alias("row_id"),
        *[c.alias(k) for k, c in _key(name).items()],
        F.when(n % 7 != 0, club_key(F.col("p_brand"))).alias("club_norm"),
        year.alias("birth_year"),
        F.when(n % 11 == 0, _dob()).alias("dob_iso"),
    )


def _misspelled(spark, folder, by_year: bool):
    """Left rows with a wrong letter in the name, so that no exact step applies; years far off unless wanted."""
    part, n = read(spark, folder, "part"), F.col("p_partkey")
    cut = (n % 3 + 2).cast("int")
    base = F.col("p_name")
    short = F.concat(F.substring(base, F.lit(1), cut - 1), F.substring(base, cut + 1, F.length(base)))
    longer = F.concat(base, F.lit("x"))
    name = F.when(n % 2 == 0, short).otherwise(longer)
    return part.select(
        n.alias("row_id"),
        *[c.alias(k) for k, c in _key(name).items()],
        F.lit(None).cast("string").alias("club_norm") if by_year else club_key(F.col("p_brand")).alias("club_norm"),
        (F.col("p_size") if by_year else F.col("p_size") + 500).alias("birth_year"),
        F.lit(None).cast("string").alias("dob_iso"),
    )


_OUT = ["row_id", "stage", "join_method", "player_id", "market_value_eur"]


def _exact(spark, folder):
    return resolve.resolve(_left(spark, folder), _right(spark, folder), fuzzy=False)


def resolve_exact(spark, folder):
    return _exact(spark, folder).select(*_OUT)


def resolve_breakdown(spark, folder):
    return resolve.breakdown(_exact(spark, folder))


def resolve_totals(spark, folder):
    return resolve.match_totals(_exact(spark, folder))


def resolve_unmatched(spark, folder):
    return resolve.unmatched(_exact(spark, folder), ["row_id", "player_norm", "player_fl"])


def resolve_one_to_one(spark, folder):
    return resolve.resolve(_left(spark, folder), _right(spark, folder), fuzzy=False, one_to_one=True).select(*_OUT)


def resolve_stable(spark, folder):
    """One to one; a part that loses its candidate gets the next one of the key."""
    return stable.resolve_stable(_left(spark, folder), _right(spark, folder)).select(*_OUT)


def crosswalk(spark, folder):
    return resolve.crosswalk(_exact(spark, folder), "row_id")


def _pairs(spark, folder):
    """Pairs of three sources: what the exact cascade found, and two lists that tie some ids to those of a third source, in which
    neighbouring numbers share an id."""
    both = _exact(spark, folder).filter(F.col("player_id").isNotNull())
    pair = lambda a, i, b, j: [F.lit(a).alias("source_a"), F.col(i).alias("id_a"), F.lit(b).alias("source_b"), j.cast("long").alias("id_b")]
    first = both.select(*pair("left", "row_id", "right", F.col("player_id")))
    part = read(spark, folder, "part")
    second = part.filter(F.col("p_partkey") % 7 == 0).select(*pair("left", "p_partkey", "third", F.floor(F.col("p_partkey") / 2)))
    third = part.filter(F.col("p_partkey") % 5 == 1).select(*pair("right", "p_partkey", "third", F.floor(F.col("p_partkey") / 3)))
    return materialize(first.unionByName(second).unionByName(third), "pairs")


def crosswalk_closure(spark, folder):
    return closure.crosswalk_closure(_pairs(spark, folder))


def crosswalk_contradictions(spark, folder):
    pairs = _pairs(spark, folder)
    return closure.contradictions(materialize(closure.crosswalk_closure(pairs), "crosswalk"), pairs)


def resolve_by_type(spark, folder):
    """The cascade within each part type, as for one run over many leagues."""
    kind = read(spark, folder, "part").select(F.col("p_partkey").alias("key"), F.col("p_type").alias("league"))
    left = _left(spark, folder).join(kind.hint("merge"), F.col("row_id") == F.col("key")).drop("key")
    right = _right(spark, folder).join(kind.hint("merge"), F.col("player_id") == F.col("key")).drop("key")
    return resolve.resolve(left, right, ["league"], fuzzy=False).select("league", *_OUT)


def resolve_fuzzy_club(spark, folder):
    found = resolve.resolve(_misspelled(spark, folder, False), _right(spark, folder))
    return found.select(*_OUT, rounded("score").alias("score"))


def resolve_fuzzy_global(spark, folder):
    found = resolve.resolve(_misspelled(spark, folder, True), _right(spark, folder))
    return found.select(*_OUT, rounded("score").alias("score"))


def name_scores(spark, folder):
    """Similarity of every part name to its type-and-brand text and to its own misspelling."""
    part = _misspelled(spark, folder, False).select("row_id", F.col("player_norm").alias("a"))
    names = read(spark, folder, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.when(F.col("p_partkey") % 5 == 0, F.concat_ws(" ", F.lower("p_type"), "p_name")).otherwise(F.col("p_name")).alias("b"),
    )
    return part.join(names, "row_id").select("row_id", rounded(token_set_ratio("a", "b")).alias("score"))


_RIGHT = """r AS (
  SELECT p_partkey AS id, p_name AS norm, p_name AS fl, replace(lower(p_brand), '#', ' ') AS club, p_size AS yr,
         strftime(DATE '1970-01-01' + CAST(p_partkey AS INTEGER), '%Y-%m-%d') AS dob, CAST(round(p_retailprice * 100) AS BIGINT) AS val, p_type AS league
  FROM part WHERE p_partkey % 3 <> 0)"""
_LEFT = """l AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN split_part(p_name, ' ', 1) || ' ' || lower(p_type) || ' ' || split_part(p_name, ' ', 2) ELSE p_name END AS norm,
         p_name AS fl, CASE WHEN p_partkey % 7 <> 0 THEN replace(lower(p_brand), '#', ' ') END AS club,
         CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN p_size + 200 WHEN p_partkey % 5 = 0 THEN p_size + 1
              WHEN p_partkey % 6 = 1 THEN p_size - 1 ELSE p_size END AS yr,
         CASE WHEN p_partkey % 11 = 0 THEN strftime(DATE '1970-01-01' + CAST(p_partkey AS INTEGER), '%Y-%m-%d') END AS dob, p_type AS league
  FROM part)"""


def _stage_sql(scope: tuple[str, ...] = ()) -> str:
    keys = {
        "norm_club_year": ["norm", "club", "yr"], "fl_club_year": ["fl", "club", "yr"], "fl_dob": ["fl", "dob"],
        "fl_year": ["fl", "yr"], "norm_club": ["norm", "club"],
    }
    steps = []
    for stage, family, shift, label in STAGES:
        cols = [*scope, *keys[family.removesuffix("_once")]]
        once = " AND k.n = 1" if family.endswith("_once") else ""
        on = " AND ".join(f"l.{c}{f' + {shift}' if c == 'yr' else ''} = k.{c}" for c in cols)
        part = ", ".join(cols)
        steps.append(
            f"SELECT l.id AS row_id, {stage} AS stage, '{label}' AS join_method, k.id AS player_id, k.val AS market_value_eur FROM l JOIN "
            f"(SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY val DESC, id) AS place, count(*) OVER (PARTITION BY {part}) AS n FROM r) k "
            f"ON {on} AND k.place = 1{once}"
        )
    return "hits AS (" + " UNION ALL ".join(steps) + ")"




def _exact_sql(scope: tuple[str, ...] = ()) -> str:
    return f"""WITH {_RIGHT}, {_LEFT}, {_stage_sql(scope)},
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY stage) AS place FROM hits) WHERE place = 1),
resolved AS (SELECT l.id AS row_id, l.norm, l.fl, l.league, stage, join_method, player_id, market_value_eur FROM l LEFT JOIN best ON l.id = best.row_id)"""


_EXACT = _exact_sql()


def score_sql(a: str, b: str) -> str:
    """Token-set score of two names as SQL; the subsequence length by a bit per letter."""
    ta, tb = (f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))" for x in (a, b))
    return f"""(WITH w AS (SELECT {ta} AS ta, {tb} AS tb),
  p AS (SELECT len(ta) AS na, len(tb) AS nb, array_to_string(list_sort(list_filter(ta, lambda t: list_contains(tb, t))), ' ') AS s,
    array_to_string(list_sort(list_filter(ta, lambda t: NOT list_contains(tb, t))), ' ') AS x,
    array_to_string(list_sort(list_filter(tb, lambda t: NOT list_contains(ta, t))), ' ') AS y FROM w),
  q AS (SELECT *, CASE WHEN s = '' THEN 0 ELSE 1 END AS g, (CAST(1 AS HUGEINT) << length(x)) - 1 AS f,
    list_transform(range(1, length(y) + 1), lambda j: coalesce(list_sum(list_transform(range(1, length(x) + 1),
      lambda i: CASE WHEN substr(x, i, 1) = substr(y, j, 1) THEN CAST(1 AS HUGEINT) << CAST(i - 1 AS INTEGER) ELSE CAST(0 AS HUGEINT) END)), CAST(0 AS HUGEINT))) AS masks FROM p),
  c AS (SELECT *, length(s) + g + length(x) AS la, length(s) + g + length(y) AS lb,
    length(x) - bit_count(list_reduce(list_prepend(f, list_transform(masks, lambda m: CAST(m AS HUGEINT))), lambda u, m: ((u + (u & m)) | (u - (u & m))) & f)) AS lcs FROM q)
  SELECT CASE WHEN na = 0 OR nb = 0 THEN 0.0 WHEN g = 1 AND (x = '' OR y = '') THEN 100.0
    WHEN g = 0 THEN 100.0 * (1 - (length(x) + length(y) - 2 * lcs) / (la + lb))
    ELSE greatest(100.0 * (1 - (length(x) + length(y) - 2 * lcs) / (la + lb)), 100.0 * (1 - (g + length(x)) / (length(s) + la)),
                  100.0 * (1 - (g + length(y)) / (length(s) + lb))) END FROM c)"""


_CLOSED = f"""{_EXACT.replace("WITH ", "WITH RECURSIVE ", 1)},
pairs AS (SELECT 'left' AS source_a, row_id AS id_a, 'right' AS source_b, player_id AS id_b FROM resolved WHERE player_id IS NOT NULL
  UNION ALL SELECT 'left', p_partkey, 'third', p_partkey // 2 FROM part WHERE p_partkey % 7 = 0
  UNION ALL SELECT 'right', p_partkey, 'third', p_partkey // 3 FROM part WHERE p_partkey % 5 = 1),
links AS (SELECT source_a || ':' || id_a AS a, source_b || ':' || id_b AS b FROM pairs),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(id, other) AS (SELECT DISTINCT a, a FROM ways UNION SELECT ways.b, other FROM reached JOIN ways ON id = a),
roots AS (SELECT id, min(other) AS root FROM reached GROUP BY id),
closed AS (SELECT sha256(root) AS player_uuid, split_part(id, ':', 1) AS source, split_part(id, ':', 2) AS source_player_id FROM roots)"""


def _stable_sql() -> str:
    """The steps in a row: rows not matched so far, numbered on both sides within each key, meet by number."""
    steps = [
        (10, "key+birth_year", ["norm", "club", "yr"], 0, False), (20, "first+last+club+birth_year", ["fl", "club", "yr"], 0, False),
        (21, "first+last+club+birth_year±1", ["fl", "club", "yr"], 1, True), (22, "first+last+club+birth_year±1", ["fl", "club", "yr"], -1, True),
        (30, "first+last+dob", ["fl", "dob"], 0, False), (40, "first+last+birth_year", ["fl", "yr"], 0, False),
        (41, "first+last+birth_year±1(unique)", ["fl", "yr"], 1, True), (42, "first+last+birth_year±1(unique)", ["fl", "yr"], -1, True),
        (50, "key_no_year", ["norm", "club"], 0, False),
    ]
    parts, done = [], ["SELECT NULL AS row_id, NULL AS player_id WHERE false"]
    for stage, label, cols, shift, once in steps:
        key, matched = ", ".join(cols), " UNION ALL ".join(done)
        own = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        on = " AND ".join(f"a.{c}{f' + {shift}' if c == 'yr' else ''} = b.{c}" for c in cols)
        parts.append(f"""m{stage} AS MATERIALIZED (SELECT a.id AS row_id, {stage} AS stage, '{label}' AS join_method, b.id AS player_id, b.val AS market_value_eur
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY id) AS nth FROM l WHERE {own} AND id NOT IN (SELECT row_id FROM ({matched}))) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY val DESC, id) AS nth FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM r WHERE {own})
        WHERE id NOT IN (SELECT player_id FROM ({matched})){" AND n = 1" if once else ""}) b ON {on} AND a.nth = b.nth)""")
        done.append(f"SELECT row_id, player_id FROM m{stage}")
    union = " UNION ALL ".join(f"SELECT * FROM m{stage}" for stage, *_ in steps)
    return f"""WITH {_RIGHT}, {_LEFT}, {", ".join(parts)}, matched AS ({union})
SELECT l.id AS row_id, stage, join_method, player_id, market_value_eur FROM l LEFT JOIN matched ON l.id = row_id"""


_MISSPELLED = """CASE WHEN p_partkey % 2 = 0 THEN substr(p_name, 1, p_partkey % 3 + 1) || substr(p_name, p_partkey % 3 + 3) ELSE p_name || 'x' END"""
_MISSPELLED_NORM = f"trim(regexp_replace({_MISSPELLED}, '\\s+', ' ', 'g'))"
_LABEL = "round(score, 1) || ')'"

QUERIES = {
    "resolve_exact": (resolve_exact, f"{_EXACT} SELECT row_id, stage, join_method, player_id, market_value_eur FROM resolved"),
    "resolve_breakdown": (resolve_breakdown, f"{_EXACT} SELECT coalesce(join_method, '') AS join_method, count(*) AS n_rows FROM resolved GROUP BY 1"),
    "resolve_totals": (resolve_totals, f"""{_EXACT} SELECT count(*) AS n_rows, count(player_id) AS matched, count(*) - count(player_id) AS unmatched FROM resolved"""),
    "resolve_unmatched": (resolve_unmatched, f"{_EXACT} SELECT row_id, norm AS player_norm, fl AS player_fl FROM resolved WHERE player_id IS NULL"),
    "resolve_one_to_one": (resolve_one_to_one, f"""{_EXACT},
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY stage, row_id) AS turn FROM best) WHERE turn = 1)
SELECT l.id AS row_id, stage, join_method, player_id, market_value_eur FROM l LEFT JOIN kept ON l.id = kept.row_id"""),
    "resolve_stable": (resolve_stable, _stable_sql()),
    "crosswalk": (crosswalk, f"""{_EXACT},
u AS (SELECT row_id, player_id, sha256(CASE WHEN player_id IS NOT NULL THEN 'transfermarkt:' || player_id ELSE 'fbref:' || row_id END) AS player_uuid FROM resolved)
SELECT player_uuid, 'fbref' AS source, CAST(row_id AS VARCHAR) AS source_player_id FROM u
UNION SELECT player_uuid, 'transfermarkt', CAST(player_id AS VARCHAR) FROM u WHERE player_id IS NOT NULL"""),
    "crosswalk_closure": (crosswalk_closure, f"{_CLOSED} SELECT * FROM closed"),
    "crosswalk_contradictions": (crosswalk_contradictions, f"""{_CLOSED},
several AS (SELECT player_uuid, source, count(DISTINCT source_player_id) AS n_ids, min(source_player_id) AS first_id, max(source_player_id) AS last_id FROM closed GROUP BY ALL HAVING n_ids > 1),
tied AS (SELECT player_uuid, count(*) AS n_pairs FROM pairs JOIN closed ON source = source_a AND source_player_id = CAST(id_a AS VARCHAR) GROUP BY 1)
SELECT several.*, n_pairs FROM several JOIN tied USING (player_uuid)"""),
    "resolve_by_type": (resolve_by_type, f"{_exact_sql(('league',))} SELECT league, row_id, stage, join_method, player_id, market_value_eur FROM resolved"),
    "resolve_fuzzy_club": (resolve_fuzzy_club, f"""
WITH {_RIGHT}, l AS (SELECT p_partkey AS id, {_MISSPELLED_NORM} AS norm, replace(lower(p_brand), '#', ' ') AS club FROM part),
names AS (SELECT DISTINCT a.norm AS a, b.norm AS b FROM (SELECT DISTINCT norm FROM l) a, (SELECT DISTINCT norm FROM r) b),
scored AS (SELECT a, b, {score_sql('a', 'b')} AS score FROM names),
best AS (SELECT * FROM (SELECT l.id AS row_id, r.id AS player_id, r.val AS market_value_eur, score,
    row_number() OVER (PARTITION BY l.id ORDER BY score DESC, val DESC, r.id) AS place
  FROM l JOIN r ON l.club = r.club JOIN scored ON l.norm = a AND r.norm = b WHERE score >= 90) WHERE place = 1)
SELECT l.id AS row_id, CASE WHEN score IS NOT NULL THEN 60 END AS stage, 'fuzzy_club(' || {_LABEL} AS join_method, player_id, market_value_eur, round(score, 4) + 0.0 AS score
FROM l LEFT JOIN best ON l.id = best.row_id"""),
    "resolve_fuzzy_global": (resolve_fuzzy_global, f"""
WITH {_RIGHT}, l AS (SELECT p_partkey AS id, {_MISSPELLED_NORM} AS norm, p_size AS yr FROM part),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fl, yr ORDER BY val DESC, id) AS place FROM r) WHERE place = 1),
names AS (SELECT DISTINCT a.norm AS a, b.norm AS b FROM (SELECT DISTINCT norm FROM l) a, (SELECT DISTINCT norm FROM r) b),
scored AS (SELECT a, b, {score_sql('a', 'b')} AS score FROM names),
ranked AS (SELECT l.id AS row_id, o.id AS player_id, o.val AS market_value_eur, score,
    row_number() OVER (PARTITION BY l.id ORDER BY score DESC, val DESC, o.id) AS place,
    lead(score) OVER (PARTITION BY l.id ORDER BY score DESC, val DESC, o.id) AS second
  FROM l JOIN once o ON o.yr BETWEEN l.yr - 1 AND l.yr + 1 JOIN scored ON l.norm = a AND o.norm = b),
best AS (SELECT * FROM ranked WHERE place = 1 AND score >= 93 AND (second IS NULL OR score - second >= 5))
SELECT l.id AS row_id, CASE WHEN score IS NOT NULL THEN 70 END AS stage, 'fuzzy_global(' || {_LABEL} AS join_method, player_id, market_value_eur, round(score, 4) + 0.0 AS score
FROM l LEFT JOIN best ON l.id = best.row_id"""),
    "name_scores": (name_scores, f"""
WITH n AS (SELECT p_partkey AS row_id, {_MISSPELLED_NORM} AS a, CASE WHEN p_partkey % 5 = 0 THEN lower(p_type) || ' ' || p_name ELSE p_name END AS b FROM part),
d AS (SELECT DISTINCT a, b FROM n), s AS (SELECT a, b, {score_sql('a', 'b')} AS score FROM d)
SELECT row_id, round(score, 4) + 0.0 AS score FROM n JOIN s USING (a, b)"""),
}
