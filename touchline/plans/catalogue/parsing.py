"""Text keys and value parsing. The strings are built from the tables' own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import parse, text
from touchline.operators.columns import coerce_numbers, to_numbers
from touchline.plans.catalogue.tables import read, rounded

_SPECIAL = r"[\p{C}\p{Zl}\p{Zp}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"


# Fixed values of the SQL, stated apart from the code that it checks.
_SPELLED = {
    "ł": "l", "ø": "o", "đ": "d", "ı": "i", "ħ": "h", "ŧ": "t", "ð": "d", "ĸ": "k",
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng", "ĳ": "ij",
}


def _folded(c: str) -> str:
    """SQL for lower-case ASCII text."""
    sql = f"lower({c})"
    for letter, plain in _SPELLED.items():
        sql = f"replace({sql}, '{letter}', '{plain}')"
    return f"regexp_replace(strip_accents({sql}), '[^\\x00-\\x7F]', '', 'g')"


def norm_key(spark, folder):
    talk = read(spark, folder, "conversations")
    return talk.select("conv_id", "turn", text.name_key(F.col("text")).alias("name_key"))


def norm_key_dropping(spark, folder):
    docs = read(spark, folder, "documents")
    return docs.select("doc_id", F.md5(text.name_key(F.col("text"), spell_out=False)).alias("name_key"))


def norm_key_nfkd(spark, folder):
    docs = read(spark, folder, "documents")
    return docs.select("doc_id", F.md5(text.name_key(F.col("text"), spell_out=False, expand=True)).alias("name_key"))


def norm_name_fl(spark, folder):
    docs = read(spark, folder, "documents").withColumn("norm", text.match_text(F.col("text")))
    return docs.select("doc_id", F.md5("norm").alias("norm_md5"), text.first_last(F.col("norm")).alias("first_last"))


def club_names(spark, folder):
    """Club spellings made from the part table: known aliases, prefixes, brackets and unknown clubs."""
    club = F.element_at(F.array(*[F.lit(c) for c in _CLUBS]), (F.col("p_partkey") % len(_CLUBS) + 1).cast("int"))
    spelled = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("C.A. "), club))
        .when(F.col("p_partkey") % 3 == 1, F.concat(club, F.lit(" ("), "p_brand", F.lit(")")))
        .otherwise(F.concat(club, F.lit(" "), F.col("p_type")))
    )
    return read(spark, folder, "part").select("p_partkey", text.club_key(spelled).alias("club"))


_CLUBS = ["Boca", "River Plate", "Vélez Sarsfield", "Lanús", "Newell's Old Boys", "Club Atlético Platense", "Huracán", "Unión"]


def parse_money(spark, folder):
    price = F.col("o_totalprice")
    whole, kind = F.floor(price).cast("string"), F.col("o_orderkey") % 9
    grouped = F.format_number(F.floor(price), 0)
    written = (
        F.when(kind == 0, F.concat(F.replace(F.round(price / 1000, 2).cast("string"), F.lit("."), F.lit(",")), F.lit(" mill. €")))
        .when(kind == 1, F.concat(whole, F.lit(" mil €")))
        .when(kind == 2, F.concat(F.lit("€"), F.col("o_custkey").cast("string"), F.lit("."), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit("m")))
        .when(kind == 3, F.concat(F.lit("€"), F.col("o_custkey").cast("string"), F.lit("k")))
        .when(kind == 4, F.concat(F.col("o_custkey").cast("string"), F.lit(" Th. €")))
        .when(kind == 5, F.concat(F.col("o_custkey").cast("string"), F.lit(".25bn")))
        .when(kind == 6, F.lit("-"))
        .when(kind == 7, F.concat(F.lit("1,"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit(",500")))
        .otherwise(F.concat(F.lit("about "), grouped))
    )
    return read(spark, folder, "orders").select("o_orderkey", parse.money_to_eur(written).alias("eur"))


def parse_money_loose(spark, folder):
    kind = F.col("o_orderkey") % 7
    cust = F.col("o_custkey").cast("string")
    written = (
        F.when(kind == 0, F.concat(F.lit("€ 1.2"), F.lpad(cust, 6, "0"), F.lit(",50")))
        .when(kind == 1, F.concat(F.lit("1.200."), cust))
        .when(kind == 2, F.concat(cust, F.lit(",5")))
        .when(kind == 3, F.concat(F.lit("-"), cust))
        .when(kind == 4, F.lit("abc"))
        .when(kind == 5, F.lit(" NaN "))
        .otherwise(F.concat(cust, F.lit(" EUR")))
    )
    return read(spark, folder, "orders").select("o_orderkey", rounded(parse.money_loose(written)).alias("value"))


def _written_dates():
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 7
    return (
        F.when(kind == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(kind == 1, F.date_format(day, "d.M.yyyy"))
        .when(kind == 2, F.date_format(day, "d-M-yyyy"))
        .when(kind == 3, F.date_format(day, "MMMM d, yyyy"))
        .when(kind == 4, F.date_format(day, "MMM d, yyyy"))
        .when(kind == 5, F.concat(F.lit("31/02/"), F.year(day)))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def parse_dob(spark, folder):
    written = _written_dates()
    return read(spark, folder, "orders").select(
        "o_orderkey",
        parse.iso_date_strict(written).alias("strict"),
        parse.iso_date_loose(written).alias("loose"),
        F.coalesce(parse.iso_date_or_null(written), F.lit("none")).alias("exact"),
        F.coalesce(parse.year_in(written), F.lit(-1)).alias("year"),
    )


def parse_age(spark, folder):
    kind, n = F.col("o_orderkey") % 4, F.col("o_custkey") % 40
    written = (
        F.when(kind == 0, F.concat(n, F.lit("-"), F.lpad((F.col("o_orderkey") % 365).cast("string"), 3, "0")))
        .when(kind == 1, n.cast("string"))
        .when(kind == 2, F.concat(n, F.lit(".7")))
        .otherwise(F.lit("x-1"))
    )
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.coalesce(parse.age_in_years(written), F.lit(-1.0)).alias("age_years"),
        F.coalesce(parse.leading_int(written), F.lit(-1)).alias("age_int"),
        F.coalesce(parse.birth_year(F.lit(None).cast("string"), written, 2024), F.lit(-1)).alias("birth_year"),
    )


def age_at(spark, folder):
    born = F.date_format("o_orderdate", "yyyy-MM-dd")
    dob = F.when(F.col("o_orderkey") % 3 != 0, born)
    return read(spark, folder, "orders").select(
        "o_orderkey",
        parse.age_on(dob, F.lit("2021-02-28").cast("date"), F.year("o_orderdate")).alias("age"),
    )


def coerce_fill0(spark, folder):
    events = read(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
        F.concat(F.regexp_extract("props", r"(\d+)", 1), F.lit("%")).alias("share"),
        F.concat(F.lit("1,"), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0")).alias("grouped"),
        F.when(F.col("event_id") % 3 == 0, F.lit("nan")).otherwise(F.col("value").cast("string")).alias("value"),
    )
    return coerce_numbers(events, ["event_id", "event_type"])


def coerce_null(spark, folder):
    events = read(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.regexp_extract("props", r"(\d+)", 1).alias("k"),
    )
    return to_numbers(events, ["value", "k", "absent"])


def coalesce_blank(spark, folder):
    kind = F.col("doc_id") % 5
    first = F.when(kind == 0, "").when(kind == 1, " NaN ").when(kind == 2, "None").when(kind == 3, F.lit(None)).otherwise(F.col("lang"))
    second = F.when(F.col("doc_id") % 2 == 0, F.lit("null")).otherwise(F.col("source"))
    return read(spark, folder, "documents").select(
        "doc_id", F.coalesce(parse.first_filled(first, second), F.lit("nothing")).alias("filled")
    )


def parse_bool(spark, folder):
    kind, quality = F.col("doc_id") % 4, F.col("quality")
    written = (
        F.when(kind == 0, F.when(quality == 1, " TRUE ").otherwise("False"))
        .when(kind == 1, F.when(quality == 1, "y").otherwise("n"))
        .when(kind == 2, quality.cast("string"))
        .otherwise(" ")
    )
    return read(spark, folder, "labels").select("doc_id", F.coalesce(parse.flag(written).cast("string"), F.lit("unknown")).alias("flag"))


def season_names(spark, folder):
    year, kind = F.year("o_orderdate"), F.col("o_orderkey") % 4
    written = (
        F.when(kind == 0, year.cast("string"))
        .when(kind == 1, F.concat(year, F.lit("-"), year + 1))
        .when(kind == 2, F.concat(year, F.lit(" / "), year + 1))
        .otherwise(F.concat(F.lit("s"), year))
    )
    league = F.element_at(F.array(*[F.lit(c) for c in ("arg", "PL", "xyz", "sau")]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.coalesce(parse.season_start(written), F.lit(-1)).alias("season_start"),
        parse.league_title(league).alias("league_title"),
        parse.file_slug(F.coalesce(parse.stat_league(F.element_at(F.array(F.lit("eng1"), F.lit("ARG1"), F.lit("Eredivisie")), (F.col("o_custkey") % 3 + 1).cast("int"))), F.lit(""))).alias("slug"),
    )


_DATE_CASE = """CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%-d.%-m.%Y')
  WHEN 2 THEN strftime(o_orderdate, '%-d-%-m-%Y') WHEN 3 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 4 THEN strftime(o_orderdate, '%b %-d, %Y')
  WHEN 5 THEN '31/02/' || year(o_orderdate) ELSE strftime(o_orderdate, '%Y-%m-%d') END"""

QUERIES = {
    "norm_key": (norm_key, f"""
SELECT conv_id, turn, trim(regexp_replace({_folded(f"regexp_replace(text, '{_SPECIAL}', '', 'g')")}, '\\s+', ' ', 'g')) AS name_key
FROM conversations"""),
    "norm_key_dropping": (norm_key_dropping, f"""
SELECT doc_id, md5(trim(regexp_replace(lower(regexp_replace(strip_accents(regexp_replace(text, '{_SPECIAL}', '', 'g')), '[^\\x00-\\x7F]', '', 'g')), '\\s+', ' ', 'g'))) AS name_key
FROM documents"""),
    "norm_key_nfkd": (norm_key_nfkd, f"""
SELECT doc_id, md5(trim(regexp_replace(lower(regexp_replace(strip_accents(regexp_replace(text, '{_SPECIAL}', '', 'g')), '[^\\x00-\\x7F]', '', 'g')), '\\s+', ' ', 'g'))) AS name_key
FROM documents"""),
    "norm_name_fl": (norm_name_fl, f"""
WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all({_folded('text')}, '\\([^)]*\\)|[a-z0-9]+|[^a-z0-9]')) AS token FROM documents),
numbered AS (SELECT doc_id, token, row_number() OVER () AS i FROM tokens WHERE token[1] <> '('),
near AS (SELECT *, lag(token) OVER w AS p1, lag(token, 2) OVER w AS p2, lead(token) OVER w AS n1, lead(token, 2) OVER w AS n2 FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
kept AS (SELECT * FROM near WHERE regexp_matches(token, '^[a-z0-9]') AND token <> 'ca'
  AND NOT coalesce((token = 'c' AND n1 = '.' AND n2 = 'a') OR (token = 'a' AND p1 = '.' AND p2 = 'c'), false)
  AND NOT coalesce((token = 'club' AND n1 IN (' ', chr(10)) AND n2 = 'atletico') OR (token = 'atletico' AND p1 IN (' ', chr(10)) AND p2 = 'club'), false)),
n AS (SELECT d.doc_id, coalesce(string_agg(token, ' ' ORDER BY i), '') AS norm FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id),
w AS (SELECT doc_id, norm, list_filter(string_split(norm, ' '), lambda t: t <> '' AND t NOT IN ('de', 'del', 'da', 'do', 'das', 'dos', 'la', 'las', 'los', 'san', 'santa', 'club', 'atletico')) AS words FROM n)
SELECT doc_id, md5(norm) AS norm_md5,
       CASE len(words) WHEN 0 THEN norm WHEN 1 THEN words[1] ELSE words[1] || ' ' || words[-1] END AS first_last FROM w"""),
    "club_names": (club_names, """
SELECT p_partkey, CASE WHEN p_partkey % 3 < 2
    THEN ['boca juniors', 'river plate', 'velez sarsfield', 'lanus', 'newells old boys', 'platense', 'huracan', 'union'][p_partkey % 8 + 1]
    ELSE ['boca', 'river plate', 'velez sarsfield', 'lanus', 'newell s old boys', 'platense', 'huracan', 'union'][p_partkey % 8 + 1] || ' ' || lower(p_type) END AS club
FROM part"""),
    "parse_money": (parse_money, """
SELECT o_orderkey, CAST(CASE o_orderkey % 9
  WHEN 0 THEN CAST(round(o_totalprice / 1000, 2) AS DECIMAL(18,2)) * 1000000 WHEN 1 THEN floor(o_totalprice) * 1000 WHEN 2 THEN o_custkey * 1000000 + (o_orderkey % 1000) * 1000
  WHEN 3 THEN o_custkey * 1000 WHEN 4 THEN o_custkey * 1000 WHEN 5 THEN o_custkey * 1000000000 + 250000000
  WHEN 7 THEN 1000500 + (o_custkey % 1000) * 1000 END AS BIGINT) AS eur
FROM orders"""),
    "parse_money_loose": (parse_money_loose, """
SELECT o_orderkey, CAST(CASE o_orderkey % 7
  WHEN 0 THEN CAST('12' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '.50' AS DOUBLE)
  WHEN 1 THEN CAST('1200' || o_custkey AS DOUBLE) WHEN 2 THEN o_custkey + 0.5 WHEN 3 THEN o_custkey WHEN 6 THEN o_custkey END AS DOUBLE) AS value
FROM orders"""),
    "parse_dob": (parse_dob, f"""
WITH d AS (SELECT o_orderkey, o_orderkey % 7 AS kind, {_DATE_CASE} AS written, strftime(o_orderdate, '%Y-%m-%d') AS iso, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey, CASE WHEN kind IN (5, 6) THEN '' ELSE iso END AS strict,
       CASE WHEN kind IN (0, 1, 6) THEN iso WHEN kind = 5 THEN y || '-02-31' ELSE written END AS loose,
       CASE WHEN kind IN (0, 1, 6) THEN iso ELSE 'none' END AS exact, CAST(y AS INTEGER) AS year FROM d"""),
    "parse_age": (parse_age, """
WITH a AS (SELECT o_orderkey, o_orderkey % 4 AS kind, o_custkey % 40 AS n, o_orderkey % 365 AS d FROM orders)
SELECT o_orderkey, CASE kind WHEN 0 THEN round_even(n + d / 365, 2) WHEN 1 THEN n WHEN 2 THEN CAST(n || '.7' AS DOUBLE) ELSE -1.0 END AS age_years,
       CAST(CASE WHEN kind < 3 THEN n ELSE -1 END AS INTEGER) AS age_int, CAST(CASE WHEN kind < 3 THEN 2024 - n ELSE -1 END AS INTEGER) AS birth_year FROM a"""),
    "age_at": (age_at, """
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) ELSE make_date(year(o_orderdate), 7, 1) END AS day FROM orders),
b AS (SELECT o_orderkey, CASE WHEN strftime(day, '%m-%d') = '02-29' THEN day - 1 ELSE day END AS born FROM d)
SELECT o_orderkey, CAST(CASE WHEN born <= DATE '2021-02-28' THEN date_part('year', age(TIMESTAMP '2021-02-28', CAST(born AS TIMESTAMP)))
  ELSE -1 - date_part('year', age(CAST(born AS TIMESTAMP) - INTERVAL 1 DAY, TIMESTAMP '2021-02-28')) END AS INTEGER) AS age FROM b"""),
    "coerce_fill0": (coerce_fill0, """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 5 <> 0 THEN event_type ELSE '' END AS event_type,
       CAST(coalesce(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE), 0) AS DOUBLE) AS share,
       CAST('1' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS DOUBLE) AS grouped,
       CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS value FROM events"""),
    "coerce_null": (coerce_null, """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS k FROM events"""),
    "coalesce_blank": (coalesce_blank, """
SELECT doc_id, coalesce(CASE WHEN doc_id % 5 = 4 THEN lang END, CASE WHEN doc_id % 2 = 1 THEN source END, 'nothing') AS filled FROM documents"""),
    "parse_bool": (parse_bool, """
SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'unknown' WHEN quality = 1 THEN 'true' ELSE 'false' END AS flag FROM labels"""),
    "season_names": (season_names, """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 3 THEN -1 ELSE year(o_orderdate) END AS INTEGER) AS season_start,
       ['Primera División Argentina', 'Premier League', 'XYZ', 'Saudi Pro League'][o_custkey % 4 + 1] AS league_title,
       ['Premier_League', 'Primera_Division_Argentina', 'Eredivisie'][o_custkey % 3 + 1] AS slug FROM orders"""),
}
