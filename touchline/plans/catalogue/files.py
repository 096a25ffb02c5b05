"""Sources, sinks and page extraction. What is written goes to the shared folder the session names."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.parse import league_title
from touchline.operators import columns, consolidate
from touchline.operators.columns import conform, ensure_columns
from touchline.plans.catalogue.tables import read
from touchline.schemas import FIELD_PLAYERS
from touchline.session import materialize, scratch_path
from touchline.sources import pages, readers, snapshots, writers


def _orders_by_season(spark, folder):
    return read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.lower("o_orderstatus").alias("league_code"), F.year("o_orderdate").cast("string").alias("season_code")
    )


def partition_refresh(spark, folder):
    """All orders loaded, then the finished ones of 1996 to 1998 loaded again at double price; 1998 has no rows now."""
    orders, path = _orders_by_season(spark, folder), scratch_path(spark, "refresh")
    writers.refresh_partitions(orders, path)
    again = orders.filter((F.col("league_code") == "f") & F.col("season_code").isin("1996", "1997", "1998"))
    doubled = again.filter(F.col("season_code") != "1998").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        writers.refresh_partitions(doubled, path, again)
    back = spark.read.option("basePath", path).parquet(path)
    return back.select("o_orderkey", "o_custkey", "o_totalprice", "league_code", F.col("season_code").cast("string").alias("season_code"))


def csv_roundtrip(spark, folder):
    """Semicolon CSV in Latin-1 with quoted text, read back with separator and encoding found from the file."""
    path = scratch_path(spark, "csv")
    docs = read(spark, folder, "documents").select(
        "doc_id", F.regexp_replace(F.col("text"), r"[^\x20-\x7E\u00A0-\u00FF]", " ").alias("text"), "lang", F.lit('a;"b').alias("Note")
    )
    writers.write_csv(docs, path, sep=";", encoding="ISO-8859-1")
    back = readers.read_csv(spark, path)
    return back.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.md5(F.trim("text")).alias("text_md5"), "lang", "Note")


def csv_mixed_headers(spark, folder):
    """Two files of one folder whose headers have other orders, another column and a quoted separator."""
    path = scratch_path(spark, "mixed")
    part = read(spark, folder, "part")
    even = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("full, name"))
    odd = part.filter("p_partkey % 2 = 1").select(F.col("p_name").alias("full, name"), F.col("p_brand").alias("Brand"), F.col("p_partkey").alias("id"))
    writers.write_csv(even, path)
    writers.write_csv(odd, path, mode="append")
    back = readers.read_csv(spark, path)
    return back.select(F.col("id").try_cast("long").alias("id"), F.col("`full, name`").alias("name"), F.coalesce("Brand", F.lit("-")).alias("brand"))


def csv_quoted_lines(spark, folder):
    """Texts with line breaks, quotes and separators, written and read back whole."""
    path = scratch_path(spark, "quoted")
    docs = read(spark, folder, "documents").select("doc_id", F.concat(F.lit('"a", '), F.replace("text", F.lit("\r"), F.lit(" "))).alias("text"))
    writers.write_csv(docs, path)
    back = readers.read_csv(spark, path, sep=",", multi_line=True)
    return back.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


def csv_bom(spark, folder):
    """A file with a byte order mark: the first column keeps its name."""
    path = scratch_path(spark, "bom")
    writers.write_csv(read(spark, folder, "nation").select("n_name", "n_nationkey"), path, bom=True)
    begins = F.hex(F.substring("content", F.lit(1), F.lit(3))) == "EFBBBF"
    marked = spark.read.format("binaryFile").load(path).agg(F.min(begins).alias("marked")).scalar()
    back = readers.read_csv(spark, path)
    return back.select("n_name", F.col("n_nationkey").try_cast("int").alias("n_nationkey"), marked.alias("marked"))


def refresh_null_partition(spark, folder):
    """Orders without a league are loaded, and then emptied again."""
    path = scratch_path(spark, "nulls")
    orders = _orders_by_season(spark, folder).withColumn("league_code", F.when(F.col("league_code") != "p", F.col("league_code")))
    writers.refresh_partitions(orders, path)
    unnamed = orders.filter(F.col("league_code").isNull())
    writers.refresh_partitions(unnamed.filter(F.col("season_code") != "1995").withColumn("o_totalprice", F.lit(0.0)), path, unnamed)
    back = spark.read.option("basePath", path).parquet(path)
    return back.select("o_orderkey", "o_totalprice", F.coalesce("league_code", F.lit("-")).alias("league_code"), F.col("season_code").cast("string").alias("season_code"))


def refresh_both(spark, folder):
    """Two tables refreshed as one load, twice."""
    root = scratch_path(spark, "both")
    orders = _orders_by_season(spark, folder)
    paths = {"finished": f"{root}/finished", "others": f"{root}/others"}
    for factor in (1, 3):
        priced = orders.withColumn("o_totalprice", F.col("o_totalprice") * factor)
        finished = F.col("league_code") == "f"
        writers.refresh_together({paths["finished"]: priced.filter(finished), paths["others"]: priced.filter(~finished)}, orders)
    back = [spark.read.parquet(p).select(F.lit(name).alias("kind"), "o_orderkey", "o_totalprice") for name, p in paths.items()]
    return back[0].unionByName(back[1])


def refresh_atomic(spark, folder):
    """Two tables in versions: a first load, a load that fails in its second table, a load of some seasons with higher prices. The
    state after the failure and the newest one, with what the first version still shows."""
    root = scratch_path(spark, "versions")
    orders = _orders_by_season(spark, folder)

    def frames(df, second=F.col("o_totalprice")):
        finished = F.col("league_code") == "f"
        return {"finished": df.filter(finished), "others": df.filter(~finished).withColumn("o_totalprice", second)}

    def state(label, number=None):
        back = [snapshots.read_table(spark, root, name, number).withColumn("kind", F.lit(name)) for name in ("finished", "others")]
        both = back[0].unionByName(back[1])
        return both.select(F.lit(label).alias("state"), "kind", "o_orderkey", "o_totalprice", "season_code")

    first = snapshots.commit(root, frames(orders))
    doubled = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    try:
        snapshots.commit(root, frames(doubled, F.raise_error(F.lit("the source broke off")).cast("double")))
    except Exception as error:  # the load of the second table
        if "the source broke off" not in str(error):
            raise
    failed = materialize(state("after the failure"), "after-failure")
    recent = doubled.filter(F.col("season_code") >= "1997")
    snapshots.commit(root, frames(recent), recent)
    return failed.unionByName(state("now")).unionByName(state("first", first))


def config_work(spark, folder):
    """Seasons to load, by source: a season per supplier of each nation, as a configuration of leagues."""
    suppliers = read(spark, folder, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("league"))
    seasons = suppliers.agg(F.sort_array(F.collect_set((2000 + F.col("s_suppkey") % 20).cast("string"))).alias("seasons")).collect()
    return readers.work_list(spark, {r.league: r.seasons for r in seasons})


def json_ids(spark, folder):
    """Ids of customers from JSON files with one array each, with their places."""
    path = scratch_path(spark, "ids")
    lists = read(spark, folder, "customer").groupBy((F.col("c_custkey") % 3).alias("g")).agg(F.sort_array(F.collect_list(F.col("c_custkey").cast("string"))).alias("ids"))
    lists.select(F.to_json("ids").alias("value")).repartition(3).write.text(path)
    return readers.read_ids(spark, path)


def observed_counts(spark, folder):
    """Counts gathered while a table is written."""
    part = read(spark, folder, "part").select("p_partkey", (F.col("p_partkey") % 4 == 0).alias("IsGK"))
    watched, counts = writers.observed(part, "load")
    writers.write_parquet(watched, scratch_path(spark, "observed"))
    found = counts.get
    return read(spark, folder, "part").agg(F.count(F.lit(1)).alias("n_parts")).select(
        "n_parts", *[F.lit(found[c]).cast("long").alias(c) for c in ("n_rows", "n_keepers", "n_field")]
    )


def flat_names(spark, folder):
    """Nested columns flattened, of repeated names the first, and the partition of a load put on the rows."""
    nation = read(spark, folder, "nation").select(F.struct("n_nationkey", "n_name").alias("nation"), F.col("n_regionkey").alias("region"))
    flat = columns.flatten(nation)
    doubled = columns.first_of_each(flat.select("*", F.col("region").alias("again")).toDF("key", "name", "region", "region"))
    named = consolidate.with_partition(doubled, F.lit("eng"), F.col("region").cast("string"))
    return named.select("key", "name", "region", "league_code", "season_code")


def joined_files(spark, folder):
    """One file per order status, named by league and season: the names become columns, other names are skipped."""
    root = scratch_path(spark, "joined")
    orders = _orders_by_season(spark, folder)
    named = {"join_f_1995_2001_mv.csv": "f", "join_o_1995_mv.csv": "o", "join_p_2001_mv.csv": "p", "join_p_2001.csv": "p"}
    for name, league in named.items():
        _single_file(orders.filter(F.col("league_code") == league).select("o_orderkey", "o_totalprice"), root, name)
    return readers.read_joined_files(spark, root).select(
        F.col("o_orderkey").try_cast("long").alias("o_orderkey"), "league_code", "season_code", league_title(F.col("league_code")).alias("league_name")
    )


def _single_file(df, root: str, name: str) -> None:
    """A folder with the file's name: Spark reads it like the file, and its parts carry the name in their path."""
    writers.write_csv(df, f"{root}/{name}")


def raw_zone(spark, folder):
    """Two landed tables by source, league and season, read back as one frame per table kind."""
    root = scratch_path(spark, "raw")
    keyed = _orders_by_season(spark, folder).select(
        F.col("o_custkey").alias("Player"), F.col("o_totalprice").alias("xG"),
        F.when(F.col("o_orderkey") % 2 == 0, "fbref").otherwise("fotmob").alias("source"), F.col("league_code").alias("league"), F.col("season_code").alias("season"),
    )
    writers.write_raw(keyed, root, "stats")
    writers.write_raw(keyed.filter(F.col("league") == "f").drop("xG"), root, "misc")
    tables = readers.read_stat_tables(spark, root, ["stats", "misc"], "fbref")
    counted = [
        df.groupBy(F.lit(kind).alias("kind"), F.col("league"), F.col("season").cast("int").alias("season")).agg(F.count(F.lit(1)).alias("n_rows"))
        for kind, df in tables.items()
    ]
    return counted[0].unionByName(counted[1])


def safe_parquet(spark, folder):
    """Repeated names, nested and binary columns written and read back as text."""
    path = scratch_path(spark, "safe")
    events = read(spark, folder, "events")
    odd = events.select(
        "event_id", F.col("event_type").alias("kind"), F.col("user_id").alias("kind"), F.encode("event_type", "UTF-8").alias("raw"),
        F.struct("user_id", "event_type").alias("nested"),
    )
    writers.write_parquet(odd, path)
    return spark.read.parquet(path)


def json_sink(spark, folder):
    path = scratch_path(spark, "json")
    part = read(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    writers.write_json(part, path)
    return spark.read.schema("p_partkey bigint, p_name string, p_retailprice double").json(path)


def replaced_table(spark, folder):
    """A table replaced by fewer rows, and another by none: the schema stays."""
    path = scratch_path(spark, "table")
    part = read(spark, folder, "part").select(F.col("p_partkey").alias("player_id"), F.col("p_name").alias("player_name"), F.col("p_size").cast("string").alias("age"))
    whole = conform(part, FIELD_PLAYERS)
    writers.replace_table(whole, path)
    writers.replace_table(whole.filter(F.col("player_id") % 3 == 0), path)
    writers.replace_table(whole.filter(F.lit(False)), f"{path}-empty")
    both = spark.read.parquet(path).unionByName(spark.read.parquet(f"{path}-empty"))
    return ensure_columns(both, FIELD_PLAYERS).select("player_id", "player_name", "age", F.col("Gls").isNull().alias("no_goals"))


def bad_rows(spark, folder):
    """Rows that do not fit the schema are reported, the others kept."""
    path = scratch_path(spark, "bad")
    part = read(spark, folder, "part").select(F.when(F.col("p_partkey") % 50 == 0, "x").otherwise(F.col("p_partkey").cast("string")).alias("id"), "p_name")
    writers.write_csv(part, path)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("p_name", T.StringType())])
    good, bad = readers.read_csv_reporting(spark, path, schema)
    line = F.concat_ws(",", "id", "p_name")
    kinds = [good.select(F.lit("good").alias("kind"), F.col("p_name").alias("line")), bad.select(F.lit("bad").alias("kind"), line.alias("line"))]
    return kinds[0].unionByName(kinds[1]).groupBy("kind", "line").agg(F.count(F.lit(1)).alias("n_rows"))


def pruned_scan(spark, folder):
    lines = readers.pruned(read(spark, folder, "lineitem"), ["player_id", "l_partkey"], ["Gls", "l_quantity", "KeyPasses"], ["season", "l_returnflag"])
    return lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("n_rows"))


def page_links(spark, folder):
    found = pages.page_links(read(spark, folder, "pages"))
    return found.select("page_id", F.col("at").cast("int").alias("at"), "href", "text")


def page_roots(spark, folder):
    return read(spark, folder, "pages").select(
        "page_id", pages.site_root(F.col("url")).alias("root"), pages.season_url(F.col("url"), F.lit(2024)).alias("season_url")
    )


def _club_pages(spark, folder):
    """Twenty suppliers to a page, as club links with text, with an image, or with neither; some listed twice."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    href = F.concat(F.lit("/slug/startseite/verein/"), key.cast("string"), F.lit("/saison_id/2020"))
    inner = (
        F.when(key % 3 == 0, F.concat(F.lit("<b>"), name, F.lit("</b> &amp; Co")))
        .when(key % 3 == 1, F.concat(F.lit('<img src="x.png" alt="'), name, F.lit('">')))
        .otherwise(F.lit(" "))
    )
    link = F.concat(F.lit('<a class="c" href="'), href, F.lit('">'), inner, F.lit("</a>"), F.lit('<a href="'), href, F.lit('">again</a><a href="/news/1">n</a>'))
    return (
        read(spark, folder, "supplier")
        .groupBy(F.floor(key / 20).alias("page_id"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key.alias("k"), link.alias("link")))), lambda x: x["link"]), "").alias("links"))
        .select("page_id", F.lit("https://www.site.test/league/1?x=2").alias("url"), F.concat(F.lit("<html><body>"), "links", F.lit("</body></html>")).alias("html"))
    )


def club_links(spark, folder):
    found = pages.club_links(_club_pages(spark, folder))
    return found.withColumn("squad_url", pages.squad_url(F.col("href"), F.lit(2024)))


def league_urls(spark, folder):
    code = F.element_at(F.array(*[F.lit(c) for c in ("eng1", "ARG1", "GB1", "XXX")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return read(spark, folder, "orders").select(
        "o_orderkey", F.coalesce(pages.league_url(code, F.year("o_orderdate")), F.lit("unknown")).alias("league_url")
    )


def squad_rows(spark, folder):
    """Twenty parts to a squad page with nested tables, dates in two places, ages, and rows that must be left out."""
    key = F.col("p_partkey")
    day = F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int"))
    dob = F.when(key % 3 == 0, F.concat(F.lit('<td data-sort="'), day.cast("string"), F.lit('">x ('), (key % 40 + 10).cast("string"), F.lit(")</td>"))).otherwise(
        F.concat(F.lit("<td>"), F.date_format(day, "MMM d, yyyy"), F.lit(" ("), (key % 40 + 10).cast("string"), F.lit(")</td>"))
    )
    link = F.when(key % 7 != 0, F.concat(F.lit('<a href="/n/profil/spieler/'), key.cast("string"), F.lit('">'), "p_name", F.lit("</a>"))).otherwise(F.lit("no link"))
    value = F.when(key % 11 != 0, F.concat(F.lit("€"), (F.col("p_size") * 1.5).cast("string"), F.lit("m"))).otherwise(F.lit("-"))
    row = F.concat(
        F.lit("<tr><td><table class='inline'><tr><td>"), link, F.lit("</td></tr><tr><td>Back</td></tr></table></td>"), dob,
        F.lit('<td class="rechts hauptlink">'), value, F.lit("</td></tr>"),
    )
    squad = (
        read(spark, folder, "part")
        .groupBy(F.floor(key / 20).alias("page_id"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key.alias("k"), row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
        .select(
            "page_id",
            F.concat(F.lit("u"), "page_id").alias("url"),
            F.concat(F.lit("<h1> Club <i>"), F.floor(F.col("page_id") / 2), F.lit("</i></h1><table class='items big'><thead><tr><th>h</th></tr></thead><tbody>"), "rows", "rows", F.lit("</tbody></table>")).alias("html"),
        )
    )
    return pages.distinct_roster(pages.squad_rows(squad))


_ORDERS = """orders_by_season AS (SELECT o_orderkey, o_custkey, o_totalprice, lower(o_orderstatus) AS league_code, CAST(year(o_orderdate) AS VARCHAR) AS season_code FROM orders)"""

QUERIES = {
    "partition_refresh": (partition_refresh, f"""
WITH {_ORDERS} SELECT o_orderkey, o_custkey, CASE WHEN league_code = 'f' AND season_code IN ('1996', '1997') THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, league_code, season_code
FROM orders_by_season WHERE NOT (league_code = 'f' AND season_code = '1998')"""),
    "csv_roundtrip": (csv_roundtrip, """
SELECT doc_id, md5(trim(regexp_replace(text, '[^\\x20-\\x7E\\x{00A0}-\\x{00FF}]', ' ', 'g'))) AS text_md5, lang, 'a;"b' AS "Note" FROM documents"""),
    "csv_mixed_headers": (csv_mixed_headers, "SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 2 = 1 THEN p_brand ELSE '-' END AS brand FROM part"),
    "csv_quoted_lines": (csv_quoted_lines, """SELECT doc_id, md5('"a", ' || replace(text, chr(13), ' ')) AS text_md5 FROM documents"""),
    "csv_bom": (csv_bom, "SELECT n_name, CAST(n_nationkey AS INTEGER) AS n_nationkey, true AS marked FROM nation"),
    "refresh_null_partition": (refresh_null_partition, f"""
WITH {_ORDERS} SELECT o_orderkey, CASE WHEN league_code = 'p' THEN 0.0 ELSE o_totalprice END AS o_totalprice, CASE WHEN league_code = 'p' THEN '-' ELSE league_code END AS league_code, season_code
FROM orders_by_season WHERE NOT (league_code = 'p' AND season_code = '1995')"""),
    "refresh_both": (refresh_both, f"""
WITH {_ORDERS} SELECT CASE WHEN league_code = 'f' THEN 'finished' ELSE 'others' END AS kind, o_orderkey, o_totalprice * 3 AS o_totalprice FROM orders_by_season"""),
    "refresh_atomic": (refresh_atomic, f"""
WITH {_ORDERS}, t AS (SELECT CASE WHEN league_code = 'f' THEN 'finished' ELSE 'others' END AS kind, o_orderkey, o_totalprice, CAST(season_code AS VARCHAR) AS season_code FROM orders_by_season)
SELECT state, kind, o_orderkey, CASE WHEN state = 'now' AND season_code >= '1997' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, season_code
FROM t, (VALUES ('after the failure'), ('now'), ('first')) s(state)"""),
    "config_work": (config_work, """
SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS league, CAST(2000 + s_suppkey % 20 AS VARCHAR) AS season, CAST(2000 + s_suppkey % 20 AS INTEGER) AS season_start, source
FROM supplier, (VALUES ('fbref'), ('transfermarkt')) s(source)"""),
    "json_ids": (json_ids, """
SELECT CAST(row_number() OVER (PARTITION BY c_custkey % 3 ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS INTEGER) AS "at", CAST(c_custkey AS VARCHAR) AS player_id FROM customer"""),
    "observed_counts": (observed_counts, """
SELECT count(*) AS n_parts, count(*) AS n_rows, count(*) FILTER (p_partkey % 4 = 0) AS n_keepers, count(*) FILTER (p_partkey % 4 <> 0) AS n_field FROM part"""),
    "flat_names": (flat_names, "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region, 'eng' AS league_code, CAST(n_regionkey AS VARCHAR) AS season_code FROM nation"),
    "joined_files": (joined_files, f"""
WITH {_ORDERS} SELECT o_orderkey, league_code, CASE league_code WHEN 'f' THEN '1995-2001' WHEN 'o' THEN '1995' ELSE '2001' END AS season_code, upper(league_code) AS league_name
FROM orders_by_season"""),
    "raw_zone": (raw_zone, f"""
WITH {_ORDERS} SELECT kind, league_code AS league, CAST(season_code AS INTEGER) AS season, count(*) AS n_rows FROM orders_by_season, (VALUES ('stats'), ('misc')) k(kind)
WHERE o_orderkey % 2 = 0 AND (kind = 'stats' OR league_code = 'f') GROUP BY ALL"""),
    "safe_parquet": (safe_parquet, """
SELECT event_id, event_type AS kind, user_id AS kind__dup1, event_type AS raw, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS nested FROM events"""),
    "json_sink": (json_sink, "SELECT p_partkey, p_name, p_retailprice FROM part"),
    "replaced_table": (replaced_table, "SELECT p_partkey AS player_id, p_name AS player_name, p_size AS age, true AS no_goals FROM part WHERE p_partkey % 3 = 0"),
    "bad_rows": (bad_rows, """
SELECT CASE WHEN p_partkey % 50 = 0 THEN 'bad' ELSE 'good' END AS kind, CASE WHEN p_partkey % 50 = 0 THEN 'x,' || p_name ELSE p_name END AS line, count(*) AS n_rows FROM part GROUP BY 1, 2"""),
    "pruned_scan": (pruned_scan, "SELECT l_partkey, l_quantity, l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY ALL"),
    "page_links": (page_links, """
WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>') AS links FROM pages),
b AS (SELECT page_id, unnest(range(len(links))) AS pos, unnest(links) AS a FROM a),
c AS (SELECT page_id, pos, regexp_extract(regexp_extract(a, '(?is)^<a\\b[^>]*>'), '(?is)\\bhref\\s*=\\s*("([^"]*)"|''([^'']*)'')', 1) AS href,
  regexp_replace(regexp_replace(a, '(?is)^<a\\b[^>]*>|</a>$', '', 'g'), '(?s)<[^>]*>', ' ', 'g') AS t FROM b)
SELECT page_id, CAST(pos AS INTEGER) AS "at", regexp_replace(href, '^["'']|["'']$', '', 'g') AS href,
  trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')) AS text
FROM c WHERE href <> ''"""),
    "page_roots": (page_roots, """
SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS root, regexp_replace(url, '[?#;].*$', '') || '?saison_id=2024' AS season_url FROM pages"""),
    "club_links": (club_links, """
SELECT s_suppkey // 20 AS page_id, CAST(s_suppkey AS VARCHAR) AS club_id, CASE s_suppkey % 3 WHEN 0 THEN s_name || ' & Co' WHEN 1 THEN s_name ELSE 'club_' || s_suppkey END AS club_name,
  'https://www.site.test/slug/startseite/verein/' || s_suppkey || '/saison_id/2020' AS href,
  'https://www.site.test/slug/kader/verein/' || s_suppkey || '/saison_id/2024/plus/1/galerie/0' AS squad_url FROM supplier"""),
    "league_urls": (league_urls, """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'unknown' ELSE 'https://www.transfermarkt.com/' ||
  CASE WHEN o_orderkey % 4 = 1 THEN 'primera-division/startseite/wettbewerb/AR1N' ELSE 'premier-league/startseite/wettbewerb/GB1' END || '?saison_id=' || year(o_orderdate) END AS league_url FROM orders"""),
    "squad_rows": (squad_rows, """
SELECT p_name AS player_name, 'Club ' || (p_partkey // 20) // 2 AS club_name, CAST(p_size * 1500000 AS BIGINT) AS market_value_eur, p_partkey AS player_id,
  strftime(DATE '1990-01-01' + CAST(p_partkey % 9000 AS INTEGER), '%Y-%m-%d') AS dob, CAST(p_partkey % 40 + 10 AS INTEGER) AS age FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0"""),
}
