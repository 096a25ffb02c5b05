"""Club links and squad rows from landed web pages (``page_id, url, html``)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parse import iso_date_strict, money_to_eur
from touchline.operators.skew import top_rows
from touchline.session import bound_batches

# League code -> (slug, code) in the value source's addresses.
VALUE_LEAGUES = {
    "ENG1": ("premier-league", "GB1"),
    "EPL": ("premier-league", "GB1"),
    "GB1": ("premier-league", "GB1"),
    "ARG1": ("primera-division", "AR1N"),
    "AR1N": ("primera-division", "AR1N"),
}
SQUAD_SCHEMA = (
    "page_id bigint, row int, player_name string, club_name string, value_text string, player_id string, "
    "cells array<struct<text: string, sort: string>>"
)
_ANCHOR = r"(?is)<a\b[^>]*>.*?</a>"


def league_url(league: Column, season: Column, domain: str = "com") -> Column:
    """Start address of a league's season; null for a league without a known slug."""
    pairs = [F.lit(x) for code, (slug, tag) in VALUE_LEAGUES.items() for x in (code, f"{slug}/startseite/wettbewerb/{tag}")]
    path = F.try_element_at(F.create_map(*pairs), F.upper(league))
    address = F.concat(F.lit(f"https://www.transfermarkt.{domain}/"), path)
    return F.concat(address, F.coalesce(F.concat(F.lit("?saison_id="), season.cast("string")), F.lit("")))


def season_url(url: Column, season: Column) -> Column:
    """A given league address without its query, with the wanted season; the scheme defaults to https."""
    full = F.when(F.rlike(url, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")), url).otherwise(F.concat(F.lit("https://"), F.ltrim(url)))
    base = F.regexp_replace(full, r"[?#;].*$", "")
    return F.concat(base, F.coalesce(F.concat(F.lit("?saison_id="), season.cast("string")), F.lit("")))


def squad_url(url: Column, season: Column) -> Column:
    """The squad page of a club's start page: old season parts go, ``startseite`` becomes the detailed ``kader`` view."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/saison_id/\d+", "")
    prefix = F.regexp_extract(path, r"^(.*)/startseite/verein/(\d+)", 1)
    club = F.regexp_extract(path, r"^(.*)/startseite/verein/(\d+)", 2)
    squad = F.concat(
        prefix, F.lit("/kader/verein/"), club, F.lit("/saison_id/"), season.cast("string"), F.lit("/plus/1/galerie/0")
    )
    return F.when(club == "", url).otherwise(squad)


def _attribute(tag: Column, name: str) -> Column:
    found = F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*("([^"]*)"|'([^']*)')""", 1)
    return F.when(found != "", F.regexp_replace(found, r"""^["']|["']$""", ""))


def _plain(html: Column) -> Column:
    """Text without tags; the five common entities decoded; whitespace squeezed."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def page_links(pages: DataFrame) -> DataFrame:
    """Every anchor with its place on the page, address, text and image description."""
    anchors = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(0))).alias("at", "a"))
    opening = F.regexp_extract("a", r"(?is)^<a\b[^>]*>", 0)
    inner = F.regexp_replace("a", r"(?is)^<a\b[^>]*>|</a>$", "")
    alt = _attribute(F.regexp_extract(inner, r"(?is)<img\b[^>]*>", 0), "alt")
    return anchors.select(
        "page_id", "url", "at", _attribute(opening, "href").alias("href"), _plain(inner).alias("text"), F.trim(alt).alias("alt")
    ).filter(F.col("href").isNotNull())


def site_root(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)


def club_links(pages: DataFrame, wanted: str = r"/startseite/verein/(\d+)") -> DataFrame:
    """The first link per page and club id: id, name (text, else image description, else ``club_<id>``), full address."""
    links = page_links(pages).withColumn("club_id", F.regexp_extract("href", wanted, 1)).filter(F.col("club_id") != "")
    first = top_rows(links, ["page_id", "club_id"], [F.col("at")])
    name = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("text", "alt")], F.concat(F.lit("club_"), "club_id"))
    absolute = F.when(F.rlike("href", F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")), F.col("href")).otherwise(
        F.concat(site_root(F.col("url")), F.when(F.startswith("href", F.lit("/")), "").otherwise("/"), F.col("href"))
    )
    return first.select("page_id", "club_id", name.alias("club_name"), absolute.alias("href"))


class _SquadTable(HTMLParser):
    """Collects the outer rows of ``table.items``: player link, value cell and the cells' texts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.club = ""
        self.tables = 0
        self.row: dict | None = None
        self.cell: dict | None = None
        self.link: list[str] | None = None
        self.heading: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        classes = attrs.get("class", "").split()
        if tag == "h1" and not self.club:
            self.heading = []
        if tag == "table" and (self.tables or "items" in classes):
            self.tables += 1
        if not self.tables:
            return
        if tag == "tr" and self.tables == 1:
            self.row = {"cells": [], "link": None, "href": "", "value": None}
            self.rows.append(self.row)
        elif tag == "td" and self.row is not None:
            if self.tables == 1:
                self.cell = {"text": [], "sort": attrs.get("data-sort"), "value": {"rechts", "hauptlink"} <= set(classes)}
                self.row["cells"].append(self.cell)
        elif tag == "a" and self.row is not None and self.row["link"] is None and "/profil/spieler/" in attrs.get("href", ""):
            self.link = []
            self.row["href"] = attrs["href"]

    def handle_endtag(self, tag):
        if tag == "h1" and self.heading is not None:
            self.club, self.heading = " ".join("".join(self.heading).split()), None
        if tag == "table" and self.tables:
            self.tables -= 1
        if tag == "a" and self.link is not None:
            if self.row is not None:
                self.row["link"] = " ".join("".join(self.link).split())
            self.link = None
        if tag == "td" and self.tables == 1:
            self.cell = None
        if tag == "tr" and self.tables == 1:
            self.row = None

    def handle_data(self, data):
        if self.heading is not None:
            self.heading.append(data)
        if self.link is not None:
            self.link.append(data)
        if self.cell is not None:
            self.cell["text"].append(data)


# Rows of a frame that a worker hands over, each with the dictionaries of its cells.
FRAME_ROWS = 2000


def _squad_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["page_id", "row", "player_name", "club_name", "value_text", "player_id", "cells"]
    for batch in batches:
        out = []
        for page_id, html in zip(batch["page_id"], batch["html"]):
            parser = _SquadTable()
            parser.feed(html)
            for at, row in enumerate(parser.rows):
                values = [c for c in row["cells"] if c["value"]]
                if not row["link"] or not values:
                    continue
                found = re.search(r"/spieler/(\d+)", row["href"])
                cells = [{"text": " ".join("".join(c["text"]).split()), "sort": c["sort"]} for c in row["cells"]]
                text = " ".join("".join(values[0]["text"]).split())
                out.append((page_id, at, row["link"], parser.club, text, found.group(1) if found else "", cells))
                if len(out) == FRAME_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
        yield pd.DataFrame(out, columns=columns)


def squad_rows(pages: DataFrame) -> DataFrame:
    """Roster rows of squad pages: player, club, value in EUR, id, date of birth, age. Rows without a value are left out.

    Only pages that have such a table go through the HTML parser; values, dates and ages are parsed in the JVM.
    """
    bound_batches(pages.sparkSession)
    with_table = pages.filter(F.contains("html", F.lit("/profil/spieler/"))).select("page_id", "html")
    raw = with_table.mapInPandas(_squad_rows, SQUAD_SCHEMA)
    ages = F.filter(F.transform("cells", lambda c: F.regexp_extract(c["text"], r"\((\d{1,2})\)", 1)), lambda a: a != "")
    dates = F.transform(
        "cells",
        lambda c: F.when(F.rlike(c["sort"], F.lit(r"^\d{4}-\d{2}-\d{2}$")), c["sort"]).otherwise(iso_date_strict(c["text"])),
    )
    known = F.filter(dates, lambda d: d != "")
    return raw.select(
        "page_id",
        "row",
        "player_name",
        "club_name",
        money_to_eur(F.col("value_text")).alias("market_value_eur"),
        F.col("player_id").try_cast("long").alias("player_id"),
        F.coalesce(F.get(known, F.lit(0)), F.lit("")).alias("dob"),
        F.get(ages, F.lit(0)).try_cast("int").alias("age"),
    ).filter(F.col("market_value_eur").isNotNull())


def distinct_roster(rows: DataFrame) -> DataFrame:
    """One row per player, club and id (date of birth where the id is missing), the first by page and row."""
    identity = F.coalesce(F.col("player_id").cast("string"), F.when(F.col("dob") != "", F.col("dob")), F.lit(""))
    keyed = rows.withColumn("_identity", identity)
    first = top_rows(keyed, ["player_name", "club_name", "_identity"], [F.col("page_id"), F.col("row")])
    return first.select("player_name", "club_name", "market_value_eur", "player_id", "dob", "age")
