"""Similar-name matching inside a block (a club, or a band of birth years) without comparing all pairs.

``token_set_ratio`` reaches a threshold in two ways only, and each has an exact index:

* the shared words nearly cover one of the names. Then that name's rarest words, taken until the rest is too short
  to cover it, contain a shared word;
* the leftover words differ by a few letters. One inserted or deleted letter spoils few letter triples, so the two
  names share a triple among the rarest few of each (prefix filter), and enough of all of them (count filter).

Both give a small set of pairs that is a superset of all pairs at or above the threshold; the score decides.
Names are reduced to distinct ones per block first, so copies of a name cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.functions.similarity import token_set_ratio
from touchline.operators.skew import skew_join
from touchline.session import materialize

LEAD = 5.0
# Frequencies are kept for the first repeats of a triple only: names hold a-z and 0-9, so there are at most
# 37^3 * _COUNTED_REPEATS of them, small enough to broadcast whatever the number of names.
_COUNTED_REPEATS = 3


def _words(name: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(name, " "), lambda w: w != "")))


def _triples(words: Column) -> Column:
    """``triple, nth`` for the letter triples of every padded word; the n-th repeat is a feature of its own."""
    grams = F.flatten(
        F.transform(
            words,
            lambda w: F.transform(
                F.sequence(F.lit(1), F.length(w) + 2),
                lambda i: F.substring(F.concat(F.lit("##"), w, F.lit("##")), i, F.lit(3)),
            ),
        )
    )
    ordered = F.array_sort(grams)

    def feature(gram: Column, i: Column) -> Column:
        nth = i - F.array_position(ordered, gram).cast("int") + 1
        return F.struct(F.xxhash64(gram, nth).alias("triple"), nth.alias("nth"))

    return F.transform(ordered, feature)


def _described(names: DataFrame, block: Sequence[str]) -> DataFrame:
    words = names.filter(F.col("name") != "").withColumn("words", _words(F.col("name")))
    return words.withColumn("width", F.length(F.array_join("words", " "))).filter(F.size("words") > 0)


def _spoiled(width: Column, blanks: Column, miss: float) -> Column:
    """The most triples of a name that can be absent from a name within the allowed distance.

    ``miss`` is the share of letters that may differ, so the partner is at most (1 + miss) / (1 - miss) times as
    long. A deleted letter spoils 3 triples of its name, a deleted blank 4, an inserted letter or blank 2; the
    longer name has deletions at worst, the shorter one no more deletions than insertions.
    """
    longer = F.floor(F.lit(2 * miss) * width + 1e-9)
    shorter = F.floor(F.lit(miss) * (width + F.floor(width * F.lit((1 + miss) / (1 - miss)) + 1e-9)) + 1e-9)
    return F.greatest(3 * longer, 3 * F.floor(shorter / 2) + 2 * F.ceil(shorter / 2)) + blanks


def _covered(words_a: Column, words_b: Column, width: Column, cover: float) -> Column:
    """The shared words make up at least ``cover`` of a name's width."""
    return F.length(F.array_join(F.array_intersect(words_a, words_b), " ")) >= F.lit(cover) * width - 1e-9


def _sided(df: DataFrame, side: str, block: Sequence[str], feature: str) -> DataFrame:
    """Columns other than the join keys get the side's suffix."""
    return df.select(*[F.col(c) if c in (*block, feature) else F.col(c).alias(f"{c}_{side}") for c in df.columns])


def _cover_pairs(x: DataFrame, y: DataFrame, block: Sequence[str], cover: float) -> DataFrame:
    """Pairs in which the shared words cover the name of ``x``: its rarest words against all words of ``y``."""
    y_words = y.withColumn("word", F.explode("words"))
    common = y_words.groupBy(*block, "word").agg(F.count(F.lit(1)).alias("names_with"))
    x_words = x.withColumn("word", F.explode("words"))
    # words unknown to y can be no shared word, but their width counts
    ranked = skew_join(x_words, common, [*block, "word"], "left", large=True)
    rarest = Window.partitionBy(*block, "name").orderBy(F.coalesce("names_with", F.lit(0)), "word")
    left_over = F.sum(F.length("word") + 1).over(rarest.rowsBetween(0, Window.unboundedFollowing)) - 1
    probes = (
        ranked.withColumns(
            {
                "left_over": left_over,
                "earlier": F.collect_list("word").over(rarest.rowsBetween(Window.unboundedPreceding, -1)),
            }
        )
        .filter(F.col("names_with").isNotNull() & (F.col("left_over") >= F.lit(cover) * F.col("width") - 1e-9))
        .drop("names_with", "left_over")
    )
    probes = materialize(probes, "probe-words")
    pairs = skew_join(_sided(probes, "x", block, "word"), _sided(y_words, "y", block, "word"), [*block, "word"], "inner", both=True, large=True)
    first_hit = ~F.arrays_overlap("earlier_x", "words_y")
    return pairs.filter(first_hit & _covered(F.col("words_x"), F.col("words_y"), F.col("width_x"), cover)).drop(
        "word", "earlier_x"
    )


def _triple_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], miss: float) -> DataFrame:
    """Pairs whose leftover words may be within the allowed distance: rare triples of both sides."""

    def features(df: DataFrame) -> DataFrame:
        return df.withColumn("f", F.explode(_triples(F.col("words")))).select(*df.columns, "f.triple", "f.nth")

    l_all, r_all = features(left), features(right)
    counted = r_all.filter(F.col("nth") <= _COUNTED_REPEATS)
    frequency = F.broadcast(counted.groupBy("triple").agg(F.count(F.lit(1)).alias("names_with")))

    def rarest(df: DataFrame) -> DataFrame:
        order = Window.partitionBy(*block, "name").orderBy(F.coalesce("names_with", F.lit(0)), "triple")
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return (
            df.join(frequency, "triple", "left")
            .withColumns({"place": F.row_number().over(order), "triples": F.collect_list("triple").over(whole)})
            .filter(F.col("place") <= _spoiled(F.col("width"), F.size("words") - 1, miss) + 1)
            .drop("names_with", "nth")
        )

    x, y = materialize(rarest(l_all), "left-triples"), materialize(rarest(r_all), "right-triples")
    pairs = skew_join(_sided(x, "x", block, "triple"), _sided(y, "y", block, "triple"), [*block, "triple"], "inner", both=True, large=True)
    wide_x, wide_y = F.col("width_x"), F.col("width_y")
    edits = F.floor(F.lit(miss) * (wide_x + wide_y) + 1e-9)

    def needed(own: Column, other: Column, words: str, triples: str) -> Column:
        """Triples that must be shared: all of one name's but those that this many edits can spoil."""
        deleted = F.floor((edits + own - other) / 2)
        return F.size(triples) - 3 * deleted - 2 * (edits - deleted) - (F.size(words) - 1)

    least = F.greatest(needed(wide_x, wide_y, "words_x", "triples_x"), needed(wide_y, wide_x, "words_y", "triples_y"), F.lit(1))
    # as this triple is the first shared one, only those behind it can be shared as well
    left_over = F.least(F.size("triples_x") - F.col("place_x"), F.size("triples_y") - F.col("place_y")) + 1
    possible = (F.abs(wide_x - wide_y) <= edits) & (left_over >= least)
    before_x = F.slice("triples_x", F.lit(1), F.col("place_x") - 1)
    before_y = F.slice("triples_y", F.lit(1), F.col("place_y") - 1)
    enough = F.size(F.array_intersect("triples_x", "triples_y")) >= least
    kept = pairs.filter(possible & ~F.arrays_overlap(before_x, before_y)).filter(enough)
    return kept.drop("triple", "place_x", "place_y", "triples_x", "triples_y")


def candidate_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """Every pair of names of one block that can reach the threshold, once, as ``block, a, b``.

    Both inputs have the block columns and a distinct ``name``; further columns of the right side are carried along.
    The names and their features are written to the shared folder on the way, as each is used several times.
    """
    block = list(block)
    carried = [c for c in right.columns if c not in (*block, "name")]
    x, y = materialize(_described(left, block), "left-names"), materialize(_described(right, block), "right-names")
    share = threshold / 100
    cover, miss = share / (2 - share), 1 - share
    wx, wy = F.col("words_x"), F.col("words_y")
    covers_left, covers_right = (_covered(wx, wy, F.col(w), cover) for w in ("width_x", "width_y"))

    def pair(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.select(
            *block, F.col(f"name_{a}").alias("a"), F.col(f"name_{b}").alias("b"), *[F.col(f"{c}_{b}").alias(c) for c in carried]
        )

    by_left = _cover_pairs(x, y, block, cover)
    # with the sides swapped, x stands for the right names
    by_right = _cover_pairs(y, x, block, cover).filter(~_covered(wx, wy, F.col("width_y"), cover))
    by_letters = _triple_pairs(x, y, block, miss).filter(~covers_left & ~covers_right)
    return pair(by_left, "x", "y").unionByName(pair(by_right, "y", "x")).unionByName(pair(by_letters, "x", "y"))


def scored_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """Candidates with their score; not stored, since only the best of each name are wanted."""
    pairs = candidate_pairs(left, right, block, threshold)
    return pairs.withColumn("score", token_set_ratio("a", "b")).filter(F.col("score") >= threshold)


def _best_first(payload: Sequence[str]) -> Column:
    """Most valuable, then lowest id."""
    return F.struct((-F.col("market_value_eur")).alias("by_value"), F.col("player_id").alias("by_id"), *payload)


def _label(kind: str) -> Column:
    return F.concat(F.lit(f"{kind}("), F.round("score", 1).cast("string"), F.lit(")"))


def _with_rows(open_rows: DataFrame, best: DataFrame, on: Sequence[str], payload: Sequence[str], kind: str) -> DataFrame:
    rows = open_rows.select("row_id", *on[:-1], F.col("player_norm").alias("a"))
    hit = skew_join(rows, best, on, "inner", spread=["row_id"], large=True)
    return hit.select(
        "row_id", _label(kind).alias("join_method"), "score", *[F.col(f"row.{c}").alias(c) for c in payload]
    )


def similar_in_club(
    open_rows: DataFrame, right: DataFrame, payload: Sequence[str], scope: Sequence[str] = (), threshold: float = 90
) -> DataFrame:
    """The most similar name of the same club, at or above the threshold; ties go to value, then id."""
    block = [*scope, "club_norm"]
    has_club = F.col("club_norm").isNotNull() & (F.col("club_norm") != "")
    wanted = open_rows.filter(has_club).select(*block, F.col("player_norm").alias("name")).distinct()
    offered = (
        right.filter(has_club & F.col("market_value_eur").isNotNull())
        .groupBy(*block, F.col("player_norm").alias("name"))
        .agg(F.min(_best_first(payload)).alias("row"))
    )
    best = (
        scored_pairs(wanted, offered, block, threshold)
        .groupBy(*block, "a")
        .agg(F.min(F.struct((-F.col("score")).alias("less"), "row")).alias("m"))
        .select(*block, "a", (-F.col("m.less")).alias("score"), F.col("m.row").alias("row"))
    )
    return _with_rows(open_rows.filter(has_club), materialize(best, "best-in-club"), [*block, "a"], payload, "fuzzy_club")


def similar_near_year(
    open_rows: DataFrame, right: DataFrame, payload: Sequence[str], scope: Sequence[str] = (), threshold: float = 93
) -> DataFrame:
    """The most similar name born within a year, at any club, if it leads the second by at least LEAD points.

    Right rows count once per (first+last name, birth year), the most valuable one. A second at LEAD or more below
    the threshold never matters, so pairs are needed down to ``threshold - LEAD`` only.
    """
    block = [*scope, "birth_year"]
    wanted = (
        open_rows.filter(F.col("birth_year").isNotNull())
        .select(*block, F.col("player_norm").alias("name"))
        .distinct()
    )
    once = (
        right.filter(F.col("birth_year").isNotNull() & F.col("market_value_eur").isNotNull())
        .groupBy(*block, "player_fl")
        .agg(F.min(_best_first(["player_norm", *payload])).alias("row"))
    )
    near = F.explode(F.array(*[F.col("birth_year") + F.lit(d) for d in (-1, 0, 1)])).alias("birth_year")
    offered = (
        once.select(*scope, near, F.col("row.player_norm").alias("name"), "row")
        .groupBy(*block, "name")
        .agg(F.count(F.lit(1)).alias("same_name"), F.min("row").alias("row"))
    )
    ranked = scored_pairs(wanted, offered, block, threshold - LEAD)
    by_name = Window.partitionBy(*block, "a").orderBy(F.col("score").desc(), F.col("row"))
    top = ranked.withColumn("place", F.row_number().over(by_name)).filter(F.col("place") <= 2)
    best = (
        top.groupBy(*block, "a")
        .agg(
            F.max(F.when(F.col("place") == 1, F.col("score"))).alias("score"),
            F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second"),
            F.max(F.when(F.col("place") == 1, F.col("same_name"))).alias("same_name"),
            F.min(F.when(F.col("place") == 1, F.col("row"))).alias("row"),
        )
        .filter((F.col("score") >= threshold) & (F.col("same_name") == 1))
        .filter(F.col("second").isNull() | (F.col("score") - F.col("second") >= LEAD))
        .select(*block, "a", "score", "row")
    )
    return _with_rows(open_rows, materialize(best, "best-near-year"), [*block, "a"], payload, "fuzzy_global")
