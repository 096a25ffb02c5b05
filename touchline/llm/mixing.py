"""Mixing sources to target weights: fixed-length blocks, multinomial counts per shard, permuted block indexes.

Every source is one stream of words, its documents one after the other in a pseudorandom order, cut into blocks of a
fixed number of words. The mix is a sequence of slots, dealt into shards. Each shard draws how many of its slots come
from each source: every slot draws a source with the probability of its target. The slots of a source are numbered
through over the shards, and a number is mapped to a block by a pseudorandom permutation of the source's blocks, one
permutation per pass. Slots beyond a source's quota (target words over mean block length) are left out and the sources
that drew too little are filled up in closing shards, so that targets are met whatever the draws were.

Streams and permutations depend on the rows alone, so reruns agree whatever the partitions.

Defined cases: null text and texts without words are never taken; documents without a source form the source null,
which comes last; rows that agree in id, text and source are separate parts of the stream; an empty table mixes to no rows; columns
other than those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.llm.common import boxed, bucketed, count_words, offsets, unboxed
from touchline.session import materialize

# Cells of the unit interval in which the sources' shares are looked up by an equi-join.
GRID = 4096
ROUNDS = 16
SLOTS_PER_TASK = 500_000


@dataclass
class Mix:
    """The parts of a mix. ``sources``: source, source_no, source_size, target, blocks, quota. ``documents``: key, doc_id,
    source_no, size, start (first word in the stream). ``slots``: shard, slot, source_no, block, pass_no."""

    sources: DataFrame
    documents: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """A row per slot and document that the slot's block holds words of: the words as positions in the document.

        Spark judges slots by the few rows that they are exploded from and would broadcast all of them, so joins with what grows
        with them are merged by a shuffle, here and below.
        """
        size = F.lit(self.block_words)
        spread = self.documents.filter("size > 0").withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("size") - 1) / size)))
        )
        first = F.greatest(F.col("start"), F.col("block") * size)
        end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * size)
        return self.slots.hint("merge").join(spread, ["source_no", "block"]).select(
            "shard", "slot", "pass_no", "source_no", "block", "key", "doc_id", "start",
            (first - F.col("start")).alias("first_word"), (end - first).alias("n_words"),
        )


def cyclic_weights(cycle: tuple[float, ...]) -> Column:
    """Weights that repeat over the sources in their order (``source_no`` counts from 0)."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("source_no") % len(cycle) + 1).cast("int"))


def _key(docs: DataFrame) -> Column:
    return F.xxhash64("doc_id", "text", "source")


def _targets(sizes: DataFrame, weight: Column, share: float, most: float) -> DataFrame:
    """Sources in code point order, null last, with the words they should give.

    Shares in proportion to the weights stop at ``most`` times the size of a source. Sources in the order in which they
    reach that stop: the first that stays below it fixes the words per weight of all that follow.
    """
    numbered = sizes.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", weight)
    by_stop = Window.orderBy((F.col("source_size") / F.col("weight")), "source_no")
    before, rest = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    ) / F.sum("weight").over(rest)
    found = numbered.withColumn("_level", level).withColumn(
        "_level", F.max(F.when(F.col("_level") * F.col("weight") <= F.col("source_size") * most, F.col("_level"))).over(everything)
    )
    stop = F.col("source_size") * F.lit(float(most))
    target = F.when(F.col("_level").isNull(), stop).otherwise(F.least(stop, F.col("_level") * F.col("weight")))
    return found.select("source", "source_no", "source_size", target.cast("double").alias("target"))


def _permuted(index: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1 (swap or not): in each round x may change places with its mirror k - x."""

    def turn(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, r), n) + n - x, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(x, mirror), key, r), F.lit(2)) == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def _draws(sources: DataFrame, n_slots: int, per_shard: int, seed: int) -> DataFrame:
    """How many slots each shard draws from each source (shard, source_no, drawn)."""
    total = F.sum("quota").over(Window.partitionBy())
    upto = F.sum("quota").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0))
    cells = (
        sources.filter("quota > 0")
        .select("source_no", ((upto - F.col("quota")) / total).alias("low"), (upto / total).alias("high"))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * GRID), F.ceil(F.col("high") * GRID))))
    )
    chance = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    slots = cells.sparkSession.range(n_slots).select(
        F.floor(F.col("id") / per_shard).alias("shard"), chance.alias("u"), F.floor(chance * GRID).alias("cell")
    )
    hit = slots.join(cells, "cell").filter("u >= low and u < high")
    return hit.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("drawn"))


def mix(
    docs: DataFrame,
    weight: Column,
    share: float = 1.0,
    most: float = 2.0,
    block_words: int = 64,
    per_shard: int = 16_384,
    seed: int = 1,
) -> Mix:
    """Mixes ``docs`` (doc_id, text, source): ``weight`` over source_no, ``share`` of all words in total, no block and so
    no document more than ``most`` (a whole number of passes) times."""
    keyed = docs.select("doc_id", "source", _key(docs).alias("key"), count_words("text").alias("size"))
    sized = materialize(keyed, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    targets = _targets(totals, weight, share, most)
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size"))).otherwise(F.lit(0))
    sources = materialize(
        targets.withColumns({"blocks": blocks.cast("long"), "quota": F.least(quota, blocks * most).cast("long")}), "sources"
    )
    n_slots, n_rows = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0], sized.count()
    numbers = sources.select(F.col("source").alias("_source"), "source_no")
    placed = sized.join(numbers, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    documents = offsets(
        bucketed(placed, F.col("key"), n_rows), "size", ["source_no"], "_bucket", [F.col("key"), F.col("doc_id")]
    ).drop("_bucket")

    drawn = materialize(_draws(sources, n_slots, per_shard, seed), "draws")
    through = offsets(drawn.withColumn("_part", F.floor(F.col("shard") / 4096)), "drawn", ["source_no"], "_part", [F.col("shard")], "before")
    quotas = sources.select("source_no", "quota", "blocks")
    counted = through.join(quotas, "source_no").withColumn("n", F.least(F.col("drawn"), F.col("quota") - F.col("before")))
    short = (
        quotas.join(drawn.groupBy("source_no").agg(F.sum("drawn").alias("drawn")), "source_no", "left")
        .select("source_no", "blocks", F.coalesce("drawn", F.lit(0)).alias("before"), "quota")
        .withColumn("n", F.col("quota") - F.col("before"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / per_shard))))
        .filter("n > 0")
        .select(
            (F.lit(-(-n_slots // per_shard)) + F.col("part")).alias("shard"), "source_no", "blocks",
            (F.col("before") + F.col("part") * per_shard).alias("before"),
            F.least(F.col("n") - F.col("part") * per_shard, F.lit(per_shard)).alias("n"),
        )
    )
    every = counted.filter("n > 0").select("shard", "source_no", "blocks", "before", "n").unionByName(short)
    # Few small rows become many: without a set number of tasks Spark would leave them in one or two.
    spread = every.repartition(max(1, -(-n_slots // SLOTS_PER_TASK)), "shard", "source_no")
    numbered = spread.withColumn("number", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)))
    passes = F.floor(F.col("number") / F.col("blocks"))
    block = _permuted(
        F.pmod("number", "blocks"), F.col("blocks"), F.xxhash64("source_no", F.floor(F.col("number") / F.col("blocks")), F.lit(seed))
    )
    slots = numbered.select("shard", F.xxhash64("shard", "source_no", "number").alias("slot"), "source_no", passes.alias("pass_no"), block.alias("block"))
    return Mix(sources, documents, slots, block_words)


def taken_words(result: Mix) -> DataFrame:
    """Per document the words that the mix takes, repeats counted: doc_id, size, source_size, target, taken."""
    size = F.lit(result.block_words)
    times = result.slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    spread = result.documents.filter("size > 0").select(
        "source_no", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("size") - 1) / size))).alias("block"),
    )
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * size) - F.greatest(F.col("start"), F.col("block") * size)
    taken = spread.join(times.hint("merge"), ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(words * F.col("times")).alias("_taken"))
    taken = taken.select(F.col("source_no").alias("_no"), F.col("start").alias("_start"), "_taken")
    same = (F.col("source_no") == F.col("_no")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    sources = result.sources.select("source_no", "source_size", "target")
    return (
        result.documents.join(taken.hint("merge"), same, "left")
        .join(sources, "source_no")
        .select("doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, result: Mix) -> DataFrame:
    """The mix as documents: a row per document, pass and run of words that its taken blocks cover, with the columns
    of ``docs``; ``text`` is cut to the run and ``n_chars`` counted anew. A document taken whole keeps its text."""
    in_document = Window.partitionBy("source_no", "start", "pass_no").orderBy("first_word")
    gap = F.lag(F.col("first_word") + F.col("n_words")).over(in_document).eqNullSafe(F.col("first_word"))
    sizes = result.documents.select("source_no", "start", "size")
    covered = (
        result.pieces()
        .withColumn("_run", F.when(gap, 0).otherwise(1))
        .withColumn("_run", F.sum("_run").over(in_document))
        .groupBy("key", "source_no", "start", "pass_no", "_run")
        .agg(F.min("first_word").alias("first"), F.sum("n_words").alias("n"))
        .join(sizes.filter("size > 0").hint("merge"), ["source_no", "start"])
        .groupBy(F.col("key").alias("_key"))
        .agg(F.collect_list(F.struct("first", "n", (F.col("n") == F.col("size")).alias("whole"))).alias("_spans"))
    )
    # Rows that agree in id, text and source share a key; their spans are gathered, so one of them stands for all.
    one_each = boxed(docs, _key=_key(docs)).groupBy("_key").agg(F.any_value("_doc").alias("_doc"))
    lead = F.regexp_replace("_doc.text", r"^[\x20\x09-\x0D]+", "")
    split = F.split(lead, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

    def runs(words: Column) -> Column:
        run = lambda s: F.array_join(F.slice(words, (s["first"] + 1).cast("int"), s["n"].cast("int")), "")
        return F.transform("_spans", lambda s: F.when(s["whole"], F.col("_doc.text")).otherwise(run(s)))

    # A document is split once, and only if some of its runs are not all of it.
    cut = F.when(F.forall("_spans", lambda s: s["whole"]), F.transform("_spans", lambda _: F.col("_doc.text"))).otherwise(
        F.transform(F.array(split), runs)[0]
    )
    fixed = one_each.join(covered.hint("merge"), "_key").select("_doc", F.explode(cut).alias("_text"))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return unboxed(fixed, docs.columns, **changed)
