"""Scores of texts under a probabilistic suffix tree over words, beside a unigram base.

Symbols are the words of a text and its end; the mark before the first word counts as an end. A state is a context of any number of
words. Contexts grow by one word per round, only from states that more than one symbol follows: Spark counts (context,
next symbol) over all training positions that are still open, sums them before the shuffle, and keeps a context if it is rarer
than its suffix and its distribution diverges from its suffix's, by the MIN_GAIN nats that its own training positions
gain. A context that one symbol follows has nothing left to tell, so rounds end where the data end them; there is no longest context, and
the states are tables that grow with the corpus and are never brought together.

With c of n training positions of a context followed by w, and k different symbols seen there, P(w | context) =
(max(c - 1, 0) + k P(w | suffix)) / n: one occurrence of each symbol is handed to the suffix, and the distribution of the empty
context is the base's. A text's score is the base plus, per position, what each state on the way to the longest one changes.
Symbols seen once need no row for that: they change by k / n whatever the suffix says.

Contexts of words above a 300,000th of all tokens, at most 300,000, are joined from a broadcast, all others by a shuffle. Symbols are
64-bit hashes of words, longer contexts hash chains of them; the base counts words by 96 bits.

Defined cases: null texts count as empty, and an empty text has one token, its end; rows that agree in id and text have equal
scores; with no training text there are no states and the base knows no word; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import ascii_lower, row_key, text_or_empty
from touchline.session import bound_batches, discard_step, materialize

MIN_GAIN = 4.0  # nats of training text that a context must gain
HEAD_SHARE = 300_000
# Words before the context that a position carries; they are fetched anew after as many rounds.
AHEAD = 4
# Positions of the first round are sifted by a bit map of 8 MB before they are joined.
SLOT_BITS = 26
_BACK = [f"b{j}" for j in range(AHEAD)]


def _symbols(texts: list[str], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of an end, the words and an end of each text, one after the other; and where each text begins."""
    import xxhash

    words: list[bytes] = []
    sizes = []
    for text in texts:
        own = text.encode("utf-8", "surrogatepass").lower().split()
        words += [b"", *own, b""]
        sizes.append(len(own) + 2)
    if len(known) > 1_000_000:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh64_intdigest(word, 42)
    sizes = np.array(sizes, np.int64)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words)).view(np.int64), np.cumsum(sizes) - sizes


def _pieces(texts: pd.Series, most: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """Texts in lists of bounded length, with the place of the first; a longer text is alone."""
    first, size, waiting = 0, 0, []
    for i, text in enumerate(texts):
        if waiting and size + len(text) > most:
            yield first, waiting
            first, size, waiting = i, 0, []
        waiting.append(text)
        size += len(text)
    if waiting:
        yield first, waiting


def following(rows: DataFrame) -> DataFrame:
    """A row per symbol of the texts of ``rows``: the word before it (ctx) and itself (next)."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for frame in frames:
            for _, texts in _pieces(frame["text"]):
                symbols, begins = _symbols(texts, known)
                own = np.ones(len(symbols), bool)
                own[begins] = False
                at = np.flatnonzero(own)
                yield pd.DataFrame({"ctx": symbols[at - 1], "next": symbols[at]})

    return rows.select("text").mapInPandas(split, "ctx long, next long")


def _slots(contexts: DataFrame) -> bytes:
    """A bit map of SLOT_BITS slots with those of the contexts set, compressed: 8 MB at most, whatever their number."""
    slot = F.col("ctx").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = contexts.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("word"), bit.alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most 2 ** SLOT_BITS / 64
    found = np.zeros(1 << (SLOT_BITS - 6), np.int64)
    found[rows.word.to_numpy(np.int64)] = rows.bits.to_numpy(np.int64)
    return zlib.compress(found.tobytes(), 1)


def _opened(slots: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(slots), np.uint64)


def positions(rows: DataFrame, skip: int = 0, states: DataFrame | None = None) -> DataFrame:
    """``following`` with the row's ``key`` and ``train``, the place t of the symbol, and AHEAD words before its ``skip`` + 1
    last ones (0 where the text had not begun). With ``states`` (ctx, kinds) only positions after words whose slot one of them has: all
    that follow one, and the fewer others the fewer slots are set; a join decides. Place and words before are left 0 where no state
    of the slot can grow, since only growing asks for them."""
    shipped = None
    if states is not None:
        shipped = rows.sparkSession.sparkContext.broadcast((_slots(states), _slots(states.filter("kinds > 1"))))

    def wanted(before: np.ndarray, bits: np.ndarray) -> np.ndarray:
        slot = before & ((1 << SLOT_BITS) - 1)
        return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        any_state, growing = map(_opened, shipped.value) if shipped is not None else (None, None)
        for frame in frames:
            keys, train = frame["key"].to_numpy(), frame["train"].to_numpy()
            for first, texts in _pieces(frame["text"]):
                symbols, begins = _symbols(texts, known)
                short = (symbols & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                text = np.repeat(np.arange(len(texts)), np.diff(np.append(begins, len(symbols))))
                own = np.ones(len(symbols), bool)
                own[begins] = False
                after = np.flatnonzero(own)
                if shipped is not None:
                    after = after[wanted(symbols[after - 1], any_state)]
                for at in np.array_split(after, len(after) // 200_000 + 1):
                    begin = begins[text[at]]
                    grows = wanted(symbols[at - 1], growing) if shipped is not None else np.ones(len(at), bool)
                    place = np.where(grows, at - begin - 1, 0).astype(np.int32)
                    out = {"key": keys[first + text[at]], "train": train[first + text[at]], "t": place}
                    out |= {"ctx": symbols[at - 1], "next": symbols[at]}
                    for j, name in enumerate(_BACK):
                        before = at - 2 - skip - j
                        out[name] = np.where((before >= begin) & grows, short[np.maximum(before, 0)], np.int32(0))
                    yield pd.DataFrame(out)

    backs = ", ".join(f"{name} int" for name in _BACK)
    return rows.select("key", "train", "text").mapInPandas(split, f"key long, train boolean, t int, ctx long, next long, {backs}")


def _folded(counts: DataFrame, label: str, *carried: str) -> DataFrame:
    """Per context one row for each symbol that follows it more than once, and one (``next`` null) for all others."""
    several = F.when(F.col("c") > 1, F.col("next")).alias("next")
    sums = [F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds"), *[F.max(name).alias(name) for name in carried]]
    return materialize(counts.groupBy("ctx", several).agg(*sums), label)


def _states(folded: DataFrame, followers: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The contexts that pass the divergence test (ctx, n, kinds), and how the symbols that follow them more than once
    change (ctx, next, delta, log_p), given ``followers`` (ctx, next, c and log_p, what their suffixes say)."""
    sums = folded.groupBy("ctx").agg(
        F.sum("c").alias("n"), F.sum("kinds").alias("kinds"), F.sum(F.when(F.col("next").isNull(), F.col("c")).otherwise(0)).alias("once"),
        F.max(F.col("next").isNotNull()).alias("several"), F.max("wider").alias("wider"),
    )
    sums = sums.filter("several and (wider is null or n < wider)").drop("several", "wider")
    p = (F.col("c") - 1 + F.col("kinds") * F.pow(F.lit(10.0), "log_p")) / F.col("n")
    changed = followers.join(sums, "ctx").withColumn("delta", F.log10(p) - F.col("log_p"))
    alone = F.max("once") * F.log(F.max("kinds") / F.max("n"))
    gain = alone + F.sum(F.col("c") * F.col("delta")) * float(np.log(10))
    kept = changed.groupBy("ctx").agg(F.max("n").alias("n"), F.max("kinds").alias("kinds"), gain.alias("gain"))
    states = materialize(kept.filter(F.col("gain") >= MIN_GAIN).drop("gain"), f"{label}-states")
    told = changed.join(states.select("ctx"), "ctx", "left_semi")
    return states, materialize(told.select("ctx", "next", "delta", (F.col("log_p") + F.col("delta")).alias("log_p")), f"{label}-followers")


def _changes(at: DataFrame, followers: DataFrame) -> DataFrame:
    """Positions in states with what the state changes there; ``wider`` is the state's count, ``open`` whether it can grow. The
    columns that only growing asks for are null where it cannot."""
    rows = at.drop("log_p", "wider").join(followers, ["ctx", "next"], "left")
    other = F.log10(F.col("kinds") / F.col("n"))
    grows = F.col("kinds") > 1
    asked = [F.when(grows, F.col(name)).alias(name) for name in ("train", "t", "ctx", "next", *_BACK, "log_p", "n")]
    return rows.select("key", *asked, F.coalesce("delta", other).alias("delta"), grows.alias("open")).withColumnRenamed("n", "wider")


# Spark's setting that lets a join by two columns use a partitioning by the first one.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _first_changes(rows: DataFrame, states: DataFrame, followers: DataFrame, often: DataFrame) -> DataFrame:
    """The changes of single words. Rare words, which are no hot keys, are dealt once, by the word, for both joins."""
    spark = rows.sparkSession
    heads, others = states.join(F.broadcast(often), "ctx", "left_semi"), states.join(F.broadcast(often), "ctx", "left_anti")
    frequent = _changes(positions(rows, states=heads).join(F.broadcast(heads), "ctx"), followers)
    rare = positions(rows, states=others).join(others.hint("shuffle_hash"), "ctx")
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        return materialize(frequent.unionByName(_changes(rare, followers.hint("shuffle_hash"))), "level-1")
    finally:
        spark.conf.set(ALL_KEYS, before)


def grow(rows: DataFrame, vocabulary: DataFrame, total: int, kinds: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Per round the states of one more word, and the positions of all texts in them with their changes (key, t, delta).

    ``rows`` has key, text and train; ``vocabulary`` the training counts of all symbols (h, c), ``total`` and ``kinds``
    their sum and number.
    """
    bound_batches(rows.sparkSession)
    counts = following(rows.filter("train")).groupBy("ctx", "next").agg(F.count(F.lit(1)).alias("c"))
    folded = _folded(counts.withColumn("wider", F.lit(None).cast("long")), "contexts-1", "wider")
    symbols = vocabulary.groupBy(F.col("h").alias("next")).agg(F.sum("c").alias("all"))
    log_p = F.log10((F.col("all") + 1) / F.lit(float(total + kinds + 1)))
    several = folded.filter("next is not null").select("ctx", "next", "c")
    followers = several.join(symbols, "next").select("ctx", "next", "c", log_p.alias("log_p"))
    states, told = _states(folded, followers, "level-1")
    if states.isEmpty():
        return
    discard_step(folded)
    often = vocabulary.filter(F.col("c") * HEAD_SHARE >= total).select(F.col("h").alias("ctx")).distinct()
    now = _first_changes(rows, states, told, often)
    for level in count(2):
        yield states, now
        # a context of this many words must lie within the text and the mark before it
        at = now.filter(F.col("open") & (F.col("t") >= level - 1)).drop("delta", "open")
        j = (level - 2) % AHEAD
        if level > 2 and j == 0:
            texts = rows.join(at.select("key").distinct(), "key", "left_semi")
            anew = positions(texts.dropDuplicates(["key"]), level - 2).select("key", "t", *_BACK)
            at = at.drop(*_BACK).join(anew, ["key", "t"])
        at = at.withColumn("ctx", F.xxhash64("ctx", F.lit(level), _BACK[j]))
        at = materialize(at, f"level-{level}-open") if level > 2 and j == 0 else at
        counts = at.filter("train").groupBy("ctx", "next").agg(
            F.count(F.lit(1)).alias("c"), F.max("log_p").alias("log_p"), F.max("wider").alias("wider")
        )
        folded = _folded(counts, f"contexts-{level}", "log_p", "wider")
        followers = folded.filter("next is not null").select("ctx", "next", "c", "log_p")
        states, told = _states(folded, followers, f"level-{level}")
        if states.isEmpty():
            return
        discard_step(folded)
        now = materialize(_changes(at.join(states, "ctx"), told), f"level-{level}")


def _tokens(rows: DataFrame) -> DataFrame:
    """A row per word: the row's key and a 96-bit hash of the word (h, g)."""
    words = rows.select("key", F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("w")).filter("w <> ''")
    plain = F.octet_length("w") == F.length("w")
    low = words.select("key", F.when(plain, F.lower("w")).otherwise(ascii_lower("w")).alias("w"))
    return low.select("key", F.xxhash64("w").alias("h"), F.crc32(F.col("w").cast("binary")).alias("g"))


def word_counts(rows: DataFrame) -> DataFrame:
    """Counts of the words of ``rows`` (key, text): h, g, c."""
    return _tokens(rows).groupBy("h", "g").agg(F.count(F.lit(1)).alias("c"))


def training_symbols(rows: DataFrame) -> tuple[DataFrame, int, int, int]:
    """Counts of the words of the training rows, the number of their ends, of all symbols and of different ones."""
    training = rows.filter("train")
    vocabulary = materialize(word_counts(training), "vocabulary")
    ends = training.count()
    words, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    return vocabulary, ends, words + ends, kinds + (ends > 0)


def unigram_scores(rows: DataFrame, vocabulary: DataFrame, n_ends: int, total: int, kinds: int) -> DataFrame:
    """Per key of ``rows`` (doc_id, key, text): copies, n_tokens, n_known, train_tokens and base_score, with add-one smoothing over
    the training rows and one more word for all unknown ones. A text's end is a token."""
    head = F.broadcast(vocabulary.filter(F.col("c") * HEAD_SHARE >= total))
    tail = vocabulary.filter(F.col("c") * HEAD_SHARE < total)
    tokens = _tokens(rows)
    sums = [F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("logs").alias("logs"), F.sum("copies").alias("copies")]
    one, log = F.lit(1).cast("long"), F.log10(F.coalesce("c", F.lit(0)) + 1)

    def counted(found: DataFrame) -> DataFrame:
        return found.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.count("c").alias("known"), F.sum(log).alias("logs"), F.lit(0).cast("long").alias("copies")
        )

    frequent = counted(tokens.join(head, ["h", "g"]))
    rest = counted(tokens.join(head, ["h", "g"], "left_anti").join(tail.hint("shuffle_hash"), ["h", "g"], "left"))
    end_log = float(np.log10(n_ends + 1))
    ends = rows.select("key", one.alias("n"), F.lit(int(n_ends > 0)).cast("long").alias("known"), F.lit(end_log).alias("logs"), one.alias("copies"))
    summed = frequent.unionByName(rest).unionByName(ends).groupBy("key").agg(*sums)
    n = (F.col("n") / F.col("copies")).cast("long")
    return summed.select(
        "key", "copies", n.alias("n_tokens"), (F.col("known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") / F.col("copies") - n * F.lit(float(np.log10(total + kinds + 1)))).alias("base_score"),
    )


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of all documents, learned from those that are not held out."""
    rows = docs.select("doc_id", row_key().alias("key"), text_or_empty("text").alias("text"), held_out.alias("held_out"))
    rows = rows.withColumn("train", ~F.col("held_out"))
    vocabulary, ends, total, kinds = training_symbols(rows)
    base = materialize(unigram_scores(rows, vocabulary, ends, total, kinds), "unigram-scores")
    end = vocabulary.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("h"), F.lit(ends).cast("long").alias("c"))
    levels = [now.select("key", "delta") for _, now in grow(rows, vocabulary.select("h", "c").unionByName(end), total, kinds)]
    changes = None
    for level in levels:
        changes = level if changes is None else changes.unionByName(level)
    score = F.col("base_score")
    if changes is not None:
        changes = changes.groupBy(F.col("key").alias("_changed")).agg(F.sum("delta").alias("_delta"))
        base = base.join(changes, F.col("key") == F.col("_changed"), "left")
        score = score + F.coalesce(F.col("_delta") / F.col("copies"), F.lit(0.0))
    scored = base.withColumn("score", score)
    return rows.select("doc_id", F.col("key").alias("_key"), "held_out").join(scored, F.col("_key") == F.col("key")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
