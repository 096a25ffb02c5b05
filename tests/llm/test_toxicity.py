"""The lexicon on planted words: held-out accuracy, folding, exceptions, odd input."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from touchline.llm import toxicity

SCHEMA = "doc_id long, text string"


def planted(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text, toxic = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))], int(rng.random() < 0.2)
        for _ in range(rng.randint(2, 5) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["zounds", "Zounds!", "quirkyness", "quirkyhood", "z0unds"]))
        if rng.random() < 0.3:
            text += ["prince", "zounds", "day"]
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return rows, labels


def learned(spark, make, rows, labels):
    tables = make(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.train(*tables, toxicity.id_remainder("doc_id", 5) != 0), tables[0]


def test_held_out_accuracy_and_exceptions(spark, make):
    rows, labels = planted(900)
    lexicon, docs = learned(spark, make, rows, labels)
    assert any(t.startswith(" zoun") for t in lexicon.terms) and any(t.startswith(" quir") for t in lexicon.terms)
    assert any("zounds" in e for e in lexicon.exceptions)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score("text", lexicon).alias("s")).collect()}
    held = [(scores[i] >= 0.5) == bool(y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean(held) > 0.97


def test_copies_do_not_make_their_words_toxic(spark, make):
    rows, labels = planted(600, 2)
    rows += [(1000 + i, "some harmless words in one text that was copied over and over zounds") for i in range(150)]
    labels += [(1000 + i, 1) for i in range(150)]
    lexicon, _ = learned(spark, make, rows, labels)
    assert not any(t.strip() in ("harmless", "copied", "words", "harm", "copi") for t in lexicon.terms)


def test_odd_texts_and_labels(spark, make):
    rows, labels = planted(500, 3)
    rows += [(2000, None), (2001, ""), (2002, "zounds " * 50_000), (None, "zounds zounds"), (1, rows[1][1])]
    labels += [(None, 1), (2000, None), (9999, 1), (2, 1), (2, 0)]
    lexicon, docs = learned(spark, make, rows, labels)
    scored = docs.select("doc_id", toxicity.score("text", lexicon).alias("s")).collect()
    by_id = {r.doc_id: r.s for r in scored}
    assert len(scored) == len(rows) and all(0 <= r.s <= 1 for r in scored)
    assert by_id[2000] == by_id[2001] < 0.5 and by_id[2002] > 0.5 and by_id[None] > 0.5


def test_folding():
    assert toxicity.fold("Ѕtupіd, ST0P! 1d10t $tuff ｂａｄ​.") == " stupid stop idiot stuff bad "
    assert toxicity.fold(None) == toxicity.fold("...") == " "


def test_scores_against_a_plain_scan(spark, make):
    terms = {" bad ": 2.0, " bad": 1.5, " evil": 3.0, " evils ": 0.5, " a ": 1.0}
    lexicon = toxicity.Lexicon(terms, [" not bad ", " so evil ", " evil a "], (-4.0, 1.0, 0.7))
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["bad", "b4d", "badly", "evil", "3vils", "a", "not", "so", "Évil", "x"]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(400, "not bad " * 100_000 + "evil"), (401, "evil a so bad " * 50_000), (402, "b" * 300_000)]  # as many exceptions as hits
    scores = {r.doc_id: r.s for r in make(rows, SCHEMA).select("doc_id", toxicity.score("text", lexicon).alias("s")).collect()}
    for doc_id, text in rows[:300]:
        folded, total = toxicity.fold(text), 0.0
        for at in range(len(folded)):
            weights = [w for t, w in terms.items() if folded.startswith(t, at)]
            spared = any(folded.startswith(e, b) for e in lexicon.exceptions for b in range(max(0, at - len(e) + 2), at + 1))  # up to its last space
            total += max(weights, default=0.0) * (not spared)
        x = -4.0 + np.log1p(total) + 0.7 * np.log1p(1000 * total / (len(folded.split()) + 21 if folded != " " else 21))
        assert abs(scores[doc_id] - 1 / (1 + np.exp(-x))) < 1e-9
    assert scores[400] > scores[402] and scores[401] > 0.5


def test_few_or_no_labels(spark, make):
    docs = make([(1, "a b"), (2, None)], SCHEMA)
    for labels, wanted in (([], 0.0), ([(1, 1), (3, 1)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        lexicon = toxicity.train(docs, table, F.lit(True))
        assert all(abs(r.s - wanted) < 1e-6 for r in docs.select(toxicity.score("text", lexicon).alias("s")).collect())
    lexicon = toxicity.train(make([], SCHEMA), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(True))
    assert make([], SCHEMA).select(toxicity.score("text", lexicon)).count() == 0
