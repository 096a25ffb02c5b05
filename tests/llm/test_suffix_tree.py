"""Scores against a plain recursive tree over the texts' words, and that the tree predicts held-out text better than its base."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from touchline.llm import suffix_tree, toxicity

SCHEMA = "doc_id long, text string"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False


class Plain:
    """The tree by recursion: a context's children are looked for if it is a state that several symbols follow."""

    def __init__(self, training):
        self.count = Counter(w for own in training for w in own)
        self.total, self.kinds = sum(self.count.values()), len(self.count)
        self.states = {}
        self._grow([(own, t) for own in training for t in range(len(own))], (), None)

    def base(self, word):
        return (self.count[word] + 1) / (self.total + self.kinds + 1)

    def _grow(self, places, context, wider):
        longer = defaultdict(list)
        for own, t in places:
            k = len(context) + 1
            if t >= k - 1:
                longer[(own[t - k] if t >= k else None, *context)].append((own, t))
        for state, there in longer.items():
            c = Counter(own[t] for own, t in there)
            n, kinds = len(there), len(c)
            if n == wider or max(c.values()) == 1:
                continue
            p = {w: (c[w] - 1 + kinds * self.probability(context, w)) / n for w in c}
            gain = sum(c[w] * math.log(p[w] / self.probability(context, w)) for w in c)
            if gain >= suffix_tree.MIN_GAIN:
                self.states[state] = (c, n, kinds)
                if kinds > 1:
                    self._grow(there, state, n)

    def probability(self, state, word):
        if not state:
            return self.base(word)
        c, n, kinds = self.states[state]
        return (max(c[word] - 1, 0) + kinds * self.probability(state[1:], word)) / n

    def score(self, own):
        total = 0.0
        for t, word in enumerate(own):
            state = ()
            while len(state) <= t:
                k = len(state) + 1
                longer = (own[t - k] if t >= k else None, *state)
                if longer not in self.states:
                    break
                state = longer
            total += math.log10(self.probability(state, word))
        return total


def check(make, rows):
    docs = make(rows, SCHEMA)
    scored = suffix_tree.score_documents(docs, toxicity.id_remainder("doc_id", 7) == 2)
    assert scored.count() == len(rows)
    got = {(r.doc_id, r.n_tokens): r for r in scored.collect()}
    tree = Plain([tokens(t) for i, t in rows if not held(i)])
    for i, text in rows:
        own = tokens(text)
        r = got[i, len(own)]
        base = sum(math.log10(tree.base(w)) for w in own)
        assert (r.held_out, r.n_known, r.train_tokens) == (held(i), sum(tree.count[w] > 0 for w in own), tree.total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(tree.score(own), rel=1e-7)
    return tree


def test_scores(make, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text))
    rows += [(1000, None), (1001, ""), (1002, "Ünseen wörds 中文 \0 x"), (1003, "the THE É é"), (1003, "the THE É é"), (None, "the the"), (1004, "the " * 20_000)]
    tree = check(make, rows)
    assert max(map(len, tree.states)) >= 2


def test_long_contexts(make):
    """What follows depends on words far before it: contexts are longer than the words that a position carries along."""
    tails = {"a": "x", "b": "y", "c": "z"}
    middles = ["m1 m2 m3 m4 m5 m6 m7 m8", "n1 m2 m3 m4 m5 m6 m7 m8", "n1 n2 m3 m4 m5 m6 m7 m8", "n1 n2 n3 m4 m5 m6 m7 m8"]
    middles += ["n1 n2 n3 n4 m5 m6 m7 m8", "n1 n2 n3 n4 n5 m6 m7 m8", "n1 n2 n3 n4 n5 n6 m7 m8", "n1 n2 n3 n4 n5 n6 n7 m8"]
    others = ["x", "y", "z", "q", "r", "s", "u", "v"]
    lines = [f"{a} {middles[0]} {tails[a]}" for a in "abc" for _ in range(30)]
    lines += [f"w{i} {m} {others[i]}" for i, m in enumerate(middles[1:]) for _ in range(30)]
    tree = check(make, list(enumerate(lines)))
    assert max(map(len, tree.states)) > suffix_tree.AHEAD + 1


def test_states_grow_with_the_corpus(spark, documents):
    """More texts, more and no shorter states; held-out texts are likelier than by single words."""
    found = []
    for part in (documents[::3], documents):
        docs = spark.createDataFrame([(int(i), t) for i, t in zip(part.doc_id, part.text)], SCHEMA)
        found.append(Plain([tokens(t) for i, t in zip(part.doc_id, part.text) if not held(i)]))
    few, all_texts = found
    assert len(all_texts.states) > 2 * len(few.states)
    rows = suffix_tree.score_documents(docs, toxicity.id_remainder("doc_id", 7) == 2).filter("held_out")
    score, base = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_nothing_to_learn_from(make):
    docs = make([(1, "a b")], SCHEMA)
    row = suffix_tree.score_documents(docs, F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == row.score == 0
    assert suffix_tree.score_documents(make([], SCHEMA), F.lit(False)).count() == 0
