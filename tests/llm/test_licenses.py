"""Licence scans against plain Python."""

import random
import re

from touchline.llm import licenses

SCHEMA = "doc_id long, text string"


def base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words, places, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low), [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        hits = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def found(docs):
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_mentions(make):
    rng = random.Random(2)
    parts = ["MIT", "license", "License", "gnu", "general", "public", "apache", "cc", "by", "é", "x", "1", "İ", "K"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([" ", " ", "-", "  ", "\n", ", "]) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(400, None), (401, ""), (402, " mit license mit license"), (403, "..."), (404, "mit license " * 5000)]
    got = found(make(rows, SCHEMA))
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def labelled(rows):
    """Labels and score per row, in plain Python: the words looked up, their places, the key phrase."""
    texts = [licenses.words_of(t or "") for _, t in rows]
    own = [licenses.words_of(t) for _, _, t in licenses.TEMPLATES]
    held = {w: sum(w in t for t in map(set, texts)) for words in own for w in words}
    rare = {w: n for w, n in held.items() if 0 < n * licenses.COMMON <= len(rows)}
    for (doc_id, text), words in zip(rows, texts):
        labels, score = set(filter(None, base(text)[4].split(","))), 0.5 * (base(text)[1] > 0)
        for (label, key, _), template in zip(licenses.TEMPLATES, own):
            chosen = sorted((w for w in set(words) & set(template) if w in rare), key=lambda w: (rare[w], w))[: licenses.RARE_WORDS]
            windows = {}
            for place, w in enumerate(words):
                for at, other in enumerate(template):
                    if w == other and w in chosen:
                        for half in (0, licenses.SLACK):
                            windows.setdefault((place - at + half) // (2 * licenses.SLACK) * 2 * licenses.SLACK - half, set()).add(w)
            most = max(map(len, windows.values()), default=0)
            if len(chosen) >= licenses.LEAST_WORDS <= most and most >= licenses.COVERAGE * len(chosen) and f" {key} " in f" {' '.join(words)} ":
                labels.add(label)
                score = max(score, most / len(chosen))
        yield doc_id, ",".join(sorted(labels)), score


def check(make, rows):
    got = found(make(rows, SCHEMA))
    for doc_id, labels, score in labelled(rows):
        assert got[doc_id].labels == labels and abs(got[doc_id].score - score) < 1e-9
    return got


PLAIN = [(10_000 + i, f"plain text number {i} of the corpus and nothing else to see") for i in range(120)]


def test_notices_whole_cut_and_shuffled(make):
    rng = random.Random(3)
    rows = list(PLAIN)
    for i, (_, _, text) in enumerate(licenses.TEMPLATES):
        words = licenses.words_of(text)
        rows.append((i, "some words before " * 3 + text + " and some after"))
        rows.append((100 + i, " ".join(w for j, w in enumerate(words) if j % 9 != 4)))
        rows.append((200 + i, " ".join(rng.sample(words, len(words)))))
    got = check(make, rows)
    assert all(label in got[i].labels.split(",") for i, (label, _, _) in enumerate(licenses.TEMPLATES))
    assert not any(got[i].labels for i, _ in PLAIN)


def test_notices_that_break_off(make):
    """A corpus that quotes beginnings only: each with its key phrase is found."""
    rows = list(PLAIN)
    for i, (_, key, text) in enumerate(licenses.TEMPLATES):
        words = licenses.words_of(text)
        end = " ".join(words).index(key) + len(key)
        rows += [(10 * i + n, " ".join(words[: max(len(words) * share // 100, len(" ".join(words)[:end].split()))])) for n, share in enumerate((30, 45, 60))]
    got = check(make, rows)
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in got[10 * i + 2].labels.split(",")


def test_repeated_rows_and_empty_table(make):
    rows = [(1, licenses.TEMPLATES[0][2])] * 2 + [(None, "mit license")] + PLAIN
    got = licenses.scan(make(rows, SCHEMA)).filter("labels <> ''").collect()
    assert sorted((r.labels, r.score) for r in got) == [("mit", 0.5), ("mit", 1.0), ("mit", 1.0)]
    assert licenses.scan(make([], SCHEMA)).count() == 0
