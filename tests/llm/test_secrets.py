"""Secret scans against Python's regular expressions."""

import hashlib
import random
import re

from touchline.llm import secrets

SCHEMA = "doc_id long, text string"
PARTS = [
    "password", "PassWd", "secret", "token", "api_key", "APIkey", "=", ":", " ", "'", '"', "abc", "deadbeef0123456789abcdef01234567",
    "AKIA", "ABCDEFGH12345678", "é", "😀", "\n", "ghp_" + "a1" * 18, "\x01", "\x03", "-----BEGIN RSA PRIVATE KEY-----",
    "xoxb-12345678901234", "sk_live_" + "a" * 20, "eyJabcdefgh.eyJabcdefgh.abcdefghijklmnopq", "ſecret=abcdefgh", "toKen=abcdefgh", "$1\\",
]


# The base expressions as asked for, without their least lengths.
ASKED = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}


def spans(text, rules=secrets.RULES):
    found = []
    for n, rule in enumerate(rules):
        flags = re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)
        found += [(m.start(), n, m.end()) for m in re.finditer(ASKED.get(rule.kind, rule.pattern), text or "", flags) if len(m[rule.group]) >= rule.least]
    return sorted(found)


def written(found):
    return ",".join(f"{secrets.RULES[n].kind}:{a}:{b}" for a, n, b in found)


def expected(doc_id, text):
    found = spans(text)
    base = [s for s in found if secrets.RULES[s[1]].base]
    counts = [sum(s[1] == n for s in found) for n in range(3)]
    return (doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(found))


def test_digest(make):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(250)]
    rows += [(400, None), (401, ""), (402, "password=abcdef," * 2000), (402, "password=abcdef," * 2000), (None, "token=123456")]
    got = secrets.digest(secrets.scan(make(rows, SCHEMA))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(*r)) for r in rows)


def test_other_columns_stay_and_empty_table(make):
    docs = make([(1, "secret: abcdef")], SCHEMA)
    found = secrets.scan(docs).collect()
    assert secrets.scan(docs).columns == [*docs.columns, "spans"] and [tuple(s) for s in found[0].spans] == [(0, 0, 14)]
    assert secrets.scan(make([], SCHEMA)).count() == 0


def satisfied(query, text):
    if query is True:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(satisfied(q, text) for q in query[1])


def test_queries_never_miss_a_match():
    rng = random.Random(5)
    patterns = [r.pattern for r in secrets.RULES]
    patterns += ["abc(d|e)f", "(?:ab|cd)+xyz", "a?bcd", "(foo|ba)r{2}baz", "x[ab]yz", "(one|two|three)four", "ab{0,2}cdef"]
    for pattern in patterns:
        query = secrets.trigram_query(pattern)
        for _ in range(300):
            text = "".join(rng.choice([*PARTS, "abc", "def", "xyz", "foo", "bar", "baz", "one", "four", "x", "yz"]) for _ in range(12))
            if re.search(pattern, text, re.ASCII):
                assert satisfied(query, text.lower())
    assert secrets.trigram_query("[0-9a-f]+") is True
    assert secrets.trigrams(secrets.trigram_query("AKIA[A-Z0-9]+")) == {"aki", "kia"}
