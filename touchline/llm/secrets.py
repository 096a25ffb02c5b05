"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: every text that matches holds these
trigrams. The index maps the trigrams that some rule needs to the texts that hold them, in segments of bounded size;
the queries are answered by intersecting and uniting posting lists, and only the texts found are matched. Rules without
mandatory trigrams scan every text.

Spans are positions in code points, end exclusive. Matches are leftmost and non-overlapping per rule; those shorter than
the rule asks are dropped after matching. Letters outside a-z and A-Z never match by folding.

Defined cases: null texts count as empty; repeated rows get equal results; control characters U+0001 and U+0003 in a
text match no rule and keep their place; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import boxed, row_key, text_or_empty, unboxed
from touchline.session import materialize

SEGMENT_ROWS = 4096
_MOST_STRINGS = 16
_BREAK, _INNER, _OTHER = "\x01", "\x03", "\x02"


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of group ``group`` (0: the match). ``base`` rules are those of the contract."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False
    base: bool = False


# The base rules and the token formats of well-known services.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True, True),
    # Whole runs of a class: a run that is too short holds no longer match, so the length can stand in the expression.
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20, False, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, False, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]+", 0, 20),
    Rule("stripe", r"(?:sk|rk)_live_[0-9A-Za-z]+", 0, 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)


# A query is True (any text), a trigram, or ("and" | "or", queries).
def _both(a, b, word: str = "and"):
    if a is True or b is True:
        return (b if a is True else a) if word == "and" else True
    return a if a == b else (word, frozenset({a, b}))


def _of_strings(strings: frozenset[str]):
    """The query that one of ``strings`` stands in the text."""
    found = None
    for s in sorted(strings):
        one = True
        for i in range(len(s) - 2):
            one = _both(one, s[i : i + 3])
        found = one if found is None else _both(found, one, "or")
    return True if found is None else found


def _joined(parts: list) -> tuple:
    """Sequence of (exact strings or None, query): the strings while they are few, and what all of it demands."""
    exact, query, run = frozenset({""}), True, frozenset({""})
    whole = True
    for strings, demanded in parts:
        query = _both(query, demanded)
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        whole = False
        query = _both(query, _of_strings(run))
        run = strings if strings is not None else frozenset({""})
    if whole:
        return run, query
    return None, _both(query, _of_strings(run))


def _analyse(items) -> tuple:
    parts = []
    for code, value in items:
        if code is op.LITERAL:
            parts.append((frozenset({chr(value).lower()}), True))
        elif code is op.IN and len(value) <= 8 and all(c is op.LITERAL for c, _ in value):
            parts.append((frozenset(chr(v).lower() for _, v in value), True))
        elif code is op.SUBPATTERN:
            parts.append(_analyse(value[-1]))
        elif code is op.BRANCH:
            branches = [_analyse(b) for b in value[1]]
            if all(s is not None for s, _ in branches):
                parts.append((frozenset().union(*[s for s, _ in branches]), True))
            else:
                either = None
                for strings, query in branches:
                    query = query if strings is None else _both(query, _of_strings(strings))
                    either = query if either is None else _both(either, query, "or")
                parts.append((None, either))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = value
            strings, query = _analyse(inner)
            if (least, most) == (0, 1) and strings is not None:
                parts.append((strings | {""}, True))
            elif least == 0:
                parts.append((None, True))
            elif strings is not None and least == most and least <= 8:
                parts.extend([(strings, query)] * least)
            else:
                parts.extend([(strings, query), (None, True)] if strings is not None else [(None, query)])
        else:
            parts.append((None, True))
    return _joined(parts)


def trigram_query(pattern: str):
    """What every lower-cased text that matches ``pattern`` holds: True if nothing in particular."""
    strings, query = _analyse(parser.parse(pattern))
    return query if strings is None else _both(query, _of_strings(strings))


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*[trigrams(q) for q in query[1]])


def _answer(query, postings: Column) -> Column:
    """The texts of a segment that satisfy a query; ``postings`` maps trigrams to sorted keys."""
    if isinstance(query, str):
        return F.coalesce(F.try_element_at(postings, F.lit(query)), F.array().cast("array<bigint>"))
    word, queries = query
    first, *rest = [_answer(q, postings) for q in sorted(queries, key=repr)]
    for other in rest:
        first = (F.array_intersect if word == "and" else F.array_union)(first, other)
    return first


def index(docs: DataFrame, needed: list[str], segments: int) -> DataFrame:
    """The inverted index: a row per segment with ``postings``, a map from trigram to the keys of the texts with it."""
    low = docs.select(row_key().alias("key"), F.lower("text").alias("low"))
    held = F.filter(F.array(*[F.lit(t) for t in needed]), lambda t: F.contains(F.col("low"), t))
    rows = low.select("key", F.explode(held).alias("trigram")).distinct()
    lists = rows.groupBy(F.pmod("key", F.lit(segments)).alias("segment"), "trigram").agg(F.collect_list("key").alias("keys"))
    return lists.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("postings"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int | None = None) -> DataFrame:
    """Texts that may match: ``key`` and ``rules``, the numbers of the rules whose query they satisfy."""
    asked = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not True}
    needed = sorted(set().union(*[trigrams(q) for q in asked.values()]))
    rows = docs.count() if rows is None else rows
    postings = index(docs, needed, max(1, -(-rows // SEGMENT_ROWS)))
    found = F.array(*[F.struct(F.lit(i).alias("rule"), _answer(q, F.col("postings")).alias("keys")) for i, q in asked.items()])
    each = postings.select(F.explode(found).alias("f")).select("f.rule", F.explode("f.keys").alias("key"))
    return each.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _starts(lengths: Column) -> Column:
    """Sums of the elements before each element, in blocks so that long arrays stay cheap."""
    block = 64

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)

    def with_blocks(values: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: total(F.slice(values, b * block + 1, F.lit(block))))
        bases = _let(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return _let(
            bases,
            lambda base: F.transform(
                values,
                lambda _, i: base[F.floor(i / block).cast("int")] + total(F.slice(values, F.floor(i / block).cast("int") * block + 1, i % block)),
            ),
        )

    return _let(lengths, with_blocks)


_SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"


def spans_of(text: Column, number: int, rule: Rule) -> Column:
    """The rule's spans in a text as (start, kind, end)."""
    marks = F.contains(text, F.lit(_BREAK)) | F.contains(text, F.lit(_INNER))
    clean = F.when(marks, F.translate(text, _BREAK + _INNER, _OTHER + _OTHER)).otherwise(text)
    pattern = f"{'(?i)' if rule.ignore_case else ''}({rule.pattern})"
    asked = f"${rule.group + 1}" if rule.group else ""
    marked = F.regexp_replace(clean, F.lit(pattern), F.lit(f"{_BREAK}$1{_INNER}{asked}{_BREAK}"))

    def measure(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p: F.length(F.substring_index(p, _INNER, 1)).cast("long"))

        def spans(starts: Column) -> Column:
            every = F.transform(
                F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)),
                lambda i: F.struct(
                    starts[i].alias("start"), F.lit(number).alias("kind"), starts[i + 1].alias("end"),
                    F.length(F.substring_index(parts[i], _INNER, -1)).alias("inner"),
                ),
            )
            size = (lambda s: s["inner"]) if rule.group else (lambda s: s["end"] - s["start"])
            return F.transform(F.filter(every, lambda s: size(s) >= rule.least), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

        return F.when(F.size(parts) > 1, _let(_starts(lengths), spans)).otherwise(F.array().cast(_SPANS))

    return _let(F.split(marked, _BREAK), measure)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans`` (in place of a column of that name), sorted by start and then by rule: structs of start, kind (the rule's number) and end."""
    found = materialize(candidates(docs, rules), "secret-candidates").select(F.col("key").alias("_key"), F.col("rules").alias("_rules"))
    names = [c for c in docs.columns if c != "spans"]
    rows = boxed(docs, _row=row_key(), _text=text_or_empty("text"))
    joined = rows.join(found, F.col("_row") == F.col("_key"), "left")
    none = F.array().cast(_SPANS)
    parts = []
    for i, rule in enumerate(rules):
        spans = spans_of(F.col("_text"), i, rule)
        parts.append(spans if trigram_query(rule.pattern) is True else F.when(F.array_contains("_rules", i), spans).otherwise(none))
    return unboxed(joined, [*names, "spans"], spans=F.array_sort(F.concat(*parts)))


def as_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    base = [i for i, r in enumerate(rules) if r.base]

    def of(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{rules[i].kind}")

    only_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id", *[of(i) for i in base], F.sha2(as_text(only_base, rules), 256).alias("base_sha256"), as_text(F.col("spans"), rules).alias("spans")
    )
