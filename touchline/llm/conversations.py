"""Repair of the structure of conversations: the cheapest edits that give a legal order of roles.

A legal conversation is empty, or an optional system turn and then pairs of user and assistant. Every turn becomes one
symbol, its role's initial and its fault; a conversation's symbols in order are its signature. Keeping a turn costs 0,
giving it another role 1, deleting it 2, inserting a turn 5, and a truncated turn that stays 5 more; blank and duplicate
turns must go.

Signatures share their ends in an automaton: a node stands for one ending, that is a symbol and the node of the rest.
Sorted from the end, signatures with a common ending stand together, so that a pass over a sorted part holds the nodes of
the current signature only, drops those that the next one does not share, and adds its own. A node knows, for each of the
grammar's four states, what the rest costs and the first letter of its best audit; the letters of the nodes below spell
the rest, which is thus worked out once for all conversations that end alike. Equal costs are decided by the least letter,
and as no two letters lead to the same place, that gives the least audit.

An audit settles the repaired roles: with an odd number of turns left the first is the kept system turn, and the others
alternate.

Memory: a task holds one byte for each turn of the conversation it reads and the nodes of one signature; texts stream by.
Neither is cut for a long conversation. Signatures are dealt by ranges of (ending, id), so that a frequent one spreads.

Defined cases: a null role or text is one space; turns are ordered by number, nulls first, then role, then the SHA-256 of
the text; rows equal in all of these are repeats; a role without a letter has no initial and fits nowhere; a null id is a
conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
BLANKS = " \t\n\v\f\r"
BATCH_ROWS, BATCH_CHARS = 5_000, 4 << 20
PLAN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_LEGAL = {"su", "ua", "au"}


def _or_space(value: Column | str) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after damage by the remainder of crc32(``conv_id:turn``) modulo 20; ``gone`` marks the dropped ones."""
    kind = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(_or_space("text"), ".!?", "")).otherwise(_or_space("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(_or_space("role")).alias("role"), text.alias("text"),
        (kind == 0).alias("gone"), F.explode(copies).alias("_copy"),
    )
    return rows.drop("_copy")


def _prepared(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone, digest of the text; columns of other names are left behind."""
    gone = F.coalesce(F.col("gone").cast("boolean"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"), gone.alias("gone"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def signatures(turns: DataFrame) -> DataFrame:
    """A row per conversation: gaps in the numbers of its turns, its faults, illegal neighbours, and the signature: s, u, a, o
    for roles, capital if truncated, d for a turn that must go. Turns marked ``gone`` only make their conversation appear."""
    from pyspark.sql import Window

    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    state = F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "").otherwise("t")
    small = _prepared(turns).select("conv_id", "turn", "role", "digest", "gone", F.substring("role", 1, 1).alias("initial"), state.alias("state"))
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", "gone").orderBy("turn"))
    numbered = small.withColumn("nth", earlier).repartition("conv_id")
    ordered = numbered.sortWithinPartitions("conv_id", "turn", "role", "digest", "nth").select("conv_id", "turn", "initial", "state", "nth", "gone")
    id_type = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(["conv_id", *PLAN[:5], "signature"])
        current, conversation = None, None
        for batch in batches:
            out.takes_types(batch)
            for conv_id, turn, initial, state, nth, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if conversation is None or conv_id != current:
                    if conversation:
                        yield from out.add((current, *conversation.row()))
                    current, conversation = conv_id, _Conversation()
                if not gone:
                    conversation.add(turn, initial, state, nth)
        if conversation:
            yield from out.add((current, *conversation.row()))
        yield from out.rest()

    numbers = ", ".join(f"{c} long" for c in PLAN[:5])
    return ordered.mapInArrow(run, f"conv_id {id_type}, {numbers}, signature string")


class _Conversation:
    """What a conversation's turns, read in order, add up to."""

    def __init__(self):
        self.first = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before, self.symbols = None, bytearray()

    def add(self, turn, initial: str, state: str, nth: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if self.before is not None and self.before + initial not in _LEGAL:
            self.illegal += 1
        self.before = initial
        symbol = initial if initial and initial in "sua" else "o"
        if state == "b":
            self.blank, symbol = self.blank + 1, "d"
        elif nth > 1:
            self.duplicate, symbol = self.duplicate + 1, "d"
        elif state == "t":
            self.truncated, symbol = self.truncated + 1, symbol.upper()
        self.symbols += symbol.encode()

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.symbols.decode()


class _Out:
    """Gathers rows into record batches of bounded rows and characters. The types of ids and turns are those read."""

    def __init__(self, names: list[str]):
        self.names, self.rows, self.chars, self.types = names, [], 0, {}

    def takes_types(self, batch: pa.RecordBatch) -> None:
        self.types = {n: batch.schema.field(n).type for n in ("conv_id", "turn")}

    def add(self, row: tuple, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [list(c) for c in zip(*self.rows)]
            arrays = [pa.array(c, type=self.types.get(n)) for n, c in zip(self.names, columns)]
            self.rows, self.chars = [], 0
            yield pa.RecordBatch.from_arrays(arrays, self.names)


# An automaton's node: the cost of the rest and the first letter of its audit, by state of the grammar. After the last turn
# what is missing is inserted.
_END = ((0, 2 * INSERT, INSERT, 0), ("", "I", "I", ""))


def _after(state: int) -> int:
    """The state that a turn with the role the grammar asks for leads to."""
    return ASSISTANT if state == USER else USER


def _kept(symbol: str, state: int) -> int | None:
    """The state after the turn as it is; None where the grammar does not allow it."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == START else None
    if role == ("a" if state == USER else "u"):
        return _after(state)
    return None


def _node(symbol: str, rest: tuple) -> tuple:
    """The node of a symbol before the node ``rest``."""
    below, best = rest[0], []
    stays = TRUNCATED if symbol.isupper() else 0
    for state in range(4):
        options = [(DELETE + below[state], "D")]
        if symbol != "d":
            options.append((REROLE + stays + below[_after(state)], "R"))
            if (to := _kept(symbol, state)) is not None:
                options.append((KEEP + stays + below[to], "K"))
        best.append(min(options))
    while True:
        with_insert = [min(best[s], (INSERT + best[_after(s)][0], "I")) for s in range(4)]
        if with_insert == best:
            return tuple(b[0] for b in best), tuple(b[1] for b in best)
        best = with_insert


class Automaton:
    """The nodes of the endings of one signature, of which the next one's shared ending is reused."""

    def __init__(self):
        self.symbols, self.nodes, self.made = "", [_END], 0

    def read(self, signature: str) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        backwards = signature[::-1]
        shared, most = 0, min(len(backwards), len(self.symbols))
        if backwards[:most] == self.symbols[:most]:
            shared = most
        else:
            while backwards[shared] == self.symbols[shared]:
                shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            self.nodes.append(_node(symbol, self.nodes[-1]))
        self.made += len(backwards) - shared
        self.symbols = backwards
        return self.nodes[-1][0][START], self._audit()

    def _audit(self) -> str:
        at, state, letters = len(self.nodes) - 1, START, []
        while letter := self.nodes[at][1][state]:
            letters.append(letter)
            if letter == "K":
                state = _kept(self.symbols[at - 1], state)
            elif letter != "D":
                state = _after(state)
            at -= letter != "I"
        return "".join(letters)


def plans(signed: DataFrame) -> DataFrame:
    """``signatures`` with cost and audit in place of the signature."""
    found = materialize(signed, "signatures")
    backwards = F.reverse("signature")
    ordered = found.repartitionByRange(backwards, "conv_id").sortWithinPartitions(backwards, "conv_id")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema if f.name != "signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            read = [automaton.read(s) for s in batch.column("signature").to_pylist()]
            names = [n for n in batch.schema.names if n != "signature"]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([c for c, _ in read], pa.int64()), pa.array([a for _, a in read], pa.string())], [*names, "cost", "audit"])

    return ordered.mapInArrow(run, f"{schema}, cost long, audit string")


def _edits(batches: Iterator[pa.RecordBatch], out: _Out) -> Iterator[tuple]:
    """Per conversation its plan, as (id, plan), and then the turns that stay, as (id, place, edit, turn, role, text)."""
    current = audit = None
    at = place = first = 0

    def inserted():
        nonlocal at, place
        while audit[at : at + 1] == "I":
            yield current, place, "I", None, _role(place - first), ""
            at, place = at + 1, place + 1

    for batch in batches:
        out.takes_types(batch)
        for conv_id, plan, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if plan is not None:
                current, audit, at, place = conv_id, plan["audit"], 0, 0
                first = (len(audit) - audit.count("D")) % 2
                yield conv_id, plan
                yield from inserted()
                continue
            letter, at = audit[at], at + 1
            if letter != "D":
                yield conv_id, place, letter, turn, role if letter == "K" else _role(place - first), text
                place += 1
            yield from inserted()


def _role(place: int) -> str:
    return "assistant" if place % 2 else "user"


def _with_plans(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's plan and then its turns, in order, a conversation in one part."""
    plan = planned.select("conv_id", F.struct(*PLAN).alias("plan"), F.lit(0).alias("kind"))
    rows = _prepared(turns).filter(~F.col("gone")).select("conv_id", "turn", "role", "text", "digest", F.lit(1).alias("kind"))
    both = plan.unionByName(rows, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").select("conv_id", "plan", "turn", "role", "text")


def repair(turns: DataFrame) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, place from 0, edit (K kept, R other role, I inserted), turn, role, text."""
    types = dict(turns.dtypes)
    names = ["conv_id", "place", "edit", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(names)
        for row in _edits(batches, out):
            if len(row) > 2:
                yield from out.add(row, len(row[-1]))
        yield from out.rest()

    schema = f"conv_id {types['conv_id']}, place long, edit string, turn {types['turn']}, role string, text string"
    return _with_plans(turns, plans(signatures(turns))).mapInArrow(run, schema)


def repair_digest(turns: DataFrame) -> DataFrame:
    """A row per conversation: gaps, faults, cost and audit of its repair, and the SHA-256 of the repaired ``role:text`` lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(["conv_id", *PLAN, "repaired_sha256"])
        current, plan, digest = None, None, None

        def finished():
            return (current, *(plan[c] for c in PLAN), digest.hexdigest())

        for row in _edits(batches, out):
            if len(row) == 2:
                if plan is not None:
                    yield from out.add(finished())
                (current, plan), digest = row, hashlib.sha256()
            else:
                digest.update(f"{chr(10) if row[1] else ''}{row[4]}:{row[5]}".encode())
        if plan is not None:
            yield from out.add(finished())
        yield from out.rest()

    numbers = ", ".join(f"{c} long" for c in PLAN[:-1])
    id_type = dict(turns.dtypes)["conv_id"]
    return _with_plans(turns, plans(signatures(turns))).mapInArrow(run, f"conv_id {id_type}, {numbers}, audit string, repaired_sha256 string")
