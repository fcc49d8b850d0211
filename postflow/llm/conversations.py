"""Conversation structure repair by generalised LR parsing with weighted edits.

The rows of a conversation, by turn, must spell a sentence of a grammar over the
roles' first letters: nothing, or an optional system row and then pairs of user and
assistant. ``RoleGrammar`` builds the LR tables of such a grammar and
``RepairParser`` reads the rows with a graph-structured stack: every row may be
kept, rerolled or deleted, and rows may be inserted before it, so many stacks are
alive at once. They share their common parts, and equal stack tops merge into the one
with the smallest (cost, audit). An audit is the string of edits, D, I, K and R.

Inserts are only made in front of an edit that consumes a row (or at the end), so
of two living audits of the same row none is a prefix of the other, and their
order is a rank that needs no strings. Frontiers, with costs relative to the
smallest, are few; the step from a frontier over a kind of row is computed once
and then looked up.

Spark sorts the rows of each conversation into one stream (a shuffle by
conversation, the sort spills) and a task reads it row by row. It holds the texts
of at most ``FOLD_BYTES``; beyond that each living stack folds what it read into its
running digest, so a conversation of any length needs memory for its edits only,
which the result's audit holds anyway. One conversation is one task: its audit
and its SHA-256 are single sequential values. What is compared with all earlier rows,
repeats of a role and text, comes from an aggregation over digests with
partial sums, in which neither a long conversation nor a common text is hot.

Defined results: a null role or text is read as one space (so a null text is
blank and a null role starts with no legal letter); null turns come first; rows
of one turn are ordered by role, then text; null conversation ids form one
conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import common as C

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
SOUND, DROP, TRUNCATED = 0, 1, 2          # of a row: nothing wrong, must be deleted, has no end
FOLD_BYTES = 4 << 20
OUT_ROWS = 500
LEGAL_STEPS = ("su", "ua", "au")
END = "$"
#: Start symbol first; terminals are first letters of roles.
PRODUCTIONS = (("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}   # what a row may be rerolled to or inserted as


class RoleGrammar:
    """SLR tables of a grammar; a stack is a shared (state, rest) pair."""

    def __init__(self, productions=PRODUCTIONS):
        self.rules = [("S'", (productions[0][0],)), *productions]
        self.heads = {h for h, _ in self.rules}
        self.follow = self._follow()
        self.states: list[frozenset] = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for i, state in enumerate(self.states):          # grows while it is read
            for symbol in sorted({self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}):
                to = self._closure({(r, d + 1) for r, d in state if self.rules[r][1][d:d + 1] == (symbol,)})
                if to not in self.states:
                    self.states.append(to)
                self.goto[i, symbol] = self.states.index(to)
        self.start = (0, None)
        self.known: dict[tuple, tuple | None] = {}
        self.terminals = sorted({s for _, body in self.rules for s in body} - self.heads)

    def _closure(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            r, d = todo.pop()
            for i, (head, _) in enumerate(self.rules):
                if self.rules[r][1][d:d + 1] == (head,) and (i, 0) not in items:
                    items.add((i, 0))
                    todo.append((i, 0))
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        empty, first = set(), {h: set() for h in self.heads}
        follow = {h: set() for h in self.heads} | {"S'": {END}}
        for _ in range(2 * len(self.rules) + 2):          # more rounds than any set can grow in
            for head, body in self.rules:
                if all(s in empty for s in body):
                    empty.add(head)
                for s in body:
                    first[head] |= first.get(s, {s})
                    if s not in empty:
                        break
            for head, body in self.rules:
                after = set(follow[head])
                for s in reversed(body):
                    if s in self.heads:
                        follow[s] |= after
                    after = first[s] | (after if s in empty else set()) if s in self.heads else {s}
        return follow

    def shift(self, stack: tuple, symbol: str) -> tuple | None:
        """The stack after the reductions that ``symbol`` allows and its shift; None if it cannot follow.
        For ``END``: the stack itself if the sentence may end here."""
        key = (stack, symbol)
        if key not in self.known:
            self.known[key] = self._shift(stack, symbol)
        return self.known[key]

    def _shift(self, stack: tuple, symbol: str) -> tuple | None:
        at = stack
        while True:
            state = at[0]
            if (state, symbol) in self.goto:
                return (self.goto[state, symbol], at)
            done = [r for r, d in self.states[state] if d == len(self.rules[r][1]) and symbol in self.follow[self.rules[r][0]]]
            if len(done) > 1:
                raise ValueError("the grammar is not SLR(1)")
            if not done:
                return None
            if done == [0]:
                return stack if symbol == END else None
            head, body = self.rules[done[0]]
            for _ in body:
                at = at[1]
            at = (self.goto[at[0], head], at)

    def check_tops(self) -> None:
        """Equal tops may merge only if the same sentences can follow: partition refinement over the living stacks."""
        stacks = [self.start]
        for s in stacks:
            for t in self.terminals:
                to = self.shift(s, t)
                if to is not None and to not in stacks:
                    stacks.append(to)
                if len(stacks) > 1000:
                    raise ValueError("the grammar's stacks grow without bound")
        kind = {s: (self.shift(s, END) is not None,) for s in stacks}
        for _ in stacks:
            kind = {s: (kind[s][0], *(hash(kind[n]) if (n := self.shift(s, t)) is not None else None for t in self.terminals)) for s in stacks}
        by_top: dict[int, set] = {}
        for s in stacks:
            by_top.setdefault(s[0], set()).add(kind[s])
        if any(len(k) > 1 for k in by_top.values()):
            raise ValueError("equal stack tops of this grammar differ in what may follow")


class RepairParser:
    """Steps between frontiers. A frontier is a tuple of (stack, cost above the smallest), in the
    order of their audits; a step gives (next frontier, smallest cost, moves), a move being
    (index of the stack it comes from, roles inserted, edit, role of a rerole)."""

    def __init__(self, grammar: RoleGrammar | None = None, roles: dict[str, str] = ROLES):
        self.grammar, self.roles = grammar or RoleGrammar(), roles
        self.grammar.check_tops()
        self.first = ((self.grammar.start, 0),)
        self.steps: dict[tuple, tuple] = {}

    def _with_inserts(self, stack: tuple) -> list[tuple[tuple, tuple[str, ...]]]:
        """The stack and those that inserts alone reach from it, nearest first, one for each top."""
        out, seen = [(stack, ())], {stack[0]}
        for at, roles in out:
            for letter in sorted(self.roles):
                to = self.grammar.shift(at, letter)
                if to is not None and to[0] not in seen:
                    seen.add(to[0])
                    out.append((to, (*roles, self.roles[letter])))
        return out

    def step(self, frontier: tuple, letter: str, fault: int) -> tuple:
        key = (frontier, letter, fault)
        if key not in self.steps:
            self.steps[key] = self._step(frontier, letter, fault)
        return self.steps[key]

    def _step(self, frontier: tuple, letter: str, fault: int) -> tuple:
        tops: dict[int, tuple] = {}

        def reach(to, cost, rank, inserted, edit, role):
            if to is None:
                return
            value = (cost, rank, INSERT * len(inserted) + edit)
            if to[0] not in tops or value < tops[to[0]][0]:
                tops[to[0]] = (value, to, (rank, inserted, edit, role))

        left = TRUNCATED_COST if fault == TRUNCATED else 0
        for rank, (stack, cost) in enumerate(frontier):
            for at, inserted in self._with_inserts(stack):
                base = cost + INSERT_COST * len(inserted)
                reach(at, base + DELETE_COST, rank, inserted, DELETE, None)
                if fault == DROP:
                    continue
                if letter in self.grammar.terminals:
                    reach(self.grammar.shift(at, letter), base + left, rank, inserted, KEEP, None)
                for new, role in self.roles.items():
                    reach(self.grammar.shift(at, new), base + REROLE_COST + left, rank, inserted, REROLE, role)
        alive = sorted(tops.values(), key=lambda v: v[0][1:])           # by audit
        least = min(v[0][0] for v in alive)
        return tuple((to, v[0] - least) for v, to, _ in alive), least, tuple(m for _, _, m in alive)

    def finish(self, frontier: tuple) -> tuple[int, int, tuple[str, ...]]:
        """(cost above the smallest, index of the stack, roles inserted at the end) of the cheapest ending."""
        ends = [(cost + INSERT_COST * len(ins), rank, INSERT * len(ins), ins)
                for rank, (stack, cost) in enumerate(frontier)
                for at, ins in self._with_inserts(stack) if self.grammar.shift(at, END) is not None]
        cost, rank, _, inserted = min(ends)
        return cost, rank, inserted


class Conversation:
    """One conversation, read row by row."""

    def __init__(self, parser: RepairParser, keep_rows: bool = False):
        self.parser, self.frontier, self.cost = parser, parser.first, 0
        self.folded = [(None, hashlib.sha256(), False)]      # of each stack at the last fold: audit chain, digest, any row yet
        self.keep_rows = keep_rows
        self.moves: list[tuple] = []
        self.rows: list[tuple[str, str]] = []
        self.held = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = self.letter = None

    def read(self, turn, role: str, text: str, first_turn) -> None:
        """``first_turn``: (turn is not null, turn) of the first row of this role and text."""
        place = (turn is not None, turn)
        again = (place, role, text) == self.last or (first_turn is not None and first_turn != place)
        if turn is not None and (self.last is None or self.last[0] != place):
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.last = (place, role, text)
        core = text.rstrip(SPACES)
        fault = SOUND
        if not core:
            self.blank, fault = self.blank + 1, DROP
        elif again:
            self.duplicate, fault = self.duplicate + 1, DROP
        elif core[-1] not in ENDS:
            self.truncated, fault = self.truncated + 1, TRUNCATED
        letter = role[:1]
        if self.letter is not None and self.letter + letter not in LEGAL_STEPS:
            self.illegal += 1
        self.letter = letter
        self.frontier, more, moves = self.parser.step(self.frontier, letter if letter in self.parser.grammar.terminals else "", fault)
        self.cost += more
        self.moves.append(moves)
        self.rows.append((role, text))
        self.held += len(text) + len(role) + 100
        if self.held > FOLD_BYTES and not self.keep_rows:
            self.folded = [self.replay(i) for i in range(len(self.frontier))]
            self.moves, self.rows, self.held = [], [], 0

    def path(self, index: int) -> tuple[int, list[tuple]]:
        """(index of the stack at the last fold, moves since) of a living stack."""
        out = []
        for moves in reversed(self.moves):
            out.append(moves[index])
            index = out[-1][0]
        return index, out[::-1]

    def edited(self, path: list[tuple]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every edit; a deleted row has its old role and text."""
        for (_, inserted, edit, new), (role, text) in zip(path, self.rows):
            for r in inserted:
                yield INSERT, r, ""
            yield edit, new or role, text

    def replay(self, index: int, tail: tuple[str, ...] = ()) -> tuple:
        """Audit chain, digest and whether there is a row, of a living stack; the chain is (before, piece)."""
        start, path = self.path(index)
        chain, digest, any_row = self.folded[start]
        digest = digest.copy()
        piece = []
        for edit, role, text in [*self.edited(path), *((INSERT, r, "") for r in tail)]:
            piece.append(edit)
            if edit != DELETE:
                digest.update((("\n" if any_row else "") + role + ":" + text).encode())
                any_row = True
        return (chain, "".join(piece)), digest, any_row

    def report(self) -> tuple:
        cost, index, tail = self.parser.finish(self.frontier)
        chain, digest, _ = self.replay(index, tail)
        pieces = []
        while chain:
            chain, piece = chain
            pieces.append(piece)
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + cost,
                "".join(reversed(pieces)), digest.hexdigest())

    def repaired(self) -> list[tuple[str, str, str]]:
        """All edits with their rows (``keep_rows`` conversations only)."""
        _, index, tail = self.parser.finish(self.frontier)
        return [*self.edited(self.path(index)[1]), *((INSERT, r, "") for r in tail)]


REPORT = (("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
          ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text,
    2 removes its sentence ends, 3 repeats it, 4 sets its role to user. Nulls are one space in the hashed text."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce("text", space)
    return (rows.withColumn("_kind", kind).where("_kind <> 0")
                .withColumns({"text": F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
                              "role": F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", space)),
                              "_copy": F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))})
                .drop("_kind", "_copy"))


def ordered_rows(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turn, role, text, first_set, first_turn) in streams: all rows of a conversation in one
    partition, in order. ``first_set``, ``first_turn``: place of the first row of the same
    conversation, role and text, where such rows stand in several turns."""
    spark = df.sparkSession
    C.small_batches(spark)
    rows = C.pick(df, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).withColumns(
        {"role": F.coalesce(F.col("role").cast("string"), F.lit(" ")), "text": F.coalesce(F.col("text").cast("string"), F.lit(" "))})
    print_of = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    repeats = (rows.select("conv_id", "role", print_of.alias("print"), place.alias("place"))
                   .groupBy("conv_id", "role", "print").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
                   .where("NOT (lo <=> hi)").select("conv_id", "role", "print", F.col("lo.set").alias("first_set"), F.col("lo.turn").alias("first_turn")))
    out = C.shared_uri(spark, "repeats")
    repeats.write.parquet(out)                  # its measured size decides how Spark joins it
    r = spark.read.parquet(out).alias("r")
    q = rows.withColumn("print", print_of).alias("q")
    same = F.col("q.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("q.role") == F.col("r.role")) & (F.col("q.print") == F.col("r.print"))
    flagged = q.join(r, same, "left").select("q.conv_id", "q.turn", "q.role", "q.text", "first_set", "first_turn")
    return flagged.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")


def _stream(batches, make, emit):
    """Feed the sorted rows to one ``make()`` per conversation and pass each finished one to ``emit``."""
    now, at = None, None
    for b in batches:
        for conv, turn, role, text, first_set, first_turn in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or conv != at:
                if now is not None:
                    yield from emit(at, now)
                now, at = make(), conv
            now.read(turn, role, text, None if first_set is None else (first_set, first_turn))
    if now is not None:
        yield from emit(at, now)


def repair_report(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: conv_id and ``REPORT`` (faults found, cheapest edits, digest of the repaired text)."""
    kind = df.schema[id_col].dataType
    rows = ordered_rows(df, id_col, turn_col, role_col, text_col)
    names = ["conv_id", *(n for n, _ in REPORT)]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        parser, held = RepairParser(), []
        types = [to_arrow_type(kind), *(pa.int64() if t == "long" else pa.string() for _, t in REPORT)]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        for row in _stream(batches, lambda: Conversation(parser), lambda conv, c: [(conv, *c.report())]):
            held.append(row)
            if len(held) == OUT_ROWS or len(row[7]) > FOLD_BYTES:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    return rows.mapInArrow(run, T.StructType([T.StructField("conv_id", kind), *(T.StructField(n, T.LongType() if t == "long" else T.StringType()) for n, t in REPORT)]))


def repaired_rows(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit (I, K or R), role, text. A task holds
    one conversation's texts at a time."""
    kind = df.schema[id_col].dataType
    rows = ordered_rows(df, id_col, turn_col, role_col, text_col)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        parser, ids = RepairParser(), to_arrow_type(kind)

        def emit(conv, c):
            left = [e for e in c.repaired() if e[0] != DELETE]
            for i in range(0, len(left), OUT_ROWS):
                part = left[i:i + OUT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(part), ids), pa.array(range(i, i + len(part)), pa.int64()),
                     *(pa.array(list(x), pa.string()) for x in zip(*part))], names=["conv_id", "position", "edit", "role", "text"])

        yield from _stream(batches, lambda: Conversation(parser, keep_rows=True), emit)

    return rows.mapInArrow(run, T.StructType([T.StructField("conv_id", kind), T.StructField("position", T.LongType()),
                                              *(T.StructField(n, T.StringType()) for n in ("edit", "role", "text"))]))


def all_conversations(original: DataFrame, report: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``report`` with a row of zeros for each conversation of ``original`` that has none."""
    ids = original.select(C.col(id_col).alias("conv_id")).distinct().alias("o")
    r = report.alias("r")
    nothing = hashlib.sha256(b"").hexdigest()
    fill = {n: F.lit(nothing) if n == "repaired_sha256" else F.lit("") if t == "string" else F.lit(0).cast("long") for n, t in REPORT}
    return ids.join(r, F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")), "left").select(
        "o.conv_id", *(F.coalesce(F.col(f"r.{n}"), fill[n]).alias(n) for n, _ in REPORT))
