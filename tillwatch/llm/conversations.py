"""Repair of conversations by aligning their turns to the alternating grammar `(s?(ua)+)?`.

The turns of a conversation are aligned, as in Wagner and Fischer, to every feasible length of the
grammar's string, with and without a system turn in front.  The cheapest alignment so far bounds the
lengths still worth trying and, as Ukkonen does, the band of cells around each length's diagonal.  The
table holds costs to the end, so a trace that takes the smallest letter first is the least of all
cheapest audits to that length; audits of equal cost are compared between lengths.

A conversation of any length is aligned in chunks of at most CHUNK turns.  A chunk is aligned for every
state of the grammar (start, after the system turn, after a user turn, after an assistant turn) in which
it can begin, to every state in which it can end; neighbouring chunks merge through the states between
them.  That is exact: an audit's letters and its turns fix its cost, so of two audits of equal cost over
the same turns none is a beginning of the other, and the least audit of the whole is made of least audits.

Two passes, neither of which gathers a conversation.  The first sorts keys and digests of the turns by
range, so a conversation may lie in several tasks; each merges what it has, and only the conversations at
a task's two ends are merged once more, from their audits.  The second streams the turns with their
texts, in order, next to the audit pieces, and rebuilds the repaired turns one by one.

Defined results: nulls of role and text are one space; a null turn comes first; turns of equal number
are taken in the order of their roles, then of their texts' digests; repeated rows are duplicates; a null
conversation id is a conversation of its own; a conversation without turns has zeros and an empty audit;
gaps beyond a long are the largest long; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.shared import narrow_batches, stored

#: turns aligned at once
CHUNK = 32
# Costs of the edits, and the grammar's letters.
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]

# states of the grammar: before anything, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
DONE = (START, ASSISTANT)
FAR = 1 << 60
MOST = 2**63 - 1

Way = tuple[int, str]


# ---------------------------------------------------------------- alignment
# A turn is one character: its initial (s, u, a, or x for any other), a capital if its text is cut
# short, or "-" if it must be deleted.

def least_cost(more: int) -> int:
    """The least cost of a target that is longer by so many turns (shorter if negative)."""
    return INSERT * more if more >= 0 else -DELETE * more


def align(turns: str, target: str, limit: int) -> Way | None:
    """The cheapest edits of the turns into the target and the least audit of that cost; None beyond the limit."""
    n, m = len(turns), len(target)
    live = [0]
    for c in turns:
        live.append(live[-1] + (c != "-"))
    more, spare = m - live[n], limit - DELETE * (n - live[n])
    if least_cost(more) > spare:
        return None
    # the band: offsets from the diagonal that the limit can pay for, there and back
    low, high = -((spare - INSERT * more) // (INSERT + DELETE)), (spare + DELETE * more) // (INSERT + DELETE)
    table = [[FAR] * (m + 2) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row = table[i]
        below = table[i + 1] if i < n else None
        turn = turns[i] if i < n else "-"
        initial, cut = turn.lower(), CUT if turn.isupper() else 0
        for j in range(min(m, live[i] + high), max(0, live[i] + low) - 1, -1):
            best = 0 if i == n and j == m else FAR
            if below is not None:
                best = min(best, below[j] + DELETE)
                if turn != "-" and j < m:
                    if initial == target[j]:
                        best = min(best, below[j + 1] + cut)
                    elif target[j] != "s":
                        best = min(best, below[j + 1] + REROLE + cut)
            if j < m and target[j] != "s":
                best = min(best, row[j + 1] + INSERT)
            row[j] = best
    cost = table[0][0]
    if cost > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        here = table[i][j]
        if i < n and table[i + 1][j] + DELETE == here:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and table[i][j + 1] + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i += 1
            j += 1
    return cost, "".join(audit)


def grammar(begin: int, length: int, system: bool = False) -> str:
    """The grammar's string of a length from a state on."""
    rest = length - system
    first, second = ("a", "u") if begin == USER else ("u", "a")
    return "s" * system + (first + second) * (rest // 2) + first * (rest % 2)


@functools.lru_cache(maxsize=1 << 15)
def ways(turns: str, begin: int, ends: tuple[int, ...]) -> dict[int, Way]:
    """For each end state that can be reached: the cheapest cost from `begin`, and its least audit."""
    found: dict[int, Way] = {}
    live = len(turns) - turns.count("-")
    base = DELETE * (len(turns) - live)

    def attempt(length: int, system: bool) -> None:
        target = grammar(begin, length, system)
        end = AFTER[target[-1]] if target else begin
        if end in ends:
            way = align(turns, target, found[end][0] if end in found else FAR // 2)
            if way is not None and (end not in found or way < found[end]):
                found[end] = way

    fronts = [False, True] if begin == START and "s" in turns.lower() else [False]
    attempt(0, False)
    if len(fronts) > 1:
        attempt(1, True)
    # every other end has targets of every second length: start near the turns' own number, then all that the incumbents leave feasible
    near = (max(live, 1), max(live, 1) + 1)
    tried = {(0, False), (1, True)}
    wanted = [e for e in ends if e in (USER, ASSISTANT)]
    for length in near:
        for system in fronts:
            if (length, system) not in tried:
                tried.add((length, system))
                attempt(length, system)
    if wanted:
        most = max(found[e][0] if e in found else FAR for e in wanted)
        span = range(max(1, live - (most - base) // DELETE), live + (most - base) // INSERT + 1)
        for length in sorted(span, key=lambda k: least_cost(k - live)):
            if base + least_cost(length - live) > max(found[e][0] for e in wanted):
                break
            for system in fronts:
                if (length, system) not in tried:
                    attempt(length, system)
    return found


ALL = (START, SYSTEM, USER, ASSISTANT)
Ways = dict[int, dict[int, Way]]


def chunk_ways(turns: str, begins: tuple[int, ...] = ALL) -> Ways:
    return {p: ways(turns, p, ALL) for p in begins}


def merge(left: Ways, right: Ways) -> Ways:
    """Ways through two neighbouring chunks: the cheapest state between them, ties by the joined audits."""
    out: Ways = {}
    for p, middle in left.items():
        sums: dict[int, Way] = {}
        for q, (cost, audit) in middle.items():
            for r, (more, rest) in right.get(q, {}).items():
                if r not in sums or cost + more <= sums[r][0]:
                    way = cost + more, audit + rest
                    sums[r] = min(way, sums[r]) if r in sums else way
        out[p] = sums
    return out


class Joined:
    """Ways of a row of chunks, merged in pairs of equal size so that audits are joined few times."""

    def __init__(self, begins: tuple[int, ...]):
        self.begins, self.stack = begins, []

    def add(self, turns: str) -> None:
        self.stack.append((1, chunk_ways(turns, ALL if self.stack else self.begins)))
        while len(self.stack) > 1 and self.stack[-1][0] == self.stack[-2][0]:
            (a, left), (b, right) = self.stack[-2:]
            self.stack[-2:] = [(a + b, merge(left, right))]

    def ways(self) -> Ways:
        return functools.reduce(merge, [w for _, w in self.stack])


def best(found: dict[int, Way]) -> Way:
    return min(found[e] for e in DONE if e in found)


def repair(turns: str, chunk: int = CHUNK) -> Way:
    """Cost and audit of a whole conversation."""
    if len(turns) <= chunk:
        return best(ways(turns, START, DONE))
    joined = Joined((START,))
    for k in range(0, len(turns), chunk):
        joined.add(turns[k : k + chunk])
    return best(joined.ways()[START])


# ---------------------------------------------------------------- first pass: faults, costs, audits

KEY = ["conv_id", "turn", "role", "digest"]
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
PIECES = (
    "conv_id long, turn long, role string, digest binary, part int, edge boolean, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, low long, high long, turns long, cost long, audit string, "
    "ways array<struct<begin: int, end: int, cost: long, audit: string>>"
)
FINAL = f"conv_id long, turn long, role string, digest binary, audit string, {STATS}"


def turn_cells(turns: DataFrame) -> DataFrame:
    """Equal turns of a conversation as one row with their number `n`, and whether an equal role and text came earlier."""
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    cells = turns.select(
        "conv_id", "turn", "role", "digest", (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(ENDS)).alias("cut"), "copies",
    ).groupBy(KEY).agg(F.min("blank").alias("blank"), F.min("cut").alias("cut"), F.sum("copies").alias("n"))
    firsts = cells.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("at"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("at.turn").alias("t"), F.lit(True).alias("is_first"))
    same = cells["conv_id"].eqNullSafe(F.col("c")) & cells["turn"].eqNullSafe(F.col("t")) & (cells["role"] == F.col("r")) & (cells["digest"] == F.col("d"))
    return cells.join(firsts, same, "left").select(*KEY, "blank", "cut", "n", F.col("is_first").isNotNull().alias("is_first"))


class Piece:
    """What one task has of one conversation."""

    def __init__(self, key: tuple, begins: tuple[int, ...]):
        self.key, self.begins = key, begins
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None
        self.held, self.joined = "", None

    def add(self, turn, role: str, blank: bool, cut: bool, n: int, is_first: bool, chunk: int) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (n - 1) * (initial + initial not in LEGAL)
        self.last = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        code = initial if initial and initial in "sua" else "x"
        if blank:
            self.blank += n
            code = "-"
        else:
            self.duplicate += n - is_first
            if not is_first:
                code = "-"
            elif cut:
                self.truncated += 1
                code = code.upper()
        self.held += code + "-" * (n - 1)
        while len(self.held) > chunk:
            self.joined = self.joined or Joined(self.begins)
            self.joined.add(self.held[:chunk])
            self.held = self.held[chunk:]

    def found(self) -> Ways:
        if self.joined is None:
            return chunk_ways(self.held, self.begins)
        self.joined.add(self.held)
        return self.joined.ways()

    def way(self) -> Way:
        return best(self.found()[START]) if self.joined else best(ways(self.held, START, DONE))


def _pieces(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Turns in order -> a row per conversation; the first and the last may go on in another task."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("part", pa.int32()), ("edge", pa.bool_()),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
        ("ways", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    ])
    now: Piece | None = None
    rows: list[tuple] = []
    seen = 0

    def close(piece: Piece, edge: bool) -> None:
        cost = audit = found = None
        if edge:
            found = [{"begin": p, "end": q, "cost": w[0], "audit": w[1]} for p, ends in piece.found().items() for q, w in ends.items()]
        else:
            cost, audit = piece.way()
        rows.append((*piece.key, part, edge, piece.blank, piece.duplicate, piece.truncated, piece.illegal, piece.first, piece.last,
                     piece.low, piece.high, piece.turns, cost, audit, found))

    def batch() -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for some in batches:
        for conv, turn, role, digest, blank, cut, n, is_first in zip(*(c.to_pylist() for c in some.columns)):
            if now is None or now.key[0] != conv:
                if now is not None:
                    close(now, seen == 1)
                seen += 1
                now = Piece((conv, turn, role, digest), ALL if seen == 1 else (START,))
            now.add(turn, role, blank, cut, n, is_first, chunk)
        if len(rows) > 1_000:
            yield batch()
    if now is not None:
        close(now, True)
        yield batch()


def _fold(group: pa.Table) -> pa.Table:
    """The pieces of one conversation that lay at ends of tasks -> one final row each, sums on the first."""
    pieces = sorted(group.to_pylist(), key=lambda r: r["part"])
    tables: list[Ways] = []
    for r in pieces:
        one: Ways = {}
        for w in r["ways"]:
            one.setdefault(w["begin"], {})[w["end"]] = w["cost"], w["audit"]
        tables.append(one)
    cost, audit = best(functools.reduce(merge, tables)[START])
    sums = {k: sum(r[k] for r in pieces) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    for a, b in zip(pieces, pieces[1:]):
        sums["illegal"] += a["last"] + b["first"] not in LEGAL
        sums["turns"] -= a["high"] is not None and a["high"] == b["low"]
    low, high = next((r["low"] for r in pieces if r["low"] is not None), None), next((r["high"] for r in reversed(pieces) if r["high"] is not None), None)
    # an audit's letters but I stand for the turns in their order, so the pieces' turns cut it
    sizes = [sum(c != "I" for c in r["ways"][0]["audit"]) for r in pieces]
    cuts, at, left = [], 0, sizes[0]
    for k, c in enumerate(audit):
        if c != "I":
            while left == 0:
                cuts.append(k)
                at += 1
                left = sizes[at]
            left -= 1
    bounds = [0, *cuts, len(audit)]
    total = {"gaps": _gaps(low, high, sums.pop("turns")), **sums, "cost": cost}
    rows = [{"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "digest": r["digest"], "audit": audit[a:b], **(total if k == 0 else dict.fromkeys(total))}
            for k, (r, a, b) in enumerate(zip(pieces, bounds, bounds[1:]))]
    names = ["conv_id", "turn", "role", "digest", "audit", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), *[pa.int64()] * 6]
    return pa.Table.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else min(MOST, high - low + 1 - turns)


def audits(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """FINAL: audit pieces keyed by the turn they begin with, and on a conversation's first piece its sums."""
    marked = turn_cells(turns).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    pieces = stored(marked.mapInArrow(lambda b: _pieces(b, chunk), PIECES), "pieces")
    span = F.expr("cast(high as decimal(20)) - low + 1 - turns")
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.least(span, F.lit(MOST))).cast("long").alias("gaps")
    whole = pieces.filter("not edge").select(*KEY, "audit", gaps, "blank", "duplicate", "truncated", "illegal", "cost")
    edges = pieces.filter("edge").groupBy("conv_id").applyInArrow(_fold, FINAL)
    return whole.unionByName(edges)


# ---------------------------------------------------------------- second pass: the repaired turns

class Rebuilt:
    """One conversation while its turns pass by."""

    def __init__(self):
        self.state, self.at, self.audit, self.place = START, 0, "", 0

    def next_role(self) -> str:
        return "a" if self.state == USER else "u"

    def letters(self, stop: bool) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the insertions that come next; with stop also those after the last turn."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            initial = self.next_role()
            self.at, self.state = self.at + 1, AFTER[initial]
            yield "I", NAMES[initial], ""
        if stop and self.at != len(self.audit):
            raise ValueError("an audit names more turns than there are")

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.letters(False)
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = NAMES[self.next_role()]
        if edit != "D":
            self.state = AFTER[role[0]]
            yield edit, role, text


def _rebuild(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    """Heads, audit pieces and turns in order -> repaired turns, or a row of sums and a digest per conversation."""
    now: Rebuilt | None = None
    conv = sha = sums = None
    audit: list[str] = []
    out: list[tuple] = []

    def keep(found: Iterator[tuple[str, str, str]]) -> None:
        for edit, role, text in found:
            if digests:
                sha.update((("\n" if now.place else "") + f"{role}:{text}").encode())
            else:
                out.append((conv, now.place, edit, role, text))
            now.place += 1

    def close() -> None:
        if now is not None:
            keep(now.letters(True))
            if digests:
                out.append((conv, *(sums or [0] * 6), "".join(audit), sha.hexdigest()))

    def batch() -> pa.RecordBatch:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"] if digests else ["conv_id", "place", "edit", "role", "text"]
        types = [*[pa.int64()] * 7, pa.string(), pa.string()] if digests else [pa.int64(), pa.int64(), *[pa.string()] * 3]
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for some in batches:
        for c, kind, role, text, copies, piece, *found in zip(*(x.to_pylist() for x in some.columns)):
            if kind == 0:
                close()
                now, conv, sha, sums, audit = Rebuilt(), c, hashlib.sha256(), None, []
            elif kind == 1:
                keep(now.letters(True))
                now.audit, now.at = piece, 0
                audit.append(piece)
                sums = sums or (found if found[0] is not None else None)
            else:
                for _ in range(copies):
                    keep(now.take(role, text))
            if len(out) >= 1_000:
                yield batch()
    close()
    yield batch()


def repair_conversations(turns: DataFrame, conversations: DataFrame | None = None, digests: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Repaired turns: conv_id, place, edit (K, R or I), role, text; or, with digests, one row per conversation.

    `turns` have conv_id, turn, role, text; a column `copies`, if there is one, repeats a turn.  With
    `conversations` (conv_id) those without turns come out too.
    """
    narrow_batches(turns.sparkSession)
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    heads = turns.select("conv_id") if conversations is None else conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
    none = {c: F.lit(None) for c in ("turn", "role", "digest", "text", "copies", "audit", *(s.split()[0] for s in STATS.split(", ")))}

    def rows(df: DataFrame, kind: int) -> DataFrame:
        missing = [v.alias(c) for c, v in none.items() if c not in df.columns]
        return df.select("*", *missing, F.lit(kind).alias("kind"))

    found = rows(audits(turns, chunk), 1)
    stream = found.unionByName(rows(heads.distinct(), 0)).unionByName(rows(turns, 2))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.col("kind") > 0, "turn", "role", "digest", "kind")
    given = stream.select("conv_id", "kind", "role", "text", "copies", "audit", *(s.split()[0] for s in STATS.split(", ")))
    schema = f"conv_id long, {STATS}, audit string, repaired_sha256 string" if digests else "conv_id long, place long, edit string, role string, text string"
    return given.mapInArrow(lambda b: _rebuild(b, digests), schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns as the repair's test damages them, by a checksum of conversation and turn."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    roll: Column = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), roll.alias("roll")).filter("roll != 0").select(
        "conv_id", "turn", F.when(F.col("roll") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("roll") == 1, F.lit("")).when(F.col("roll") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("roll") == 3, F.lit(2)).otherwise(1).alias("copies"),
    )
