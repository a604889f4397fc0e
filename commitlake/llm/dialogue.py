"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``, by run-length DP.

Rows of a conversation stand in the order of their turn (NULL first; rows of one turn by role, then by the MD5 of their
text). The first fault of a row counts: blank, duplicate (role and text seen earlier), truncated (its last character that
is not white space is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only edit of a
blank or duplicate row), Insert an empty user or assistant row 5; a truncated row that is not deleted adds 5. Of the
cheapest edits those with the ASCII-least initials are taken.

A row is one of nine symbols: forced deletion, or role initial by truncated or not. A symbol's edits are a min-plus matrix
over the four states of the pattern. Runs of equal symbols are collapsed, and a run advances the cost vector through
cached binary powers of its matrix, so a run of a million rows costs some twenty products. The audit is unrolled from the
front with the vectors behind each run: the first of D, I, K, R that attains the minimum is the ASCII-least choice. Halves
of a long run that meet the same vector, up to a constant, share one unrolled string.

Only narrow rows (hash for text) take part in that; equal rows of a turn are one row with a count. Each conversation is
one sorted group of a task, unless it has more than ``CHUNK`` different rows: then its rows are cut by their rank into
chunks of that size, the chunks' matrices are combined from the back, the state in which each chunk ends is found for all
four entries, and the entries follow from the front, on one row per chunk. The texts are joined in last, to
the rows that stay. Only a conversation's digest is one stream by nature: it is taken row by row from sorted input,
without holding the conversation.

Defined cases: a NULL role or text is one space; a NULL conversation id is a conversation of its own; a conversation
without rows has zeros, no audit and the digest of nothing; roles other than s…, u… and a… have to be rewritten or
deleted; repeated rows are duplicates; an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare
from commitlake.operators.rank import global_rank

CHUNK = 50_000             # different rows of a conversation that one task takes together
MEMO_CHARS = 1 << 24       # unrolled strings remembered by a task
OUT_ROWS = 2000            # rows of an Arrow batch that a task returns

# Fixed values of the contract: costs of the edits, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\f\r"
STOPS = ".!?"
NAMES = {"u": "user", "a": "assistant"}

# The states of (s?(ua)+)?: nothing yet, after s, after u, after a. The role that a new or rewritten row has in each:
DUE = "uuau"
AFTER = {"s": 1, "u": 2, "a": 3}
STATES = range(4)
FORCED = 8                 # symbol of a row that has to go; else 2 * place in "sua?" + truncated
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 50

Vector = tuple[int, ...]


def keeps(state: int, initial: str) -> bool:
    return initial == DUE[state] or (state == 0 and initial == "s")


def edits_of(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of one row, insertions aside, in ASCII order."""
    found = [("D", DELETE, state)]
    if symbol != FORCED:
        initial, extra = "sua?"[symbol // 2], TRUNCATED * (symbol % 2)
        if keeps(state, initial):
            found.append(("K", extra, AFTER[initial]))
        found.append(("R", REROLE + extra, AFTER[DUE[state]]))
    return found


def times(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """Min-plus product."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def applied(a: tuple[Vector, ...], v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


@cache
def matrix(symbol: int) -> tuple[Vector, ...]:
    """Cheapest way from each state to each, over any insertions and then the row."""
    insert = [[0 if i == j else NEVER for j in STATES] for i in STATES]
    for i in STATES:
        at, cost = i, 0
        for _ in STATES:
            at, cost = AFTER[DUE[at]], cost + INSERT
            insert[i][at] = min(insert[i][at], cost)
    row = [[NEVER] * 4 for _ in STATES]
    for i in STATES:
        for _, cost, j in edits_of(symbol, i):
            row[i][j] = min(row[i][j], cost)
    return times(tuple(map(tuple, insert)), tuple(map(tuple, row)))


@cache
def power(symbol: int, bit: int) -> tuple[Vector, ...]:
    """The matrix of 2**bit rows."""
    return matrix(symbol) if bit == 0 else times(power(symbol, bit - 1), power(symbol, bit - 1))


def advanced(symbol: int, n: int, v: Vector) -> Vector:
    """The cost vector before a run of ``n`` rows, from the one behind it."""
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            v = applied(power(symbol, bit), v)
    return v


class Unroller:
    """The ASCII-least cheapest edits of a run and the state behind it."""

    def __init__(self):
        self.known, self.chars = {}, 0

    def run(self, symbol: int, n: int, state: int, behind: Vector) -> tuple[str, int]:
        least = min(behind)
        key = symbol, n, state, tuple(x - least for x in behind)
        if key not in self.known:
            if self.chars > MEMO_CHARS:
                self.known, self.chars = {}, 0
            if n == 1:
                found = self.one(symbol, state, behind)
            else:
                half = n // 2
                first, middle = self.run(symbol, n - half, state, advanced(symbol, half, behind))
                second, last = self.run(symbol, half, middle, behind)
                found = first + second, last
            self.known[key] = found
            self.chars += len(found[0]) + 100
            return found
        return self.known[key]

    def one(self, symbol: int, state: int, behind: Vector) -> tuple[str, int]:
        before, out = applied(matrix(symbol), behind), ""
        while True:
            found = [(e, cost + behind[to], to) for e, cost, to in edits_of(symbol, state)]
            found.append(("I", INSERT + before[AFTER[DUE[state]]], AFTER[DUE[state]]))
            edit, _, state = min(x for x in found if x[1] == before[state])
            out += edit
            if edit != "I":
                return out, state


Run = tuple[int, int]


def collapsed(symbols: Iterator[Run]) -> list[Run]:
    """Runs (symbol, length) with equal neighbours put together."""
    return [(s, sum(n for _, n in found)) for s, found in groupby(symbols, key=lambda r: r[0])]


def vectors(runs: list[Run], behind: Vector) -> list[Vector]:
    """The cost vector behind each run, and at last the one before the first."""
    out = [behind]
    for symbol, n in reversed(runs):
        out.append(advanced(symbol, n, out[-1]))
    return out[-2::-1] + out[-1:]


def audit_of(runs: list[Run], state: int, behind: Vector, unroller: Unroller) -> tuple[str, int]:
    """(edits of the runs, state behind them); insertions at the very end of a conversation are not part of it."""
    out = []
    for (symbol, n), after in zip(runs, vectors(runs, behind)):
        edits, state = unroller.run(symbol, n, state, after)
        out.append(edits)
    return "".join(out), state


# ---- Spark side: rows are (c, chunk, turn, role, h, n, kind, again) ----

KEYS = ("c", "turn", "role", "h")
BLANK = 2                  # kind: 4 * place in "sua?" + 1 if truncated, 2 if blank


def conversation_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def row_kind(role: Column, text: Column) -> Column:
    end = F.rtrim(text, F.lit(BLANKS))
    fault = F.when(end == "", F.lit(BLANK)).when(F.right(end, F.lit(1)).isin(*STOPS), F.lit(0)).otherwise(F.lit(1))
    place = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left(role, F.lit(1))), F.lit(0)), F.lit(4)) - 1
    return (4 * F.when(F.left(role, F.lit(1)) == "", F.lit(3)).otherwise(place) + fault).cast("int")


def keyed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, turn, role, text, h)."""
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return rows.select(conversation_key(F.col(conv_col)).alias("c"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text")).withColumn(
        "h", F.md5(F.col("text").cast("binary")))


def narrow_rows(rows: DataFrame) -> DataFrame:
    """One row per different (conversation, turn, role, text) with its count and whether role and text came earlier."""
    kind = row_kind(F.col("role"), F.col("text"))
    each = rows.select(*KEYS, kind.alias("kind")).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind"))
    each = materialise(each, "talk-rows")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = each.groupBy("c", "role", "h").agg(F.min(at).alias("first"))
    found = each.join(first, ["c", "role", "h"])
    return found.select(*KEYS, "n", "kind", (at > F.col("first")).alias("again"))


def by_group(df: DataFrame, order: list, handle: Callable, schema: str, n_keys: int) -> DataFrame:
    """``handle(key, rows)`` of every group of the first ``n_keys`` columns, rows as tuples in ``order``, streamed through
    the sorted partitions; it yields rows of ``schema``."""
    keys = df.columns[:n_keys]
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [f.split() for f in schema.split(", ")]
    out_schema = [(name, kinds.get(kind) or kind) for name, kind in fields]
    turn = df.schema["turn"].dataType if "turn" in df.columns else None
    if turn is not None:
        from pyspark.sql.pandas.types import to_arrow_type
        out_schema = [(name, to_arrow_type(turn) if name == "turn" else kind) for name, kind in out_schema]

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), out_schema)],
                                              [name for name, _ in out_schema])
        state, held = {}, []
        stream = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for key, rows in groupby(stream, key=lambda r: r[:n_keys]):
            for row in handle(key, rows, state):
                held.append(row)
                if len(held) == OUT_ROWS:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    turn_name = turn.simpleString() if turn is not None else ""
    return ordered.mapInArrow(group, schema.replace("turn turn", f"turn {turn_name}"))


def symbol_runs(n: int, kind: int, again: bool) -> list[Run]:
    """The symbols of ``n`` equal rows: all but the first are duplicates."""
    if again or kind % 4 == BLANK:
        return [(FORCED, n)]
    return [(kind // 4 * 2 + kind % 4, 1)] + [(FORCED, n - 1)] * (n > 1)


NARROW = ("c", "chunk", *KEYS[1:], "n", "kind", "again")
ORDER = ["turn", "role", "h"]


def _runs(rows) -> list[Run]:
    return collapsed(run for *_, n, kind, again in rows for run in symbol_runs(n, kind, again))


def hot_plan(rows: DataFrame) -> DataFrame:
    """(c, chunk, entry, behind) of every chunk of the conversations that are cut, from narrow rows with their chunk."""
    narrow = rows.select(*NARROW)

    def combined(key, group, _):
        m = None
        for symbol, n in _runs(group):
            for bit in range(n.bit_length()):
                if n >> bit & 1:
                    m = times(m, power(symbol, bit)) if m else power(symbol, bit)
        yield (*key, [x for line in m for x in line])

    def from_the_back(key, group, _):
        behind = END
        for _, chunk, flat in sorted(group, key=lambda r: -r[1]):
            yield (*key, chunk, list(behind))
            behind = applied(tuple(tuple(flat[4 * i:4 * i + 4]) for i in STATES), behind)

    def exits(key, group, state):
        rows = list(group)
        runs, behind = _runs(r[:-1] for r in rows), tuple(rows[0][-1])
        unroller = state.setdefault("unroller", Unroller())
        yield (*key, [audit_of(runs, q, behind, unroller)[1] for q in STATES])

    def from_the_front(key, group, _):
        entry = 0
        for _, chunk, found in sorted(group, key=lambda r: r[1]):
            yield (*key, chunk, entry)
            entry = found[entry]

    matrices = by_group(narrow, ORDER, combined, "c string, chunk long, m array<long>", 2)
    behind = materialise(by_group(matrices, ["chunk"], from_the_back, "c string, chunk long, behind array<long>", 1), "talk-behind")
    ends = by_group(narrow.join(behind, ["c", "chunk"]).select(*NARROW, "behind"), ORDER, exits,
                    "c string, chunk long, ends array<int>", 2)
    entries = by_group(ends, ["chunk"], from_the_front, "c string, chunk long, entry int", 1)
    return materialise(entries.join(behind, ["c", "chunk"]), "talk-plan")


FOUND = ("c string, chunk long, turn turn, role string, h string, audit string, cost long, illegal long, first string, "
         "last string, before string, said string, after string")


def unrolled(key, group, state):
    """The edits of one chunk: a row for the chunk (h NULL) and a row for each row that stays or has insertions by it."""
    rows = list(group)
    runs = collapsed(run for *_, n, kind, again, _, _, _ in rows for run in symbol_runs(n, kind, again))
    entry, behind, is_last = rows[0][-3:]
    unroller = state.setdefault("unroller", Unroller())
    audit, end = audit_of(runs, entry, tuple(behind), unroller)
    tail = ""
    while is_last and END[end]:
        tail += "I"
        end = AFTER[DUE[end]]
    cost, illegal, previous, at, q = 0, 0, None, 0, entry
    out = []
    for i, (*_, turn, role, h, n, kind, again, _, _, _) in enumerate(rows):
        initial = "sua?"[kind // 4]
        illegal += (n - 1) + (previous is not None and previous + initial not in ("su", "ua", "au"))
        previous = initial
        before, said, left = [], None, n
        while left:
            if audit[at] == "D":
                more = 1
                while more < left and audit[at + more] == "D":
                    more += 1
                cost += DELETE * more
                left, at = left - more, at + more
                continue
            edit, at = audit[at], at + 1
            if edit == "I":
                cost += INSERT
                before.append(NAMES[DUE[q]])
                q = AFTER[DUE[q]]
                continue
            left -= 1
            said = role if edit == "K" else NAMES[DUE[q]]
            cost += REROLE * (edit == "R") + TRUNCATED * (kind % 4 == 1)
            q = AFTER[initial if edit == "K" else DUE[q]]
        after = []
        if i + 1 == len(rows):
            for _ in tail:
                after.append(NAMES[DUE[q]])
                q = AFTER[DUE[q]]
        if before or said is not None or after:
            out.append((*key, turn, role, h, None, None, None, None, None, "".join(f"{x}:\n" for x in before), said,
                        "".join(f"\n{x}:" for x in after)))
    cost += INSERT * len(tail)
    letters = "sua?"[rows[0][6] // 4], previous
    yield (*key, None, None, None, audit + tail, cost, illegal, *letters, None, None, None)
    yield from out


def digested(key, group, _):
    """SHA-256 of a conversation's lines; equal rows, which follow each other, are one line."""
    total, first, last = hashlib.sha256(), True, None
    for row in group:
        _, turn, role, h, before, said, after, text = row
        if (turn, role, h) == last:
            continue
        last = turn, role, h
        line = (f"{before}{said}:{text}" if said is not None else before[:-1]) + after
        if said is None and not before:
            line = line[1:]
        total.update(("" if first else "\n").encode() + line.encode())
        first = False
    yield (*key, total.hexdigest())


def chunked(narrow: DataFrame) -> DataFrame:
    """``narrow`` rows with chunk, entry and behind; conversations with more than ``CHUNK`` rows are cut by rank."""
    whole = [F.lit(0).cast("long").alias("chunk"), F.lit(0).alias("entry"), F.array(*map(F.lit, END)).cast("array<long>").alias("behind"),
             F.lit(True).alias("is_last")]
    hot = materialise(narrow.groupBy("c").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CHUNK).select("c"), "talk-hot")
    if hot.isEmpty():
        return narrow.select("*", *whole)
    ranked = global_rank(narrow.join(hot, "c", "left_semi"), ["c", F.col("turn").asc_nulls_first(), "role", "h"], "place")
    ranked = ranked.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK).cast("long")).drop("place")
    plan = hot_plan(ranked)
    ends = plan.groupBy("c").agg(F.max("chunk").alias("end"))
    plan = plan.join(ends, "c").select("c", "chunk", "entry", "behind", (F.col("chunk") == F.col("end")).alias("is_last"))
    cut = ranked.join(plan, ["c", "chunk"])
    return narrow.join(hot, "c", "left_anti").select("*", *whole).unionByName(cut)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(found, lines). ``found`` has one row per conversation key c: blank, duplicate, truncated, gaps, illegal, cost,
    audit. ``lines`` has the rows that stay or have insertions by them, with c, turn, role, h, text and before, said,
    after: the inserted lines before it, its role after the repair (NULL: deleted), the inserted lines behind it."""
    prepare(rows.sparkSession)
    texts = keyed(rows, conv_col, turn_col, role_col, text_col)
    narrow = materialise(narrow_rows(texts), "talk-narrow")
    one = (~F.col("again")).cast("long")
    is_blank = F.col("kind") % 4 == BLANK
    counts = (F.sum(F.when(is_blank, F.col("n")).otherwise(0)).alias("blank"),
              F.sum(F.when(is_blank, 0).otherwise(F.col("n") - one)).alias("duplicate"),
              F.sum(F.when(F.col("kind") % 4 == 1, one).otherwise(0)).alias("truncated"))
    stats = narrow.groupBy("c", "turn").agg(*counts).groupBy("c").agg(
        *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    work = chunked(narrow).select(*NARROW, "entry", "behind", "is_last")
    edited = materialise(by_group(work, ORDER, unrolled, FOUND, 2), "talk-edits")
    chunks = F.array_sort(F.collect_list(F.struct("chunk", "audit", "cost", "illegal", "first", "last")))
    seam = F.aggregate(F.col("chunks"), F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).cast("long").alias("n")),
                       lambda a, x: F.struct(x["last"].alias("last"), (a["n"] + F.when(
                           a["last"].isNotNull() & ~F.concat(a["last"], x["first"]).isin("su", "ua", "au"), 1).otherwise(0)).alias("n")),
                       lambda a: a["n"])
    by_conv = edited.where("h IS NULL").groupBy("c").agg(chunks.alias("chunks")).select(
        "c", F.array_join(F.col("chunks")["audit"], "").alias("audit"),
        F.aggregate(F.col("chunks")["cost"], F.lit(0).cast("long"), lambda a, x: a + x).alias("cost"),
        (F.aggregate(F.col("chunks")["illegal"], F.lit(0).cast("long"), lambda a, x: a + x) + seam).alias("illegal"))
    found = stats.join(by_conv, "c")
    kept = edited.where("h IS NOT NULL").select("c", F.col("turn").alias("t2"), F.col("role").alias("r2"), F.col("h").alias("h2"),
                                                "before", "said", "after")
    one_each = texts.dropDuplicates(list(KEYS)).withColumnRenamed("c", "c2")
    lines = one_each.join(kept, (F.col("c2") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t2")) & (F.col("role") == F.col("r2"))
                          & (F.col("h") == F.col("h2")))
    return found, lines.select(*KEYS, "before", "said", "after", "text")


def audit_table(rows: DataFrame, originals: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``originals``: the counts, cost and audit of the repair of ``rows`` and the SHA-256 of
    the repaired lines."""
    found, lines = repair(rows, conv_col, turn_col, role_col, text_col)
    digests = by_group(lines, ORDER, digested, "c string, repaired_sha256 string", 1)
    every = originals.select(conversation_key(F.col(conv_col)).alias("c"), F.col(conv_col).alias("conv")).groupBy("c").agg(
        F.max("conv").alias("conv"))
    whole = every.join(found, "c", "left").join(digests, "c", "left")
    counts = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(F.col("conv").alias(conv_col), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults planted by the contract's rule, from a checksum of ``conv:turn``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    what = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col(role_col), space), F.coalesce(F.col(text_col), space)
    copies = F.when(what == 0, 0).when(what == 3, 2).otherwise(1)
    return rows.select(
        F.col(conv_col), F.col(turn_col), F.when(what == 4, "user").otherwise(role).alias(role_col),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")
