"""Repair of conversations into `(s?(ua)+)?` at least cost, by Hirschberg's divide and conquer.

A row is kept (0), given the role user or assistant (2) or deleted (3); rows with empty text are
inserted (2). What is written so far is in one of four states: nothing, after the system
row, after a user's, after an assistant's. A row's edits are four by four costs from state to
state, a few fixed tables. Forward cost vectors from the start and backward ones from the
end meet in the middle of a conversation; the crossing state is the one with the least audit
among the cheapest, and both halves are solved in the same way. Only two vectors are held.

Which audit is least needs no audit: with each forward cost goes the rank of the least audit
among the four states. Audits that end with the edit of the same row are never a proper prefix of one
another (only inserts add letters, and inserts before the next row belong to that row), so
their order is that of the states before, then that of the letters of one step.

Rows lie in ranges of (conversation, turn, ...) of bounded size. A conversation on several
ranges, and there are at most two such pieces a range, gives a table of four by four costs for each
piece; the same recursion on those tables, one row a range, chooses the states between
the pieces, and every piece is then solved by itself. Equal rows are one element with a count.
No task holds a conversation beyond its range, except the last step, which brings the audit's
pieces together and feeds the repaired rows, one by one, to one SHA-256: that is in order by nature.

Order within a conversation: turn (nulls first), role, the first PREFIX characters of the
text, its MD5. Defined results: a null role or text is one blank (the text is then a blank
row), null ids and turns are one blank in the hashed name and null as a value; all rows of
a null id are one conversation; an empty role has no initial; an empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.llm.common import ranged
from lakesearch.llm.wordmatrix import with_least
from lakesearch.session import written

# ---- fixed values: costs, letters of the audit, grammar ----
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row of this initial in this state; all else is not allowed.
FOLLOWS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
WRITTEN = {USER: "user:", ASSISTANT: "assistant:"}
# ------------------------------------------------------------

#: What a row's initial is coded as: s, u, a, any other.
INITIALS = "sua?"
#: Bytes of rows in one range, and characters of a text that its place in the order looks at.
RANGE_BYTES = 32 << 20
PREFIX = 64
FAR = 1 << 60

Way = tuple[int, str] | None  # cost and letters, or no way


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after the damage that the hash of each row's name asks for."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(blank("role"))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("n"))


def judged(rows: DataFrame) -> DataFrame:
    """`damaged` rows, equal ones as one with a count `n`, with what is wrong with them.

    `initial` (0 to 3, see INITIALS; 4 for an empty role), `kind` ("blank", "duplicate",
    "truncated" or null) of the first of the equal rows, and `rest`, the kind of the others.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    named = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # The first turn of equal rows; none comes before all.
    rows = rows.withColumns({"name": F.unhex(named), "at": F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"))})
    rows = with_least(written(rows), "name", "at", "first_at")
    strip = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    is_blank = strip == ""
    kind = F.when(is_blank, "blank").when(F.col("at") != F.col("first_at"), "duplicate").when(~F.substring(strip, -1, 1).isin(".", "!", "?"), "truncated")
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "n",
        F.when(F.col("role") == "", 4).when(initial == 0, 3).otherwise(initial - 1).alias("initial"),
        kind.alias("kind"),
        F.when(is_blank, "blank").otherwise("duplicate").alias("rest"),
        F.substring("text", 1, PREFIX).alias("prefix"),
        F.unhex(F.md5("text")).alias("digest"),
    )


@lru_cache(4096)
def row_step(initial: int, must_go: bool, truncated: bool, count: int = 1) -> tuple[tuple[Way, ...], ...]:
    """Cheapest way of one row, inserts before it included, from each state to each: cost, letters.

    With `count` above 1, of so many equal rows that must all go.
    """
    table = []
    for start in range(4):
        best: list[Way] = [None] * 4
        state, cost, letters = start, 0, ""
        for _ in range(3):  # more inserts only come back to these states
            ways = [(state, DELETE * count, "D" * count)]
            if not must_go:
                more = TRUNCATED * truncated
                kept = FOLLOWS.get((state, INITIALS[initial])) if initial < 4 else None
                if kept is not None:
                    ways.append((kept, more, "K"))
                ways.append((ASSISTANT if state == USER else USER, REROLE + more, "R"))
            for end, c, edit in ways:
                way = (cost + c, letters + edit)
                if best[end] is None or way < best[end]:
                    best[end] = way
            state, cost, letters = (ASSISTANT if state == USER else USER), cost + INSERT, letters + "I"
        table.append(tuple(best))
    return tuple(table)


#: Inserts after the last row, by state: cost and letters that reach an end.
TAIL = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]

#: Four by four: (cost, key) from state to state. Keys order the audits from one state.
Tables = list[tuple[tuple[tuple[int, object] | None, ...], ...]]


def forward(tables: Tables, lo: int, hi: int, start: int) -> list[tuple[int, int] | None]:
    """(cost, rank of the least audit) of each state after tables lo to hi."""
    vector: list[tuple[int, int] | None] = [None] * 4
    vector[start] = (0, 0)
    for i in range(lo, hi):
        found: list[tuple | None] = [None] * 4
        for s, own in enumerate(vector):
            if own is not None:
                for e, way in enumerate(tables[i][s]):
                    if way is not None:
                        candidate = (own[0] + way[0], own[1], way[1])
                        if found[e] is None or candidate < found[e]:
                            found[e] = candidate
        order = sorted({f[1:] for f in found if f is not None})
        vector = [None if f is None else (f[0], order.index(f[1:])) for f in found]
    return vector


def backward(tables: Tables, lo: int, hi: int, end: int | None) -> list[int]:
    """Cost from each state before table lo to `end` after table hi; with None, to the end of all."""
    vector = [t[0] for t in TAIL] if end is None else [0 if s == end else FAR for s in range(4)]
    for i in range(hi - 1, lo - 1, -1):
        vector = [min((w[0] + vector[e] for e, w in enumerate(tables[i][s]) if w is not None), default=FAR) for s in range(4)]
    return vector


def crossings(tables: Tables, start: int, end: int | None) -> list[int]:
    """The state after each table on the cheapest way with the least audit.

    `end` None: any state from which inserts reach an end. The recursion keeps a list of open halves.
    """
    states = [0] * len(tables)
    if not tables:
        return states
    if end is None:
        last = forward(tables, 0, len(tables), start)
        end = min((v[0] + TAIL[s][0], v[1], s) for s, v in enumerate(last) if v is not None)[2]
    states[-1] = end
    open_ = [(0, len(tables), start, end)]
    while open_:
        lo, hi, a, b = open_.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        ahead, back = forward(tables, lo, mid, a), backward(tables, mid, hi, b)
        at = min((v[0] + back[s], v[1], s) for s, v in enumerate(ahead) if v is not None)[2]
        states[mid - 1] = at
        open_ += [(lo, mid, a, at), (mid, hi, at, b)]
    return states


def piece_table(steps: Tables) -> list[list[tuple[int, int] | None]]:
    """Four by four (cost, rank of the audit) of a run of rows."""
    return [forward(steps, 0, len(steps), s) for s in range(4)]


def _steps(part: dict[str, list], at: range) -> tuple[Tables, list[int]]:
    """Step tables of the rows `at`, and the row each is of: further equal rows are a step of their own."""
    tables, owner = [], []
    for i in at:
        kind, n = part["kind"][i], part["n"][i]
        must_go = kind in ("blank", "duplicate")
        if must_go:
            tables.append(row_step(part["initial"][i], True, False, n))
            owner.append(i)
        else:
            tables.append(row_step(part["initial"][i], False, kind == "truncated"))
            owner.append(i)
            if n > 1:
                tables.append(row_step(part["initial"][i], True, False, n - 1))
                owner.append(i)
    return tables, owner


def _conversations(table: pa.Table) -> tuple[dict[str, list], list[range]]:
    """The rows of a range in order, and those of each conversation."""
    part = {c: table[c].to_pylist() for c in table.column_names}
    key = lambda i: ((part["conv_id"][i] is not None, part["conv_id"][i] or 0), (part["turn"][i] is not None, part["turn"][i] or 0), part["role"][i].encode(), part["prefix"][i].encode(), part["digest"][i])
    order = sorted(range(table.num_rows), key=key)
    part = {c: [v[i] for i in order] for c, v in part.items()}
    ids = part["conv_id"]
    cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
    return part, [range(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


_PIECES = "conv_id long, part int, costs array<long>, ranks array<int>"
_STATES = "conv_id long, part int, start int, end int, is_last boolean"
_SOLVED = "conv_id long, part int, audit string, cost long, illegal long, first int, last int, sha256 string, chunks array<string>"


def _outer_pieces(table: pa.Table) -> pa.Table:
    """Tables of the first and last conversation of a range: only those can go on elsewhere."""
    part, runs = _conversations(table)
    rows = []
    for run in {runs[0], runs[-1]}:
        cells = [way for row in piece_table(_steps(part, run)[0]) for way in row]
        rows.append((part["conv_id"][run[0]], part["part"][run[0]], [FAR if w is None else w[0] for w in cells], [0 if w is None else w[1] for w in cells]))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())))], names=["conv_id", "part", "costs", "ranks"])


def _between(pieces: pa.Table) -> pa.Table:
    """States at both ends of the pieces of one conversation: one row a range."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["part"])
    tables = [tuple(tuple(None if r["costs"][4 * s + e] >= FAR else (r["costs"][4 * s + e], r["ranks"][4 * s + e]) for e in range(4)) for s in range(4)) for r in rows]
    ends = crossings(tables, NOTHING, None)
    found = [(r["conv_id"], r["part"], a, b, r is rows[-1]) for r, a, b in zip(rows, [NOTHING, *ends], ends)]
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["conv_id", "part", "start", "end", "is_last"])


#: Characters of repaired rows in one chunk of a piece.
CHUNK = 1 << 12


def _solve(part: dict[str, list], run: range, start: int, end: int | None, is_last: bool) -> tuple[str, int, list[str]]:
    """Audit, cost and repaired rows of a conversation's rows between two states."""
    steps, owner = _steps(part, run)
    states = crossings(steps, start, end)
    letters, out, cost, state = [], [], 0, start

    for table, i, after in zip(steps, owner, states):
        c, edits = table[state][after]
        cost += c
        for edit in edits:
            if edit == "D":
                continue
            if edit == "K":
                out.append(f"{part['role'][i]}:{part['text'][i]}")
                state = FOLLOWS[state, INITIALS[part["initial"][i]]]
                continue
            state = ASSISTANT if state == USER else USER
            out.append(WRITTEN[state] + (part["text"][i] if edit == "R" else ""))
        letters.append(edits)
    if is_last:
        cost += TAIL[state][0]
        for edit in TAIL[state][1]:
            state = ASSISTANT if state == USER else USER
            out.append(WRITTEN[state])
            letters.append(edit)
    return "".join(letters), cost, out


def _chunks(lines: list[str]) -> list[str]:
    found, own, size = [], [], 0
    for line in lines:
        own.append(line)
        size += len(line)
        if size >= CHUNK:
            found.append("\n".join(own))
            own, size = [], 0
    return [*found, "\n".join(own)] if own else found


def _solve_range(table: pa.Table, states: pa.Table) -> pa.Table:
    """Every conversation of a range, or its piece if it goes on elsewhere."""
    given = {r["conv_id"]: r for r in states.to_pylist()}
    part, runs = _conversations(table) if table.num_rows else ({}, [])
    rows = []
    for run in runs:
        conv = part["conv_id"][run[0]]
        piece = given.get(conv)
        audit, cost, lines = _solve(part, run, *((piece["start"], piece["end"], piece["is_last"]) if piece else (NOTHING, None, True)))
        shown = [INITIALS[c] if c < 3 else "?" for c in (part["initial"][i] for i in run)]
        illegal = sum(a + b not in LEGAL for a, b in zip(shown, shown[1:])) + sum(part["n"][i] - 1 for i in run)
        digest = None if piece else hashlib.sha256("\n".join(lines).encode()).hexdigest()
        rows.append((conv, part["part"][run[0]], audit, cost, illegal, part["initial"][run[0]], part["initial"][run[-1]], digest, _chunks(lines) if piece else []))
    types = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()))
    names = ["conv_id", "part", "audit", "cost", "illegal", "first", "last", "sha256", "chunks"]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _streamed_hashes(solved: DataFrame) -> DataFrame:
    """(conv_id, sha256) of conversations in pieces: their chunks in order, one at a time."""
    chunks = solved.where("sha256 IS NULL").select("conv_id", "part", F.posexplode_outer("chunks").alias("k", "chunk"))
    chunks = chunks.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, conv, written_any, open_ = None, None, False, False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])

        for batch in batches:
            for i in range(batch.num_rows):
                own, chunk = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if not open_ or own != conv:
                    if open_:
                        yield row()
                    digest, conv, written_any, open_ = hashlib.sha256(), own, False, True
                if chunk is not None:
                    digest.update((b"\n" if written_any else b"") + chunk.encode())
                    written_any = True
        if open_:
            yield row()

    return chunks.select("conv_id", "chunk").mapInArrow(run, "conv_id long, sha256 string")


def _illegal_between(pieces: Column) -> Column:
    """Pairs of neighbours that lie on two pieces (sorted structs) and may not follow one another."""
    legal = [INITIALS.index(p[0]) * 10 + INITIALS.index(p[1]) for p in LEGAL]
    pair = lambda i: F.element_at(pieces, i)["last"] * 10 + F.element_at(pieces, i + 1)["first"]
    at = F.when(F.size(pieces) > 1, F.sequence(F.lit(1), F.size(pieces) - 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(at, lambda i: ~pair(i).isin(*legal)))


def repaired(conversations: DataFrame) -> DataFrame:
    """One row a conversation: faults found, least cost, audit and hash of the repaired rows."""
    rows = written(judged(damaged(conversations.select("conv_id", "turn", "role", "text"))))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("role") + 64), F.lit(0))).first()[0]
    order = ["conv_id", "turn", "role", "prefix", "digest"]
    parts = ranged(rows, order, max(1, -(-size // RANGE_BYTES)))
    narrow = parts.drop("text", "rest")
    pieces = written(narrow.groupBy("part").applyInArrow(_outer_pieces, _PIECES))
    # Conversations that lie on several ranges: at most two pieces of each range.
    split = pieces.groupBy("conv_id").agg(F.count("*").alias("pieces")).where("pieces > 1")
    split = pieces.join(split.withColumnRenamed("conv_id", "split_id"), F.col("conv_id").eqNullSafe(F.col("split_id")))
    states = written(split.select(*pieces.columns).groupBy("conv_id").applyInArrow(_between, _STATES))
    own = states.withColumnRenamed("part", "of_part")
    solved = written(parts.drop("rest").groupBy("part").cogroup(own.groupBy("of_part")).applyInArrow(_solve_range, _SOLVED))
    hashes = _streamed_hashes(solved)
    piece = F.struct("part", "audit", "first", "last")
    done = solved.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.max("sha256").alias("sha256"))
    done = done.select("conv_id", "cost", (F.col("illegal") + _illegal_between(F.col("p"))).alias("illegal"), F.array_join("p.audit", "").alias("audit"), "sha256")
    done = done.unionByName(hashes.select("conv_id", "sha256"), allowMissingColumns=True)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.when(F.lit(kind) == "truncated", 1).otherwise(F.col("n"))).otherwise(0) + F.when((F.col("kind").isNull() | (F.col("kind") == "truncated")) & (F.col("rest") == kind), F.col("n") - 1).otherwise(0))
    turns = rows.groupBy("conv_id", "turn").agg(*[of(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    faults = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    everyone = conversations.select("conv_id").distinct()
    all_ = everyone.unionByName(faults, allowMissingColumns=True).unionByName(done, allowMissingColumns=True)
    number = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    return all_.groupBy("conv_id").agg(
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
