"""Repair of conversations' structure: the cheapest edits that make the roles read ``(s?(ua)+)?``.

Rows are put in order and numbered without a one-task window (``number_rows``), faults are found by aggregates and a join
on the row number.  The search works on segments of at most ``SEGMENT`` rows, so a conversation of any length spreads
over tasks.  Between segments only role states matter (start, after a system, a user, an assistant row): a first pass
gives each segment's least cost from state to state, which put together backwards bound what follows any row; then
every segment is searched from each state it can begin in, and a forward pass picks the search that applies.  These two
passes hold one short row for each segment, a 4096th of the data.

The search is depth-first branch and bound on an explicit stack.  A node is (row, state) with a cost and the audit that
led there; a branch deletes, keeps or reroles the row, after at most one inserted one (a second gives back the state
before it).  Suffix bounds relax the audit away; the first dive follows them to an incumbent; then branches are taken in
ASCII order, and a node is left when its cost and bound cannot beat the incumbent, or when its table shows a prefix that
is no dearer (an earlier one has the smaller audit).  An empty stack proves the incumbent.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.kit import arrow_map, stored
from finlens.operators.positions import number_rows

SEGMENT = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # fixed values: costs of the edits
END = ((0, "", START), (2 * INSERT, "II", ASSISTANT), (INSERT, "I", ASSISTANT), (0, "", ASSISTANT))  # by state
NEVER = 1 << 60
_AFTER = {"u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "s": {START: SYSTEM}}
LEGAL = ("su", "ua", "au")


def _moves(code: str) -> list[list[tuple[str, int, int]]]:
    """By state: (audit, cost, next state) of a row's edits in ASCII order.  A code is the role's initial, lower case, or
    upper case where the row is truncated; ``o`` another role; ``x`` must go."""
    out = []
    for state in range(4):
        moves = [("D", DELETE, state)]
        for lead, at in (("", state), *(("I", there[state]) for r in "ua" if (there := _AFTER[r]).get(state) is not None)):
            fee = INSERT * len(lead) + TRUNCATED * code.isupper()
            if code != "x":
                if _AFTER.get(code.lower(), {}).get(at) is not None:
                    moves.append((lead + "K", fee + KEEP, _AFTER[code.lower()][at]))
                moves += [(lead + "R", fee + REROLE, _AFTER[r][at]) for r in "ua" if at in _AFTER[r]]
        out.append(sorted(moves))
    return out


MOVES = {c: _moves(c) for c in "suaoSUAOx"}


def suffix_bounds(codes: str, after: list[int]) -> list[list[int]]:
    """Least cost from each state before each row to the end; ``after``: costs from each state behind the last row."""
    out = [list(after)]
    for c in reversed(codes):
        nxt = out[-1]
        out.append([min(cost + nxt[t] for _, cost, t in moves) for moves in MOVES[c]])
    return out[::-1]


def through(codes: str) -> list[int]:
    """Least cost from state to state over all rows, 16 numbers."""
    by_end = [suffix_bounds(codes, [0 if t == e else NEVER for t in range(4)])[0] for e in range(4)]
    return [by_end[e][s] for s in range(4) for e in range(4)]


def search(codes: str, state: int, after: list[int], bounds: list[list[int]] | None = None) -> tuple[int, str, int]:
    """Least cost with what follows, the ASCII-least audit of that cost over these rows, and the state behind them."""
    bound = bounds or suffix_bounds(codes, after)
    n = len(codes)
    # incumbent: the dive along the least bounds, its audit not yet the least
    cost, s, audit = 0, state, []
    for i, c in enumerate(codes):
        piece, fee, s = min(MOVES[c][s], key=lambda m: (m[1] + bound[i + 1][m[2]], m[0]))  # noqa: B023
        cost += fee
        audit.append(piece)
    best = (cost + after[s], "".join(audit), s)
    reached: dict[int, int] = {}                # (row, state): least cost of a prefix, the first of its cost has the least audit
    stack, path = [(0, state, 0, "")], []       # path: the pieces that lead to the node in hand
    while stack:
        i, s, cost, piece = stack.pop()
        del path[max(i - 1, 0):]
        if i:
            path.append(piece)
        if cost + bound[i][s] > best[0] or reached.get(4 * i + s, NEVER) <= cost:
            continue
        reached[4 * i + s] = cost
        if i == n:
            total = cost + after[s]
            found = "".join(path)
            if (total, found) < best[:2]:
                best = (total, found, s)
            # of equal cost, whatever is still on the stack has a greater audit
            stack = [x for x in stack if x[2] + bound[x[0]][x[1]] < best[0]]
            continue
        for piece, fee, t in reversed(MOVES[codes[i]][s]):
            if cost + fee + bound[i + 1][t] <= best[0]:
                stack.append((i + 1, t, cost + fee, piece))
    return best


def _plain(turns: DataFrame) -> DataFrame:
    """Turns with what orders them: null roles and texts as one space, 16 bytes of the text's sha256 as ``key``."""
    return (turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
            .withColumn("key", F.unhex(F.substring(F.sha2("text", 256), 1, 32))))


def judged(turns: DataFrame) -> DataFrame:
    """(conv_id, conv, row, rows, turn, role, fault) of every row of turns (conv_id, turn, role, text): the numbers of the conversation and
    of the row in it, from 0, the conversation's rows, and blank, duplicate, truncated or null.  Texts stay behind."""
    text = F.col("text")
    fault = F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    t = _plain(turns).select("conv_id", "turn", "role", "key", fault.alias("_fault"))
    t = stored(number_rows(t, ["turn", "role", "key"], by=["conv_id"], name="row", count="rows", ordinal="conv"), "turns")
    # the first row of each role and text; the join is on the row number, so no text is a hot key
    first = t.groupBy("conv", "role", "key").agg(F.min("row").alias("_row")).select(F.col("conv").alias("_conv"), "_row")
    t = t.join(first, (F.col("conv") == F.col("_conv")) & (F.col("row") == F.col("_row")), "left")
    fault = F.when((F.coalesce("_fault", F.lit("")) != "blank") & F.col("_row").isNull(), "duplicate").otherwise(F.col("_fault"))
    return t.select("conv_id", "conv", "row", "rows", "turn", "role", fault.alias("fault"))


def _segments(rows: DataFrame, size: int) -> DataFrame:
    """(conv, conv_id, seg, last, codes, initials): rows of judged() as one sign a row."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    s = (rows.groupBy("conv", "conv_id", "rows", F.floor(F.col("row") / size).alias("seg"))
         .agg(F.sort_array(F.collect_list(F.struct("row", code.alias("code"), initial.alias("initial")))).alias("p")))
    joined = lambda name: F.array_join(F.transform("p", lambda x: x[name]), "").alias(f"{name}s")
    return s.select("conv", "conv_id", "seg", (F.ceil(F.col("rows") / size) - 1).alias("last"), joined("code"), joined("initial"))


def _matrices(batches):
    for b in batches:
        m = [through(c) for c in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(m, pa.list_(pa.int64()))], names=["conv", "seg", "m"])


def _backwards(batches):
    """Least costs behind each segment, from its conversation's later ones, which come first."""
    finish = [e[0] for e in END]
    now, after = None, finish
    for b in batches:
        out = []
        for conv, m in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if conv != now:
                now, after = conv, finish
            out.append(after)
            after = [min(m[4 * x + y] + after[y] for y in range(4)) for x in range(4)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))], names=["_conv", "_seg", "after"])


_SEARCHES = pa.schema([("conv", pa.int64()), ("seg", pa.int64()), ("audits", pa.list_(pa.string())), ("costs", pa.list_(pa.int64())),
                       ("ends", pa.list_(pa.int32())), ("bad", pa.int64()), ("first", pa.string()), ("final", pa.string())])
_CHAIN = pa.schema([("_conv", pa.int64()), ("_seg", pa.int64()), ("state", pa.int32()), ("illegal", pa.int64())])


def _searches(batches):
    """Every segment searched from each state it can begin in."""
    for b in batches:
        rows = []
        for conv, seg, last, codes, initials, after in zip(*(c.to_pylist() for c in b.columns), strict=True):
            after = after or [e[0] for e in END]
            bounds = suffix_bounds(codes, after)
            found = []
            for state in range(4 if seg else 1):
                cost, audit, end = search(codes, state, after, bounds)
                found.append((audit + END[end][1], cost, end) if seg == last else (audit, cost - after[end], end))
            rows.append((conv, seg, *map(list, zip(*found, strict=True)), sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1)), initials[0], initials[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_SEARCHES), _SEARCHES, strict=True)], schema=_SEARCHES)


def _forwards(batches):
    """The state that each segment begins in, and its pairs of roles that may not stand together, the first with the row before."""
    now, state, before = None, START, ""
    for b in batches:
        out = []
        for conv, seg, ends, bad, first, final in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if conv != now:
                now, state, before = conv, START, ""
            out.append((conv, seg, state, bad + (before != "" and before + first not in LEGAL)))
            state, before = ends[state], final
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(_CHAIN), _CHAIN, strict=True)], schema=_CHAIN)


def audits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, conv_id, seg, audit, cost, illegal) of every segment of judged()'s rows: its edits, those behind the conversation's
    last row included, their cost, and how many of its rows may not stand behind the row before."""
    s = stored(_segments(rows, segment), "turn-segments")
    same = (F.col("conv") == F.col("_conv")) & (F.col("seg") == F.col("_seg"))
    # conversations of one segment need no bounds from elsewhere
    several = arrow_map(s.where("last > 0").select("conv", "seg", "codes"), _matrices, "conv long, seg long, m array<long>")
    after = arrow_map(several.repartition("conv").sortWithinPartitions("conv", F.desc("seg")), _backwards, "_conv long, _seg long, after array<long>")
    found = s.join(after, same, "left").select("conv", "seg", "last", "codes", "initials", "after")
    found = stored(arrow_map(found, _searches, "conv long, seg long, audits array<string>, costs array<long>, ends array<int>, bad long, first string, final string"), "turn-searches")
    chain = arrow_map(found.select("conv", "seg", "ends", "bad", "first", "final").repartition("conv").sortWithinPartitions("conv", "seg"), _forwards,
                      "_conv long, _seg long, state int, illegal long")
    return (found.join(chain, same).join(s.select(F.col("conv").alias("_c"), F.col("seg").alias("_s"), "conv_id"), (F.col("conv") == F.col("_c")) & (F.col("seg") == F.col("_s")))
            .select("conv", "conv_id", "seg", F.get("audits", F.col("state")).alias("audit"), F.get("costs", F.col("state")).alias("cost"), "illegal"))


def _replay(batches):
    """Rows as their conversation's audit, which comes first, leaves them."""
    now, todo, parts = object(), "", []
    at = left = place = 0
    state = START
    for b in batches:
        kind, out = b.schema.field(0).type, []

        def put(conv_id, role, text, edit):
            nonlocal place, state
            state = _AFTER[role[:1]][state]
            out.append((conv_id, place, role, text, edit))  # noqa: B023
            place += 1

        def insert(conv_id):
            nonlocal at
            while at < len(todo) and todo[at] == "I":
                at += 1
                put(conv_id, "assistant" if state == USER else "user", "", "I")  # noqa: B023
        for conv_id, is_row, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if conv_id != now:
                now, parts, todo, at, place, state = conv_id, [], None, 0, 0, START
            if not is_row:
                parts.append(text)
                continue
            if todo is None:
                todo, parts = "".join(parts), []
                left = len(todo) - todo.count("I")
            insert(conv_id)
            edit, at, left = todo[at], at + 1, left - 1
            if edit == "K":
                put(conv_id, role, text, edit)
            elif edit == "R":
                put(conv_id, "assistant" if state == USER else "user", text, edit)
            if not left:
                insert(conv_id)  # behind the last row
        cols = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (kind, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                                         names=["conv_id", "place", "role", "text", "edit"])


def _digests(batches):
    now, held, kind = None, None, None
    for b in batches:
        kind, out = b.schema.field(0).type, []
        for conv_id, place, role, text, _ in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if not place:
                if held is not None:
                    out.append((now, held.hexdigest()))
                now, held = conv_id, hashlib.sha256()
            held.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield _pairs(out, kind)
    if held is not None:
        yield _pairs([(now, held.hexdigest())], kind)


def _pairs(rows, kind):
    ids, digests = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], names=["conv_id", "digest"])


def repair(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Two tables from turns (conv_id, turn, role, text), the second a row for each conversation: the repaired rows (conv_id, place, role,
    text, edit), place from 0, edit K, R or I, in order within a partition, and (conv_id, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256: of ``role:text`` of the rows left, joined by newlines).

    Rows go by turn (null first), role and sha256 of the text; null roles and texts count as one space; a null conv_id is a
    conversation of its own; other columns are not read.  No turns give no rows.  One task folds a conversation's
    digest, since a sha256 is sequential; it streams, and holds no more than the audit, which is part of the result."""
    rows = stored(judged(turns), "turn-faults")
    plan = stored(audits(rows, segment), "turn-audits")
    kind = dict(turns.dtypes)["conv_id"]
    texts = _plain(turns).select("conv_id", F.lit(True).alias("is_row"), F.lit(0).cast("long").alias("seg"), "turn", "role", "key", "text")
    marks = plan.select("conv_id", F.lit(False).alias("is_row"), "seg", F.lit(None).cast(dict(turns.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"),
                        F.lit(None).cast("binary").alias("key"), F.col("audit").alias("text"))
    both = texts.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "seg", "turn", "role", "key")
    fixed = arrow_map(both.select("conv_id", "is_row", "role", "text"), _replay, f"conv_id {kind}, place long, role string, text string, edit string")
    folded = arrow_map(fixed, _digests, f"conv_id {kind}, digest string")
    count = lambda f: F.sum((F.coalesce("fault", F.lit("")) == f).cast("long")).alias(f)
    counts = rows.groupBy("conv_id").agg(count("blank"), count("duplicate"), count("truncated"))
    whole = plan.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = join_on_id(join_on_id(counts, whole), folded).withColumn("repaired_sha256", F.coalesce("digest", F.sha2(F.lit(""), 256))).drop("digest")
    return fixed, out


def join_on_id(left: DataFrame, right: DataFrame) -> DataFrame:
    """A row of right added to each of left by conv_id, null a value like others."""
    right = right.withColumnRenamed("conv_id", "_id")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
