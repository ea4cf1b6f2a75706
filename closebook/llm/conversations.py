"""Operator 12: conversation repair by Knuth's lightest-derivation agenda.

A conversation of system, user and assistant turns is well formed when its role
initials read ``(s?(ua)+)?``. Repairs are derivations of a weighted hypergraph:
an item (rows read, state of that grammar) follows from an earlier one by an
edit of the next row (keep, rerole, delete) or by an inserted turn. Weights are
pairs (cost, audit), audit being the edits' initials; every deduction is a
superior function of them (no result is below its antecedents and better
antecedents give better results), so items popped in the order of their weights
are final, and the first goal item popped is the lightest repair.

Rows are dealt by range in the order of conversations and turns and stream
through the tasks, at most ``CHUNK`` rows of a conversation in memory. A
conversation that one task sees whole in one chunk is solved there. Of others,
each chunk gives its lightest pieces from every state to every state, and a
second agenda joins pieces to prefixes (deductions with two antecedents), with
few numbers a chunk; texts are read again only to write the repaired turns.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

CHUNK = 256
SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
STATES = 4  # 0 nothing yet, 1 after s, 2 after u, 3 after a
WANTED = "uuau"  # the initial that a rerole or an insert gives in each state
AFTER = (2, 2, 3, 2)  # and the state that follows
ACCEPT = (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs

BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = 1, 2, 3  # first faults; 0: none


def lightest_derivations(axioms: Iterable[tuple[Hashable, object]],
                         deduce: Callable[[Hashable, object], Iterable[tuple[Hashable, object]]],
                         goal: Callable[[Hashable], bool]) -> dict:
    """Weights of all items up to the first goal, by Knuth's generalisation of Dijkstra's method.

    ``deduce`` yields (item, weight) of all conclusions in which a popped item
    is the last antecedent to be final; weights must be comparable with ``<``
    and no conclusion may weigh less than an antecedent. The last item of the
    returned dictionary is the goal, if one was reached.
    """
    agenda, final, order = [], {}, 0
    for item, weight in axioms:
        heapq.heappush(agenda, (weight, order, item))
        order += 1
    while agenda:
        weight, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if goal(item):
            break
        for found, more in deduce(item, weight):
            if found not in final:
                heapq.heappush(agenda, (more, order, found))
                order += 1
    return final


def step(state: int, initial: str) -> int | None:
    """The state after a kept row with this initial."""
    if initial == "s":
        return 1 if state == 0 else None
    return AFTER[state] if initial == WANTED[state] else None


def _deduce(rows: list[tuple[str, int]], last: bool):
    """Deductions from items (rows read, state) of ``rows`` (role initial, fault); inserts at the end only if ``last``."""
    n = len(rows)

    def deduce(item, weight):
        (i, state), (cost, audit) = item, weight
        if i < n or last:
            yield (i, AFTER[state]), (cost + INSERT, audit + "I")
        if i < n:
            initial, fault = rows[i]
            yield (i + 1, state), (cost + DELETE, audit + "D")
            if fault not in (BLANK_ROW, DUPLICATE_ROW):
                extra = TRUNCATED if fault == TRUNCATED_ROW else 0
                kept = step(state, initial)
                if kept is not None:
                    yield (i + 1, kept), (cost + KEEP + extra, audit + "K")
                yield (i + 1, AFTER[state]), (cost + REROLE + extra, audit + "R")

    return deduce


def lightest_repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the lightest repair of a whole conversation."""
    n = len(rows)
    final = lightest_derivations([((0, 0), (0, ""))], _deduce(rows, True), lambda x: x[0] == n and x[1] in ACCEPT)
    return final[next(reversed(final))]


def lightest_pieces(rows: list[tuple[str, int]]) -> list[tuple[int, str] | None]:
    """(cost, audit) of the lightest piece from each state to each state (16, state by state; None: impossible).

    Inserts stand before rows only, so all pieces end with an edit of the last
    row and none is the beginning of another.
    """
    n, out = len(rows), []
    for start in range(STATES):
        final = lightest_derivations([((0, start), (0, ""))], _deduce(rows, False), lambda x: False)
        out += [final.get((n, end)) for end in range(STATES)]
    return out


def apply_edits(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns of ``rows`` (role, text), read from ``state``."""
    roles, texts, i = [], [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        role, text = (NAMES[WANTED[state]], "") if edit == "I" else rows[i]
        i += edit != "I"
        if edit == "R":
            role = NAMES[WANTED[state]]
        roles.append(role)
        texts.append(text)
        state = step(state, role[:1])
    return roles, texts


class _Trail:
    """Weight of a prefix of chunks: cost, then the sequence of pieces' audits, kept as links back."""

    __slots__ = ("cost", "length", "rank", "state", "before")

    def __init__(self, cost, length, rank, state, before):
        self.cost, self.length, self.rank, self.state, self.before = cost, length, rank, state, before

    def __lt__(self, other):
        if (self.cost, self.length) != (other.cost, other.length):
            return (self.cost, self.length) < (other.cost, other.length)
        a, b = self.chunks()[0], other.chunks()[0]
        while a is not b:  # back to the first chunk in which they differ
            if a.before is b.before:
                return a.rank < b.rank
            a, b = a.before, b.before
        return False

    def chunks(self) -> tuple["_Trail", str]:
        """The trail without the inserts at its end, and these."""
        trail, tail = self, ""
        while trail.before is not None and trail.before.length == trail.length:
            trail, tail = trail.before, tail + "I"
        return trail, tail


def join_pieces(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[int], str]:
    """Cost, states before each chunk and after the last, and the inserts at the end, of the lightest repair.

    Prefix(j + 1, q) follows from Prefix(j, p) and Piece(j, p, q). ``costs`` and
    ``ranks`` (order of the audits) have 16 entries a chunk, -1: no such piece.
    """
    n = len(costs)

    def deduce(item, weight):
        j, state = item
        if j < n:
            for q in range(STATES):
                cost = costs[j][STATES * state + q]
                if cost >= 0:
                    yield (j + 1, q), _Trail(weight.cost + cost, j + 1, ranks[j][STATES * state + q], q, weight)
        elif state not in ACCEPT:
            yield (j, AFTER[state]), _Trail(weight.cost + INSERT, j, 0, AFTER[state], weight)

    final = lightest_derivations([((0, 0), _Trail(0, 0, 0, 0, None))], deduce, lambda x: x[0] == n and x[1] in ACCEPT)
    last = final[next(reversed(final))]
    trail, tail = last.chunks()
    states = [trail.state]
    while trail.before is not None:
        trail = trail.before
        states.append(trail.state)
    return last.cost, states[::-1], tail


_CHUNKS = ("whole boolean, hole boolean, conv long, at long, n long, low long, high long, first_turn long, last_turn long, "
           "turns long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
           "cost long, audit string, repaired_sha256 string, roles array<string>, texts array<string>, "
           "costs array<long>, ranks array<int>, audits array<string>")
_NAMES = [c.split()[0] for c in _CHUNKS.split(", ")]


def first_fault(text: str, repeated: bool) -> int:
    bare = text.strip(SPACE)
    if not bare:
        return BLANK_ROW
    if repeated:
        return DUPLICATE_ROW
    return 0 if bare[-1] in ".!?" else TRUNCATED_ROW


def _digest(roles: list[str], texts: list[str]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(roles, texts)).encode()).hexdigest()


def _chunk(key: tuple, rows: list[tuple], whole: bool, at: int) -> dict:
    """One output row for ``rows`` (turn, role, text, repeated) of a conversation; solved if ``whole``."""
    faults = [(role[:1], first_fault(text, repeated)) for _, role, text, repeated in rows]
    turns = [t for t, *_ in rows if t is not None]
    initials = [r for r, _ in faults]
    out = dict.fromkeys(_NAMES)
    out.update(whole=whole, hole=key[0], conv=key[1], at=at, n=len(rows), low=min(turns, default=None), high=max(turns, default=None),
               first_turn=turns[0] if turns else None, last_turn=turns[-1] if turns else None, turns=len(set(turns)),
               first_role=initials[0], last_role=initials[-1],
               illegal=sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
               **{name: sum(f == kind for _, f in faults)
                  for name, kind in (("blank", BLANK_ROW), ("duplicate", DUPLICATE_ROW), ("truncated", TRUNCATED_ROW))})
    plain = [(role, text) for _, role, text, _ in rows]
    if whole:
        cost, audit = lightest_repair(faults)
        roles, texts = apply_edits(plain, audit, 0)
        out.update(cost=cost, audit=audit, repaired_sha256=_digest(roles, texts), roles=roles, texts=texts)
    else:
        pieces = lightest_pieces(faults)
        order = {a: i for i, a in enumerate(sorted({p[1] for p in pieces if p}))}
        out.update(roles=[r for r, _ in plain], texts=[t for _, t in plain], costs=[p[0] if p else -1 for p in pieces],
                   ranks=[order[p[1]] if p else -1 for p in pieces], audits=[p[1] if p else "" for p in pieces])
    return out


def _chunked(rows: DataFrame) -> DataFrame:
    """Rows sorted inside ordered partitions -> chunks; a partition's first and last conversations may go on elsewhere."""
    schema = rows.sparkSession.createDataFrame([], _CHUNKS).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        at, done = TaskContext.get().partitionId() << 33, []
        key, held, inside = None, [], False  # inside: this partition saw where the conversation begins

        def take(whole):
            nonlocal at, held
            done.append(_chunk(key, held, whole, at))
            at, held = at + 1, []

        for batch in batches:
            for hole, conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (hole, conv) != key:
                    if key is not None:
                        take(inside)
                    inside, key = key is not None, (hole, conv)
                elif len(held) == CHUNK:
                    take(False)
                    inside = False
                held.append(row)
                if len(done) >= 512:
                    yield pa.RecordBatch.from_pylist(done, schema=arrow)
                    done.clear()
        if held:
            take(False)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return rows.mapInArrow(run, schema)


_JOINED = ("hole boolean, conv long, at long, entry int, leave int, tail string, cost long, gaps long, blank long, duplicate long, "
           "truncated long, illegal long")


def _joined(pieces: DataFrame) -> DataFrame:
    """For each chunk of a conversation the state before it; the conversation's totals stand with its last chunk."""
    def run(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        cost, states, tail = join_pieces([r["costs"] for r in rows], [r["ranks"] for r in rows])
        turns = [r for r in rows if r["low"] is not None]
        again = sum(x["last_turn"] == y["first_turn"] for x, y in zip(turns, turns[1:]))
        gaps = turns[-1]["high"] - turns[0]["low"] + 1 - sum(r["turns"] for r in turns) + again if turns else 0
        illegal = sum(x["last_role"] + y["first_role"] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
        none, last = [None] * (len(rows) - 1), len(rows) - 1
        total = lambda name: sum(r[name] for r in rows)
        return pa.table({
            "hole": pa.array([r["hole"] for r in rows], pa.bool_()), "conv": pa.array([r["conv"] for r in rows], pa.int64()),
            "at": pa.array([r["at"] for r in rows], pa.int64()),
            "entry": pa.array(states[:-1], pa.int32()),
            "leave": pa.array(states[1:], pa.int32()),
            "tail": pa.array([""] * last + [tail], pa.string()), "cost": pa.array(none + [cost], pa.int64()),
            "gaps": pa.array(none + [gaps], pa.int64()), "blank": pa.array(none + [total("blank")], pa.int64()),
            "duplicate": pa.array(none + [total("duplicate")], pa.int64()),
            "truncated": pa.array(none + [total("truncated")], pa.int64()),
            "illegal": pa.array(none + [total("illegal") + illegal], pa.int64())})

    slim = pieces.select("hole", "conv", "at", "low", "high", "first_turn", "last_turn", "turns", "blank", "duplicate",
                         "truncated", "illegal", "first_role", "last_role", "costs", "ranks")
    return slim.groupBy("hole", "conv").applyInArrow(run, _JOINED)


_WRITTEN = "hole boolean, conv long, at long, audit string, roles array<string>, texts array<string>"


def _written(pieces: DataFrame, joined: DataFrame) -> DataFrame:
    """Each chunk's part of the audit and its repaired turns."""
    rows = pieces.select("hole", "conv", "at", "roles", "texts", "audits")
    places = joined.select("hole", "conv", "at", "entry", "leave", "tail")
    both = rows.join(places, ["hole", "conv", "at"])

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = r["audits"][STATES * r["entry"] + r["leave"]] + r["tail"]
                roles, texts = apply_edits(list(zip(r["roles"], r["texts"])), audit, r["entry"])
                out.append((r["hole"], r["conv"], r["at"], audit, roles, texts))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["hole", "conv", "at", "audit", "roles", "texts"])

    return both.mapInArrow(run, _WRITTEN)


def _read_through(written: DataFrame) -> DataFrame:
    """hole, conv, audit and repaired_sha256 of conversations from their chunks in order, one chunk in memory at a time."""
    def run(batches):
        key, audit, sha, begun, done = None, [], None, False, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["hole"], r["conv"]) != key:
                    if key is not None:
                        done.append((*key, "".join(audit), sha.hexdigest()))
                    key, audit, sha, begun = (r["hole"], r["conv"]), [], hashlib.sha256(), False
                audit.append(r["audit"])
                for role, text in zip(r["roles"], r["texts"]):
                    sha.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
                    begun = True
        if key is not None:
            done.append((*key, "".join(audit), sha.hexdigest()))
        cols = list(zip(*done)) if done else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.bool_(), pa.int64(), pa.string(), pa.string()))],
            names=["hole", "conv", "audit", "repaired_sha256"])

    dealt = written.repartition("hole", "conv").sortWithinPartitions("hole", "conv", "at")
    return dealt.mapInArrow(run, "hole boolean, conv long, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``rows`` with faults put in, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    row, 4 makes its role user; the others stay. Null roles and texts, and null
    ids and turns in the key, count as one space; ids and turns stay null.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1))
    return marked.withColumn("text", text).withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).select(
        "conv_id", "turn", "role", "text", F.explode(times).alias("copy")).drop("copy")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, turns) of conversations ``rows`` (conv_id, turn, role, text).

    Summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Turns: conv_id, place (ascending inside a conversation),
    role, text of the repaired turns. Rows are read in the order of their turn
    (null first), then role, then text. A row's first fault counts: ``blank``
    (no character but white space), ``duplicate`` (role and text stand earlier
    in the conversation), ``truncated`` (last such character not ``.!?``). The
    edits K keep (0), R rerole to user or assistant (2), D delete (3; a must
    for blank and duplicate rows), I insert an empty user or assistant turn (2)
    and 1 for each truncated row that stays make the cost; ``audit`` lists the
    lightest repair's edits, the ASCII-least of equal cost. ``gaps``: turns
    missing between the first and the last; ``illegal``: neighbours whose role
    initials are not su, ua or au.

    Null roles and texts count as one space; null ids are one conversation, the
    first; null turns make no gap; equal rows are duplicates of the first.
    Empty texts are blank; texts of any length only pass through. An empty
    table gives no rows. Other columns are not read.

    A conversation of any length is cut into chunks; only its few numbers a
    chunk meet in one task. Its audit is one string and its hash one running
    SHA-256, so one task must read its repaired turns through, one chunk at a
    time.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    keyed = rows.select(F.col("conv_id").isNotNull().alias("hole"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
                        F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    keyed = materialize(keyed.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.hash("text", F.lit(12)))
                        .withColumn("mono", F.monotonically_increasing_id()), "turns")
    same = ["hole", "conv", "role", "h1", "h2"]
    firsts = keyed.groupBy(*same).agg(F.min(F.struct("turn", "mono")).alias("first"), F.count("*").alias("rows")).filter(
        "rows > 1").select(*same, F.col("first.mono").alias("first"))
    flagged = keyed.join(firsts, same, "left").withColumn("repeated", F.coalesce(F.col("mono") != F.col("first"), F.lit(False)))
    order = [F.col("hole"), F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("mono")]
    ordered = flagged.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "hole", "conv", "turn", "role", "text", "repeated")
    chunks = materialize(_chunked(ordered), "chunks")

    pieces = chunks.filter("not whole")
    joined = materialize(_joined(pieces), "joined")
    written = materialize(_written(pieces, joined), "written")
    parts = joined.filter("cost IS NOT NULL").join(_read_through(written), ["hole", "conv"])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    columns = [*_COUNTS, "audit", "repaired_sha256"]
    whole = chunks.filter("whole").select("hole", "conv", gaps, *columns[1:])
    conv_id = F.when(F.col("hole"), F.col("conv")).alias("conv_id")
    summary = whole.unionByName(parts.select("hole", "conv", *columns)).select(conv_id, *columns)
    turns = chunks.filter("whole").select("hole", "conv", "at", "roles", "texts").unionByName(
        written.select("hole", "conv", "at", "roles", "texts"))
    turns = turns.select("hole", "conv", "at", F.posexplode(F.arrays_zip("roles", "texts")).alias("line", "t"))
    return summary, turns.select(conv_id, F.struct("at", "line").alias("place"), F.col("t.roles").alias("role"),
                                 F.col("t.texts").alias("text"))


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """``repair_conversations`` of ``damage(rows)``, with a row for every conv_id of ``rows``.

    A conversation without rows after the damage has zeros, an empty audit and
    the hash of the empty string.
    """
    summary, _ = repair_conversations(damage(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(summary, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
