"""Repair of conversation structure at the least cost, as two sorted streams with carried state.

A conversation's rows are ordered by turn (nulls first, then by content).  A row is *blank* without a character outside white
space, else a *duplicate* if its role and text came earlier, else *truncated* if its last such character is none of ``.!?``.
Edits turn the rows into ``system? (user assistant)+`` or nothing: Keep costs 0, Rerole to user or assistant 2, Delete 3
(forced for blank and duplicate rows), Insert an empty turn 2; a truncated row that stays adds 1.  Of the cheapest edits the
string of initials that sorts first is taken.

1. :func:`plan_edits`: rows without their texts are dealt by conversation and streamed from the last to the first.  The
   state carried across Arrow batches is the cost to finish from each of four places (start, after system, user,
   assistant).  A row adds one byte: the best next edit from each place, the least letter of those that reach the cost.  After
   ``CHUNK`` rows these bytes are spilled as an output row, so a giant conversation needs no more memory than a small one.
2. :func:`repair`: texts and spilled bytes are dealt by conversation and streamed from the first row on; bytes sort in front
   of the rows they are for.  Following them gives every edit in order, with the rows that stay, change or come new.

A transition depends on nine kinds of rows and on cost differences of few values, so each is worked out once and kept.

Defined results: nulls in role or text count as one space, so such a text is blank and such a role has to be changed; null
turns come first; a null conversation id names a conversation of its own.  Roles other than system, user and assistant are
told by their first letter.  Rows equal in turn, role and text follow each other, the later ones being duplicates; rows
that differ but share a turn are ordered by a hash of their content.  An empty table gives no edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.tables import pick, stored

#: Rows whose best edits make one spilled row; edits in a batch of output.
CHUNK, BATCH = 65_536, 8_192

WHITE = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
START, SYSTEM, USER, ASSISTANT = range(4)
EDITS = "DIKR"  # by code, in their order
DELETE, INSERT, KEEP, REROLE = range(4)
_COST = {DELETE: 3, INSERT: 2, REROLE: 2}
_DUE = (USER, USER, ASSISTANT, USER)  # the turn that an insertion or a new role gives in each place
_AT_END = (0, 4, 2, 0)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _kept(place: int, role: int) -> int | None:
    """The place after a row of that role is kept, if it may be."""
    return role if role == _DUE[place] or (role == SYSTEM and place == START) else None


class _Transitions(dict):
    """(role, must go, truncated, costs to finish after the row) -> (costs before it, less their least; that; best edits)."""

    def __missing__(self, key):
        role, gone, truncated, after = key

        def over(place: int) -> dict[int, int]:
            ways = {DELETE: 3 + after[place]}
            if not gone:
                ways[REROLE] = 2 + truncated + after[_DUE[place]]
                if (to := _kept(place, role)) is not None:
                    ways[KEEP] = truncated + after[to]
            return ways

        ways = [over(place) for place in range(4)]
        cost = [min(w.values()) for w in ways]
        for _ in range(3):  # insertions lead from place to place
            cost = [min(c, _COST[INSERT] + cost[_DUE[p]]) for p, c in enumerate(cost)]
        for p, w in enumerate(ways):
            w[INSERT] = _COST[INSERT] + cost[_DUE[p]]
        best = [min(e for e, c in w.items() if c == cost[p]) for p, w in enumerate(ways)]
        least = min(cost)
        got = self[key] = tuple(c - least for c in cost), least, sum(e << 2 * p for p, e in enumerate(best))
        return got


_steps = _Transitions()


def _role(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(0).cast("int")


def _rows(conversations: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, h) with nulls of role and text replaced; h orders rows of one turn."""
    rows = pick(conversations, conv=conversation, turn=turn, role=role, text=text)
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("conv", F.col("turn").cast("bigint"), *spoken).withColumn("h", F.unhex(F.md5(content)))


def _best_edits(chunk: int):
    """From rows in descending order: spilled edits (conv, turn, h, rest, edits) and, with a conversation's last, its facts."""
    facts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, edits, out = None, bytearray(), []
        after, cost, later, last_turn, top, turns = _AT_END, 0, None, None, None, 0
        blank = duplicate = truncated = illegal = 0
        place, rest = None, 0  # (conv, turn, h) of the row before, and the number of rows from it on

        def spill(done: bool) -> None:
            gaps = top - last_turn + 1 - turns if turns else 0
            out.append((*place, rest, bytes(reversed(edits)), *((gaps, blank, duplicate, truncated, illegal, cost + after[START]) if done else [None] * 6)))
            edits.clear()

        def made() -> pa.RecordBatch:
            names = ("conv", "turn", "h", "rest", "edits", *facts)
            kinds = (conv_kind, pa.int64(), pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 6)
            got = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=list(names))
            out.clear()
            return got

        for batch in batches:
            conv_kind = batch.schema.field("conv").type
            for conv, turn, h, role, fault in zip(*(batch[c].to_pylist() for c in ("conv", "turn", "h", "role", "fault"))):
                if place is None or conv != now:
                    if place is not None:
                        spill(True)
                    now, after, cost, later, last_turn, top, turns = conv, _AT_END, 0, None, None, None, 0
                    blank = duplicate = truncated = illegal = rest = 0
                elif len(edits) >= chunk:
                    spill(False)
                if len(out) >= BATCH or out and len(out) * chunk > 1 << 26:
                    yield made()
                blank, duplicate, truncated = blank + (fault == 1), duplicate + (fault == 2), truncated + (fault == 3)
                illegal += later is not None and (role, later) not in _LEGAL
                if turn is not None:
                    top = turn if top is None else top
                    turns += turn != last_turn
                    last_turn = turn
                after, least, best = _steps[role, fault in (1, 2), int(fault == 3), after]
                cost += least
                edits.append(best)
                later, place, rest = role, (conv, turn, h), rest + 1
        if place is not None:
            spill(True)
            yield made()

    return run


def plan_edits(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A stored table of best edits (conv, turn, h, rest, edits) in chunks; a conversation's first chunk holds its facts.

    Facts are gaps, blank, duplicate, truncated, illegal and cost; elsewhere they are null.
    """
    rows = _rows(conversations, conversation, turn, role, text)
    end = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    fault = F.when(end == "", 1).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    compact = rows.select("conv", "turn", "h", _role(F.col("role")).alias("role"), fault.alias("fault")).repartition("conv")
    # both sorts run inside the partitions by conversation
    nth = F.row_number().over(Window.partitionBy("conv", "h").orderBy(F.col("turn").asc_nulls_first()))
    marked = compact.withColumn("fault", F.when((F.col("fault") != 1) & (nth > 1), 2).otherwise(F.col("fault")))
    ordered = marked.sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), F.col("h").desc(), (F.col("fault") == 2).desc())
    kind = rows.schema["conv"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return stored(ordered.mapInArrow(_best_edits(chunk), f"conv {kind}, turn bigint, h binary, rest bigint, edits binary, {counts}"))


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits in order, from rows in ascending order that follow the best edits meant for them."""
    now, begun, place, nth = None, False, START, 0
    edits, at = bytearray(), 0
    out: list[tuple] = []
    kinds: dict[str, pa.DataType] = {}

    def emit(edit: int, turn, role, text) -> None:
        nonlocal nth
        out.append((now, nth, EDITS[edit], turn, role, text))
        nth += 1

    def insert() -> None:
        nonlocal place
        place = _DUE[place]
        emit(INSERT, None, _NAMES[place], "")

    def finish() -> None:
        while begun and place in (SYSTEM, USER):
            insert()

    def made() -> pa.RecordBatch:
        types = (kinds["conv"], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
        got = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), types)], names=["conv", "nth", "edit", "turn", "role", "text"])
        out.clear()
        return got

    for batch in batches:
        kinds["conv"] = batch.schema.field("conv").type
        for conv, turn, role, text, code, best in zip(*(batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "code", "edits"))):
            if not begun or conv != now:
                finish()
                now, begun, place, nth = conv, True, START, 0
                edits, at = bytearray(), 0
            if best is not None:
                edits = edits[at:] + best
                at = 0
                continue
            own, at = edits[at], at + 1
            while (edit := own >> 2 * place & 3) == INSERT:
                insert()
            if edit == KEEP:
                place = _kept(place, code)
            elif edit == REROLE:
                place = _DUE[place]
                role = _NAMES[place]
            emit(edit, turn, role, text)
            if len(out) >= BATCH:
                yield made()
    finish()
    if out:
        yield made()


def repair(conversations: DataFrame, plan: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, nth, edit, turn, role, text): every edit of every conversation, deleted rows included, in order.

    Rows of a conversation come one after the other, which :func:`digests` needs; ``nth`` numbers them otherwise.
    """
    rows = _rows(conversations, conversation, turn, role, text).withColumns({"code": _role(F.col("role")), "edits": F.lit(None).cast("binary"), "rest": F.lit(-1).cast("bigint")})
    chunks = plan.select("conv", "turn", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "h", F.lit(None).cast("int").alias("code"), "edits", "rest")
    ordered = rows.unionByName(chunks).repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "h", F.col("rest").desc())
    kind = rows.schema["conv"].dataType.simpleString()
    return ordered.select("conv", "turn", "role", "text", "code", "edits").mapInArrow(_followed, f"conv {kind}, nth bigint, edit string, turn bigint, role string, text string")


def digests(edits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256) of each conversation from edits in the order that :func:`repair` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nth, audit, sha, first = None, -1, bytearray(), hashlib.sha256(), True
        done: list[tuple] = []
        for batch in batches:
            for conv, i, edit, role, text in zip(*(batch[c].to_pylist() for c in ("conv", "nth", "edit", "role", "text"))):
                if i == 0:
                    if nth >= 0:
                        done.append((now, audit.decode(), sha.hexdigest()))
                    now, nth, audit, sha, first = conv, -1, bytearray(), hashlib.sha256(), True
                if i != nth + 1 or conv != now:
                    raise ValueError("edits are not in order")
                nth = i
                audit += edit.encode()
                if edit != "D":
                    sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            kind = batch.schema.field("conv").type
            if done:
                yield made(done, kind)
                done = []
        if nth >= 0:
            yield made([(now, audit.decode(), sha.hexdigest())], kind)

    def made(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), (kind, pa.string(), pa.string()))], names=["conv", "audit", "repaired_sha256"])

    kind = edits.schema["conv"].dataType.simpleString()
    return edits.mapInArrow(run, f"conv {kind}, audit string, repaired_sha256 string")


def damage(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults by a checksum of conversation and turn: one in twenty of each of five kinds.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user; nulls in role and text,
    and in what the checksum reads, count as one space.
    """
    rows = pick(conversations, conv_id=conversation, turn=turn, role=role, text=text)
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])) % 20
    rows = rows.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), times.alias("_")).drop("_")


def audited(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """Every conversation id of ``original`` with the facts, the edits and the digest of its repair of ``damaged``."""
    plan = plan_edits(damaged)
    facts = plan.where("cost IS NOT NULL").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = pick(original, conv_id="conv_id").distinct()
    done = digests(repair(damaged, plan))
    joined = ids.join(facts, F.col("conv_id").eqNullSafe(facts["conv"]), "left").drop("conv").join(done, F.col("conv_id").eqNullSafe(done["conv"]), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
