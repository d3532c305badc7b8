"""Conversation repair against a plain search over all edits, and its edge cases."""

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import pyarrow.parquet as pq

from blockloom.llm import conversations as C
from blockloom.llm import queries
from blockloom.session import cut_lineage

WORD, LAST = re.compile(r"[^\x20\x09-\x0D]"), re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
GRAMMAR = re.compile("(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kind = "blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "truncated" if LAST.search(text)[1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by recursion over what is left and the initials so far (as the state of the grammar)."""
    kinds = faults(rows)

    @cache
    def go(i, state):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]

        def add(cost, edit, to, said):
            rest = go(i + (edit != "I"), to)
            ways.append((cost + rest[0], edit + rest[1], said + rest[2]))

        if i < len(rows):
            _, role, text = rows[i]
            extra = kinds[i] == "truncated"
            add(3, "D", state, ())
            if kinds[i] not in ("blank", "duplicate"):
                if role[:1] and role[0] in after:
                    add(extra, "K", role[0], (f"{role}:{text}",))
                due = after[-1]
                add(2 + extra, "R", due, (f"{({'u': 'user', 'a': 'assistant'}[due])}:{text}",))
        inserted(i, state, after, ways)
        return min(ways)

    def inserted(i, state, after, ways, depth=3):
        # insertions in a row: every number that can pay off, each followed by something else
        due, said, cost, edits = after[-1], (), 0, ""
        for _ in range(depth):
            said += (({"u": "user:", "a": "assistant:"})[due],)
            cost, edits, state = cost + 2, edits + "I", due
            rest = step(i, state)
            if rest:
                ways.append((cost + rest[0], edits + rest[1], said + rest[2]))
            due = "a" if state == "u" else "u"

    @cache
    def step(i, state):
        """The cheapest way on that does not begin with an insertion."""
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if i < len(rows):
            _, role, text = rows[i]
            extra = kinds[i] == "truncated"
            options = [("D", 3, state, ())]
            if kinds[i] not in ("blank", "duplicate"):
                if role[:1] and role[0] in after:
                    options.append(("K", int(extra), role[0], (f"{role}:{text}",)))
                due = after[-1]
                options.append(("R", 2 + extra, due, (f"{({'u': 'user', 'a': 'assistant'}[due])}:{text}",)))
            for edit, cost, to, said in options:
                rest = go(i + 1, to)
                ways.append((cost + rest[0], edit + rest[1], said + rest[2]))
        return min(ways) if ways else None

    return go(0, "")


def expected(rows):
    """The result for rows in order, (turn, role, text) without nulls in role and text."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", EMPTY)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds = faults(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, said = cheapest(tuple(rows))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def ordered(rows):
    """By turn, nulls first; rows of one turn by the hash of their content."""
    content = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, content(r)))


def damaged(rows):
    """Rows (conv, turn, role, text) after the faults."""
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            yield from [row] * (2 if kind == 3 else 1)


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def check(spark, rows, chunk=C.CHUNK):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    plan = C.plan_edits(frame, chunk=chunk)
    facts = {r["conv"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")) for r in plan.where("cost IS NOT NULL").collect()}
    done = {r["conv"]: (r["audit"], r["repaired_sha256"]) for r in C.digests(C.repair(frame, plan)).collect()}
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = {c: expected(ordered(own)) for c, own in by_conversation(spaced).items()}
    assert {c: facts[c] + done[c] for c in facts} == want
    return plan


def test_whole_table(spark, folder):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{folder}/conversations.parquet").to_pylist()]
    after = by_conversation(damaged(rows))
    want = {c: expected(ordered(after.get(c, []))) for c in {r[0] for r in rows}}
    got = queries.op11_conversation_repair(spark, folder).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r[c] for c in names) for r in got} == want


def test_random_conversations(spark):
    random.seed(3)
    texts = ["", " \t", "a.", "b!", "c", "d?", None, "e. \n", "a."]
    roles = ["user", "assistant", "system", "tool", "", None, "u"]
    rows = []
    for conv in range(600):
        for _ in range(random.randint(1, 9)):
            rows.append((conv, random.choice([None, *range(6)]), random.choice(roles[: random.choice([2, 3, 7])]), random.choice(texts)))
    rows += [(None, 0, "user", "x."), (None, 1, "assistant", "y.")]
    check(spark, rows)


def test_every_short_sequence_of_roles(spark):
    rows = []
    for n in range(1, 6):
        for roles in product(("system", "user", "assistant"), repeat=n):
            conv = len({r[0] for r in rows[-1:]}) and rows[-1][0] + 1 if rows else 0
            rows += [(conv, i, role, f"{i}.") for i, role in enumerate(roles)]
    check(spark, rows)


def test_giant_conversation_spills(spark):
    random.seed(5)
    rows = [(1, i // 2, random.choice(["user", "assistant", "assistant"]), random.choice(["x.", "", f"{i}", f"{i}."])) for i in range(400)]
    rows += [(1, 77, "user", "same.")] * 40 + [(2, 0, "user", "a."), (3, None, "user", "b")]
    plan = check(spark, rows, chunk=7)
    assert plan.where("conv = 1").count() > 50
    assert [r["conv"] for r in plan.where("cost IS NOT NULL").orderBy("conv").collect()] == [1, 2, 3]


def test_edits_are_valid_and_checked(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "tool", "b."), (1, 2, "user", "c")], "conv_id bigint, turn bigint, role string, text string")
    edits = C.repair(frame, C.plan_edits(frame))
    rows = edits.collect()
    assert GRAMMAR.fullmatch("".join(r["role"][0] for r in rows if r["edit"] != "D"))
    assert [r["nth"] for r in rows] == list(range(len(rows)))
    try:
        C.digests(cut_lineage(edits.orderBy(edits["nth"].desc()))).collect()
    except Exception as e:
        assert "not in order" in str(e)
    else:
        raise AssertionError("edits out of order were taken")


def test_empty_and_clashing_columns(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string"
    empty = spark.createDataFrame([], kinds)
    assert C.audited(empty, C.damage(empty)).count() == 0
    wide = spark.createDataFrame([(5, 0, "user", "a.", "x", "y", 1, "z")], kinds + ", conv string, h string, rest int, ROLE_2 string").toDF("conv_id", "turn", "role", "text", "conv", "h", "rest", "ROLE")
    (row,) = C.audited(wide, wide).collect()
    assert (row["conv_id"], row["audit"], row["cost"]) == (5, "KI", 2)


def test_dropped_conversation(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    original = spark.createDataFrame([(conv, 0, "user", "a.")], "conv_id bigint, turn bigint, role string, text string")
    (row,) = C.audited(original, C.damage(original)).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", EMPTY)
