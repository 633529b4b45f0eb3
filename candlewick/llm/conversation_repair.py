"""Conversation repair by a generalised LR parse over the role grammar.

A sound conversation's role initials match ``(s?(ua)+)?``. The parser's automaton
is made from the grammar's rules. Reading a row, every stack top of the
graph-structured stack tries all edits: keep the row, rerole it, delete it, or
insert an empty turn before it; reductions fork without look-ahead, and forks that
can't shift die. Equal tops accept the same rest, so they merge into the one with
the least (cost, audit). At most a few tops live, whatever the length.

Comparing audits needs no strings. With insertions noted before the row that
follows them, audits after the same row are never prefixes of one another, so the
order of two tops' audits never changes later, and a rank per top stands for it.

A conversation of any length is split: rows are sorted by range over all
conversations, cut into parts of ``PART_ROWS``, and each part is parsed once for
every top it may be entered with. What is left of a part is a small table
(entry, exit) -> (cost, rank); these are chained per conversation, and then each
part replays its own best edits. Rows move without their texts until the end.

Defined cases: null role or text count as one space; a row whose role begins with
none of s, u, a (or is empty) can't be kept as it is; rows without a turn come first; equal turns go by role, then text digest; repeated rows are duplicates of
the first; a null conv_id is a conversation of its own; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import materialise, table

PART_ROWS = 1_000
# The role grammar, the roles that edits may set, and edit costs.
GRAMMAR = (("Z", "C"), ("C", ""), ("C", "B"), ("C", "sB"), ("B", "P"), ("B", "BP"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SOUND, BLANK, DUPLICATE, CUT = range(4)

Stack = tuple[int, ...]


@lru_cache(maxsize=1)
def automaton() -> tuple[dict[tuple[int, str], int], list[list[tuple[str, int]]]]:
    """goto[(state, symbol)] and, per state, the rules that are complete there
    as (left side, length)."""
    def closure(items: frozenset) -> frozenset:
        todo, done = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            for i, (left, _) in enumerate(GRAMMAR):
                if GRAMMAR[rule][1][dot:dot + 1] == left and (i, 0) not in done:
                    done.add((i, 0))
                    todo.append((i, 0))
        return frozenset(done)

    states, goto = [closure(frozenset([(0, 0)]))], {}
    for n, items in enumerate(states):  # grows while it is read
        for symbol in sorted({GRAMMAR[r][1][d] for r, d in items if d < len(GRAMMAR[r][1])}):
            to = closure(frozenset((r, d + 1) for r, d in items if GRAMMAR[r][1][d:d + 1] == symbol))
            if to not in states:
                states.append(to)
            goto[n, symbol] = states.index(to)
    done = [[(GRAMMAR[r][0], d) for r, d in sorted(items) if d == len(GRAMMAR[r][1])] for items in states]
    return goto, done


def _reduced(stack: Stack) -> Iterator[Stack]:
    """The stack and all that it reduces to."""
    goto, done = automaton()
    todo = [stack]
    while todo:
        s = todo.pop()
        yield s
        for left, n in done[s[-1]]:
            if left != "Z":
                base = s[:len(s) - n]
                todo.append((*base, goto[base[-1], left]))


@lru_cache(maxsize=10_000)
def shift(stack: Stack, symbol: str) -> Stack | None:
    goto, _ = automaton()
    return next(((*s, goto[s[-1], symbol]) for s in _reduced(stack) if (s[-1], symbol) in goto), None)


@lru_cache(maxsize=10_000)
def ending(stack: Stack) -> str:
    """The fewest initials to insert so that the conversation may end."""
    _, done = automaton()
    tries = [(stack, "")]
    for s, added in tries:
        if any(("Z", 1) in done[r[-1]] for r in _reduced(s)):
            return added
        tries += [(t, added + x) for x in ROLES if (t := shift(s, x))]
    raise AssertionError("every stack has an ending")


@lru_cache(maxsize=1)
def entries() -> dict[int, Stack]:
    """A stack for each top that a part can be entered with."""
    found = {0: (0,)}
    todo = [(0,)]
    while todo:
        s = todo.pop()
        for x in ("s", *ROLES):
            if (t := shift(s, x)) and t[-1] not in found:
                found[t[-1]] = t
                todo.append(t)
    return found


@lru_cache(maxsize=100_000)
def edits(stack: Stack, initial: str, fault: int) -> tuple[tuple[int, str, Stack, str], ...]:
    """All edits of a row on a stack: cost, letters, new stack, and the roles
    that inserted or reroled turns get. Two insertions in a row change no top,
    and an insertion before a deletion can as well follow it, so neither is
    tried."""
    out = [(DELETE, "D", stack, "")]
    if fault not in (BLANK, DUPLICATE):
        late = TRUNCATED if fault == CUT else 0
        before = [(0, "", stack, "")] + [(INSERT, "I", s, x) for x in ROLES if (s := shift(stack, x))]
        for cost, letters, s, roles in before:
            if to := shift(s, initial):
                out.append((cost + late, letters + "K", to, roles))
            out += [(cost + late + REROLE, letters + "R", to, roles + x) for x in ROLES if (to := shift(s, x))]
    return tuple(out)


def parse(entry: int, initials: list[str], faults: list[int]):
    """Exits of a part entered with a top: {top: (cost, rank of its audit)}, and
    for every row {top: (top before, letters, roles)}."""
    tops = {entry: (0, 0, entries()[entry])}
    trace = []
    for initial, fault in zip(initials, faults):
        best: dict[int, tuple] = {}
        for top, (cost, rank, stack) in tops.items():
            for extra, letters, to, roles in edits(stack, initial, fault):
                key = (cost + extra, rank, letters)
                if to[-1] not in best or key < best[to[-1]][0]:
                    best[to[-1]] = (key, to, top, roles)
        ranked = sorted(best, key=lambda t: best[t][0][1:])
        tops = {t: (best[t][0][0], i, best[t][1]) for i, t in enumerate(ranked)}
        trace.append({t: (best[t][2], best[t][0][2], best[t][3]) for t in ranked})
    return {t: (cost, rank) for t, (cost, rank, _) in tops.items()}, trace


def chain(parts: list[list[dict]]) -> tuple[int, list[tuple[int, int]]]:
    """The cheapest way through a conversation's parts, ties by audit: cost and
    (entry, exit) per part. A part is its list of moves."""
    tops, back = {0: (0, 0)}, []
    for moves in parts:
        best: dict[int, tuple] = {}
        for m in moves:
            if m["entry"] in tops:
                cost, rank = tops[m["entry"]]
                key = (cost + m["cost"], rank, m["rank"])
                if m["exit"] not in best or key < best[m["exit"]][0]:
                    best[m["exit"]] = (key, m["entry"])
        ranked = sorted(best, key=lambda t: best[t][0][1:])
        tops = {t: (best[t][0][0], i) for i, t in enumerate(ranked)}
        back.append({t: best[t][1] for t in ranked})
    stacks = entries()
    total, _, top = min((cost + INSERT * len(ending(stacks[t])), rank, t) for t, (cost, rank) in tops.items())
    way = []
    for step in reversed(back):
        way.append((step[top], top))
        top = step[top]
    return total, way[::-1]


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, and ``lost`` for rows that are dropped. The
    crc32 of ``conv_id:turn`` decides: drop, empty, strip end marks, repeat, or
    set the role to user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    return df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("lost"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0)))).alias("copy")).drop("copy")


MOVES = "array<struct<entry:int,exit:int,cost:long,rank:int>>"
COUNTS = "blank long, duplicate long, truncated long, illegal long"


def _cut_parts(kind: str, part_rows: int):
    """Parts of a sorted partition, parsed for every entry they may have."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        conv, rows, follows = None, [], True  # a partition may begin inside a conversation
        out = []

        def part() -> dict:
            nonlocal number
            initials, faults, uids, turns = map(list, zip(*rows))
            known = [t for t in turns if t is not None]
            moves = [{"entry": e, "exit": x, "cost": c, "rank": r} for e in (entries() if follows else (0,))
                     for x, (c, r) in parse(e, initials, faults)[0].items()]
            number += 1
            return {"conv_id": conv, "part": base + number, "moves": moves, "initials": initials, "faults": faults,
                    "uids": uids, "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
                    "turns": len(set(known)), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
                    "truncated": faults.count(CUT),
                    "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))}

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return batch

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("conv_id", batch.schema.field(0).type), ("part", pa.int64()),
                    ("moves", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                                                  ("rank", pa.int32())]))),
                    ("initials", pa.list_(pa.string())), ("faults", pa.list_(pa.int32())), ("uids", pa.list_(pa.int64())),
                    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()),
                    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())])
            for c, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if rows and (c != conv or len(rows) == part_rows):
                    out.append(part())
                    follows, rows = c == conv, []
                    if len(out) == 1_000:
                        yield flush()
                conv = c
                rows.append(tuple(row))
        if rows:
            out.append(part())
        if out:
            yield flush()

    return cut, (f"conv_id {kind}, part long, moves {MOVES}, initials array<string>, faults array<int>, "
                 f"uids array<long>, first_turn long, last_turn long, turns long, {COUNTS}")


def _chained(kind: str):
    """Way and summary of each conversation from its parts in order."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        parts: list[dict] = []

        def close() -> list[dict]:
            cost, way = chain([p["moves"] for p in parts])
            turns = [p for p in parts if p["turns"]]
            shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(turns, turns[1:]))
            gaps = (turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - sum(p["turns"] for p in turns) + shared
                    if turns else 0)
            total = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal")}
            total["illegal"] += sum(a["tail"] + b["head"] not in LEGAL_PAIRS for a, b in zip(parts, parts[1:]))
            none = dict.fromkeys([*total, "gaps", "cost"])
            return [{"conv_id": p["conv_id"], "part": p["part"], "entry": e, "exit": x,
                     **({**total, "gaps": gaps, "cost": cost} if p is parts[-1] else none)}
                    for p, (e, x) in zip(parts, way)]

        def frame(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        out: list[dict] = []
        for batch in batches:
            if schema is None:
                schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int64()),
                                    ("entry", pa.int32()), ("exit", pa.int32()),
                                    *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "gaps", "cost"))])
            for row in batch.to_pylist():
                if parts and row["conv_id"] != parts[0]["conv_id"]:
                    out += close()
                    parts = []
                parts.append(row)
            if out:
                yield frame(out)
                out = []
        if parts:
            yield frame(close())

    return walk, f"conv_id {kind}, part long, entry int, exit int, {COUNTS}, gaps long, cost long"


def _replayed(kind: str):
    """The edits of each part on its way from entry to exit."""
    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("conv_id", "part", "step", "edit", "role", "uid")}

            def put(*row) -> None:
                for c, v in zip(out.values(), row):
                    c.append(v)

            for p in batch.to_pylist():
                _, trace = parse(p["entry"], p["initials"], p["faults"])
                top, way = p["exit"], []
                for step in reversed(trace):
                    top, letters, roles = step[top]
                    way.append((letters, roles))
                steps = [(x, ROLES[roles[i]] if i < len(roles) else None, None if x == "I" else uid)
                         for (letters, roles), uid in zip(reversed(way), p["uids"]) for i, x in enumerate(letters)]
                if p["last"]:
                    steps += [("I", ROLES[x], None) for x in ending(entries()[p["exit"]])]
                for i, (edit, role, uid) in enumerate(steps):
                    put(p["conv_id"], p["part"], i, edit, role, uid)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["conv_id"], batch.schema.field("conv_id").type), pa.array(out["part"], pa.int64()),
                pa.array(out["step"], pa.int32()), pa.array(out["edit"], pa.string()), pa.array(out["role"], pa.string()),
                pa.array(out["uid"], pa.int64())], names=list(out))

    return replay, f"conv_id {kind}, part long, step int, edit string, role string, uid long"


def repair(df: DataFrame, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and a summary of each conversation of (conv_id, turn, role,
    text). Rows: conv_id, part, step (their order), edit (K, R, D or I), turn,
    role and text; a deleted row keeps its own. Summary: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost."""
    kind = df.schema["conv_id"].dataType.simpleString()
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    d = df.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    sound: Column = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(SOUND)
    rows = materialise(d.withColumns({
        "uid": F.monotonically_increasing_id(), "digest": F.unhex(F.sha2("text", 256)), "fault": sound,
        "initial": F.substring("role", 1, 1)}), "turns")
    narrow = rows.drop("text")
    # The first row of each text, by partial aggregates; joined by row number, so
    # a text on many rows is no hot key.
    place = F.struct(F.col("turn").isNotNull().alias("p"), "turn", "uid")
    firsts = narrow.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("m")).select(
        F.col("m.uid").alias("uid"), F.lit(True).alias("first"))
    narrow = narrow.join(firsts, "uid", "left").withColumn(
        "fault", F.when(F.col("first").isNull() & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "uid"]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "initial", "fault", "uid", "turn")
    cut, schema = _cut_parts(kind, part_rows)
    parts = materialise(ordered.mapInArrow(cut, schema), "parts")

    light = parts.select("conv_id", "part", "moves", "first_turn", "last_turn", "turns", "blank", "duplicate",
                         "truncated", "illegal", F.col("initials")[0].alias("head"),
                         F.element_at("initials", -1).alias("tail"))
    walk, schema = _chained(kind)
    by_part = [F.col("conv_id").asc_nulls_first(), "part"]
    ways = materialise(light.repartition("conv_id").sortWithinPartitions(*by_part).mapInArrow(walk, schema), "ways")
    summary = ways.where("cost IS NOT NULL").drop("part", "entry", "exit")

    replay, schema = _replayed(kind)
    steps = parts.select("conv_id", "part", "initials", "faults", "uids").join(
        ways.select("part", "entry", "exit", F.col("cost").isNotNull().alias("last")), "part").mapInArrow(replay, schema)
    own = rows.select("uid", "turn", F.col("role").alias("own_role"), "text")
    columns = ["conv_id", "part", "step", "edit", "turn", "role", "text"]
    edited = steps.where("uid IS NOT NULL").join(own, "uid").withColumn("role", F.coalesce("role", "own_role"))
    inserted = steps.where("uid IS NULL").withColumns({"turn": F.lit(None).cast("long"), "text": F.lit("")})
    return edited.select(*columns).unionByName(inserted.select(*columns)), summary


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256. A hash has to read a conversation in
    order, so rows are sorted by Spark and streamed: no conversation is held."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, sha, begun, any_row, type_ = None, [], hashlib.sha256(), False, False, None
        out: list[tuple] = []

        def frame() -> pa.RecordBatch:
            ids, audits, hashes = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, type_), pa.array(audits), pa.array(hashes)],
                                              names=["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            type_ = batch.schema.field(0).type
            for c, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if any_row and c != conv:
                    out.append((conv, "".join(audit), sha.hexdigest()))
                    audit, sha, begun = [], hashlib.sha256(), False
                conv, any_row = c, True
                audit.append(edit)
                if edit != "D":
                    sha.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
                    begun = True
            if out:
                yield frame()
        if any_row:
            out.append((conv, "".join(audit), sha.hexdigest()))
            yield frame()

    return repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "step").select(
        "conv_id", "edit", "role", "text").mapInArrow(
        walk, f"conv_id {kind}, audit string, repaired_sha256 string")


def op11_glr_repair(spark, sf_dir) -> DataFrame:
    """Every conversation's faults, cheapest edits and the digest of its repair."""
    raw = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired, summary = repair(damage(raw).where("NOT lost").drop("lost"))
    ids = raw.select("conv_id").distinct()
    s, d = summary.withColumnRenamed("conv_id", "s_id"), digests(repaired).withColumnRenamed("conv_id", "d_id")
    out = ids.join(s, F.col("conv_id").eqNullSafe(F.col("s_id")), "left").join(
        d, F.col("conv_id").eqNullSafe(F.col("d_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


# One step of the search per row and state (a: empty, s, u, ua as lists
# [cost, audit, text]); the states are those of the roles' regular expression.
_STATES = {
    # state: [(from state, letters, initials read or made, inserted before)]
    "e": [], "s": [("e", "s", "")],
    "u": [("e", "u", ""), ("s", "u", ""), ("f", "u", ""), ("u", "u", "a")],
    "f": [("u", "a", ""), ("e", "a", "u"), ("s", "a", "u"), ("f", "a", "u")],
}


def _sql_state(state: str) -> str:
    far = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
    tries = [f"CASE WHEN q.{state}.c < 1000000 THEN {{'c': q.{state}.c + 3, 'a': q.{state}.a || 'D', 't': q.{state}.t}} ELSE {far} END"]
    for start, read, made in _STATES[state]:
        insert = f" || '\n{ROLES[made]}:'" if made else ""
        letter, extra = ("I", INSERT) if made else ("", 0)
        good = f"q.{start}.c < 1000000 AND r.fault NOT IN ({BLANK}, {DUPLICATE})"
        late = f"CASE WHEN r.fault = {CUT} THEN 1 ELSE 0 END"
        tries.append(f"CASE WHEN {good} AND r.initial = '{read}' THEN {{'c': q.{start}.c + {extra} + {late}, "
                     f"'a': q.{start}.a || '{letter}K', 't': q.{start}.t{insert} || '\n' || r.role || ':' || r.text}} ELSE {far} END")
        if read in ROLES:
            tries.append(f"CASE WHEN {good} THEN {{'c': q.{start}.c + {extra + REROLE} + {late}, "
                         f"'a': q.{start}.a || '{letter}R', 't': q.{start}.t{insert} || '\n{ROLES[read]}:' || r.text}} ELSE {far} END")
    return f"list_min([{', '.join(tries)}])"


SQL = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), h AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i::INTEGER, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
  FROM k
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged
), r AS (
  SELECT conv_id, turn, n, role, text, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN {BLANK} WHEN seen > 1 THEN {DUPLICATE}
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN {CUT} ELSE {SOUND} END AS fault,
         lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS next FROM numbered
), q AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS e,
         {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s, {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS u,
         {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS f
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT q.conv_id, r.n, {_sql_state('e')}, {_sql_state('s')}, {_sql_state('u')}, {_sql_state('f')}
  FROM q JOIN r ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.n = q.n + 1
), last AS (SELECT conv_id, arg_max(q, n) AS q FROM q GROUP BY conv_id),
best AS (
  SELECT conv_id, list_min([q.e, q.f, {{'c': q.u.c + 2, 'a': q.u.a || 'I', 't': q.u.t || chr(10) || 'assistant:'}},
    {{'c': q.s.c + 4, 'a': q.s.a || 'II', 't': q.s.t || chr(10) || 'user:' || chr(10) || 'assistant:'}}]) AS b FROM last
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {DUPLICATE}) AS duplicate,
         count(*) FILTER (fault = {CUT}) AS truncated,
         count(*) FILTER (next IS NOT NULL AND initial || next NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit, sha256(substr(b.t, 2)) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id
"""
