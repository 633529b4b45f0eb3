import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from candlewick.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
LANGUAGE = re.compile("(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append(cr.BLANK if not last else cr.DUPLICATE if (role, text) in seen else cr.SOUND if last in ".!?" else cr.CUT)
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest edits of rows (role, text) by search over all of bounded cost."""
    marks = faults(rows)
    best = None
    # Every row: K, R to u, R to a, or D, with up to two inserted turns before it.
    inserts = ["", "u", "a", "ua", "au"]
    options = []
    for (role, _), f in zip(rows, marks):
        own = [("D", "", 3)]
        if f not in (cr.BLANK, cr.DUPLICATE):
            own += [("K", role[:1], f == cr.CUT), ("R", "u", 2 + (f == cr.CUT)), ("R", "a", 2 + (f == cr.CUT))]
        options.append([(i, *o) for i in inserts for o in own])
    for pick in itertools.product(*options, inserts):
        *each, tail = pick
        initials = "".join(i + x for i, _, x, _ in each) + tail
        if not LANGUAGE.fullmatch(initials) or any(e == "K" and x not in set("sua") for _, e, x, _ in each):
            continue
        cost = sum(2 * len(i) + c for i, _, _, c in each) + 2 * len(tail)
        audit = "".join("I" * len(i) + e for i, e, _, _ in each) + "I" * len(tail)
        if best is None or (cost, audit) < best[:2]:
            out = []
            for (role, text), (i, e, x, _) in zip(rows, each):
                out += [f"{cr.ROLES[y]}:" for y in i]
                out += [] if e == "D" else [f"{role if e == 'K' else cr.ROLES[x]}:{text}"]
            best = (cost, audit, "\n".join(out + [f"{cr.ROLES[y]}:" for y in tail]))
    return best


def results(spark, rows, **options):
    """rows (conv_id, turn, role, text) -> {conv_id: (summary, audit, hash, repaired)}."""
    d = spark.createDataFrame([(*r, "x", 1) for r in rows],
                              "conv_id long, turn long, role string, text string, part string, uid int")
    repaired, summary = cr.repair(d, **options)
    sha = {r.conv_id: r for r in cr.digests(repaired).collect()}
    return {r.conv_id: (r, sha[r.conv_id].audit, sha[r.conv_id].repaired_sha256) for r in summary.collect()}


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "usr"]
    texts = ["a.", "b!", "cut", " ", "x? ", "", "a.\n"]
    return [(rng.choices(roles, [6, 6, 2, 1, .5, .5])[0], rng.choices(texts, [4, 3, 2, 1, 3, .5, 1])[0] if rng.random() < .6
             else f"t{rng.randint(0, 99)}.") for _ in range(n)]


@pytest.mark.parametrize("part_rows", [1000, 2])
def test_against_brute_force(spark, part_rows):
    rng = random.Random(part_rows)
    convs = {c: random_rows(rng, rng.randint(1, 4)) for c in range(120)}
    got = results(spark, [(c, t, *r) for c, rows in convs.items() for t, r in enumerate(rows)], part_rows=part_rows)
    for c, rows in convs.items():
        cost, audit, text = brute(rows)
        s, a, sha = got[c]
        marks = faults(rows)
        initials = [r[:1] for r, _ in rows]
        assert (s.cost, a, sha) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
        assert (s.blank, s.duplicate, s.truncated) == tuple(marks.count(x) for x in (cr.BLANK, cr.DUPLICATE, cr.CUT))
        assert s.illegal == sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


def test_parts_do_not_change_a_long_conversation(spark):
    rng = random.Random(5)
    long = [(1, t // 2 * 3, *r) for t, r in enumerate(random_rows(rng, 1500))]
    others = [(c, t, *r) for c in (None, 0, 2) for t, r in enumerate(random_rows(rng, 5))]
    whole = results(spark, long + others, part_rows=10_000)
    assert whole.keys() == {None, 0, 1, 2}
    assert whole == results(spark, long + others, part_rows=7)
    assert whole[1][0].gaps == 749 * 3 + 1 - 750


def test_awkward_rows(spark):
    rows = [(1, None, "user", "late."), (1, None, "user", "late."), (1, 5, None, None), (1, 2, "user", "x."), (1, 2, "assistant", "y."),
            (2, None, "assistant", "only"), (3, 1, "user", "w" * 100_000 + "."), (3, 9, "assistant", "ok!")]
    got = results(spark, rows)
    s, audit, _ = got[1]
    # Null turns first; the repeat goes; equal turns by role (assistant before user).
    assert (s.gaps, s.blank, s.duplicate, audit) == (2, 1, 1, "KDKKDI")
    assert (got[2][0].gaps, got[2][0].cost, got[2][1]) == (0, 3, "D")  # as cheap as IK
    assert (got[3][0].gaps, got[3][1]) == (7, "KK")
    assert results(spark, []) == {}


def test_automaton_accepts_the_role_language():
    for n in range(6):
        for word in map("".join, itertools.product("sua", repeat=n)):
            stack = (0,)
            for x in word:
                stack = stack and cr.shift(stack, x)
            assert bool(stack and cr.ending(stack) == "") == bool(LANGUAGE.fullmatch(word)), word


def test_damage(spark):
    rows = [(i, t, "assistant", "One. Two! Three?") for i in range(20) for t in (0, None)] + [(None, 1, None, None)]
    out = cr.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    expected = []
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        expected += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    got = cr.op11_glr_repair(spark, sf_dir)
    want = con.sql(cr.SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
