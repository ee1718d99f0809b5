import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from rankfold.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if f:
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            yield from [(conv, turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)


def cheapest(rows):
    """(cost, audit, lines) by the definition: every choice of edits, costs first, then the audit."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        said = {"u": "user", "a": "assistant"}[after[state]]
        if inserted < 3:
            c, a, t = best(i, after[state], inserted + 1)
            ways.append((c + 2, "I" + a, (said + ":", *t)))
        if i < len(rows):
            fault, role, text = rows[i]
            c, a, t = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                extra, initial = fault == "truncated", role[:1]
                c, a, t = best(i + 1, after[state], 0)
                ways.append((c + 2 + extra, "R" + a, (f"{said}:{text}", *t)))
                if initial == after[state] or (state, initial) == ("", "s"):
                    c, a, t = best(i + 1, initial, 0)
                    ways.append((c + extra, "K" + a, (f"{role}:{text}", *t)))
        return min(ways) if ways else (10 ** 9, "", ())

    for i in range(len(rows), 0, -1):  # from the back, so that no call goes deep
        for state in after:
            best(i, state, 0)
    return best(0, "", 0)


def plain(table):
    out = {}
    damaged = list(damage(table))
    for conv in {r[0] for r in table}:
        rows = sorted((r for r in damaged if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(cr_mark(r)).hexdigest()))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in rows:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((fault, role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(tuple(faults))
        kinds = [f[0] for f in faults]
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def cr_mark(r):
    conv, _, role, text = r
    return f"{'' if conv is None else f'={conv}'}:{len(role)}:{role}{text}".encode()


def spark_rows(spark, rows, **more):
    out = cr.repair(spark.createDataFrame(rows, SCHEMA), **more)
    assert out.columns == COLUMNS
    got = {r.conv_id: tuple(r)[1:] for r in out.collect()}
    return got


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for k in range(rng.randint(1, 12)):
            text = rng.choice(["Yes.", "No", "Why?", " ", "", None, "Fine! \t", "Well\n", f"Number {k}.", f"Éa {k}", f"So {k}!"])
            rows.append((conv if conv % 9 else None, rng.choice([k, k, k, k + 1, k // 2, None]),
                         rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "umpire"]), text))
    rows += rows[:40]
    assert spark_rows(spark, rows) == plain(rows)


def test_long_conversation_over_many_segments(spark, monkeypatch):
    """Segments of a few rows, over several tasks, give the same as one."""
    rng = random.Random(8)
    rows = [(7, k, rng.choice(["user", "assistant", "system", "bot"]), rng.choice([f"Line {k}.", f"Line {k}", "Again.", ""])) for k in range(300)]
    rows += [(7, 400, "user", "Copies.")] * 50 + [(8, 0, "user", "Hello."), (8, 1, "assistant", "Good day.")]
    want = plain(rows)
    monkeypatch.setattr(cr, "SEGMENT_ROWS", 7)
    assert spark_rows(spark, rows) == want
    monkeypatch.setattr(cr, "SEGMENT_CHARACTERS", 20)
    assert spark_rows(spark, rows) == want


def test_no_rows_after_damage(spark):
    conv = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    got = spark_rows(spark, [(conv, 0, "user", "Hi."), (conv, 0, "user", "Hi.")])
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert spark_rows(spark, []) == {}


def test_block_lookup_equals_plain_steps():
    rng = random.Random(2)
    for block in (1, 2, 3):
        tables = cr.Tables(block)
        for _ in range(300):
            symbols = bytes(rng.choices(range(cr.SYMBOLS), k=rng.randint(0, 20)))
            for state in cr.STATES:
                costs, total = cr.normal(cr.with_inserts([0 if q == state else cr.DEAD for q in cr.STATES]))
                for s in symbols:
                    costs, add = cr.normal(cr.step(costs, s))
                    total += add
                assert tables.forward(symbols, state) == [total + c if c < cr.DEAD else -1 for c in costs]
            audit, last = cr.trace(tables.backward(symbols, cr.TO_END), cr.EMPTY)
            ends = tables.forward(symbols)
            cost = cr.apply(audit + cr.ending(last), symbols, *([["u"] * len(symbols)] * 2), cr.EMPTY)[2]
            assert cost == min(c for c in (ends[cr.EMPTY], ends[cr.ASSISTANT]) if c >= 0)


def test_vectors_stay_few():
    """Normalised vectors are a closed, small set: the tables do not grow with the conversation."""
    assert len(cr.Tables(1).vectors) < 200


def test_repaired_turns_read_as_they_should(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Cut off"), (1, 2, "user", "Yes."), (2, 0, "system", "Rules."), (2, 1, "user", "Ask?"),
            (2, 2, "assistant", "Answer."), (3, 0, "user", "x" * 400_000 + "."), (3, 1, "assistant", "Long.")]
    same = lambda df: df.withColumn("copies", F.lit(1).cast("long"))
    done = cr.repaired(cr.faults(same(spark.createDataFrame(rows, SCHEMA))))
    lines = {}
    for r in cr.turns(done).orderBy("conv_id", "part", "segment", "turn").collect():
        lines.setdefault(r.conv_id, []).append(r.role)
    assert lines[2] == ["system", "user", "assistant"] and lines[3] == ["user", "assistant"]
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in v)) for v in lines.values())
    assert {r.conv_id: r.audit for r in done.collect()}[2] == "KKK"


@pytest.mark.parametrize("extra", ["copies", "mark", "symbols"])
def test_clashing_columns(spark, extra):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn(extra, F.lit("x"))
    assert {r.conv_id: tuple(r)[1:] for r in cr.repair(df).collect()} == plain(rows)
