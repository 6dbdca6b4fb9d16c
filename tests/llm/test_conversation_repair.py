"""Conversation repair against a search through all edit sequences."""

from __future__ import annotations

import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from __spark_entry__ import SMALLEST
from tidemark.llm import conversation_repair
from tidemark.llm.conversation_repair import Costs, Search, accepting
from tidemark.llm.queries import QUERIES, damaged

WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows, costs=Costs()):
    """Faults, least cost, least audit and repaired turns of (turn, role, text) rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(WHITE)
        if not shown:
            faults.append("blank")
            continue
        faults.append("duplicate" if (role, text) in seen else
                      None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))

    # all edits, shortest first: the best of each place and state is settled from the end
    best = {}
    for place in range(len(rows), -1, -1):
        done = {}
        if place == len(rows):
            done = {"": (0, "", ()), "a": (0, "", ())}
        else:
            _, role, text = rows[place]
            for state in ("", "s", "u", "a"):
                options = []
                cost, audit, turns = best[place + 1][state]
                options.append((cost + costs.delete, "D" + audit, turns))
                if faults[place] in (None, "truncated"):
                    extra = costs.truncated if faults[place] else 0
                    for new, price, letter in [(role, 0, "K"), ("user", costs.rerole, "R"),
                                               ("assistant", costs.rerole, "R")]:
                        after = NEXT.get((state, new[:1]))
                        if after and after in best[place + 1]:
                            cost, audit, turns = best[place + 1][after]
                            options.append((cost + price + extra, letter + audit,
                                            ((new, text), *turns)))
                done[state] = min(options, key=lambda o: o[:2])
        for _ in range(3):  # inserts before this place
            for state in ("", "s", "u", "a"):
                for new in ("user", "assistant"):
                    after = NEXT.get((state, new[0]))
                    if after in done:
                        cost, audit, turns = done[after]
                        one = (cost + costs.insert, "I" + audit, ((new, ""), *turns))
                        if state not in done or one[:2] < done[state][:2]:
                            done[state] = one
        best[place] = done
    cost, audit, turns = best[0][""]
    numbers = sorted({t for t, _, _ in rows if t is not None})
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {"gaps": numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost,
            "audit": audit, "repaired_sha256": hashlib.sha256(
                "\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()}


def plain_damage(rows):
    """(conv_id, turn, role, text) rows by conversation after the damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) \
            if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(m, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
            for c, m in out.items()}


def random_rows(rng, convs, most):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "user"]
    texts = ["Yes.", "No!", "cut", "", " \n", "What?", None, "so on…", "x. ", "a\tb.\n"]
    return [(c, rng.choice([None, t, t, t, rng.randrange(9)]), rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.6 else f"Turn {t} of {rng.random()}.")
            for c in convs for t in range(rng.randrange(most))]


SCHEMA = "conv_id long, turn long, role string, text string, place string, edits int"


def _found(df):
    rows = [r.asDict() for r in df.collect()]
    found = {r.pop("conv_id"): r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 9, 1, 3), Costs(3, 2, 2, 0), Costs(1, 1, 1, 1)])
def test_repair_equals_the_search_through_all_edits(spark, costs):
    rng = random.Random(costs.delete)
    rows = random_rows(rng, [None, *range(60)], 12) + random_rows(rng, range(100, 103), 400)
    rows += [(200, t, "user", "Go on.") for t in range(150)] + [(201, None, "user", "Hm.")] * 90
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    expected = {c: plain_repair(m, costs) for c, m in plain_damage(rows).items()}
    for part_bytes, chunk_rows in ((1 << 20, 16), (600, 3)):
        repaired = conversation_repair.repair(damaged(df), costs, "present", part_bytes, chunk_rows)
        assert _found(conversation_repair.report(repaired, costs)) == expected


def test_turns_that_repair_returns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hi."), (1, 2, "user", " "),
            (1, 3, "assistant", "Hi."), (1, 4, "user", "Well?")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    turns = conversation_repair.repair(df, Costs(delete=9)).first()["turns"]
    assert [(t["fault"], t["edit"], t["new_role"]) for t in turns] == [
        (None, "K", "system"), (None, "R", "user"), ("blank", "D", None), ("duplicate", "D", None),
        (None, "R", "assistant")]


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.report(conversation_repair.repair(none)).collect() == []


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "so " * 400_000 + "."), (1, 1, "assistant", "x" * 1_500_000),
            (1, 2, "assistant", "y" * 1_500_000 + "!")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    expected = plain_repair([r[1:] for r in rows])
    assert _found(conversation_repair.report(conversation_repair.repair(df)))[1] == expected


def test_chunks_converge_to_the_plain_recursion():
    rng = np.random.default_rng(4)
    costs = Costs()
    lengths = rng.integers(0, 60, 200)
    ends = np.cumsum(lengths)
    codes = rng.integers(0, 12, ends[-1])
    whole = Search(codes, ends - lengths, ends, accepting(costs, 200), costs, 10_000)
    assert whole.passes == 0
    for rows in (1, 3, 16):
        cut = Search(codes, ends - lengths, ends, accepting(costs, 200), costs, rows)
        assert (cut.before == whole.before).all() and (cut.after == whole.after).all()


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the given tables")
def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALLEST}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = _found(QUERIES["op11_conversation_repair"](spark, SMALLEST))
    assert found == {c: plain_repair(m) for c, m in plain_damage(rows).items()}
