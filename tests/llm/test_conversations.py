"""Conversation repair against a plain recursion over all edits."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from wakeline.llm import conversations as C
from wakeline.llm.registry import queries

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """Least (cost, edits) by (row, state), from the end; at most two inserted turns at one place can be of use."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    new = {"": "u", "s": "u", "a": "u", "u": "a"}
    best = {s: (0, "") if s in ("", "a") else None for s in step}

    def inserted(level):
        for _ in range(3):
            for s in step:
                rest = level[new[s]]
                if rest is not None and (level[s] is None or (rest[0] + 2, "I" + rest[1]) < level[s]):
                    level[s] = (rest[0] + 2, "I" + rest[1])
        return level

    best = inserted(best)
    for role, _, fault in reversed(rows):
        now = {}
        for s in step:
            ways = [(best[s][0] + 3, "D" + best[s][1])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if role[:1] in step[s]:
                    c, e = best[step[s][role[:1]]]
                    ways.append((c + more, "K" + e))
                c, e = best[new[s]]
                ways.append((c + 2 + more, "R" + e))
            now[s] = min(ways)
        best = inserted(now)
    return best[""]


def plain(rows, faults=True):
    """rows: conv_id, turn, role, text. The query's rows."""
    ids = {r[0] for r in rows}
    kept = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        role, text = shown[2:]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20 if faults else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    none = lambda x: (x is not None, x if x is not None else 0)
    kept.sort(key=lambda r: (none(r[0]), none(r[1]), r[2], r[3]))
    out = {i: (i, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in ids}
    for conv, group in groupby(kept, key=lambda r: r[0]):
        group, seen, marked = list(group), set(), []
        for _, _, role, text in group:
            body = re.sub("[ \t-\r]+$", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        cost, audit = cheapest(marked)
        said, at = [], iter(marked)
        for e in audit:
            other = "assistant" if said and said[-1][0] == "u" else "user"
            if e == "I":
                said.append(other + ":")
                continue
            role, text, _ = next(at)
            if e != "D":
                said.append((role if e == "K" else other) + ":" + text)
        count = lambda x: sum(m[2] == x for m in marked)
        out[conv] = (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return set(out.values())


def random_rows(rng, n, roles=("system", "user", "assistant", "user", "assistant", "tool", "")):
    texts = ["Yes.", "No!", "why?", "and so", "a ", "", " \n", "Well. ", "It is 3", "Hm?", "Go on."]
    return [(rng.choice(roles), f"{rng.choice(texts)}{rng.choice(['', k, f'{k}.'])}") for k in range(n)]


def faulty(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(C.WHITE)
        out.append((role, text, "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


@pytest.mark.parametrize("segment", [1, 2, 7, 64])
def test_auction_finds_the_first_of_the_cheapest_edits(segment, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(400):
        rows = faulty(random_rows(rng, rng.randrange(1, 14)))
        assert C.cheapest(rows, {C.START: (0, "")}, True)[C.END] == cheapest(rows), rows


def test_long_conversations_in_segments():
    rng = random.Random(4)
    for n in (65, 128, 500):
        rows = faulty([(role, f"{k}{text}") for k, (role, text) in enumerate(random_rows(rng, n))])
        assert C.cheapest(rows, {C.START: (0, "")}, True)[C.END] == cheapest(rows)


def test_prices_are_dual_values():
    rng = random.Random(8)
    for _ in range(50):
        a = C.Auction(faulty(random_rows(rng, 12)), C.END)
        a.trace(C.START)
        assert all(a.price[i] <= c + a.price[j] for i, arcs in enumerate(a.arcs) for _, c, j in arcs)


@pytest.mark.parametrize("piece_rows", [3, 4096])
def test_conversations_over_many_tasks_and_pieces(spark, piece_rows):
    rng = random.Random(piece_rows)
    rows = []
    for conv in [None, *range(30), 99]:
        n = 260 if conv == 99 else rng.randrange(1, 9)
        for k, (role, text) in enumerate(random_rows(rng, n)):
            turn = None if rng.random() < 0.05 else k + rng.randrange(2)
            rows.append((conv, turn, None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
    rows += rows[5:9] + [(99, 7, "user", "again")] * 11
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", C.F.lit("clash")).repartition(7)
    for faults in (True, False):
        got = C.audit(df, faults, piece_rows)
        assert got.columns == COLUMNS
        assert {tuple(r) for r in got.collect()} == plain(rows, faults)


def test_query_is_the_plain_form(spark):
    for sf in ("0.001", "0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        got = queries()["op12_conversations"](spark, f"/root/testdata/sf{sf}").collect()
        assert {tuple(r) for r in got} == plain(rows) and len(got) == len({r[0] for r in rows})


def test_empty_tables_string_ids_and_turns_kept(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.audit(none, True).collect() == []
    df = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "user", "Hi there."), ("y", 0, "assistant", "Yes.")], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in C.repair(df).collect()}
    assert (got["x"].audit, [tuple(t) for t in got["x"].repaired]) == ("KR", [("user", "Hi."), ("assistant", "Hi there.")])
    assert (got["y"].audit, [tuple(t) for t in got["y"].repaired]) == ("IK", [("user", ""), ("assistant", "Yes.")])
