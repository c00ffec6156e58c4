import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from cardwatch.llm import conversation_repair

DDL = "conv_id long, turn long, role string, text string, c string, at long, n long"
SPACE = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit, lines) by search over all edits in order of (cost, audit)."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        nxt = "assistant" if state == "u" else "user"
        heapq.heappush(queue, (cost + 5, audit + "I", i, nxt[0], (*lines, nxt + ":")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(queue, (cost + 2, audit + "D", i + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 * (fault == "truncated")
        if role[:1] == nxt[0] or (role[:1] == "s" and state == ""):
            heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
        heapq.heappush(queue, (cost + 1 + more, audit + "R", i + 1, nxt[0], (*lines, f"{nxt}:{text}")))


def expected(rows, damage=True):
    told = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        told[conv]
        said = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        dice = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20 if damage else 19
        role, text = said[2:]
        if dice == 0:
            continue
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        role = "user" if dice == 4 else role
        told[conv] += [(turn, role, text)] * (2 if dice == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()
    for conv, all_rows in told.items():
        all_rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        turns = [r[0] for r in all_rows if r[0] is not None]
        seen, faulty = set(), []
        for _, role, text in all_rows:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        initials = [r[0][:1] for r in faulty]
        cost, audit, lines = cheapest(faulty)
        count = lambda f: sum(r[2] == f for r in faulty)
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
               sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
               hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talks():
    rnd = random.Random(5)
    texts = ["Yes.", "No!", "what", "", " \t", "A long one. ", "é?", "cut off", None, "a\nb."]
    rows = []
    for conv in range(150):
        for turn in range(rnd.randint(0, 9)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn + 3]), role, rnd.choice(texts), "x", 1, 2))
    for turn in range(90):
        rows.append((777, turn, rnd.choice(["user", "assistant", "tool"]), rnd.choice(texts) or str(turn), "x", 1, 2))
    rows += [(None, None, None, None, None, None, None), (None, 1, "user", "Hello.", "", 0, 0), (20_000, 1, "user", "x" * 300_000 + ".", "", 0, 0)]
    return rows + rows[5:9]


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("block", [8192, 4])
def test_repair_is_the_cheapest_and_least(spark, monkeypatch, damage, block):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    rows = talks()
    got = conversation_repair.repair(spark.createDataFrame(rows, DDL).repartition(3), damage)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    key = lambda r: (r[0] is not None, r[0] or 0)
    found, wanted = sorted(map(tuple, got.collect()), key=key), sorted(expected(rows, damage), key=key)
    assert len(found) == len(wanted)
    assert [(a, b) for a, b in zip(found, wanted) if a != b] == []


def test_ranks_of_all_nodes_follow_their_audits():
    import numpy as np
    import pandas as pd

    rnd = random.Random(2)
    rows = pd.DataFrame({"c": ["a"] * 7 + ["b"] * 40 + ["c"], "at": range(48), "n": 1, "block": 0,
                         "initial": [rnd.choice("suax") for _ in range(48)], "fault": [rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(48)]})
    block = conversation_repair.Block(rows)
    cost, arcs = block.costs(np.broadcast_to(conversation_repair.END, (3, 4)))
    pointers, label, rank = block.least_path(cost, arcs)
    audits = []
    for node in range(4 * len(rows)):
        audit = ""
        while node < 4 * len(rows):
            audit, node = audit + "DIKR"[label.ravel()[node]], pointers[0][node]
        audits.append(audit)
    order = np.argsort(rank[:len(audits)], kind="stable")
    assert [audits[i] for i in order] == sorted(audits)


def test_no_conversations(spark):
    assert conversation_repair.repair(spark.createDataFrame([], DDL)).collect() == []


def test_all_rows_of_the_table(spark):
    from cardwatch.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_repair"](spark, sf_dir).collect())) == sorted(expected(rows))
