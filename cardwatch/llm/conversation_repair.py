"""Repair of conversation structure: cheapest edits by a cost table, the least audit by prefix doubling.

A repaired conversation's role initials match ``(s?(ua)+)?``. A node is (rows done, state), the state
says what the last role was: START, SYSTEM, USER or ASSISTANT. Costs to the end are taken from behind;
arcs that reach them are the optimal ones. Conversations of any length are cut into blocks of rows:
costs pass between blocks as 4 x 4 matrices, the chosen state as a map of four states.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of a block; a task holds one block without its texts.
BLOCK = 8192
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after one more row that is inserted or given another role, by state.
SPOKEN = np.array([USER, USER, ASSISTANT, USER])
#: State after a kept row, by role initial (s, u, a, other) and state; -1 where it may not stand.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
FAR = 1 << 50
#: Costs behind the last row: nothing or a whole pair is fine, other states need inserts.
END = np.array([0, 2 * INSERT, INSERT, 0])
SPACES = " \t\n\x0b\f\r"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def damaged(rows: DataFrame, damage: bool = True) -> DataFrame:
    """Rows (c, conv_id, turn, role, text, n) of ``rows``, NULL roles and texts as one space, equal rows counted in n."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dice = F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % 20 if damage else F.lit(19)
    text = F.when(dice == 1, "").when(dice == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    return (
        rows.filter(dice != 0)
        .select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c"), "conv_id",
                F.col("turn").cast("long").alias("turn"), F.when(dice == 4, "user").otherwise(said("role")).alias("role"),
                text.alias("text"), F.when(dice == 3, 2).otherwise(1).alias("copies"))
        .groupBy("c", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    )


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in a written table with their place ``at``, which rises along each conversation, and their faults by place.

    Ranges of (conversation, turn, digest) are dealt out, so a hot conversation spreads over tasks.
    """
    rows = rows.withColumn("said", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("said")]
    at = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    at = materialize(at, "repair-rows")
    first = at.groupBy("c", "said").agg(F.min("at").alias("first"))
    repeated = at.select("c", "said", "at").join(first, ["c", "said"]).filter("at > first").select("at", F.lit(True).alias("again"))
    bare = F.rtrim("text", F.lit(SPACES))
    faults = (
        at.select("c", "at", "n", F.expr(f"at div {BLOCK}").alias("block"), F.substring("role", 1, 1).alias("initial"),
                  (F.length(bare) == 0).alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
        .join(repeated, "at", "left")
        .withColumn("fault", F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("cut"), 3).otherwise(0))
        .select("c", "at", "n", "block", "initial", "fault")
    )
    return at.drop("said"), materialize(faults, "repair-faults")


def _arcs(after: np.ndarray, initial: np.ndarray, fault: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs (label D I K R, rows, states, ...) of each arc out of a row's nodes and the nodes' own least costs."""
    shape = (len(n), *[1] * (after.ndim - 1))
    after = after + (DELETE * (n - 1)).reshape(shape)
    cut = np.where(fault == 3, TRUNCATED, 0).reshape(shape)
    barred = np.where((fault == 1) | (fault == 2), FAR, 0).reshape(shape)
    goes = KEPT[initial]
    kept = np.take_along_axis(after, goes.clip(0).reshape(*goes.shape, *[1] * (after.ndim - 2)), 1)
    kept = kept + np.where(goes < 0, FAR, 0).reshape(*goes.shape, *[1] * (after.ndim - 2))
    arcs = np.stack([after + DELETE, np.full_like(after, FAR), kept + KEEP + cut + barred, after[:, SPOKEN] + REROLE + cut + barred])
    least = arcs.min(0)
    arcs[1, :, [USER, ASSISTANT]] = np.moveaxis(least[:, [ASSISTANT, USER]], 1, 0) + INSERT  # two inserts never lead back at a gain
    least = np.minimum(least, arcs[1])
    arcs[1, :, [START, SYSTEM]] = least[:, USER] + INSERT
    least = np.minimum(least, arcs[1])
    return np.minimum(arcs, FAR), np.minimum(least, FAR)


class Block:
    """The rows of one block, in order; a segment is what it holds of one conversation."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("at", ignore_index=True)
        self.rows, self.names = rows, rows["c"].to_numpy()
        begins = np.r_[True, self.names[1:] != self.names[:-1]]
        self.first = np.flatnonzero(begins)
        self.segment = np.cumsum(begins) - 1
        self.last = np.r_[self.first[1:], len(rows)] - 1
        self.initial = rows["initial"].map({"s": 0, "u": 1, "a": 2}).fillna(3).to_numpy(np.int64)
        self.fault, self.n = rows["fault"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)

    def costs(self, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least cost from every node to the segment's end, where it is ``end`` (segments, states, ...), and of every arc."""
        cost = np.empty((len(self.rows), *end.shape[1:]), np.int64)
        arcs = np.empty((4, *cost.shape), np.int64)
        after, row = end, self.last.copy()
        live = np.arange(len(row))
        while len(live):
            at = row[live]
            arcs[:, at], cost[at] = _arcs(after[live], self.initial[at], self.fault[at], self.n[at])
            after = after.copy() if after is end else after
            after[live] = cost[at]
            row[live] -= 1
            live = live[row[live] >= self.first[live]]
        return cost, arcs

    def least_path(self, cost: np.ndarray, arcs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Doubled pointers, chosen arc labels and ranks of all nodes.

        A node is 4 * row + state; the four nodes behind a segment's last row are sinks. A node's arcs have
        different labels, so its least first label fixes one pointer; ranks of audits of 1, 2, 4 ... labels
        follow from the ranks of both halves while pointers are doubled, and the final ranks choose the arc
        with the least (label, rank of the rest).
        """
        m, state = len(self.rows), np.arange(4)
        row = np.arange(m)[:, None]
        behind = 4 * np.where(row == self.last[self.segment][:, None], m + self.segment[:, None], row + 1)
        to = np.stack([behind + state, np.broadcast_to(4 * row + SPOKEN, (m, 4)), behind + KEPT[self.initial].clip(0), behind + SPOKEN])
        optimal = (arcs == cost[None]) & (arcs < FAR)
        label = optimal.argmax(0)
        sinks = 4 * m + np.arange(4 * len(self.first))
        pointer = np.r_[np.take_along_axis(to, label[None], 0).ravel(), sinks]
        rank = np.r_[1 + label.ravel(), np.zeros(len(sinks), np.int64)]
        pointers = [pointer]
        while (pointer[:4 * m] < 4 * m).any():
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
            pointers.append(pointer)
        key = np.where(optimal, np.arange(4)[:, None, None] * (int(rank.max()) + 1) + rank[to], FAR)
        return pointers, key.argmin(0), rank

    def walked(self, pointers: list[np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, node) in order along the path of each segment from its entry state, by doubled pointers."""
        segment, node = np.arange(len(self.first)), 4 * self.first + start
        step = np.zeros(len(node), np.int64)
        for k, pointer in enumerate(pointers):
            further = pointer[node]
            real = further < 4 * len(self.rows)
            segment, node = np.r_[segment, segment[real]], np.r_[node, further[real]]
            step = np.r_[step, step[real] + (1 << k)]
        order = np.lexsort((step, segment))
        return segment[order], node[order]


def _split_costs(rows: pd.DataFrame) -> pd.DataFrame:
    """Per (conversation, block) the matrix of least costs from each entry state to each state behind its last row."""
    block = Block(rows)
    end = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, FAR), (len(block.first), 4, 4))
    cost, _ = block.costs(end)
    return pd.DataFrame({"c": block.names[block.first], "block": rows["block"].iloc[0],
                         "costs": [cost[i].ravel() for i in block.first]})


def _behind(pieces: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each block of one conversation, from its last block to its first."""
    pieces = pieces.sort_values("block", ascending=False)
    after, out = END.astype(np.int64), []
    for costs in pieces["costs"]:
        out.append(after)
        after = np.minimum((np.asarray(costs).reshape(4, 4) + after[None]).min(1), FAR)
    return pd.DataFrame({"c": pieces["c"], "block": pieces["block"], "behind": out})


def _ends(block: Block, rows: pd.DataFrame) -> np.ndarray:
    given = rows["behind"].iloc[block.first] if "behind" in rows else []
    return np.array([END if b is None else b for b in given], np.int64).reshape(-1, 4)


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """Per (conversation, block) the state behind its last row by entry state, along the least audit."""
    block = Block(rows)
    pointers, _, _ = block.least_path(*block.costs(_ends(block, block.rows)))
    exits = np.stack([pointers[-1][4 * block.first + s] % 4 for s in range(4)], 1)
    return pd.DataFrame({"c": block.names[block.first], "block": rows["block"].iloc[0], "exits": list(exits)})


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """Entry state of each block of one conversation, from its first block to its last."""
    pieces = pieces.sort_values("block")
    state, out = START, []
    for exits in pieces["exits"]:
        out.append(state)
        state = int(exits[state])
    return pd.DataFrame({"c": pieces["c"], "block": pieces["block"], "entry": out})


def _edits(rows: pd.DataFrame) -> pd.DataFrame:
    """Edits of every row: their initials, the roles inserted before and behind it, and its own role (NULL: deleted)."""
    block = Block(rows)
    rows = block.rows
    end = _ends(block, rows)
    pointers, label, _ = block.least_path(*block.costs(end))
    start = rows["entry"].iloc[block.first].fillna(START).to_numpy(np.int64)
    _, node = block.walked(pointers, start)
    row, state = np.divmod(node, 4)
    action = label[row, state]
    m = len(rows)
    edits, before, own, behind = [""] * m, [""] * m, [""] * m, [""] * m
    for r, s, a in zip(row.tolist(), state.tolist(), action.tolist()):
        spoken = "a" if SPOKEN[s] == ASSISTANT else "u"
        edits[r] += "DIKR"[a]
        if a == 1:
            before[r] += spoken
        elif a:
            own[r] = "k" if a == 2 else spoken
    last = (pointers[-1][4 * block.first + start] % 4).tolist()
    final = rows["final"].iloc[block.first].tolist()
    for r, s, f in zip(block.last.tolist(), last, final):
        while f and s not in (START, ASSISTANT):  # inserts behind the last row
            s = int(SPOKEN[s])
            behind[r] += "a" if s == ASSISTANT else "u"
    return pd.DataFrame({"at": rows["at"], "edits": edits, "before": before, "own": own, "behind": behind})


RESULT = pa.schema([
    ("c", pa.string()), *[(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.large_string()), ("repaired_sha256", pa.string()),
])
COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
ROLES = {"u": "user", "a": "assistant"}


def _digests(batches):
    """Counts, audit and hash of each conversation from its rows in order; only the audit is held, not the texts."""
    name, out = None, []

    def close():
        known = high is not None
        out.append((name, high - low + 1 - turns if known else 0, *faults, illegal, cost, "".join(audit), sha.hexdigest()))

    def emit():
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RESULT)], schema=RESULT)
        out.clear()
        return batch

    for batch in batches:
        for c, turn, role, text, n, fault, edits, before, own, behind in zip(*(col.to_pylist() for col in batch.columns)):
            if c != name:
                if name is not None:
                    close()
                name, low, high, turns, faults, illegal, cost, audit, sha, any_line, last = c, None, None, 0, [0, 0, 0], 0, 0, [], hashlib.sha256(), False, None
            if turn is not None:
                turns += turn != high
                low, high = turn if low is None else low, turn
            initial = role[:1]
            if last is not None:
                illegal += last + initial not in ("su", "ua", "au")
            illegal += n - 1
            last = initial
            faults[0] += n if fault == 1 else 0
            faults[1] += n if fault == 2 else n - 1 if fault != 1 else 0
            faults[2] += fault == 3
            audit.append(edits + "D" * (n - 1) + "I" * len(behind))
            cost += sum(COSTS[e] for e in audit[-1]) + (TRUNCATED if fault == 3 and own else 0)
            lines = [ROLES[r] + ":" for r in before]
            if own:
                lines.append(f"{role if own == 'k' else ROLES[own]}:{text}")
            lines += [ROLES[r] + ":" for r in behind]
            for line in lines:
                sha.update(b"\n" * any_line + line.encode("utf-8", "replace"))
                any_line = True
            if len(out) >= 500:
                yield emit()
    if name is not None:
        close()
    if out:
        yield emit()


def repair(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """Faults, cheapest edits and the repaired conversation's hash, one row per conv_id.

    Faults, edits and costs are those of the module's constants: a blank or repeated row must go, a
    truncated row costs more while it stays. Of equally cheap edits those whose initials (K R D I) come
    first in ASCII order are taken. With ``damage`` rows are first damaged by a hash of conversation and
    turn, to test the repair.

    Rows of a conversation are ordered by turn (NULL first), equal turns by a digest of role and text. NULL roles and texts
    are one space, NULL conv_id is a conversation of its own. Equal rows are repeats of the first. A
    conversation without rows after damage has zeros, an empty audit and the hash of nothing. An empty
    table gives an empty result; other columns are not read. Blocks of one conversation are dealt out;
    what one task holds of a conversation grows by 128 bytes per 8,192 rows and by its audit.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    at, slim = placed(damaged(rows, damage))
    spans = slim.groupBy("c").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    split = materialize(slim.join(spans.filter("low < high"), "c").drop("low", "high"), "repair-split")
    pieces = split.groupBy("block").applyInPandas(_split_costs, "c string, block long, costs array<long>")
    behind = materialize(pieces.groupBy("c").applyInPandas(_behind, "c string, block long, behind array<long>"), "repair-behind")
    exits = (
        split.join(behind, ["c", "block"]).groupBy("block")
        .applyInPandas(_exits, "c string, block long, exits array<long>")
    )
    entries = exits.groupBy("c").applyInPandas(_entries, "c string, block long, entry long")
    known = behind.join(entries, ["c", "block"])
    ready = (
        slim.join(spans.select("c", "high"), "c").withColumn("final", F.col("block") == F.col("high")).drop("high")
        .join(known, ["c", "block"], "left")
    )
    schema = "at long, edits string, before string, own string, behind string"
    edits = ready.groupBy("block").applyInPandas(_edits, schema)
    told = (
        at.join(slim.select("at", "fault"), "at").join(edits, "at")
        .repartition("c").sortWithinPartitions("c", "at")
        .select("c", "turn", "role", "text", "n", "fault", "edits", "before", "own", "behind")
    )
    ddl = "c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    done = told.mapInArrow(_digests, ddl)
    names = rows.select("conv_id").distinct().withColumn(
        "c", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    counts: list[Column] = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return names.join(done, "c", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))
