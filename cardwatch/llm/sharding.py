"""Minimax contiguous sharding: the smallest feasible capacity over ordered atomic groups, then cut there."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import numbered
from cardwatch.session import materialize

#: Hash bits of the first block table, and bits added at each refinement.
FIRST_BITS, MORE_BITS = 12, 10
#: A group above 1/HEAVY of a shard is handled by name; at most HEAVY groups per shard can be.
HEAVY = 256


class Blocks:
    """Ordered items: single groups (atomic) and hash blocks of many small groups (divisible for now)."""

    def __init__(self, key, bits, size, atomic, heavy):
        self.key, self.bits = np.array(key, np.int64), np.array(bits, np.int64)
        self.atomic, self.heavy = np.array(atomic, bool), np.array(heavy, bool)
        self.size = np.array(size, np.int64)
        self.before = np.concatenate([[0], np.cumsum(self.size)])

    def greedy(self, capacity: int, shards: int, divisible: bool) -> tuple[bool, list[int]]:
        """Fill shards from the left; cut weights, and whether all items found a place."""
        at, cuts, total = 0, [], int(self.before[-1])
        for _ in range(shards):
            if at >= total:
                cuts.append(total)
                continue
            to = min(at + capacity, total)
            i = int(np.searchsorted(self.before, to, "right")) - 1
            if i < len(self.size) and not (divisible and not self.atomic[i]):
                to = int(self.before[i])
            at = max(at, to)
            cuts.append(at)
        return at >= total, cuts

    def smallest(self, shards: int, divisible: bool) -> int:
        """Binary search of the smallest capacity for which the greedy filling fits."""
        low, high = -(-int(self.before[-1]) // shards), int(self.before[-1])
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, divisible)[0]:
                high = mid
            else:
                low = mid + 1
        return low


def _block_sums(light: DataFrame, bits: int, within: tuple[int, list[int]] | None = None) -> list:
    if within:
        parent_bits, ids = within
        light = light.filter(F.shiftright("h", 64 - parent_bits).isin(ids))
    block = F.shiftright("h", 64 - bits).alias("block")
    rows = light.groupBy(block).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    return sorted((r["block"], r["bytes"], r["n"]) for r in rows)


def _order(heavy: list, blocks: list, shards: int) -> Blocks:
    """Large groups are spread over the order, so that each shard can be filled up with small ones."""
    load, lanes = [0] * shards, [[] for _ in range(shards)]
    for h, size in heavy:
        lane = load.index(min(load))
        load[lane] += size
        lanes[lane].append((h, 64, size, True, True))
    level = (sum(load) + sum(b[1] for b in blocks)) / shards
    items, i, used, due = [], 0, 0, 0.0
    for lane in range(shards):
        items += lanes[lane]
        due += max(0.0, level - load[lane])
        while i < len(blocks) and (used < due or lane == shards - 1):
            key, size, n = blocks[i]
            items.append((key << (64 - FIRST_BITS), FIRST_BITS, size, n == 1, False))
            used, i = used + size, i + 1
    return Blocks(*zip(*items)) if items else Blocks([], [], [], [], [])


def plan_cuts(groups: DataFrame, shards: int) -> tuple[dict[int, int], list[int]]:
    """Shard of every large group, and the hash values at which the small groups' shards begin.

    The driver holds block totals only (a few thousand rows), never the groups. Treating blocks as
    divisible bounds the capacity from below, as atomic from above; blocks in which a cut may fall
    are split further until both bounds meet, so the capacity is exactly the smallest one.
    """
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    limit = total // (shards * HEAVY)
    heavy = [(r["h"], r["bytes"]) for r in groups.filter(F.col("bytes") > limit).collect()]
    heavy.sort(key=lambda r: (-r[1], r[0]))
    light = groups.filter(F.col("bytes") <= limit)
    named, first, rest = {}, 0, total
    while heavy and shards - first > 1 and heavy[0][1] * (shards - first) >= rest:
        h, size = heavy.pop(0)
        named[h], rest, first = first, rest - size, first + 1
    left = shards - first
    items = _order(heavy, _block_sums(light, FIRST_BITS), left)
    while True:
        low, high = items.smallest(left, True), items.smallest(left, False)
        if low == high:
            break
        lower, upper = items.greedy(low, left, False)[1], items.greedy(high, left, True)[1]
        touched = np.zeros(len(items.size), bool)
        for a, b in zip(lower, upper):
            touched |= (items.before[1:] > a) & (items.before[:-1] < max(b, a + 1))
        open_ = np.flatnonzero(touched & ~items.atomic)
        if not len(open_):
            open_ = np.flatnonzero(~items.atomic)
        parts = {}
        for bits in sorted(set(items.bits[open_].tolist())):
            finer = min(64, bits + MORE_BITS)
            ids = [int(items.key[i]) >> (64 - bits) for i in open_ if items.bits[i] == bits]
            for key, size, n in _block_sums(light, finer, (bits, ids)):
                start = key << (64 - finer)
                parts.setdefault(((start >> (64 - bits)) << (64 - bits), bits), []).append(
                    (start, finer, size, n == 1 or finer == 64, False))
        rows = []
        for i in range(len(items.size)):
            row = (int(items.key[i]), int(items.bits[i]), int(items.size[i]), bool(items.atomic[i]), bool(items.heavy[i]))
            rows += parts.get(row[:2], [row]) if not row[3] else [row]
        items = Blocks(*zip(*rows))
    cuts = items.greedy(high, left, False)[1]
    shard = first + np.searchsorted(np.array(cuts), items.before[:-1], "right").clip(0, left - 1)
    named |= {int(h): int(s) for h, s, big in zip(items.key, shard, items.heavy) if big}
    small = ~items.heavy
    starts = []
    for s in range(first + 1, shards):
        keys = items.key[small & (shard >= s)]
        starts.append(int(keys[0]) if len(keys) else 2**63 - 1)
    return named, ([-2**63] * first + starts)


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Deal documents into ``shards`` shards of nearly equal bytes; equal texts stay in one shard.

    Groups are documents with equal text (by 64-bit hash), ordered by that hash; their size is the
    bytes of all copies, one more per document for the separator. The largest shard is as small as
    any contiguous cut of that order allows. A group larger than a fair share gets a shard of its
    own. Returns ``doc_id``, size, text_crc32, shard, slot (gapless from 0 in each shard) per row.

    NULL text: no bytes (size 1, checksum of the empty string), one group of its own. Empty text:
    size 1. Repeated rows are placed like any copy, each with its own slot. NULL doc_id is kept. An
    empty table gives an empty result. Other columns are not read.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(text).alias("h")), "shard-rows")
    groups = materialize(slim.groupBy("h").agg(F.sum("size").alias("bytes")), "shard-groups")
    named, starts = plan_cuts(groups, shards)
    place = sum((F.col("h") >= F.lit(s)).cast("int") for s in starts) if starts else F.lit(0)
    spark = docs.sparkSession
    large = spark.createDataFrame(sorted(named.items()), "h long, fixed int")
    placed = slim.join(F.broadcast(large), "h", "left").select(
        "doc_id", "size", "text_crc32", F.coalesce("fixed", place).cast("int").alias("shard"))
    return numbered(placed, ["shard"], ["doc_id", "text_crc32"], "slot")
