"""Mixing sources to target weights: a hypergeometric splitting tree deals exact quotas to output shards."""

from __future__ import annotations

import math
import re
from decimal import Decimal
from fractions import Fraction
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import buckets_for, numbered, small_table, veiled, worker_memory
from cardwatch.session import materialize

#: Weights by the sources' order, share of all words that the mix takes, and how often a source may go in at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), Fraction(3, 2), 2
#: Size classes per doubling of a document's words; output shards.
STEPS, SHARDS = 16, 8
#: Blocks that sources are dealt into; the driver sees one row of totals per block.
BLOCKS = 4096
#: Numbers below which the hypergeometric draw is made at once.
MOST_AT_ONCE = 10**9
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def first_words(text: str, words: int) -> str:
    """The text up to the end of so many words, on its own bytes."""
    raw = text.encode()
    last = next(islice(WORD.finditer(raw), words - 1, None))
    return raw[:last.end()].decode()


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> list[Fraction]:
    """Words to take from each source: by weight, none above ``most`` times its size, the excess shared anew."""
    left, out = share * sum(sizes), [Fraction(0)] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    open_ = list(range(len(sizes)))
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = [i for i in open_ if unit * weight[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * weight[i]
            break
        for i in over:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        gone = set(over)
        open_ = [i for i in open_ if i not in gone]
    return out


def class_quotas(fraction: Fraction, classes: list[tuple[int, int]]) -> list[int]:
    """Documents to draw per size class (number, words), so that the running words stay near the fraction."""
    quotas, seen, taken = [], Fraction(0), Fraction(0)
    for n, words in classes:
        seen += words
        mean = Fraction(words, n)
        q = 0 if not words else min(n, max(0, round((fraction * seen - taken) / mean)))
        quotas.append(q)
        taken += q * mean
    return quotas


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among ``n`` drawn, exact for any numbers.

    Above 10^9, where the library's draw ends, every item is put into one of two halves by a fair coin, as the
    items below and above the middle of independent uniform numbers; the half that holds the n-th smallest
    number is looked at further, a half below it is drawn as a whole.
    """
    got = 0
    while good + bad >= MOST_AT_ONCE:
        g, b = int(rng.binomial(good, 0.5)), int(rng.binomial(bad, 0.5))
        if g + b <= n:
            got, n, good, bad = got + g, n - g - b, good - g, bad - b
        else:
            good, bad = g, b
    return got + (int(rng.hypergeometric(good, bad, n)) if n else 0)


def splitting_tree(quotas: list[int], shards: int, seed: list[int], room: list[int] | None = None) -> np.ndarray:
    """Quota per shard and class: each node splits its quotas at random between two halves of the shards.

    The shards take equal numbers, or what ``room`` says for each.
    """
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(quota: list[int], low: int, high: int) -> None:
        if high - low == 1:
            out[low] = quota
            return
        rng = np.random.default_rng([*seed, low, high])
        middle = (low + high) // 2
        rest, left = sum(quota), []
        want = sum(room[low:middle]) if room else rest * (middle - low) // (high - low)
        for q in quota:
            got = hypergeometric(rng, q, rest - q, want)
            left.append(got)
            rest, want = rest - q, want - got
        split(left, low, middle)
        split([q - x for q, x in zip(quota, left)], middle, high)

    split(quotas, 0, shards)
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1, row by row: a Feistel network, walked until it falls below n."""
    bits = np.maximum(2, np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1))
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            x, h, m = out[todo], half[todo], mask[todo]
            left, right = x >> h, x & m
            for turn in range(4):
                mixed = (right + np.uint64(key + turn)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((mixed >> np.uint64(32)) & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, h, size): words that ASCII white space separates, and a hash of the text."""
    raw = docs.select("doc_id", "source", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))

    def count(batches):
        worker_memory("mixing")
        for batch in batches:
            size = pa.array([len(x.as_py().split()) for x in batch.column("raw")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], size], ["doc_id", "source", "h", "size"])

    return raw.mapInArrow(count, "doc_id long, source string, h long, size long")


def source_table(strata: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Rows (name, sid, source_size, weight): sources numbered in code point order, NULL last, by ranges of names."""
    sizes = materialize(strata.groupBy(F.col("source").alias("name")).agg(F.sum("words").alias("source_size")), "mix-sizes")
    ranges = sizes.repartitionByRange(buckets_for(sizes.count(), 50_000), F.col("name").asc_nulls_last())
    dealt = materialize(ranges.withColumn("part", F.spark_partition_id()), "mix-ranges")
    # One row per range, a few thousand names each.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy(F.col("name").asc_nulls_last())
    named = dealt.withColumn("at", F.row_number().over(within) - 1).join(firsts, "part").select(
        "name", (F.col("first") + F.col("at")).alias("sid"), "source_size")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights)).cast("int") + 1)
    return materialize(named.withColumn("weight", turn.cast("long")), "mix-sources")


def water_level(sources: DataFrame, share: Fraction, most: int) -> Fraction:
    """Words per unit of weight at which the sources, none above ``most`` times its size, hold ``share`` of all words.

    Each round is one pass over the sources and gives back two sums; the level only rises.
    """
    words, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * words / weight
    while True:
        cap, part = (F.lit(Decimal(x)).cast("decimal(38,0)") for x in (level.denominator * most, level.numerator))
        over = part * F.col("weight") > cap * F.col("source_size")
        full, open_ = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)), F.sum(F.when(~over, F.col("weight")))).first()
        if not open_ or (higher := (share * words - most * full) / open_) == level:
            return level
        level = higher


def shard_ends(strata: DataFrame, level: Fraction, most: int, shards: int, seed: int) -> DataFrame:
    """Rows (sid, class, n, ends, target, aim): where each shard's part of a stratum ends, layer after layer.

    ``strata`` has sid, class, n, words, source_size and weight. Quotas follow from a source's own size classes,
    a few hundred at most. The splitting tree first splits the totals of blocks of sources, in the driver, then
    each block's strata by the block's part of every shard, which is the same draw.
    """
    layers = range(most + 1)

    def rules(pdf):
        rows = sorted(pdf[["sid", "class", "n", "words", "source_size", "weight"]].itertuples(index=False, name=None),
                      key=lambda r: (r[0], -r[1]))
        block, out = int(pdf["block"].iloc[0]), []
        for sid, part in groupby(rows, key=lambda r: r[0]):
            classes = [tuple(map(int, r[1:4])) for r in part if (last := r)]
            size, weight = int(last[4]), int(last[5])
            wanted = min(level * weight, Fraction(most * size))
            whole = int(wanted // size) if size else 0
            fraction = (wanted - whole * size) / size if size else Fraction(0)
            quotas = class_quotas(fraction, [c[1:] for c in classes])
            for (name, n, _), q in zip(classes, quotas):
                quota = [n if layer < whole and name >= 0 else q if layer == whole else 0 for layer in layers]
                out.append((int(sid), name, n, block, quota, float(wanted), math.floor(wanted + Fraction(1, 2))))
        return type(pdf)(out, columns=["sid", "class", "n", "block", "quota", "target", "aim"])

    blocked = strata.withColumn("block", F.pmod(F.col("sid"), F.lit(BLOCKS)))
    ruled = materialize(blocked.groupBy("block").applyInPandas(
        rules, "sid long, class int, n long, block long, quota array<long>, target double, aim long"), "mix-quotas")
    totals = ruled.groupBy("block").agg(*[F.sum(F.col("quota")[layer]) for layer in layers]).orderBy("block").collect()
    trees = [splitting_tree([r[1 + layer] for r in totals], shards, [seed, layer]) for layer in layers]
    rooms = small_table(ruled.sparkSession, [(r[0], [t[:, i].tolist() for t in trees]) for i, r in enumerate(totals)],
                        pa.schema([("block", pa.int64()), ("rooms", pa.list_(pa.list_(pa.int64())))]))

    def deal(pdf):
        pdf = pdf.sort_values(["sid", "class"], ascending=[True, False], ignore_index=True)
        block, rooms = int(pdf["block"].iloc[0]), pdf["rooms"].iloc[0]
        quotas = [[int(x) for x in q] for q in pdf["quota"]]
        ends = [np.cumsum(splitting_tree([q[layer] for q in quotas], shards, [seed, layer, block], [int(x) for x in rooms[layer]]), axis=0)
                for layer in layers]
        pdf["ends"] = np.concatenate(ends).T.tolist()
        return pdf[["sid", "class", "n", "ends", "target", "aim"]]

    return materialize(ruled.join(F.broadcast(rooms), "block").groupBy("block").applyInPandas(
        deal, "sid long, class int, n long, ends array<long>, target double, aim long"), "mix-ends")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST,
        shards: int = SHARDS, seed: int = 11) -> DataFrame:
    """Draw documents so that each source comes to its target of words; one row per document.

    Sources in code point order (NULL last) get ``weights`` in turn. A block is a document. Each source
    goes in whole as often as its target allows; of the rest an exact quota per size class is drawn:
    documents are numbered within (source, class), a keyed permutation reorders the numbers, and
    the first of them are drawn. A splitting tree divides the quotas of each layer among ``shards``,
    and the permuted numbers fall to the shards in that order, disjointly. One document per
    source is taken in part (its first words), so that the source meets its target to a word.
    Returns doc_id, h, source, size, source_size, target, taken and ``copies`` (layer, shard, words and
    a random place for the shuffle within the shard). A rerun gives the same rows.

    NULL text counts no words. Documents without words take nothing. Repeated rows are documents of
    their own. NULL doc_id is kept, NULL source is a source. An empty table gives an empty result.
    Sources may be any number: the driver sees the totals of ``BLOCKS`` blocks of them. Other columns are not read.
    """
    spark = docs.sparkSession
    schema = ("doc_id long, h long, source string, size long, source_size long, target double, taken long, "
              "copies array<struct<layer: int, shard: int, words: long, place: long>>")
    steps = F.floor(STEPS * F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double"))).cast("int")
    slim = materialize(word_counts(docs).withColumn("class", F.when(F.col("size") > 0, steps).otherwise(-1)), "mix-rows")
    strata = materialize(
        slim.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-strata")
    if strata.isEmpty():
        return spark.createDataFrame([], schema)
    sources = source_table(strata, weights)
    same = F.col("source").eqNullSafe(F.col("name"))
    ends = shard_ends(strata.join(sources, same), water_level(sources, share, most), most, shards, seed)
    layers = range(most + 1)

    def draw(frames):
        for pdf in frames:
            n, number, size = (pdf[c].to_numpy() for c in ("n", "number", "size"))
            end = np.stack(pdf["ends"].to_numpy()).reshape(len(pdf), len(layers), shards)
            copies: list[list] = [[] for _ in range(len(pdf))]
            for layer in layers:
                at = permuted(number, n, seed * 1000 + 10 * layer)
                shard = (at[:, None] >= end[:, layer]).sum(axis=1)
                for i in np.flatnonzero(shard < shards):
                    copies[i].append({"layer": layer, "shard": int(shard[i]), "words": int(size[i]), "place": 0})
            pdf["copies"] = copies
            yield pdf[["doc_id", "h", "source", "size", "sid", "class", "number", "copies"]]

    source_rows = materialize(
        sources.join(ends.groupBy("sid").agg(F.first("target").alias("target"), F.first("aim").alias("aim")), "sid")
        .select("sid", "source_size", "target", "aim"), "mix-targets")
    dealt = slim.join(sources.select("name", "sid"), same).select("doc_id", "h", "source", "size", "sid", "class")
    lined = numbered(materialize(dealt, "mix-dealt"), ["sid", "class"], ["doc_id", "h"], "number")
    copy = "array<struct<layer: int, shard: int, words: long, place: long>>"
    drawn = materialize(lined.join(ends.select("sid", "class", "n", "ends"), ["sid", "class"]).mapInPandas(
        draw, f"doc_id long, h long, source string, size long, sid long, class int, number long, copies {copy}"), "mix-drawn")
    return _to_the_word(drawn, source_rows, seed, copy, most, shards)


def _to_the_word(drawn: DataFrame, source_rows: DataFrame, seed: int, copy: str, most: int, shards: int) -> DataFrame:
    """Shorten one drawn copy per source, or add a part of one document, so that the words meet the target."""
    words = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    state = drawn.withColumn("taken", words)
    sums = state.groupBy("sid").agg(F.sum("taken").alias("got")).join(source_rows, "sid")
    gap = F.col("aim") - F.col("got")
    free = F.col("size") * most - F.col("taken")
    name = F.struct("class", "number")
    # the longest document that can give up a copy, and the one that has most room for more
    ends = state.groupBy("sid").agg(
        F.max(F.when(F.size("copies") > 0, F.struct("size", name.alias("row")))).alias("long"),
        F.max(F.struct(F.least(free, F.col("size")).alias("room"), name.alias("row"))).alias("wide"))
    # A written table: its size decides the join, so a large source is not dealt to one task.
    fix = materialize(sums.join(ends, "sid").select(
        "sid", "source_size", "target",
        F.when(gap < 0, F.greatest(gap, -F.col("long.size"))).otherwise(F.least(gap, F.col("wide.room"))).alias("gap"),
        F.when(gap < 0, F.col("long.row")).otherwise(F.col("wide.row")).alias("row")), "mix-fix")
    here = (F.col("row") == name) & (F.col("gap") != 0)
    less = F.transform("copies", lambda c, i: F.struct(
        c["layer"].alias("layer"), c["shard"].alias("shard"),
        (c["words"] + F.when(i == F.size("copies") - 1, F.col("gap")).otherwise(F.lit(0))).alias("words"), c["place"].alias("place")))
    more = F.concat("copies", F.array(F.struct(
        F.lit(most).alias("layer"), F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(shards)).cast("int").alias("shard"),
        F.col("gap").alias("words"), F.lit(0).cast("long").alias("place"))))
    fitted = F.when(here & (F.col("gap") < 0), less).when(here, more).otherwise(F.col("copies")).cast(copy)
    shuffled = F.transform("fitted", lambda c: F.struct(
        c["layer"].alias("layer"), c["shard"].alias("shard"), c["words"].alias("words"),
        F.xxhash64(F.lit(seed), c["layer"], F.col("sid"), F.col("class"), F.col("number")).alias("place")))
    return (
        state.join(fix, "sid").withColumn("fitted", fitted)
        .withColumn("copies", F.filter(shuffled, lambda c: c["words"] > 0))
        .select("doc_id", "h", "source", "size", "source_size", "target", words.alias("taken"), "copies")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per copy of a document, with the columns of ``docs``.

    Copies lie where the join puts them and are shuffled there by their random place. The one document
    per source that goes in partly keeps its first words with the white space between them, and ``n_chars`` is then its new length.
    Rows equal in doc_id and text share their copies.
    """
    plan = mix(docs, **options).filter(F.size("copies") > 0).groupBy(
        F.col("doc_id").alias("own_id"), F.col("h").alias("own_h")).agg(
        F.flatten(F.collect_list("copies")).alias("copies"), F.first("size").alias("size"))
    plain, at = veiled(docs)
    marked = plain.withColumns({"doc_id": F.col(at["doc_id"]), "h": F.xxhash64(at["text"])}).dropDuplicates(["doc_id", "h"])
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))
    each = marked.join(plan, same).select(*at.values(), "size", F.explode("copies").alias("copy"))
    each = each.select(*at.values(), "size", F.col("copy.words").alias("words"), F.col("copy.place").alias("place"))

    def cut(batches):
        for batch in batches:
            texts, sizes = batch.column(at["text"]).to_pylist(), batch.column(at["n_chars"]).to_pylist()
            for i, (size, words) in enumerate(zip(batch.column("size").to_pylist(), batch.column("words").to_pylist())):
                if words < size:
                    texts[i] = first_words(texts[i], words)
                    sizes[i] = len(texts[i])
            new = {at["text"]: pa.array(texts, pa.string()), at["n_chars"]: pa.array(sizes, pa.int64())}
            names = list(at.values())
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names)

    return each.sortWithinPartitions("place").mapInArrow(cut, plain.schema).toDF(*docs.columns)
