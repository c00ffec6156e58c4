"""Jaccard join of word n-grams as a blocked sparse matrix product, and the components of its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import LONGEST_WORD, components, found_rows, veiled, worker_memory
from cardwatch.session import materialize

#: Words of an n-gram; two sets link if PART * common >= WHOLE * (sum of sizes), which is a Jaccard index of 0.8.
WORDS, PART, WHOLE = 5, 9, 4
#: One in EVERY documents is looked at to find frequent n-grams (all of fewer than SAMPLE documents), how often
#: such an n-gram occurs among those, and how many n-grams are kept.
EVERY, SAMPLE, FREQUENT, MOST_FREQUENT = 32, 8192, 2, 200_000
#: Columns of the incidence matrix up to this length give their pairs at once; nodes in a block of a
#: group, and shared n-grams multiplied at once.
SHORT, BLOCK, SLICE = 256, 512, 2048
REMEMBERED = 120_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class NGrams:
    """Sorted distinct 64-bit hashes of a text's n-grams; a shorter text is one n-gram as a whole."""

    def __init__(self):
        self.seen: dict[bytes, int] = worker_memory("ngram_join")

    def __call__(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        more = {}
        for w in set(words).difference(self.seen):
            (self.seen if len(w) <= LONGEST_WORD else more)[w] = xxhash.xxh3_64_intdigest(w)
        known = (lambda w: more[w] if w in more else self.seen[w]) if more else self.seen.__getitem__
        h = np.fromiter(map(known, words), np.uint64, len(words))
        n = min(WORDS, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = _mix((out + h[i:len(h) - n + 1 + i]) * ODD)
        return np.unique(out)


def name_of(grams: np.ndarray) -> int:
    """64-bit name of a set, the same for equal sets."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def least_common(n: np.ndarray) -> np.ndarray:
    """What a set of ``n`` must share with any set it links to: its size times 0.8, rounded up."""
    return -(-WHOLE * n // (PART - WHOLE))


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))


def gram_sets(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, h, n, node): hash of the text, size of the set and its name (NULL if empty)."""

    def measure(batches):
        grams = NGrams()
        for batch in batches:
            found = [grams(r.as_py()) for r in batch.column("raw")]
            n = pa.array([len(g) for g in found], pa.int64())
            node = pa.array([name_of(g) if len(g) else None for g in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], n, node], ["doc_id", "h", "n", "node"])

    return _raw(docs).mapInArrow(measure, "doc_id long, h long, n long, node long")


def frequent_grams(docs: DataFrame, rows: int) -> np.ndarray:
    """N-grams that are frequent in a sample of documents. They only go last in the order of n-grams.

    Any order gives the same links; this one keeps passages that many documents share out of the
    short beginnings that are compared.
    """
    every = min(EVERY, max(1, rows // SAMPLE))

    def spread(batches):
        grams = NGrams()
        for batch in batches:
            found = {name_of(g): g for r in batch.column("raw") if len(g := grams(r.as_py()))}
            if found:
                values, counts = np.unique(np.concatenate(list(found.values())), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["gram", "n"])

    some = _raw(docs).filter(F.pmod(F.xxhash64("doc_id", "h"), F.lit(every)) == 0)
    counted = some.mapInArrow(spread, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT).select("gram").toArrow()
    return np.sort(top.column("gram").to_numpy().astype(np.int64).view(np.uint64))


def beginnings(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Incidence rows (gram, node, n) of each set's first n-grams, infrequent ones first.

    Sets that link share at least ``least_common`` n-grams, so their beginnings, which leave out one
    less than that, have one in common. Copies within a task are taken once.
    """

    frequent = np.append(frequent, np.uint64(2**64 - 1))  # a place for what is above all

    def spread(batches):
        grams, known = NGrams(), set()
        for batch in batches:
            out = []
            for r in batch.column("raw"):
                g = grams(r.as_py())
                if not len(g) or (node := name_of(g)) in known:
                    continue
                if len(known) > REMEMBERED:
                    known.clear()
                known.add(node)
                last = frequent[np.searchsorted(frequent, g)] == g
                first = np.concatenate([g[~last], g[last]])[:len(g) - int(least_common(len(g))) + 1]
                out.append((first, node, len(g)))
            if out:
                lengths = [len(f) for f, _, _ in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([f for f, _, _ in out]).view(np.int64)),
                    pa.array(np.repeat(np.array([n for _, n, _ in out], np.int64), lengths)),
                    pa.array(np.repeat(np.array([s for _, _, s in out], np.int64), lengths))], ["gram", "node", "n"])

    return _raw(docs).mapInArrow(spread, "gram long, node long, n long")


def _arrays(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _overlaps(columns: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows (a, b, size of a, size of b, common) over some short columns: one product of their entries."""
    parts = []
    for length in {len(c[0]) for c in columns}:
        same = [c for c in columns if len(c[0]) == length]
        nodes, sizes = np.stack([c[0] for c in same]), np.stack([c[1] for c in same])
        i, j = np.triu_indices(length, 1)
        a, b, na, nb = nodes[:, i].ravel(), nodes[:, j].ravel(), sizes[:, i].ravel(), sizes[:, j].ravel()
        near = (PART - WHOLE) * np.minimum(na, nb) >= WHOLE * np.maximum(na, nb)
        parts.append(np.stack([a, b, na, nb], axis=1)[near])
    rows, counts = np.unique(np.concatenate(parts), axis=0, return_counts=True)
    return np.concatenate([rows, counts[:, None]], axis=1)


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the incidence matrix, sorted by n-gram: overlap counts of short ones, the nodes of long ones.

    Long columns come out as (first node, node, 0, 0, 0), a star that holds their nodes together.
    """
    names = ["a", "b", "na", "nb", "common"]

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(5)], names)

    def star(center: int, nodes: np.ndarray) -> pa.RecordBatch:
        rows = np.zeros((len(nodes), 5), np.int64)
        rows[:, 0], rows[:, 1] = center, nodes
        return emit(rows)

    held = [np.zeros(0, np.int64)] * 3  # the last column so far, which may go on
    center = None  # first node of that column once it is long
    for batch in batches:
        gram, node, n = (np.concatenate(x) for x in zip(held, _arrays(batch, ["gram", "node", "n"])))
        if not len(gram):
            continue
        fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])])
        gram, node, n = gram[fresh], node[fresh], n[fresh]
        starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        ends = np.concatenate([starts[1:], [len(gram)]])
        columns, pending = [], 0
        for k in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == len(starts) - 1) | (np.arange(len(starts)) == 0)):
            low, high, final = starts[k], ends[k], k == len(starts) - 1
            if k or center is None:
                center = None
                if high - low > SHORT:
                    center = int(node[low])
            if center is not None:
                yield star(center, node[low:high])
                if final:
                    held = [x[high - 1:high] for x in (gram, node, n)]
                else:
                    center = None
            elif final:
                held = [x[low:high] for x in (gram, node, n)]
            elif high - low > 1:
                columns.append((node[low:high], n[low:high]))
                pending += (high - low) ** 2
                if pending > 100_000:
                    yield emit(_overlaps(columns))
                    columns, pending = [], 0
        if columns:
            yield emit(_overlaps(columns))
    if center is None and len(held[0]) > 1:
        yield emit(_overlaps([(held[1], held[2])]))


def candidates(docs: DataFrame, rows: int) -> DataFrame:
    """Pairs (a, b) of sets that may link, and stars over the nodes of long columns."""
    entries = beginnings(docs, frequent_grams(docs, rows))
    ordered = entries.repartition("gram").sortWithinPartitions("gram", "node")
    product = ordered.mapInArrow(_products, "a long, b long, na long, nb long, common long")
    counted = product.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    # beyond the beginnings a pair can share at most what the larger set has left there
    room = F.floor((WHOLE * F.greatest("na", "nb") + PART - WHOLE - 1) / (PART - WHOLE)) - 1
    possible = PART * (F.col("common") + room) >= WHOLE * (F.col("na") + F.col("nb"))
    return counted.filter((F.col("common") == 0) | possible).select("a", "b")


def _linked(grams: list[np.ndarray]) -> np.ndarray:
    """Matrix of links among sets: the sparse product of a block, in slices of its shared columns."""
    sizes = np.array([len(g) for g in grams])
    if len(grams) == 2:
        common = np.array([[0, len(np.intersect1d(*grams, assume_unique=True))]] * 2)
        common[1] = common[0, ::-1]
    else:
        values, column = np.unique(np.concatenate(grams), return_inverse=True)
        owner = np.repeat(np.arange(len(grams)), sizes)
        shared = np.bincount(column, minlength=len(values)) > 1
        place = np.cumsum(shared) - 1
        owner, column = owner[shared[column]], place[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(grams), len(grams)), np.float32)
        for low in range(0, int(shared.sum()), SLICE):
            i, j = np.searchsorted(column, [low, low + SLICE])
            part = np.zeros((len(grams), SLICE), np.float32)
            part[owner[i:j], column[i:j] - low] = 1
            common += part @ part.T
    return PART * common >= WHOLE * (sizes[:, None] + sizes[None])


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each row reaches over the links."""
    np.fill_diagonal(linked, True)
    label = np.arange(len(linked))
    while True:
        lower = np.where(linked, label[None], len(linked)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sets, sorted by block: a spanning forest of each block's links."""

    def edges(block: dict[int, np.ndarray]) -> pa.RecordBatch:
        nodes, a, b = np.array(list(block), np.int64), [], []
        if len(nodes) > 1:
            root = _forest(_linked(list(block.values())))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            a, b = nodes[moved], nodes[root[moved]]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key, block = None, {}
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("grp", "i", "j", "node", "grams"))):
            grp, i, j, node, grams = (v.as_py() for v in row)
            if (grp, i, j) != key:
                if len(block) > 1:
                    yield edges(block)
                key, block = (grp, i, j), {}
            block[node] = np.frombuffer(grams, np.uint64)
    if len(block) > 1:
        yield edges(block)


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) between names of sets with the same components as all links have.

    Candidates are grouped by their components; a set travels to its group once per block of the group,
    and each pair of blocks is multiplied in a task of its own.
    """
    near = materialize(candidates(docs, sets.count()), "join-candidates")
    groups = materialize(components(near, "join-group"), "join-groups")
    sized = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    chosen = sets.join(groups, "node").groupBy("node", "root").agg(F.min(F.struct("doc_id", "h")).alias("doc"))
    wanted = chosen.join(sized, "root").select(
        "node", "parts", F.col("root").alias("grp"), F.col("doc.doc_id").alias("own_id"), F.col("doc.h").alias("own_h"))
    texts = found_rows(_raw(docs), wanted, "join-wanted")

    def build(batches):
        grams = NGrams()
        for batch in batches:
            packed = pa.array([grams(r.as_py()).tobytes() for r in batch.column("raw")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("grp", "parts", "node")), packed],
                                             ["grp", "parts", "node", "grams"])

    full = texts.select("raw", "node", "grp", "parts").mapInArrow(build, "grp long, parts int, node long, grams binary")
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    blocks = full.select("grp", "node", "grams", own.alias("own"), other.alias("other")).select(
        "grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "grams")
    return blocks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(_compare, "a long, b long")


def join_classes(docs: DataFrame) -> DataFrame:
    """Per document row its set's size, and the smallest doc_id that it reaches over links.

    Lower-cases A-Z, takes words between ASCII white space and distinct 5-word n-grams (a shorter
    text: all its words as one). Two documents link if their sets have a Jaccard index of 0.8 or
    more; equal sets always do. Sets are compared by 64-bit hashes. Only sets that differ are
    compared, each once per block; classes are found from spanning forests, so copies are never
    expanded into pairs.

    NULL, empty and blank texts: size 0, linked with nothing, a class of their own. NULL doc_id is kept;
    a class's doc_id is the smallest that is not NULL. Repeated rows are in one class. An empty
    table gives an empty result. Other columns are not read. Returns doc_id, h (hash of the text),
    n_shingles, node (name of the set) and component_id.
    """
    sets = materialize(gram_sets(docs), "join-rows")
    roots = materialize(components(links(docs, sets), "join-class"), "join-roots")
    named = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    classed = materialize(named.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("class"), "least"), "join-classes")
    least = classed.groupBy("class").agg(F.min("least").alias("component_id"))
    by_node = classed.select("node", "class").join(least, "class")
    linked = sets.join(by_node, "node", "left")
    return linked.select("doc_id", "h", F.col("n").alias("n_shingles"), "node", "class",
                         F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of every class stays: the one with the smallest doc_id (then the smallest text hash).

    Documents without words have no class and stay. Repeated rows of the one that stays: one stays.
    Columns of ``docs`` come back as they were.
    """
    classes = materialize(join_classes(docs), "join-result")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = classes.filter("node is not null").groupBy("class").agg(F.min(order).alias("first"))
    stay = first.select(F.col("first.doc_id").alias("own_id"), F.col("first.h").alias("own_h"))
    plain, at = veiled(docs)
    words = F.coalesce(F.col(at["text"]), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = plain.filter(words).withColumns({"doc_id": F.col(at["doc_id"]), "h": F.xxhash64(at["text"])})
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))
    kept = marked.join(stay, same, "left_semi").dropDuplicates(["doc_id", "h"]).drop("doc_id", "h")
    return kept.union(plain.filter(~words)).toDF(*docs.columns)
