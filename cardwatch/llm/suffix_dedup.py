"""Removal of repeated byte strings by longest-previous-factor arrays over parts of the suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import found_keys, found_rows, trimmed, veiled, worker_memory
from cardwatch.session import materialize

#: Bytes of a repeated string, of the anchor that is chosen inside it, and of text that is hashed at once.
LENGTH, ANCHOR, PIECE = 200, 64, 1 << 19
#: Bytes of spans in one suffix array; an anchor with more different spans than this is dealt out by window.
AT_ONCE, MOST_SPANS = 1 << 18, 500
WIDE = LENGTH - ANCHOR + 1
#: Parts in which the places of one window are ordered.
SALTS = 32
#: Bits of a hash that give way to the position.
PLACE = np.uint64((1 << 22) - 1)
ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE = np.random.default_rng(17).integers(0, 2**63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchor_hashes(code: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position, by doubling the length."""
    h, size = BYTE[code], 1
    while size < ANCHOR:
        h = _mix(h[:-size] * ODD + h[size:])
        size *= 2
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours: running least values from both ends of blocks."""
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs_of(raws: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per run of windows that choose one anchor: anchor hash, span hash, text number, first window, windows.

    A window is a string of LENGTH bytes; it chooses the anchor with the least hash in it (the leftmost
    of equal ones), so equal windows choose equal anchors wherever they stand. A span is what the
    windows of a run cover. Long texts go through in pieces; a run then ends with its piece.
    """
    step = PIECE - LENGTH + 1  # pieces share bytes but no window
    parts = [(i, at, raw[at:at + PIECE]) for i, raw in enumerate(raws) for at in range(0, max(0, len(raw) - LENGTH) + 1, step)
             if len(raw) - at >= LENGTH]
    group, size = [], 0
    for part in [*parts, None]:
        if group and (part is None or size + len(part[2]) > PIECE):
            yield _runs(group)
            group, size = [], 0
        if part:
            group.append(part)
            size += len(part[2])


def _runs(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = b"".join(p[2] for p in parts)
    code = np.frombuffer(data, np.uint8)
    lengths = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(lengths)
    h = anchor_hashes(code)
    where = np.arange(len(h), dtype=np.uint64)
    chosen = sliding_least((h & ~PLACE) | where, WIDE) & PLACE
    valid = np.zeros(len(chosen) + 1, bool)
    for end, n in zip(ends, lengths):
        valid[end - n:end - LENGTH + 1] = True
    starts = np.flatnonzero(valid[:-1] & np.concatenate([[True], ~valid[:-2] | (chosen[1:] != chosen[:-1])]))
    edge = np.flatnonzero(~valid | np.concatenate([[True], chosen[1:] != chosen[:-1], [True]]))
    stops = edge[np.searchsorted(edge, starts, "right")]
    part = np.searchsorted(ends, starts, "right")
    text = np.array([p[0] for p in parts])[part]
    first = starts - (ends - lengths)[part] + np.array([p[1] for p in parts])[part]
    view = memoryview(data)
    spans = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b + LENGTH - 1]) for a, b in zip(starts.tolist(), stops.tolist())),
                        np.uint64, len(starts))
    return h[chosen[starts].astype(np.int64)].view(np.int64), spans.view(np.int64), text, first, stops - starts


def ranks(code: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Order of the strings of 8, 16, ... 128 and LENGTH bytes from each position, by prefix doubling."""
    padded = np.concatenate([code, np.zeros(2 * LENGTH, np.uint8)])
    n = len(code)
    value = np.zeros(n + LENGTH, np.uint64)
    for j in range(8):
        value = (value << np.uint64(8)) | padded[j:j + n + LENGTH]
    out, size = [], 8
    rank = np.unique(value, return_inverse=True)[1].astype(np.uint64)
    out.append((8, rank.astype(np.uint32)))
    while size < LENGTH:
        step = min(size, LENGTH - size)
        key = np.zeros_like(rank)
        key[:-step] = rank[:-step] * np.uint64(len(rank)) + rank[step:]
        key[-step:] = rank[-step:] * np.uint64(len(rank))
        rank = np.unique(key, return_inverse=True)[1].astype(np.uint64)
        size += step
        out.append((size, rank.astype(np.uint32)))
    return out


def common_prefixes(levels: list[tuple[int, np.ndarray]], code: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest common prefix, up to LENGTH, of each suffix in ``order`` with the one before."""
    out = np.zeros(len(order), np.int64)
    left, right = order[:-1], order[1:]
    same = np.zeros(len(left), np.int64)
    whole = levels[-1][1][left] == levels[-1][1][right]
    for size, rank in reversed(levels[:-1]):
        same += np.where(rank[left + same] == rank[right + same], size, 0)
    padded = np.concatenate([code, np.zeros(2 * LENGTH, np.uint8)])
    for _ in range(7):
        same += (same < LENGTH) & (padded[left + same] == padded[right + same])
    out[1:] = np.where(whole, LENGTH, np.minimum(same, LENGTH - 1))
    return out


def previous_factors(position: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, given in suffix order.

    To either side the next suffix of a smaller position is found by jumping over larger ones; the
    least common prefix on the way is what both share.
    """
    best = np.zeros(len(position), np.int64)
    for turn in (1, -1):
        at = position[::turn]
        shared = prefix.copy() if turn == 1 else np.concatenate([[0], prefix[:0:-1]])
        smaller = np.arange(-1, len(at) - 1)
        while True:
            open_ = np.flatnonzero((smaller >= 0) & (shared > 0))
            open_ = open_[at[smaller[open_]] > at[open_]]
            if not len(open_):
                break
            over = smaller[open_]
            shared[open_] = np.minimum(shared[open_], shared[over])
            smaller[open_] = smaller[over]
        found = np.where(smaller >= 0, shared, 0)
        best = np.maximum(best, found[::turn])
    return best


def repeated_windows(spans: list[bytes], others: bool) -> list[np.ndarray]:
    """Per span (in text order) which of its windows also stand in an earlier span, or with ``others`` in any other."""
    code = np.frombuffer(b"".join(spans), np.uint8)
    windows = np.array([len(s) - LENGTH + 1 for s in spans])
    begin = np.concatenate([[0], np.cumsum([len(s) for s in spans])[:-1]])
    owner = np.repeat(np.arange(len(spans)), windows)
    place = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    starts = begin[owner] + place
    levels = ranks(code)
    order = starts[np.argsort(levels[-1][1][starts], kind="stable")]
    prefix = common_prefixes(levels, code, order)
    factor = previous_factors(order, prefix)
    if others:
        factor = np.maximum(factor, previous_factors(-order, prefix))
    found = np.zeros(len(code), bool)
    found[order[factor >= LENGTH]] = True
    return np.split(found[starts], np.cumsum(windows)[:-1])


def _stretches(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    yield from zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist())


def _documents(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))


def _all_runs(docs: DataFrame, text: str) -> DataFrame:
    def find(batches):
        worker_memory("suffix_dedup")
        for batch in batches:
            doc_id, h = (batch.column(c) for c in ("doc_id", "h"))
            for anchor, span, owner, first, windows in runs_of(batch.column("raw").to_pylist()):
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(span), doc_id.take(at), h.take(at), pa.array(first.astype(np.int64)),
                     pa.array(windows.astype(np.int32))], ["anchor", "span", "doc_id", "h", "first", "windows"])

    return _documents(docs, text).mapInArrow(
        find, "anchor long, span long, doc_id long, h long, first long, windows int")


def _place() -> Column:
    """Order of the corpus: by doc_id (NULL last), text hash and position."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "first")


def _compared(spans: DataFrame, others: bool) -> DataFrame:
    """Repeated windows among the spans of an anchor, by one suffix array for some anchors at a time."""

    def search(batches):
        def flush(rows):
            out = []
            if len(rows) > 1:
                for (doc_id, h, first, _), flags in zip(rows, repeated_windows([r[3] for r in rows], others)):
                    out += [(doc_id, h, first + at, n) for at, n in _stretches(flags)]
            cols = list(zip(*out)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                ["doc_id", "h", "first", "windows"])

        rows, size, anchor = [], 0, None
        for batch in batches:
            for a, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "h", "first", "bytes"))):
                if a != anchor and size > AT_ONCE:
                    yield flush(rows)
                    rows, size = [], 0
                if a != anchor or rows[-1][:3] != tuple(row[:3]):
                    rows.append(tuple(row))
                    size += len(row[3])
                anchor = a
        yield flush(rows)
        trimmed()

    ordered = spans.repartition("anchor").sortWithinPartitions("anchor", F.col("doc_id").isNull(), "doc_id", "h", "first")
    return ordered.mapInArrow(search, "doc_id long, h long, first long, windows int")


def _dealt_out(spans: DataFrame, others: bool) -> DataFrame:
    """The same for anchors with very many spans: each window is a suffix of its own, grouped by its bytes."""

    def spread(batches):
        for batch in batches:
            for doc_id, h, first, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "first", "bytes"))):
                n = len(data) - LENGTH + 1
                view = memoryview(data)
                keys = [xxhash.xxh3_128_digest(view[i:i + LENGTH]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array([doc_id] * n, pa.int64()), pa.array([h] * n, pa.int64()),
                     pa.array(np.arange(first, first + n))], ["window", "doc_id", "h", "first"])

    spans = spans.dropDuplicates(["anchor", "doc_id", "h", "first"])  # rows equal in doc_id and text are one place
    each = spans.mapInArrow(spread, "window binary, doc_id long, h long, first long")
    # A window with any number of places is walked in SALTS parts; only the first place of each part is compared further.
    part = Window.partitionBy("window", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS))).orderBy(_place())
    some = each.withColumns({"at": F.row_number().over(part), "next": F.lead("first").over(part).isNotNull()})
    some = materialize(some, "dedup-windows")
    whole = Window.partitionBy("window").orderBy(_place())
    firsts = some.filter("at = 1").withColumns({"at": F.row_number().over(whole), "more": F.lead("first").over(whole).isNotNull()})
    found = firsts.filter("at > 1 or next or more" if others else "at > 1").select("doc_id", "h", "first")
    return some.filter("at > 1").select("doc_id", "h", "first").union(found).withColumn("windows", F.lit(1))


def repeats(docs: DataFrame, keep_first: bool, text: str = "text") -> DataFrame:
    """Rows (doc_id, h, first, windows): runs of windows whose bytes stand elsewhere too.

    Windows are grouped by the anchor they choose, so a group holds a part of the suffix array with
    all of its equal prefixes. Runs whose anchor stands nowhere else drop out; runs with equal spans
    count as one span with copies; spans that differ are compared by longest-previous-factor
    arrays. With ``keep_first`` the first place in the order of the corpus is left out.
    """
    runs = materialize(_all_runs(docs, text), "dedup-runs")
    again = runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    some = materialize(found_keys(runs, again, "anchor", "dedup-again").drop("n"), "dedup-some")
    spans = materialize(
        some.groupBy("anchor", "span").agg(F.count("*").alias("copies"), F.min(_place()).alias("least"), F.max("windows").alias("windows")),
        "dedup-spans")
    copied = some.join(spans.filter("copies > 1").select("anchor", "span", "least"), ["anchor", "span"])
    if keep_first:
        copied = copied.filter(_place() != F.col("least"))
    kinds = spans.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = (
        spans.join(kinds, "anchor")
        .groupBy(F.col("least.doc_id").alias("own_id"), F.col("least.h").alias("own_h"))
        .agg(F.collect_list(F.struct("anchor", F.col("least.first").alias("first"), "windows", "kinds")).alias("parts"))
    )
    texts = found_rows(_documents(docs, text), wanted, "dedup-wanted")

    def cut(batches):
        for batch in batches:
            for doc_id, h, raw, parts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "raw", "parts"))):
                yield pa.RecordBatch.from_arrays([
                    pa.array([p["anchor"] for p in parts], pa.int64()), pa.array([p["kinds"] for p in parts], pa.int64()),
                    pa.array([doc_id] * len(parts), pa.int64()), pa.array([h] * len(parts), pa.int64()),
                    pa.array([p["first"] for p in parts], pa.int64()),
                    pa.array([raw[p["first"]:p["first"] + p["windows"] + LENGTH - 1] for p in parts], pa.binary()),
                ], ["anchor", "kinds", "doc_id", "h", "first", "bytes"])

    schema = "anchor long, kinds long, doc_id long, h long, first long, bytes binary"
    strings = materialize(texts.select("doc_id", "h", "raw", "parts").mapInArrow(cut, schema), "dedup-strings")
    few, many = F.col("kinds") <= MOST_SPANS, F.col("kinds") > MOST_SPANS
    return (
        copied.select("doc_id", "h", "first", "windows")
        .union(_compared(strings.filter(few), not keep_first))
        .union(_dealt_out(strings.filter(many), not keep_first))
    )


def merged(found: DataFrame) -> DataFrame:
    """Runs of windows whose bytes touch or overlap joined into one, so that a text has few of them."""
    ahead = Window.partitionBy("doc_id", "h").orderBy("first", "end")
    begins = F.coalesce(F.col("first") > F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1)) + LENGTH - 1, F.lit(True))
    runs = found.withColumn("end", F.col("first") + F.col("windows")).withColumn("begins", begins.cast("int"))
    numbered = runs.withColumn("run", F.sum("begins").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "h", "run").agg(F.min("first").alias("first"), F.max("end").alias("end")).select(
        "doc_id", "h", "first", (F.col("end") - F.col("first")).alias("windows"))


def kept_parts(raw: bytes, found: list[tuple[int, int]]) -> tuple[list[bytes], int]:
    """What is left of a text without the bytes that the found runs of windows cover; number of cuts."""
    parts, at, cuts = [], 0, 0
    for first, windows in sorted(found):
        end = first + windows + LENGTH - 1
        if first > at or not cuts:
            parts.append(raw[at:first])
            cuts += 1
        at = max(at, end)
    return [*parts, raw[at:]], cuts


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes], int]]:
    """Each touched document's bytes, the pieces left of them and the number of cuts."""
    for raw, parts in zip(batch.column("raw").to_pylist(), batch.column("found").to_pylist()):
        yield raw, *kept_parts(raw, [(p["first"], p["windows"]) for p in parts])


def touched(docs: DataFrame, keep_first: bool, text: str) -> DataFrame:
    """Rows (doc_id, h, raw, found): documents that lose bytes, and the runs of windows that go."""
    found = materialize(repeats(docs, keep_first, text), "dedup-found")
    by_doc = merged(found).groupBy(F.col("doc_id").alias("own_id"), F.col("h").alias("own_h")).agg(
        F.collect_list(F.struct("first", "windows")).alias("found"))
    rows = found_rows(_documents(docs, text), by_doc, "dedup-by-doc").dropDuplicates(["doc_id", "h"])
    return rows.select("doc_id", "h", "raw", "found")


CUT = "n_removed long, n_spans long, kept_sha256 string, kept array<binary>"


def removed(docs: DataFrame, keep_first: bool = True, text: str = "text") -> DataFrame:
    """Documents that hold a string of 200 bytes which stands elsewhere too, and what is left of them.

    Texts are UTF-8 bytes; matches do not cross documents, and strings are judged on the input. With
    ``keep_first`` the first place in the corpus (by doc_id, NULL last, then position) stays; else every
    place goes. One row per touched document: doc_id, h (hash of the text), n_removed, n_spans
    (cuts), kept_sha256 and kept (the pieces of bytes left).

    NULL text: no bytes. Rows that are equal in doc_id and text are one document when the first place
    is chosen, and copies of each other when every place goes; they give one row. Other columns are
    not read.
    """
    def cut(batches):
        for batch in batches:
            out = []
            for raw, pieces, cuts in _kept(batch):
                left = b"".join(pieces)
                out.append((len(raw) - len(left), cuts, hashlib.sha256(left).hexdigest(), pieces))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "h", "n_removed", "n_spans", "kept_sha256", "kept"])

    return touched(docs, keep_first, text).mapInArrow(cut, f"doc_id long, h long, {CUT}")


def digests(docs: DataFrame, keep_first: bool = True, text: str = "text") -> DataFrame:
    """Per document row doc_id, n_bytes, n_removed, n_spans and kept_sha256; see ``removed``.

    An empty table gives an empty result.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    whole = docs.select("doc_id", F.xxhash64(text).alias("h"), F.octet_length(raw).cast("long").alias("n_bytes"),
                        F.sha2(raw, 256).alias("whole_sha256"))
    cut = materialize(removed(docs, keep_first, text).drop("kept"), "dedup-cut").withColumnsRenamed({"doc_id": "own_id", "h": "own_h"})
    return whole.join(cut, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Documents with the first place of every repeated string only; the columns of ``docs``.

    A character that a cut splits goes with the cut. ``n_chars`` is the new length where the text has
    changed. Documents of which nothing is left drop out; NULL and empty texts stay as they are.
    """
    def write(batches):
        for batch in batches:
            texts = ["".join(p.decode("utf-8", "ignore") for p in pieces) for _, pieces, _ in _kept(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(texts, pa.string())], ["own_id", "own_h", "own_text"])

    # One Python step from bytes to text: of two in a row each task would hold two workers, which stay for the stages after it.
    cut = materialize(touched(docs, True, "text").mapInArrow(write, "own_id long, own_h long, own_text string"), "dedup-texts")
    plain, at = veiled(docs)
    text, n_chars = F.col(at["text"]), F.col(at["n_chars"])
    same = F.col(at["doc_id"]).eqNullSafe(F.col("own_id")) & (F.xxhash64(at["text"]) == F.col("own_h"))
    joined = plain.join(cut, same, "left").filter("own_text is null or own_text <> ''")
    changed = {"text": F.coalesce("own_text", text),
               "n_chars": F.when(F.col("own_text").isNull(), n_chars).otherwise(F.length("own_text").cast("long"))}
    return joined.select(*(changed.get(c, F.col(name)).alias(c) for c, name in at.items()))
