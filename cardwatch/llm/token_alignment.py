"""Alignment of two tokenizers: covering tokens by as-of merges, groups by equal ends, corpus-wide link counts."""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.session import materialize

#: Bytes of text aligned together and tokens per side of one as-of merge; both bound a worker's arrays.
TOGETHER, SLICE = 1 << 20, 200_000
#: A block's table of pairs is closed at so many pairs or bytes of text.
BLOCK_PAIRS, BLOCK_BYTES = 1 << 20, 32 << 20
#: Bits of an id in a pair's key.
BITS = 21
LOW = (1 << BITS) - 1
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
PIECES = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in NUMBERS], ("groups_sha256", pa.string()),
    ("keys", pa.binary()), ("counts", pa.binary()), ("is_doc", pa.bool_()),
])
PIECES_DDL = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, counts binary, "
    "is_doc boolean"
)


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Sides:
    """Both tokenizers, the bytes of their tokens and the decimal forms of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as f:
            stored = json.load(f)
        special = {t["content"] for t in stored.get("added_tokens", [])}
        byte_of = byte_level()
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in stored["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("side-a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path_a)
        self.exact.encode_special_tokens = True
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.piece = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.piece.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        ends = lambda n, s: np.array([f"{i}{s}" for i in range(n)], object)
        self.said = [[ends(len(self.bytes_a), s) for s in ",|"], [ends(len(self.bytes_b), s) for s in ",;"]]

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.piece.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.piece.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides, or None where the bytes of either are not those of a space and the text."""
        raw = (" " + text).encode("utf-8", "replace")
        try:
            a = self.fast.encode_ordinary(" " + text)
        except BaseException as failed:  # the pattern's engine gives up on some very long runs
            if isinstance(failed, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            a = self.exact.encode(" " + text, add_special_tokens=False).ids
        b = self.piece.encode(text, num_threads=1)
        same = b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw
        return (a, b) if same else None


def worker_sides(path_a: str, path_b: str) -> Sides:
    """One pair of tokenizers per worker process."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_aligned_sides", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Sides(path_a, path_b)
    return kept[path_a, path_b]


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (a, b) of all tokens whose bytes overlap; tokens of both sides cover their documents without gaps.

    Of two tokens that overlap one starts within the other, so the token that covers each start, looked
    up in both directions, gives all pairs; those that start together come once.
    """
    left = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(doc_a)), "own": start_a}).sort_values("start", kind="stable")
    right = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(doc_b))}).sort_values("start", kind="stable")
    one = pd.merge_asof(left, right, on="start", by="doc")
    two = pd.merge_asof(right, left, on="start", by="doc")
    two = two[two["own"] < two["start"]]
    return np.r_[one["a"].to_numpy(), two["a"].to_numpy()], np.r_[one["b"].to_numpy(), two["b"].to_numpy()]


def aligned(sides: Sides, both: list[tuple[list[int], list[int]]]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Counts and group digest of each document, and its (document, key, links) triples in order.

    Documents lie one after another on one axis of bytes; slices are cut where tokens of both sides end.
    """
    ids_a, ids_b = (np.concatenate([np.array(x[k], np.int64) for x in both]) for k in (0, 1))
    n_a, n_b = (np.array([len(x[k]) for x in both]) for k in (0, 1))
    doc_a, doc_b = np.repeat(np.arange(len(both)), n_a), np.repeat(np.arange(len(both)), n_b)
    end_a, end_b = np.cumsum(sides.length_a[ids_a]), np.cumsum(sides.length_b[ids_b])
    shared = end_a[end_b[np.searchsorted(end_b, end_a)] == end_a]
    group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
    n_groups = np.bincount(doc_a[np.searchsorted(end_a, shared)], minlength=len(both))

    packed, n_links = [], np.zeros(len(both), np.int64)
    low_a = low_b = 0
    while low_a < len(ids_a):
        last = group_a[min(low_a + SLICE, len(ids_a)) - 1]
        high_a, high_b = np.searchsorted(group_a, last, "right"), np.searchsorted(group_b, last, "right")
        a, b = slice(low_a, high_a), slice(low_b, high_b)
        i, j = overlaps(doc_a[a], end_a[a] - sides.length_a[ids_a[a]], doc_b[b], end_b[b] - sides.length_b[ids_b[b]])
        docs = doc_a[a][i]
        n_links += np.bincount(docs, minlength=len(both))
        packed.append(np.unique((docs << 2 * BITS) | (ids_a[a][i] << BITS) | ids_b[b][j], return_counts=True))
        low_a, low_b = high_a, high_b
    keys, counts = (np.concatenate([p[k] for p in packed]) for k in (0, 1))
    if len(packed) > 1:  # a document may reach over several slices
        keys, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, counts).astype(np.int64)

    at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    closes_a, closes_b = (np.r_[g[1:] != g[:-1], True].astype(int) for g in (group_a, group_b))
    said = np.empty(len(ids_a) + len(ids_b), object)
    for at, ids, closes, (inner, final) in ((at_a, ids_a, closes_a, sides.said[0]), (at_b, ids_b, closes_b, sides.said[1])):
        said[at] = np.where(closes, final[ids], inner[ids])
    rows, low = [], 0
    for k, high in enumerate(np.cumsum(n_a + n_b).tolist()):
        text = "".join(said[low:high])[:-1]
        rows.append((int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), hashlib.sha256(text.encode()).hexdigest()))
        low = high
    return rows, keys >> 2 * BITS, keys & ((1 << 2 * BITS) - 1), counts


def _zipped(numbers: np.ndarray) -> bytes:
    return pa.Codec("zstd", 1).compress(numbers.tobytes(), asbytes=True)


def _unzipped(data: bytes, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data, size, asbytes=True), kind)


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Rising keys as differences and their counts, each with its number in front."""
    head = len(keys).to_bytes(8, "little")
    return head + _zipped(np.diff(keys, prepend=0).astype("<i8")), head + _zipped(counts.astype("<i8"))


def _recounted(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 8 * int.from_bytes(keys[:8], "little")
    return np.cumsum(_unzipped(keys[8:], n, "<i8")), _unzipped(counts[8:], n, "<i8")


class Pairs:
    """In how many of a block's documents each pair occurs, merged whenever so many entries have come in."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.new: list[np.ndarray] = []
        self.waiting = self.size = 0

    def add(self, keys: np.ndarray, size: int) -> None:
        self.new.append(keys)
        self.waiting += len(keys)
        self.size += size
        if self.waiting > BLOCK_PAIRS:
            self.merge()

    def merge(self) -> None:
        if self.new:
            keys, counts = np.unique(np.concatenate(self.new), return_counts=True)
            merged, place = np.unique(np.r_[self.keys, keys], return_inverse=True)
            self.counts = np.bincount(place, np.r_[self.counts, counts]).astype(np.int64)
            self.keys, self.new, self.waiting = merged, [], 0

    def full(self) -> bool:
        return self.size > BLOCK_BYTES or len(self.keys) > BLOCK_PAIRS


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)


def _tokenized(path_a: str, path_b: str):
    """Batches of (doc_id, text) to rows of documents and, where a block closes, a row of its pairs."""

    def pieces(batches):
        sides, pairs = worker_sides(path_a, path_b), Pairs()
        block = TaskContext.get().partitionId() << 24

        def chunk(names, both, size):
            found, docs, keys, counts = aligned(sides, both)
            cut = np.searchsorted(docs, np.arange(len(both) + 1)).tolist()
            pairs.add(keys, size)
            return _piece_batch([(block, name, *numbers, *_counted(keys[i:j], counts[i:j]), True)
                                 for name, numbers, i, j in zip(names, found, cut, cut[1:])])

        def close():
            pairs.merge()
            return _piece_batch([(block, None, None, None, None, None, None, *_counted(pairs.keys, pairs.counts), False)])

        for batch in batches:
            names, both, size, bare = [], [], 0, []
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                ids = sides.ids(text) if text else None
                if ids is None:
                    bare.append((block, name, 0, 0, 0, 0, "", None, None, True))
                    continue
                names.append(name)
                both.append(ids)
                size += len(text)
                if size > TOGETHER:
                    yield chunk(names, both, size)
                    names, both, size = [], [], 0
            if both:
                yield chunk(names, both, size)
            if bare:
                yield _piece_batch(bare)
            if pairs.full():
                yield close()
                pairs, block = Pairs(), block + 1
        if pairs.size:
            yield close()

    return pieces


def _spread(batches):
    """Rows (block, a, b, n) of the pairs of each block, in pieces."""
    for batch in batches:
        for block, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "counts"))):
            keys, counts = _recounted(keys, counts)
            for i in range(0, len(keys), 50_000):
                k = keys[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), block)), pa.array((k >> BITS).astype(np.int32)), pa.array((k & LOW).astype(np.int32)),
                     pa.array(counts[i:i + 50_000])], names=["block", "a", "b", "n"])


def _summed(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """n_best and count_sum of a block's documents by the corpus-wide counts of its pairs."""
    key = (pairs["a"].to_numpy(np.int64) << BITS) | pairs["b"].to_numpy(np.int64)
    order = np.argsort(key)
    key, total, best = key[order], pairs["total"].to_numpy()[order], pairs["best"].to_numpy()[order]
    sums = []
    for keys, counts in zip(docs["keys"], docs["counts"]):
        if keys is None:
            sums.append((0, 0))
            continue
        keys, counts = _recounted(keys, counts)
        at = np.searchsorted(key, keys)
        sums.append((int(counts[best[at]].sum()), int((counts * total[at]).sum())))
    out = docs[["doc_id", *NUMBERS]].copy()
    out["n_best"], out["count_sum"] = zip(*sums) if sums else ([], [])
    out["groups_sha256"] = docs["groups_sha256"]
    return out


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Align the tokens of two tokenizers over every whole text and count linked id pairs over all documents.

    Side A is a byte-level BPE file of tokenizers and reads a space and the text, side B a sentencepiece
    model, which adds that space; special tokens in texts are plain text. Tokens whose byte ranges overlap
    are linked, and offsets where tokens of both sides end cut them into groups. Returns per document
    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many documents as its A id's
    most frequent pair), count_sum (over links, documents that hold the pair) and groups_sha256 (hash of
    ``a1,a2|b1;a3|b2,b3``).

    NULL and empty texts and texts that a side does not give back byte by byte have zeros and an empty
    digest. Repeated rows are documents of their own; NULL doc_id is kept. An empty table gives an empty
    result; other columns are not read. Pairs travel once per block of texts, never per link.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = materialize(given.mapInArrow(_tokenized(path_a, path_b), PIECES_DDL), "align-pieces")
    found = pieces.filter("not is_doc").select("block", "keys", "counts").mapInArrow(_spread, "block long, a int, b int, n long")
    found = materialize(found, "align-pairs")
    totals = materialize(found.groupBy("a", "b").agg(F.sum("n").alias("total")), "align-totals")
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    judged = totals.join(most, "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    known = found.select("block", "a", "b").join(judged, ["a", "b"])
    told = pieces.filter("is_doc").drop("is_doc")
    with_tokens = told.filter("keys is not null")
    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    summed = with_tokens.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(_summed, ddl)
    bare = told.filter("keys is null").select("doc_id", *NUMBERS, F.lit(0).cast("long").alias("n_best"),
                                              F.lit(0).cast("long").alias("count_sum"), "groups_sha256")
    return summed.unionByName(bare)
