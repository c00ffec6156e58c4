"""Harmonic packing of token pieces: classes of reciprocal capacity, a fixed number of pieces per bin."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import numbered, small_table, worker_memory
from cardwatch.session import materialize

#: Tokens of a sequence, and the smallest binary piece; what is left of a document below it stays whole.
CAPACITY, LEAST = 2048, 64
#: Id that ends every document.
END_ID = 1
#: Words whose ids a worker remembers; the older half goes when it is full.
REMEMBERED = 250_000
#: Bytes of words and ids, at five a letter, above which they all go: texts without spaces are one word each.
MOST_BYTES = 64 << 20
#: New words that are encoded as one text.
TOGETHER = 500
#: A capital before a character that may be a combining mark: one of U+0300 to U+037F, or of U+0580 and above.
MARKED = re.compile(rb"[A-Z][\xcc\xcd\xd6-\xf4]")
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])
RULES = pa.schema([("length", pa.int32()), ("per", pa.int64()), ("first", pa.int64()), ("done", pa.int64())])
REST = pa.schema([("length", pa.int32()), ("number", pa.int64()), ("sequence", pa.int64()), ("place", pa.int64())])


class WordEncoder:
    """Ids of a text, word by word: a pre-tokenizer that splits at white space makes words independent."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(names.values()) + 1, bool)
        self.closing[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words of letters go through together and are told apart by their closing tokens."""
        texts = [w.decode("utf-8", "replace") for w in words]
        letters = [i for i, t in enumerate(texts) if t.isalpha()]
        groups = [letters[i:i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        found = self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in g) for g in groups], add_special_tokens=False)
        out: dict[int, bytes] = {}
        for group, encoding in zip(groups, found):
            ids = np.array(encoding.ids, "<u4")
            cut = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
            if len(cut) == len(group):
                raw = ids.tobytes()
                out.update(zip(group, (raw[i:j] for i, j in zip([0, *cut], cut))))
        rest = [i for i in range(len(texts)) if i not in out]
        single = self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        out.update((i, np.array(e.ids, "<u4").tobytes()) for i, e in zip(rest, single))
        return [out[i] for i in range(len(texts))]

    def learn(self, words: set[bytes]) -> None:
        if len(self.new) > REMEMBERED or self.size > MOST_BYTES:
            self.old, self.new, self.size = self.new if self.size <= MOST_BYTES else {}, {}, 0
        missing = [w for w in words if w not in self.new]
        fresh = []
        for w in missing:
            if (ids := self.old.get(w)) is None:
                fresh.append(w)
            else:
                self.new[w] = ids
        # a closing stop or comma after an ASCII letter or digit is a token of its own
        split = [w for w in fresh if w[-1:] in b".," and w[-2:-1].isalnum()]
        ends = {w[-1:] for w in split}
        need = {w[:-1] for w in split} | ends | (set(fresh) - set(split))
        need = [w for w in need if w not in self.new]
        self.new.update(zip(need, self._encode(need)))
        for w in split:
            self.new[w] = self.new[w[:-1]] + self.new[w[-1:]]
        self.size += 5 * sum(map(len, missing))

    def words(self, raw: bytes) -> list[bytes]:
        """Lower case does not change a word's ids, unless the text spells a special token.

        A capital with a mark right behind it may be composed before the tokenizer lowers it, so words
        other than ASCII keep their case in a text that holds such a pair.
        """
        if b"<|" in raw:
            return raw.split()
        if raw.isascii() or not MARKED.search(raw):
            return raw.lower().split()
        return [w.lower() if w.isascii() else w for w in raw.split()]

    def texts(self, raws: list[bytes]) -> Iterator[bytes]:
        """Ids of each text as unsigned 32-bit little-endian numbers."""
        split = [self.words(r) for r in raws]
        self.learn(set().union(*split))
        for words in split:
            yield b"".join(map(self.new.__getitem__, words))


def worker_encoder(path: str) -> WordEncoder:
    """One encoder per worker process: the tasks that run there one after another share its words."""
    kept = worker_memory("packing")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def cuts(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then powers of two, then a rest below ``least``."""
    whole, rest = divmod(n, capacity)
    out, size = [capacity] * whole, capacity // 2
    while size >= least:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


def layout(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, tuple[int, int, int]], list[tuple]]:
    """Where the pieces of each length go, by their number within the length.

    Per length: pieces per bin, first sequence, and pieces in full bins. The pieces that do not fill
    a bin (fewer than a bin of each length) are listed as (length, number, sequence, offset): powers
    of two in bins of a power of two, which need no padding, the others together, longest first.
    """
    rules, rest, sequence = {}, [], 0
    for size in sorted(counts, reverse=True):
        per = capacity // size
        full = counts[size] // per
        rules[size] = (per, sequence, full * per)
        sequence += full
    open_at = capacity
    for size in sorted(counts, reverse=True):
        per, _, done = rules[size]
        left = range(done, counts[size])
        if size & (size - 1) == 0 and size >= LEAST:
            at, group = left.start, per
            while group:
                if left.stop - at >= group:
                    rest += [(size, at + i, sequence, i * size) for i in range(group)]
                    sequence, at = sequence + 1, at + group
                group //= 2
            continue
        for number in left:
            if open_at + size > capacity:
                current, sequence, open_at = sequence, sequence + 1, 0
            rest.append((size, number, current, open_at))
            open_at += size
    return rules, rest


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens with next to no padding.

    A document (its ids by the tokenizer file, then id 1) is cut into whole sequences, at most five
    powers of two from 1024 to 64, and a rest below 64. A length L is a class of its own, of which
    2048 // L pieces fill a bin: pieces are numbered within their class, and bin and offset follow
    from the number, so no worker has to know of another's bins. Bins of powers of two are full, the
    other classes lose less than 3 %; what does not fill a bin is less than one bin per class.
    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the piece's ids as unsigned 32-bit little-endian numbers.

    NULL and empty texts give the one closing id. Repeated rows are packed like any other. NULL
    doc_id is kept. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession

    def pieces(batches):
        encoder, end = worker_encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            names, raws = batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()
            rows = []
            for name, ids in zip(names, encoder.texts(raws)):
                ids += end
                start = 0
                for length in cuts(len(ids) // 4):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((name, start, length, zlib.crc32(part), len(ids) // 4, part if with_ids else None))
                    start += length
            cols = list(zip(*rows)) or [[]] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCHEMA)], schema=SCHEMA)

    raw = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    schema = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, ids binary"
    cut = materialize(raw.mapInArrow(pieces, schema), "pack-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    rules, rest = layout(counts)
    by_rule = small_table(spark, [(s, *r) for s, r in rules.items()], RULES)
    by_rest = small_table(spark, rest, REST)
    wide = numbered(cut, ["length"], ["doc_id", "start", "ids_crc32", "doc_tokens"], "number")
    full = F.col("number") < F.col("done")
    out = (
        wide.join(F.broadcast(by_rule), "length").join(F.broadcast(by_rest), ["length", "number"], "left")
        .select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                F.when(full, F.col("first") + F.expr("number div per")).otherwise(F.col("sequence")).alias("sequence_id"),
                F.when(full, F.col("number") % F.col("per") * F.col("length")).otherwise(F.col("place")).alias("offset"), "ids")
    )
    return out if with_ids else out.drop("ids")
