"""Personal data in texts: exact patterns, and a character tagger that adds what they miss."""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import char_tagger
from cardwatch.llm.char_tagger import KINDS

#: Windows of text that are tagged, the distance of their beginnings, and windows tagged together.
WINDOW, STRIDE, TOGETHER = 128, 64, 512
#: Bounded sample of labelled windows that the tagger learns from, their length, LSTM units per direction, steps.
SAMPLE, LEARNT, HIDDEN, STEPS = 1500, 96, 16, 300
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
#: A digit run is tried from its beginning only: its other starts would end alike.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TELLING = re.compile(r"[0-9@]")
NOT_DIGIT = re.compile(r"[^0-9]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the digits pass the checksum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def passes(kind: int, said: str) -> bool:
    """The rules on a match of a kind's pattern besides the pattern."""
    if kind == 0:
        return True
    if kind == 1:
        return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in said.split("."))
    digits = NOT_DIGIT.sub("", said)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def base(text: str) -> list[Span]:
    """Spans (kind, start, end) of the exact patterns, leftmost and non-overlapping per kind, in order, at linear cost."""
    out: list[Span] = []
    at, low = text.find("@"), 0
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            out.append((0, start, found.end()))
            low = found.end()
        at = text.find("@", max(at + 1, low))
    if not TELLING.search(text):
        return out
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if passes(kind, m.group())]
    return out


def whole(kind: int, text: str, start: int, end: int) -> bool:
    """Exact check of a tagged span: a whole match of its kind that passes, not cut out of a longer word or number."""
    said = text[start:end]
    if not ((EMAIL, IP, CARD, PHONE)[kind].fullmatch(said) and passes(kind, said)):
        return False
    inner = LOCAL.__contains__ if kind == 0 else str.isdigit
    return not (start and inner(text[start - 1])) and not (end < len(text) and inner(text[end]))


def tagged(path: np.ndarray) -> Iterator[Span]:
    """Spans of one window's tags: a first tag begins one, and so does a change of kind."""
    kind = char_tagger.KIND_OF[path]
    opens = np.isin(path, (4, 6, 8)) | (np.r_[-1, kind[:-1]] != kind)
    starts = np.flatnonzero(opens & (kind >= 0))
    for s in starts.tolist():
        rest = np.flatnonzero(opens[s + 1:])
        yield int(kind[s]), s, s + 1 + int(rest[0]) if len(rest) else len(path)


def windows(text: str, all_of_them: bool = False) -> list[int]:
    """Beginnings of the windows that hold a digit or an at sign.

    The tagger's paths cannot open and close a span without one, whatever its weights, so the other
    windows need no decoding: their result is known to be empty.
    """
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    if all_of_them:
        return [STRIDE * k for k in range(last + 1)]
    found = set()
    for m in TELLING.finditer(text):
        k = m.start() // STRIDE
        found.update(i for i in range(k - WINDOW // STRIDE + 1, k + 1) if 0 <= i <= last)
    return [STRIDE * k for k in sorted(found)]


def reconciled(votes: dict[Span, int], taken: list[Span]) -> list[Span]:
    """Of the windows' spans the set without overlaps that has the most votes over the whole text, ties to the earlier end.

    Spans that overlap an exact one give way to it.
    """
    taken = sorted((s, e) for _, s, e in taken)
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else starts
    free = []
    for span in sorted(votes, key=lambda v: (v[2], v[1], v[0])):
        before = int(np.searchsorted(starts, span[2])) if taken else 0
        if not before or reach[before - 1] <= span[1]:
            free.append(span)
    ends = [s[2] for s in free]
    best, last = [0], []
    for i, span in enumerate(free):
        j = int(np.searchsorted(ends, span[1], "right"))
        j = min(j, i)
        with_it = best[j] + votes[span]
        last.append((j, with_it > best[i]))
        best.append(max(best[i], with_it))
    out, i = [], len(free)
    while i:
        j, use = last[i - 1]
        if use:
            out.append(free[i - 1])
        i = j if use else i - 1
    return out[::-1]


def added(texts: list[str], exact: list[list[Span]], weights: dict, all_windows: bool = False) -> list[list[Span]]:
    """Spans that the tagger adds to the exact ones of each text, from overlapping windows of the whole text."""
    table, votes = char_tagger.Symbols(), [defaultdict(int) for _ in texts]
    queue = [(k, start) for k, text in enumerate(texts) for start in windows(text, all_windows)]
    for i in range(0, len(queue), TOGETHER):
        part = queue[i:i + TOGETHER]
        x = np.zeros((len(part), WINDOW), np.int64)
        for row, (k, start) in zip(x, part):
            said = char_tagger.symbols(texts[k][start:start + WINDOW], table)
            row[:len(said)] = said
        paths = char_tagger.decode(weights, x, np.array([start == 0 for _, start in part]))
        for row, path, (k, start) in zip(x, paths, part):
            length = int((row != char_tagger.PAD).sum())
            for kind, s, e in tagged(path[:length]):
                cut = (s == 0 and start) or (e == length and start + length < len(texts[k]))
                if not cut and whole(kind, texts[k], start + s, start + e):  # how far from the window's edges
                    votes[k][kind, start + s, start + e] += 1 + min(s, length - e, STRIDE // 2)
    return [reconciled(v, b) for v, b in zip(votes, exact)]


def _tags(spans: list[Span], text: str) -> np.ndarray:
    tags = np.zeros(len(text), np.int64)
    for kind, s, e in spans:
        if kind == 0:
            at = text.index("@", s)
            tags[s:at], tags[at], tags[at + 1:e] = 1, 2, 3
        elif kind == 3:
            tags[s], tags[s + 1], tags[s + 2:e] = 8, 9, 10
        else:
            tags[s], tags[s + 1:e] = 2 + 2 * kind, 3 + 2 * kind
    return tags


def labelled(text: str, sure: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """Windows around exact spans with all exact spans inside them; those that leave other digits about are negative for the rest."""
    kept, end = [], -1
    for span in sorted(sure, key=lambda s: (s[1], -s[2])):
        if span[1] >= end:
            kept.append(span)
            end = span[2]
    for kind, s, e in kept:
        if e - s > LEARNT // 2:
            continue
        low = max(0, s - (LEARNT - (e - s)) // 2)
        high = low + LEARNT
        inside = [(k, a - low, b - low) for k, a, b in kept if a >= low and b <= high]
        edges = [a for _, a, b in kept if a < high < b] + [high]
        first = max([b - low for _, a, b in kept if a < low < b] + [0])
        yield text[low:min(edges)][first:], [(k, a - first, b - first) for k, a, b in inside if a >= first]


def lessons(sample: list[tuple[str, list[Span]]], seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Training windows and tags: each sample window as it is and twice more with further labelled spans set beside its own.

    Digits of set-in spans are drawn anew, so that the tagger learns forms, not numbers.
    """
    rnd, table = np.random.default_rng(seed), char_tagger.Symbols()
    by_kind = defaultdict(list)
    for text, spans in sample:
        for kind, s, e in spans:
            by_kind[kind].append(text[s:e])
    kinds = sorted(by_kind)
    rows = []
    rows += sample
    for text, spans in [*sample, *sample]:
        k, s, e = spans[int(rnd.integers(len(spans)))]
        parts, at, put = [text[:e]], e, [x for x in spans if x[2] <= e]
        for _ in range(int(rnd.integers(1, 3))):
            kind = kinds[int(rnd.integers(len(kinds)))]
            said = by_kind[kind][int(rnd.integers(len(by_kind[kind])))]
            if kind != 0:
                said = "".join(str(rnd.integers(10)) if c.isdigit() else c for c in said)
            gap = (" ", " ", ", ", " ")[int(rnd.integers(4))]
            put.append((kind, at + len(gap), at + len(gap) + len(said)))
            parts += [gap, said]
            at = put[-1][2]
        rows.append(("".join(parts) + " " + text[e:].lstrip("0123456789 -.")[:20], put))
    x, tags = np.zeros((len(rows), LEARNT), np.int64), np.zeros((len(rows), LEARNT), np.int64)
    for i, (text, spans) in enumerate(rows):
        low = max(0, max(e for *_, e in spans) + 12 - LEARNT)
        part = char_tagger.symbols(text[low:low + LEARNT], table)
        x[i, :len(part)] = part
        tags[i, :len(part)] = _tags(spans, text)[low:low + LEARNT]
    return x, tags


def _samples(batches):
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            if TELLING.search(text):
                found += labelled(text, base(text))
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([json.dumps(s) for _, s in found], pa.string())],
                                         names=["said", "spans"])


def trained(texts: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Tagger fitted on at most ``sample`` windows, those of least hash; None where no text has an exact span."""
    found = texts.mapInArrow(_samples, "said string, spans string").distinct()
    found = found.withColumn("h", F.xxhash64("said", "spans")).orderBy("h", "said", "spans").limit(sample).collect()
    rows = [(r["said"], [tuple(s) for s in json.loads(r["spans"])]) for r in found]
    rows = [r for r in rows if r[1]]
    return char_tagger.fit(*lessons(rows), HIDDEN, STEPS) if rows else None


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


RESULT = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])


def _found(weights: dict | None):
    def find(batches):
        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            exact = [base(t) for t in texts]
            more = added(texts, exact, weights) if weights else [[] for _ in texts]
            rows = [(name, *(sum(s[0] == k for s in sure) for k in range(4)), hashlib.sha256(listed(sure).encode()).hexdigest(),
                     listed(sure + extra)) for name, sure, extra in zip(names, exact, more)]
            cols = list(zip(*rows)) or [[]] * len(RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, RESULT)], schema=RESULT)

    return find


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """Emails, IPv4 addresses, card and phone numbers of every whole text.

    Exact patterns give the base spans; the tagger, fitted on at most ``sample`` windows with base spans,
    adds spans that the patterns swallow or break, such as a phone number with a card number behind it.
    Windows overlap, the spans they decode are reconciled over the whole text, and each added span is a
    whole match of its kind that overlaps no other span. Tagged spans are at most 64 characters long, base
    spans of any length.

    Returns per document doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (hash of the base
    spans as kind:start:end in code points) and spans (base and added ones). NULL texts are empty: no
    spans. Repeated rows have equal results. NULL doc_id is kept. An empty table gives an empty result;
    a table without base spans has nothing to learn from and gets no added ones. Other columns are not read.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    weights = trained(given.select("text"), sample)
    ddl = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return given.mapInArrow(_found(weights), ddl)
