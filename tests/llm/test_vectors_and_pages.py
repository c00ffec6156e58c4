"""Searches and archives against brute force, with odd rows and empty tables; SQL twins of the queries."""

import gzip
import hashlib
import os

import numpy as np
import pytest
from oracle import compare
from pyspark.sql import functions as F

from cardwatch.llm import exact_topk, forest_search, warc
from cardwatch.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_twin(spark, key):
    assert compare(spark, FOLDER, key, QUERIES[key], ORACLES[key]) == ""


@pytest.fixture(scope="module")
def vectors(spark):
    x = np.random.default_rng(4).normal(size=(300, 8)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(400, None, 1), (500, [0.0] * 8, 1), (600, [nan] * 8, 1), (700, [inf] + [1.0] * 7, 1), (800, [None] + [1.0] * 7, 1),
           (900, [1.0, 2.0], 1), (None, [1.0] * 8, 1), (1000, [], 1), rows[3]]
    return spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, score int"), x


def test_nearest_finds_the_nearest(vectors):
    df, x = vectors
    x, out = x.astype(float), {}
    for r in forest_search.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(out) == list(range(0, 300, 20))
    hits = 0
    for q, found in out.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(s == d[i] for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(best))
    assert hits >= 0.9 * 10 * len(out)
    assert [i for _, i, _ in sorted(out[100])] == list(range(101, 111))
    assert forest_search.nearest(df.filter("false"), F.lit(True)).count() == 0


def test_topk_is_exact_in_any_blocks(vectors):
    df, x = vectors
    whole = np.floor(256 * x.astype(float)).astype(int)
    for block in (4096, 7):
        out = {}
        for r in exact_topk.exact_topk(df, F.col("vec_id") % 20 == 0, k=5, query_block=block).collect():
            out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        for q in range(0, 300, 20):
            s = whole @ whole[q]
            best = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:5]
            assert sorted(out[q]) == [(n + 1, i, s[i]) for n, i in enumerate(best)]
    assert out[900] == [] if 900 in out else True
    assert exact_topk.exact_topk(df.filter("false"), F.lit(True)).count() == 0


def pages(spark):
    long, same = "<p>ü</p>" * 900, "x" * 150
    rows = [(1, "http://a\r\nX: y", long), (2, None, long), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (8, "u", same), (7, "u", same), (9, "u", same), (7, "u", same), (None, "u", same), (None, "u", "z" * 120),
            (10, "u", "WARC/1.1\r\n\r\n" * 20), (11, "u", "y" * 99), (12, "u", "y" * 99)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("segment", [700, warc.SEGMENT_BYTES])
def test_archives_come_back_whole(spark, segment):
    rows, df = pages(spark)
    out = warc.archive_round_trip(df, segment_bytes=segment).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        revisit = first is not None and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in out)
    assert warc.archive_round_trip(df.filter("false")).count() == 0


def test_the_registered_query_joins_continuation_records(spark, monkeypatch):
    paths, write = [], warc.write_archives

    def noted(pages, path, *rest):
        paths.append(path)
        write(pages, path, *rest)

    monkeypatch.setattr(warc, "write_archives", noted)
    QUERIES["op10_warc"](spark, FOLDER).count()
    files = spark.read.format("binaryFile").load(paths[0]).collect()
    fields = [f for r in files for f, _ in warc.parse(bytes(r["content"]))]
    origins = {f["warc-segment-origin-id"] for f in fields if f["warc-type"] == "continuation"}
    long = {f["warc-record-id"] for f in fields if f.get("warc-segment-number") == "1"}
    assert origins and origins == long


def test_framing_and_segments_are_verified():
    data = bytes(range(256)) * 300
    assert warc.dechunked(warc.chunked(data, 1000)) == data
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.reassembled([(2, 4, b"cd"), (1, None, b"ab"), (1, None, b"ab")]) == b"abcd"
    for parts in ([(1, None, b"ab"), (3, 4, b"cd")], [(1, None, b"ab"), (2, 5, b"cd")]):
        with pytest.raises(ValueError):
            warc.reassembled(parts)
    one = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>"}, b"body") + warc.END
    assert [b for _, b in warc.parse(gzip.compress(one) + gzip.compress(one))] == [b"body", b"body"]
