import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwatch.llm import token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """One row per (doc_id, text), token by token."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    byte_of = token_alignment.byte_level()
    told, holds = [], Counter()
    for name, text in rows:
        if not text:
            told.append((name, [], [], [], []))
            continue
        raw, ends, ids = (" " + text).encode(), [], []
        tokens = one.encode(" " + text, add_special_tokens=False)
        pieces = two.encode(text)
        data = [[bytes(byte_of[c] for c in t) for t in tokens.tokens],
                [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("\u2581", " ").encode()
                 for i, p in ((i, two.id_to_piece(i)) for i in pieces)]]
        if any(b"".join(d) != raw for d in data):
            told.append((name, [], [], [], []))
            continue
        spans = []
        for d in data:
            at, out = 0, []
            for t in d:
                out.append((at, at + len(t)))
                at += len(t)
            spans.append(out)
        links, j = [], 0
        for (s, e), a in zip(spans[0], tokens.ids):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(pieces) and spans[1][k][0] < e:
                links.append((a, pieces[k]))
                k += 1
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        sides = [list(zip(spans[0], tokens.ids)), list(zip(spans[1], pieces))]
        at = [0, 0]
        for high in shared:
            part = []
            for k in (0, 1):
                got = []
                while at[k] < len(sides[k]) and sides[k][at[k]][0][1] <= high:
                    got.append(str(sides[k][at[k]][1]))
                    at[k] += 1
                part.append(",".join(got))
            groups.append("|".join(part))
        holds.update(set(links))
        told.append((name, tokens.ids, pieces, groups, links))
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    for name, a, b, groups, links in told:
        yield (name, len(a), len(b), len(groups), len(links), sum(holds[p] == most[p[0]] for p in links), sum(holds[p] for p in links),
               hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")


ODD = ["<|endoftext|> and <s> </s> <unk>", "a\u2581b", " leading", "trailing  ", "\n\n\t x", "naïve café \U0001F600 \u4e2d\u6587", "H\u0331a",
       "ﬁ ① Å", "\x00\x01", "    ", "<0x41>", "it's 12345 words' end", "z" * 3000, " " * 5000, "\u3000wide", "e\u0301"]


@pytest.mark.parametrize("small", [False, True])
def test_tokens_links_and_counts(spark, odd_rows, odd, monkeypatch, small):
    if small:  # many slices, blocks and merges
        for name, value in (("TOGETHER", 3000), ("SLICE", 50), ("BLOCK_PAIRS", 300), ("BLOCK_BYTES", 9000)):
            monkeypatch.setattr(token_alignment, name, value)
    docs = odd.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"), True)
    docs = docs.withColumn("block", F.lit("x")).withColumn("keys", F.lit(1))
    got = token_alignment.align(docs.repartition(3), A, B)
    rows = [(r[0], r[1]) for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(ODD)]
    key = lambda r: tuple((x is not None, x or 0) for x in r[:-1])
    found, wanted = sorted(map(tuple, got.collect()), key=key), sorted(brute(rows), key=key)
    assert len(found) == len(wanted)
    assert [(a, b) for a, b in zip(found, wanted) if a != b] == []


def test_all_documents(spark):
    from cardwatch.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_align"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


def test_nothing_to_align(none):
    assert token_alignment.align(none, A, B).collect() == []
