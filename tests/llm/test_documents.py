"""Operators on documents against brute force, with odd rows and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import mixing, ngram_join, packing, quality, sharding, suffix_dedup, toxicity

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def raw(text):
    return (text or "").encode()


def test_shards_are_whole_groups_of_nearly_equal_bytes(odd, odd_rows, none):
    out = sharding.shard_documents(odd, 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (r[0], len(raw(r[1])) + 1, zlib.crc32(raw(r[1]))) for r in odd_rows)
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    texts = defaultdict(set)
    for r in out:
        texts[r["text_crc32"], r["size"]].add(r["shard"])
    assert max(map(len, texts.values())) <= 2  # NULL and the empty text share size and checksum
    assert sharding.shard_documents(none, 4).count() == 0


def test_cuts_reach_the_smallest_capacity(spark):
    sizes = [int(x) for x in np.random.default_rng(2).integers(1, 50, 300)]
    groups = spark.createDataFrame([(i * 2**50 - 2**57, s) for i, s in enumerate(sizes)], "h long, bytes long")
    named, starts = sharding.plan_cuts(groups, 8)
    load = [0] * 8
    for i, s in enumerate(sizes):
        h = i * 2**50 - 2**57
        load[named[h] if h in named else sum(h >= x for x in starts)] += s
    assert sum(load) == sum(sizes) and max(load) <= -(-sum(sizes) // 8) + 50 and min(load) > 0


def covered(texts):
    n = suffix_dedup.LENGTH
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    for t in texts:
        out = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                out[i:i + n] = True
        yield out


def test_every_place_of_a_repeated_string_goes(odd, odd_rows, none):
    out = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in suffix_dedup.digests(odd, keep_first=False).collect())
    want = Counter()
    for row, gone in zip(odd_rows, covered([raw(r[1]) for r in odd_rows])):
        kept = np.frombuffer(raw(row[1]), np.uint8)[~gone].tobytes()
        cuts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[row[0], len(gone), int(gone.sum()), cuts, hashlib.sha256(kept).hexdigest()] += 1
    assert out == want
    assert suffix_dedup.digests(none).count() == 0


def test_the_first_place_stays(odd):
    out = {r["doc_id"]: r for r in suffix_dedup.deduplicated(odd).collect() if r["doc_id"] is not None}
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert out[5]["text"] == texts[5] and 6 not in out  # the later copy has nothing left
    assert out[8]["text"] == texts[8] and len(out[9]["text"]) < len(texts[9])
    assert out[0]["text"] is None and out[1]["text"] == "" and out[10]["text"] == texts[10]
    assert out[9]["n_chars"] == len(out[9]["text"])


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("salts", [1, 32])
def test_windows_of_very_common_anchors_are_dealt_out(odd, monkeypatch, keep_first, salts):
    want = sorted(map(tuple, suffix_dedup.digests(odd, keep_first=keep_first).fillna(-1).collect()))
    monkeypatch.setattr(suffix_dedup, "MOST_SPANS", 0)
    monkeypatch.setattr(suffix_dedup, "SALTS", salts)
    assert sorted(map(tuple, suffix_dedup.digests(odd, keep_first=keep_first).fillna(-1).collect())) == want


def test_long_texts_go_through_in_pieces(monkeypatch):
    text = np.random.default_rng(1).integers(97, 123, 5000, np.uint8).tobytes() * 2
    whole = list(suffix_dedup.runs_of([text]))
    monkeypatch.setattr(suffix_dedup, "PIECE", 1500)
    windows = np.concatenate([np.arange(f, f + n) for run in suffix_dedup.runs_of([text]) for f, n in zip(run[3], run[4])])
    assert sorted(windows) == list(range(len(text) - suffix_dedup.LENGTH + 1)) and len(whole) == 1


def test_previous_factors_against_the_definition():
    text = np.frombuffer(b"abaababaabaab" * 3, np.uint8)
    levels = suffix_dedup.ranks(text)
    order = np.argsort(levels[-1][1][:len(text)], kind="stable")
    got = np.zeros(len(text), int)
    got[order] = suffix_dedup.previous_factors(order, suffix_dedup.common_prefixes(levels, text, order))
    padded = text.tobytes() + bytes(400)
    for i in range(len(text)):
        longest = 0
        for j in range(i):
            n = 0
            while n < suffix_dedup.LENGTH and padded[i + n] == padded[j + n]:
                n += 1
            longest = max(longest, n)
        assert got[i] == longest


def grams(text):
    words = raw(text).lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_join_classes_against_all_pairs(odd, odd_rows, none):
    sets = [grams(r[1]) for r in odd_rows]
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    want = Counter()
    for i, r in enumerate(odd_rows):
        ids = [odd_rows[j][0] for j in range(len(sets)) if label[j] == label[i] and odd_rows[j][0] is not None]
        want[r[0], len(sets[i]), r[0] if not sets[i] else min(ids)] += 1
    out = ngram_join.join_classes(odd).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == want
    assert ngram_join.join_classes(none).count() == 0


def test_long_columns_and_blocks_give_the_same_classes(odd, monkeypatch):
    want = sorted(ngram_join.join_classes(odd).select("doc_id", "component_id").fillna(-1).collect())
    monkeypatch.setattr(ngram_join, "SHORT", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 1)
    assert sorted(ngram_join.join_classes(odd).select("doc_id", "component_id").fillna(-1).collect()) == want


def test_one_of_each_class_stays(odd):
    out = [r["doc_id"] for r in ngram_join.keep_one(odd).collect()]
    assert 5 in out and not {6, 7} & set(out) and {0, 1, 2} <= set(out)
    assert Counter(out)[5] == 1 and Counter(out)[14] == 1


def test_packing_is_whole_and_tight(odd, odd_rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in odd_rows:
        want[tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1])] += 1
    pieces = packing.pack(odd, VOCABULARY, with_ids=True).collect()
    got, padding, tokens = Counter(), 0, 0
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        fitting = [d for d in want if len(d) == p["doc_tokens"] and list(d[p["start"]:p["start"] + len(ids)]) == ids.tolist()]
        assert fitting
        got[p["doc_tokens"]] += len(ids)
    assert got == Counter({n: n * sum(c for d, c in want.items() if len(d) == n) for n in {len(d) for d in want}})
    rows = defaultdict(list)
    for p in pieces:
        rows[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in rows.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
        tokens, padding = tokens + end, padding + (0 if end & (end - 1) == 0 else 2048 - end)
    assert padding <= 2048 + 0.03 * tokens
    assert packing.pack(none, VOCABULARY).count() == 0


def test_special_tokens_and_odd_signs_keep_their_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["a <|endoftext|> b", "<|EndOfText|>", "ΟΔΟΣ ΣΑΣ.", "it's 12,5. é é x…. \x1c\x85y", "İ ẞ ﬁ", "a,. b.,", ""]
    found = packing.WordEncoder(VOCABULARY).texts([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_capitals_before_combining_marks_keep_their_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    pairs = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"]
    texts = [*pairs, "H\u0331anukkah is Near, J\u030cOB. X", *[p + "Abc DEF " + p.lower() + "abc Def" for p in pairs]]
    found = packing.WordEncoder(VOCABULARY).texts([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_mix_meets_its_targets(odd, odd_rows, none):
    out = mixing.mix(odd).collect()
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(raw(r[1]).split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, mixing.targets([sizes[s] for s in names])))
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]] and r["target"] == float(want[r["source"]])
        assert sum(c["words"] for c in r["copies"]) == r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in names)
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], len(raw(r[1]).split())) for r in odd_rows)
    again = mixing.mix(odd.repartition(5)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in out)
    assert mixing.mix(none).count() == 0


def test_mix_of_more_sources_than_blocks(spark, monkeypatch):
    # was refused above 100,000 sources
    docs = spark.range(100_500).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 7 as int))").alias("text"), F.concat(F.lit("https://host"), "id").alias("source"))
    monkeypatch.setattr(mixing, "BLOCKS", 16)
    out = mixing.mix(docs).toPandas().sort_values("source", ignore_index=True)
    want = mixing.targets([int(i) % 7 + 1 for i in out["doc_id"]])
    assert out["target"].tolist() == [float(t) for t in want]
    assert all(abs(got - t) <= 1 for got, t in zip(out["taken"], want))
    tree = mixing.splitting_tree([5, 7, 90], 4, [1], [50, 2, 0, 50])
    assert tree.sum(axis=0).tolist() == [5, 7, 90] and tree.sum(axis=1).tolist() == [50, 2, 0, 50]


def test_mixed_copies_have_the_words_of_the_plan(odd):
    plan = mixing.mix(odd).agg(F.sum("taken")).first()[0]
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    assert sum(len(raw(r["text"]).split()) for r in out.collect()) == plan


def test_targets_stop_at_twice_the_size():
    got = [float(t) for t in mixing.targets([10, 1000, 10, 0])]
    assert got[0] == 20 and got[2] == 20 and got[3] == 0 and got[1] == 1530 - 40


def test_the_splitting_tree_keeps_quotas():
    tree = mixing.splitting_tree([5, 0, 70, 2 * 10**9], 8, [1])
    assert tree.sum(axis=0).tolist() == [5, 0, 70, 2 * 10**9] and (tree >= 0).all()
    assert sorted(mixing.permuted(np.arange(1000), np.full(1000, 1000), 3)) == list(range(1000))


def test_draws_of_any_size_are_hypergeometric(monkeypatch):
    few = np.random.default_rng(1)
    direct = np.array([few.hypergeometric(700, 300, 400) for _ in range(4000)])
    monkeypatch.setattr(mixing, "MOST_AT_ONCE", 50)
    rng = np.random.default_rng(2)
    halved = np.array([mixing.hypergeometric(rng, 700, 300, 400) for _ in range(4000)])
    assert abs(direct.mean() - halved.mean()) < 0.5 and abs(direct.std() / halved.std() - 1) < 0.06
    edges = [(5, 0, 3, 3), (0, 90, 4, 0), (60, 60, 120, 60), (60, 60, 0, 0)]
    assert [mixing.hypergeometric(rng, g, b, n) for g, b, n, _ in edges] == [e[3] for e in edges]
    monkeypatch.undo()
    big = mixing.hypergeometric(rng, 3 * 10**12, 10**12, 10**12)
    assert abs(big - 0.75e12) < 6 * (1e12 * 0.75 * 0.25 * 0.75) ** 0.5


def test_shards_hold_the_quotas_of_the_tree(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 11 as int))").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    out = mixing.mix(docs).collect()
    placed = defaultdict(Counter)
    for r in out:
        for c in r["copies"]:
            placed[c["layer"], c["shard"]][r["source"]] += 1
    drawn = Counter(c["layer"] for r in out for c in r["copies"])
    for layer in (0, 1):
        sizes = [sum(placed[layer, s].values()) for s in range(mixing.SHARDS)]
        assert sum(sizes) == drawn[layer] and max(sizes) - min(sizes) <= 8  # equal shares but for the halving
        for source in "012":
            parts = [placed[layer, s][source] for s in range(mixing.SHARDS)]
            mean = sum(parts) / len(parts)
            assert max(parts) < mean + 6 * (mean + 1) ** 0.5 and min(parts) > mean - 6 * (mean + 1) ** 0.5
    twice = [{c["shard"] for c in r["copies"]} for r in out if len(r["copies"]) > 1]
    assert np.mean([len(s) > 1 for s in twice]) > 0.6  # copies of a document spread over the shards


def test_a_text_is_cut_on_its_own_bytes():
    assert mixing.first_words(" a\tb\n\n ü  c d", 4) == " a\tb\n\n ü  c"


@pytest.fixture()
def labels(spark, odd_rows):
    known = [(r[0], int(i % 3 > 0), int(i % 4 == 0)) for i, r in enumerate(odd_rows[:60])]
    return spark.createDataFrame([*known, (None, 1, 1), (3, None, None), (4, 1, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")


def test_toxic_words_raise_the_severity(spark, odd, none, labels):
    rows = [(i, f"plain words number {i % 7} {'vile scum ' * (1 + i % 3) if i % 4 == 0 else ''}end") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flags = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    out = toxicity.rated(docs, flags.filter("doc_id < 300")).filter("doc_id >= 300").collect()
    assert all(r["toxic"] == (r["doc_id"] % 4 == 0) for r in out)
    mean = lambda k: np.mean([r["expected_severity"] for r in out if r["doc_id"] % 4 == 0 and r["doc_id"] % 3 == k])
    assert mean(2) > mean(0)
    rated = toxicity.rated(odd.withColumn("grade", F.lit("old")), labels)
    assert rated.count() == odd.count() and toxicity.rated(none, labels).count() == 0
    assert toxicity.rated(odd, labels.filter("toxic = 0")).filter("toxic").count() == 0


def test_quality_holds_on_rows_that_it_did_not_learn(spark, odd, none, labels):
    sf = "/root/testdata/sf0.1"
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.scored(docs.join(known.select("doc_id"), "doc_id", "left_semi"), known).join(known, "doc_id").filter("held_out")
    rows = out.select("predicted", "quality").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
    scored = quality.scored(odd, labels).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.scored(none, labels.filter("false")).count() == 0


def test_classes_do_not_depend_on_the_list_of_frequent_grams(spark, monkeypatch):
    """The list only orders n-grams: none, all of them or half of them give the classes of all pairs."""
    rnd = random.Random(11)
    common = [f"c{i}" for i in range(30)]
    texts = []
    for k in range(24):
        own = common[:rnd.randint(6, 30)] + [f"w{k // 3}_{i}" for i in range(rnd.choice([8, 40, 60]))]
        texts.append(" ".join(own[:-1] + [f"x{k}"] if k % 2 else own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < len(texts)
    grams = ngram_join.NGrams()
    every = np.unique(np.concatenate([grams(t.encode()) for t in texts]))
    for frequent in (np.zeros(0, np.uint64), every, every[::2]):
        monkeypatch.setattr(ngram_join, "frequent_grams", lambda docs, rows, chosen=frequent: chosen)
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.join_classes(docs).collect()}
        assert [got[k] for k in range(len(texts))] == root
