import hashlib
import random
import re

import numpy as np
import pytest

from cardwatch.llm import char_tagger, personal_data

NAIVE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]"]


def naive(text):
    """The patterns as they stand, by backtracking search."""
    out = []
    for kind, pattern in enumerate(NAIVE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
            good = [True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                    13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0, 9 <= len(digits) <= 15][kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def card(rnd):
    digits = "".join(str(rnd.randint(0, 9)) for _ in range(15))
    return next(digits + str(i) for i in range(10) if personal_data.luhn(digits + str(i)))


def some(rnd, kind):
    if kind == 0:
        return f"{rnd.choice(['ann', 'bo.lee', 'x_y'])}.{rnd.randint(10, 99)}@mail{rnd.randint(1, 9)}.example.com"
    if kind == 1:
        return ".".join(str(rnd.randint(0, 255)) for _ in range(4))
    return card(rnd) if kind == 2 else f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"


def told(n):
    rnd = random.Random(n)
    words = "the of and blue größe time naïve lamp stone river house".split()
    say = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    rows = [(i, f"{say(rnd.randint(1, 40))} {some(rnd, i % 4)} {say(rnd.randint(1, 20))}.", "x") for i in range(400)]
    rows += [(1000 + i, say(30), "x") for i in range(50)]
    rows += [(2000 + i, f"{say(9)} {some(rnd, 3)} {some(rnd, 2)} {say(9)}", "x") for i in range(60)]
    return rows + [(3000, None, None), (None, "", ""), (3001, f"{say(20000)} {some(rnd, 0)} {say(5)}", ""), (3001, rows[1][1], ""), rows[1],
                   (3002, "1" * 300_000 + "." * 1000 + "a" * 300_000 + "@", ""), (3003, "a@b.cd_e@f.g 1.2.3.4.5.6.7.8", "")]


DDL = "doc_id long, text string, spans string"


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(7)
    for _ in range(4000):
        text = "".join(rnd.choice("0123456789009911..@@@+- ()aZ_é%\n") for _ in range(rnd.randint(0, 60)))
        assert sorted(personal_data.base(text)) == sorted(naive(text)), text
        parts = [some(rnd, rnd.randint(0, 3)) for _ in range(3)]
        text = rnd.choice([" ", ", ", "-", ".", ""]).join(parts)
        assert sorted(personal_data.base(text)) == sorted(naive(text)), text


def test_gradients_and_best_paths():
    rnd = np.random.default_rng(4)
    weights = {k: w.astype(np.float64) for k, w in char_tagger.fresh(3, 2).items()}
    table, texts = char_tagger.Symbols(), ["a 1.2.3.4 b", "x@y.z +12"]
    x, tags = np.zeros((2, 12), np.int64), np.zeros((2, 12), np.int64)
    for i, (t, spans) in enumerate(zip(texts, ([(1, 2, 9)], [(0, 0, 5)]))):
        x[i, :len(t)] = char_tagger.symbols(t, table)
        tags[i, :len(t)] = personal_data._tags(spans, t)
    _, grads = char_tagger.loss(weights, x, tags)
    for k, w in weights.items():
        used = [tuple(i) for i in np.argwhere(np.abs(grads[k]) > 1e-4)]
        for at in [used[int(rnd.integers(len(used)))] for _ in range(4)]:
            kept, d = w[at], 1e-5
            w[at] = kept + d
            up = char_tagger.loss(weights, x, tags)[0]
            w[at] = kept - d
            down = char_tagger.loss(weights, x, tags)[0]
            w[at] = kept
            assert abs((up - down) / (2 * d) - grads[k][at]) < 1e-3 * max(1, abs(grads[k][at])), k
    # best path and whole sum against all paths of a short window
    score, _ = char_tagger.unary(weights, x[:1, 2:6])
    moves = weights["moves"] + char_tagger.MOVES
    paths = np.stack(np.meshgrid(*[np.arange(11)] * 4, indexing="ij"), -1).reshape(-1, 4)
    worth = score[0, np.arange(4), paths].sum(1) + moves[paths[:, :-1], paths[:, 1:]].sum(1)
    assert (char_tagger.decode(weights, x[:1, 2:6], np.array([False]))[0] == paths[worth.argmax()]).all()
    path = np.array([[4, 5, 5, 5]])
    top = worth.max()
    whole = top + np.log(np.exp(worth - top).sum())
    mine = score[0, np.arange(4), path[0]].sum() + moves[path[0, :-1], path[0, 1:]].sum()
    assert abs(char_tagger.loss(weights, x[:1, 2:6], path)[0] - (whole - mine)) < 1e-4


def test_skipped_windows_are_empty_whatever_the_weights():
    rnd = random.Random(1)
    texts = [t for _, t, _ in told(3) if t and len(t) < 3000] + ["".join(rnd.choice("ab .-%@+1") for _ in range(700)) for _ in range(20)]
    for seed in range(2):
        weights = char_tagger.fresh(4, seed)
        weights["bias"] = np.random.default_rng(seed).normal(0, 3, 11).astype(np.float32)
        none = [[] for _ in texts]
        assert personal_data.added(texts, none, weights) == personal_data.added(texts, none, weights, all_windows=True)


def test_reconciliation_is_the_best_choice():
    rnd = random.Random(3)
    for _ in range(200):
        votes = {}
        for _ in range(rnd.randint(0, 8)):
            s = rnd.randint(0, 20)
            votes[rnd.randint(0, 3), s, s + rnd.randint(1, 8)] = rnd.randint(1, 9)
        taken = [(0, 5, 9)] if rnd.random() < 0.5 else []
        spans = list(votes)
        apart = lambda a, b: a[2] <= b[1] or b[2] <= a[1]
        best = 0
        for mask in range(1 << len(spans)):
            chosen = [s for i, s in enumerate(spans) if mask >> i & 1]
            if all(apart(a, b) for i, a in enumerate(chosen) for b in chosen[i + 1:]) and all(apart(a, b) for a in chosen for b in taken):
                best = max(best, sum(votes[s] for s in chosen))
        got = personal_data.reconciled(votes, taken)
        assert sum(votes[s] for s in got) == best and all(apart(a, b) for i, a in enumerate(got) for b in got[i + 1:])


def test_find_keeps_base_spans_and_adds_swallowed_ones(spark):
    rows = told(11)
    got = personal_data.find(spark.createDataFrame(rows, DDL).repartition(4)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[-1])
    wanted = []
    for name, text, _ in rows:
        spans = sorted(naive(text) if text is None or len(text) < 100_000 else [] if text.startswith("1") else naive(text)) if text else []
        listed = ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        wanted.append((name, *(sum(s[0] == k for s in spans) for k in range(4)), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((tuple(r)[:-1] for r in got), key=key) == sorted(wanted, key=key)
    by_name = {r["doc_id"]: r["spans"] for r in got}
    texts = {r[0]: r[1] for r in rows}
    assert all(by_name[1000 + i] == "" for i in range(50))
    both = 0
    for i in range(2000, 2060):
        spans = [s.split(":") for s in by_name[i].split(",") if s]
        both += sorted(k for k, *_ in spans) == ["card", "phone"]
        for k, s, e in spans:
            assert re.fullmatch(NAIVE[personal_data.KINDS.index(k)], texts[i][int(s):int(e)])
    assert both >= 50  # swallowed by the patterns, found by the tagger


@pytest.mark.parametrize("rows", [[], [(1, "no data here", ""), (2, None, ""), (3, "only 12 and a@b", "")]])
def test_nothing_to_learn_from(spark, rows):
    got = personal_data.find(spark.createDataFrame(rows, DDL)).collect()
    assert sorted((r["doc_id"], r["spans"]) for r in got) == [(r[0], "") for r in rows]
