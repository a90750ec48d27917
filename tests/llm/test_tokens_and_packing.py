"""Token counts and packing against the tokenizer library, and exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessellum.llm import packing, tokencount, wordbpe

PARTS = ["a", "B", "'s", "it's", "'", "é", "é", "≠", " ", "\n", "\x0b", " ", "́", "12", "½", "...", "!", "<|startoftext|>", "<|endoftext|>", "<|", "Σ", "İ", "한국", "日本", "\U0001f600", "\x00", "\x85", "aaaaaaa", "ſ", "_", "ß"]


@pytest.fixture(scope="module")
def tokenizer():
    return wordbpe.load(wordbpe.DEFAULT)[0]


@pytest.fixture(scope="module")
def odd(make):
    draw = random.Random(1)
    return make([(i, "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))), None, None, None) for i in range(1500)])


def test_counts_equal_the_library(documents, awkward, odd, tokenizer):
    for df in (documents, awkward, odd):
        got = sorted(map(tuple, tokencount.token_counts(df).collect()), key=repr)
        want = []
        for r in df.collect():
            n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
            want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 2048))
        assert got == sorted(want, key=repr)


def test_special_strings_beside_each_other_and_at_edges(make, tokenizer):
    texts = ["<|endof", "text|><|endoftext|>", "<|startoftext|", "><|endoftext|><|", "e<|endoftext|>\u0301", "'<|endoftext|>s <|startoftext|><|startoftext|>re", "<|endoftext|>" * 3000]
    rows = make([(i, t, None, None, None) for i, t in enumerate(texts)]).coalesce(1)
    got = [r["n_tokens"] for r in tokencount.token_counts(rows).orderBy("doc_id").collect()]
    assert got == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_an_empty_table(empty):
    assert tokencount.token_counts(empty).count() == 0


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError):
        wordbpe.load("byte_bpe_50k.json")


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing_holds_every_token(documents, awkward, odd, tokenizer):
    docs = documents.unionByName(awkward, allowMissingColumns=True).unionByName(odd.withColumn("doc_id", odd.doc_id + 10**6), allowMissingColumns=True)
    rows = packing.pack(docs, with_ids=False).collect()
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a : a + 2048], "<u4").tobytes()
            want[r["doc_id"], k, a, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    n = check_sequences(rows, 2048)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) * 1.01 + 1


def test_sequences_bring_their_ids(documents):
    p = packing.Packing(capacity=512)
    rows = packing.sequences(documents, p).collect()
    assert all(len(bytes(r["ids"])) == 4 * r["n_tokens"] <= 4 * 512 for r in rows)
    assert sum(len(r["pieces"]) for r in rows) == packing.pack(documents, p).count()


def test_packing_of_an_empty_table(empty):
    assert packing.pack(empty).count() == 0


def held_by(runs, capacity):
    held = Counter()
    for run in runs:
        assert sum(n * side for n, side in run.slots) + run.room == capacity and run.room >= 0 and run.count > 0
        for n, side in run.slots:
            held[n] += side * run.count
    return held


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    draw = random.Random(seed)
    counts = Counter(draw.choice([draw.randint(1, 100), draw.randint(30, 100), 100, 51]) for _ in range(draw.randint(1, 400)))
    total = sum(n * c for n, c in counts.items())
    for groups, slack, rounds in ((1, 0, 1), (5, 3, 4), (40, 100, 9), (32, 2, 0)):
        p = packing.Packing(capacity=100, groups=groups, slack=slack, rounds=rounds)
        for times in (1, 10**9):
            runs = packing.plan({n: c * times for n, c in counts.items()}, p)
            assert held_by(runs, 100) == {n: c * times for n, c in counts.items()}
            assert sum(r.count for r in runs) >= -(-total * times // 100)
    assert packing.plan({}, packing.Packing()) == []


def test_configurations_make_the_packing(spark):
    """Nearly all large pieces of the table, and of ten times as many of other lengths, stand in configured sequences."""
    from pathlib import Path

    path = "/root/testdata/sf0.01/documents.parquet"
    if not Path(path).exists():
        pytest.skip("no test tables")
    p = packing.Packing()
    table = {r["length"]: r["count"] for r in packing.pieces(spark.read.parquet(path), p).groupBy("length").count().collect()}
    draw = np.random.default_rng(4)
    drawn = Counter(np.clip(draw.lognormal(6.4, 0.7, 11_000).astype(int), 1, 2048).tolist())
    for counts in (table, drawn):
        runs = packing.plan(counts, p)
        assert held_by(runs, 2048) == counts
        large = sum(c for n, c in counts.items() if 256 < n < 2048)
        configured = sum(r.count * side for r in runs if r.configured for n, side in r.slots if n > 256)
        assert configured >= 0.9 * large
        assert sum(r.count for r in runs) <= -(-sum(n * c for n, c in counts.items()) // 2048) * 1.01


def test_groups_are_of_equal_cardinality_and_rounded_up():
    draw = random.Random(7)
    for _ in range(30):
        pieces = sorted((draw.choice([draw.randint(1, 30), 17]) for _ in range(draw.randint(1, 80))), reverse=True)
        groups = draw.randint(1, len(pieces))
        rounded = Counter()
        for g in range(groups):
            a, b = len(pieces) * g // groups, len(pieces) * (g + 1) // groups
            rounded[pieces[a]] += b - a
        sizes, demand = packing.grouped(Counter(pieces), groups)
        assert list(zip(sizes.tolist(), demand.tolist())) == sorted(rounded.items(), reverse=True)


def test_knapsack_against_all_multisets():
    draw = random.Random(2)
    for _ in range(40):
        sizes = np.array(sorted({draw.randint(3, 30) for _ in range(4)}))
        values = np.array([draw.choice([0, draw.random()]) for _ in sizes])
        best = [0.0] * 61
        for room in range(61):
            best[room] = max([0.0, *(best[room - s] + v for s, v in zip(sizes.tolist(), values.tolist()) if s <= room)])
        value, chosen = packing._knapsack(values, sizes, 60)
        assert abs(value - best[60]) < 1e-9 and abs((chosen * values).sum() - value) < 1e-9 and (chosen * sizes).sum() <= 60


def test_a_third_of_all_pieces_alike():
    counts = {900: 10**6, 100: 50_000, 1500: 3, 2048: 7}
    runs = packing.plan(counts, packing.Packing())
    assert held_by(runs, 2048) == counts and sum(r.count for r in runs) <= 500_000 + 3 + 7


def test_configurations_meet_their_demand():
    sizes, demand = np.array([70, 50, 30]), np.array([10.0, 21.0, 40.0])
    chosen = packing.configurations(sizes, demand, 100)
    made = sum(np.array(p) * t for p, t in chosen)
    assert np.allclose(made, demand) and sum(t for _, t in chosen) < 34
    assert all((pattern * sizes).sum() <= 100 for pattern, _ in chosen)
