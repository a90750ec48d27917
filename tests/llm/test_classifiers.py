"""Held-out accuracy of the classifiers, and their folds."""

import math
import zlib

import numpy as np
import pytest

from tessellum.llm import quality, toxicity
from tessellum.llm.folds import training_labels


@pytest.fixture(scope="module")
def larger(spark):
    from pathlib import Path

    path = "/root/testdata/sf0.01"
    if not Path(path).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{path}/documents.parquet").cache(), spark.read.parquet(f"{path}/labels.parquet").cache()


def test_quality_on_held_out_labels(larger):
    docs, labels = larger
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r for r in rows if r["quality"] == 1]
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95 and np.mean([r["predicted"] for r in good]) > 0.95


def test_toxicity_on_held_out_labels(larger):
    docs, labels = larger
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    assert np.mean([r["predicted"] for r in clean]) < 0.03 and np.mean(toxic) > np.mean([r["score"] for r in clean]) + 0.15
    assert np.mean([x >= 0.7 for x in toxic]) >= 0.4 and ranked_above(toxic, [r["score"] for r in clean]) > 0.85


def ranked_above(ones, others):
    """The share of pairs in which the one is ranked above the other."""
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in others])


def test_folds(spark, make):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(50)] + [(1, 0, 1), (None, 1, 1), (60, None, 1), (61, 2, 1)], "doc_id bigint, quality int, toxic int")
    got = dict(map(tuple, training_labels(labels, "quality", 4, 2).collect()))
    assert got == {i: i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 4 != 2}


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows(spark, awkward, empty, larger, score):
    _, labels = larger
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 1)], "doc_id bigint, quality int, toxic int")
    for taught in (none, one):
        rows = score(awkward, taught).collect()
        assert len(rows) == 8 and {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {0}
    assert score(empty, labels).count() == 0
    held = {r["doc_id"]: r["held_out"] for r in score(awkward, none).collect()}
    folds, out = (4, 2) if score is quality.quality_scores else (3, 1)
    assert held == {None: False} | {i: zlib.crc32(str(i).encode()) % folds == out for i in range(1, 7)}


def test_scores_are_probabilities(larger, awkward):
    _, labels = larger
    docs, _ = larger
    both = docs.select("doc_id", "text").unionByName(awkward.select((awkward.doc_id + 10**7).alias("doc_id"), "text"))
    for rows in (quality.quality_scores(both, labels).collect(), toxicity.toxicity_scores(both, labels).collect()):
        assert len(rows) == docs.count() + 8 and all(0 <= r["score"] <= 1 for r in rows)


def test_ftrl_learns_a_word_and_stays_sparse():
    draw = np.random.default_rng(0)
    spec = toxicity.ToxicityModelSpec(bits=12, l1=4.0)
    examples = [(np.unique(np.append(draw.integers(10, 4000, 30), np.full(int(i % 5 == 0), 7))), int(i % 5 == 0)) for i in range(800)]
    at, w = toxicity.train(examples, spec)
    weights = dict(zip(at.tolist(), w.tolist()))
    assert weights[7] > 2 and len(at) < 400 and weights[1 << 12] < 0


def brute_ftrl(examples, spec):
    """FTRL-proximal one coordinate at a time, in dictionaries."""
    z, n, bias = {}, {}, 1 << spec.bits

    def weight(i):
        total = z.get(i, 0.0)
        if i != bias:
            if abs(total) <= spec.l1:
                return 0.0
            total -= math.copysign(spec.l1, total)
        return -total / ((spec.beta + math.sqrt(n.get(i, 0.0))) / spec.alpha + spec.l2)

    for _ in range(spec.epochs):
        for coordinates, label in examples:
            at = [*coordinates.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for i in at:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / spec.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if i == bias or weight(i) != 0}


def test_ftrl_against_a_plain_restatement():
    draw = np.random.default_rng(3)
    spec = toxicity.ToxicityModelSpec(bits=8, l1=1.5, l2=0.1, epochs=3)
    examples = [(np.unique(np.append(draw.integers(0, 200, 12), np.full(int(i % 4 == 0), 9))), int(i % 4 == 0)) for i in range(150)]
    at, w = toxicity.train(examples, spec)
    want = brute_ftrl(examples, spec)
    assert set(at.tolist()) == set(want) and np.allclose(w, [want[i] for i in at.tolist()])


def test_features_are_words_pairs_and_skip_pairs():
    import pyarrow as pa

    from tessellum.llm import arrowtext as at

    texts = ["a b c d", "b c", "", "A, b! c"]
    block = next(at.blocks(pa.array(texts)))
    found, owner = toxicity.features(block, 40)
    sets = [set(found[owner == i].tolist()) for i in range(4)]
    assert [len(x) for x in sets] == [4 + 3 + 2, 3, 0, 3 + 2 + 1] and sets[1] < sets[0] and sets[3] < sets[0]


def test_an_id_of_many_texts_is_learned_from_once(spark, make):
    rows = [(i, f"word{i} text{k}" + (" nasty" if i % 2 else ""), None, None, None) for i in range(40) for k in range(30)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    least = make([r for r in rows if r[1].split()[1] == "text0"])
    spec = toxicity.ToxicityModelSpec(train_rows=25, l1=0.1, epochs=2)
    many = {r["score"] for r in toxicity.toxicity_scores(make(rows), labels, spec).filter("doc_id = 1").collect()}
    few = {r["score"] for r in toxicity.toxicity_scores(least, labels, spec).filter("doc_id = 1").collect()}
    assert few <= many


def test_discriminant_against_a_plain_restatement(larger):
    """Class means and shrunken covariances from the rows themselves, densities by a solver and a determinant."""
    docs, labels = larger
    spec = quality.QualityModelSpec()
    table = quality.measured(docs)
    rows = {r["doc_id"]: np.array(r[1:]) for r in table.collect()}
    taught = dict(map(tuple, training_labels(labels, "quality", 4, 2).collect()))
    by_class = [np.stack([rows[i] for i, y in taught.items() if y == c and i in rows]) for c in (0, 1)]
    count = [len(x) for x in by_class]
    scatter = [np.cov(x.T, bias=True) for x in by_class]
    pooled = (count[0] * scatter[0] + count[1] * scatter[1]) / sum(count)

    def log_density(x, c):
        cov = (1 - spec.pooled) * scatter[c] + spec.pooled * pooled
        cov = (1 - spec.ridge) * cov + spec.ridge * np.trace(cov) / len(cov) * np.eye(len(cov))
        off = x - by_class[c].mean(axis=0)
        return -0.5 * off @ np.linalg.solve(cov, off) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(count[c] / sum(count))

    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, labels).collect()}
    for i in list(got)[:300]:
        ratio = log_density(rows[i], 1) - log_density(rows[i], 0)
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(ratio, -500, 500)))) < 1e-6


def test_statistics_against_a_plain_restatement(awkward):
    import pyarrow as pa

    from tessellum.llm import arrowtext as at

    texts = ["A cat, a cat! Sat 42 times.\nA cat, a cat! Sat 42 times.\n\n#tag #tag $5", "", "one", "é ü 日本"]
    got = quality.statistics(next(at.blocks(pa.array(texts))))
    for row, t in zip(got, texts):
        words = t.split()
        chars, some = max(sum(map(len, words)), 1), max(len(words), 1)
        lines = [x for x in t.split("\n") if x]
        stops, symbols = sum(t.count(c) for c in ".!?"), sum(t.count(c) for c in "#*$%&|<>")
        signs = sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in t)
        want = {
            "words": np.log1p(len(words)),
            "word_length": np.log1p(sum(map(len, words)) / some),
            "word_spread": np.log1p(np.std([len(w) for w in words]) if words else 0),
            "symbols": np.log(0.002 + symbols / chars),
            "digits": np.log(0.01 + sum(c in "0123456789" for c in t) / chars),
            "capitals": np.log(0.005 + sum("A" <= c <= "Z" for c in t) / chars),
            "stops": np.log(0.01 + stops / some),
            "line_words": np.log1p(len(words) / max(len(lines), 1)),
            "repeated_lines": np.sqrt((len(lines) - len(set(lines))) / max(len(lines), 1)),
            "distinct_words": np.log(0.02 + len({w.lower() for w in words}) / some),
            "sentence_words": np.log1p(len(words) / (stops + 1)),
            "other_signs": np.log(0.005 + (signs - symbols - stops) / chars),
        }
        assert {k: round(float(row[quality.STATISTICS.index(k)]), 9) for k in want} == {k: round(float(v), 9) for k, v in want.items()}
