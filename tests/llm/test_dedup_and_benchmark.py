"""Near-duplicates and decontamination against brute force."""

import hashlib
import random
import re
import string

import pytest

from tessellum.llm import decontam, minhash
from tessellum.llm.components import connected_components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, similarity=85):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if sets[d]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_documents_against_brute_force(documents):
    want = brute_components([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert as_dict(minhash.near_duplicates(documents)) == want


def crowd(seed=3, groups=3, size=60):
    """Groups of copies of a text with ever more words changed: some are linked, many are similar without a link, and chains hold."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    rows, doc = [], 0
    for _ in range(groups):
        base = [word() for _ in range(120)]
        for k in range(size):
            text = list(base)
            for _ in range(draw.randint(0, 6 if k % 3 else 1)):
                text[draw.randrange(len(text))] = word()
            rows.append((doc, " ".join(text)))
            doc += 1
    return rows


@pytest.mark.parametrize("spec", [minhash.NearDuplicates(), minhash.NearDuplicates(long=8, block=16, order_sample=4, broadcast_ids=0)])
def test_crowded_groups_against_brute_force(make, spec):
    rows = crowd()
    df = make([(d, t, None, None, None) for d, t in rows])
    assert as_dict(minhash.near_duplicates(df, spec)) == brute_components(rows)


def test_hot_keys_change_nothing(make, monkeypatch):
    """Classes, lists and centres that are joined by broadcast, and sets in blocks of a few bytes."""
    from tessellum.llm import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rows = crowd(seed=5, groups=2, size=40)
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000 + i, "one two") for i in range(20)] + [(3000 + i, "") for i in range(20)]
    df = make([(d, t, None, None, None) for d, t in rows] + [(None, rows[3][1], None, None, None)] * 9)
    spec = minhash.NearDuplicates(long=8, block=16, block_bytes=3000, beside=2)
    got = as_dict(minhash.near_duplicates(df, spec))
    assert got.pop(None)[1:] == (None, True) and got == brute_components(rows)


def test_common_elements_of_sets():
    import numpy as np

    draw = np.random.default_rng(1)
    one, two = ([np.unique(draw.integers(0, 400, draw.integers(1, 200)).astype(np.uint64) << np.uint64(40)) for _ in range(n)] for n in (7, 11))
    want = [[len(np.intersect1d(a, b)) for b in two] for a in one]
    assert minhash._common(one, two).tolist() == want == minhash._common(one, two, cells=30).tolist()
    assert not minhash._common([np.array([1], np.uint64)], [np.array([2], np.uint64)]).any()


def test_near_duplicates_of_awkward_rows(awkward, empty):
    got = sorted(map(tuple, minhash.near_duplicates(awkward).collect()), key=repr)
    by_id = {r[0]: r[1:4] for r in got}
    assert len(got) == 8 and by_id[None] == (4, None, True)
    assert by_id[1] == by_id[2][:0] + (0, 1, True) and by_id[2] == (0, 2, True) and by_id[3] == (0, 3, True)
    assert by_id[4] == (1, 4, True) and by_id[5] == (1, 5, True)
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (201, 200), (7, 7), (None, 3)], "a bigint, b bigint")
    got = dict(map(tuple, connected_components(links).collect()))
    assert got == {i: 0 for i in range(101)} | {200: 200, 201: 200}


def brute_contamination(docs, items, width=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= owners
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("spec", [decontam.Decontamination(), decontam.Decontamination(block_windows=900, expand=7, copies=1)])
def test_contamination_against_brute_force(spark, documents, folder, make, awkward, spec):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    short = spark.createDataFrame([(900, "one"), (901, "Ünïcödé 日本語"), (902, ""), (903, None), (None, "word word"), (900, "one")], "item_id bigint, text string")
    every = items.select("item_id", "text").unionByName(short)
    docs = documents.unionByName(awkward, allowMissingColumns=True)
    got = decontam.contamination(docs, every, spec)
    want = brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in every.filter("item_id IS NOT NULL").collect()])
    assert sorted((tuple(r[:6]) for r in got.collect()), key=repr) == want


def test_proximity(spark, make):
    item = " ".join(f"w{i}" for i in range(13))
    near = item.replace("w5", "extra w5").replace("w9 w10", "w10 w9")
    df = make([(1, item, None, None, None), (2, near, None, None, None), (3, item.replace("w5", ""), None, None, None)])
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontam.contamination(df, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()}
    assert got == {1: (13, 1), 2: (0, 1), 3: (0, 0)}


def test_blocks_change_nothing(spark, make):
    """Items that repeat, that share windows and that are long; documents of common words, repeated and without ids."""
    draw = random.Random(8)
    word = lambda: draw.choice(["a", "b", "the", "of", f"w{draw.randint(0, 40)}"])
    shared = [word() for _ in range(30)]
    texts = [" ".join([word() for _ in range(draw.randint(0, 20))] + shared[: draw.randint(0, 30)]) for _ in range(12)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[3]) for i in range(8)] + [(3, texts[3])] * 5, "item_id bigint, text string")
    rows = [(i, " ".join([word() for _ in range(40)]) + " " + texts[i % 12].replace(" of", "  x of", 1), None, None, None) for i in range(24)]
    docs = make(rows + [(None, texts[3], None, None, None)] * 7 + [rows[5]] * 3)
    results = []
    for spec in (decontam.Decontamination(), decontam.Decontamination(block_windows=60, copies=2), decontam.Decontamination(block_windows=17, expand=3, copies=3)):
        results.append(sorted((tuple(r) for r in decontam.contamination(docs, items, spec).collect()), key=repr))
    assert results[0] == results[1] == results[2] and len(results[0]) == 34 and max(r[-1] for r in results[0]) > 10
    assert [r[:6] for r in results[0]] == brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_contamination_of_empty_tables(spark, empty, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contamination(empty, none).count() == 0
    assert decontam.contamination(documents, none).filter("contaminated OR n_hit > 0").count() == 0
