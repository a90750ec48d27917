"""The corpus pipeline, stage by stage against what the operators say."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tessellum.llm import quality, secrets, wordbpe
from tests.llm.test_dedup_and_benchmark import brute_components, brute_contamination, crowd


def test_stages(spark, documents, folder):
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    docs = documents
    stages = [f for _, f in corpus_pipeline.STAGES]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    after = stages[0](spark, docs, folder)
    assert after.columns == docs.columns and ids(after) == ids(quality.quality_scores(docs, labels).filter("predicted = 1"))
    docs = after.cache()
    after = stages[1](spark, docs, folder)
    alone = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], 80)
    assert after.columns == docs.columns and ids(after) == sorted(d for d, (_, _, kept) in alone.items() if kept)
    docs = after.cache()
    after = stages[2](spark, docs, folder)
    judged = brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert after.columns == docs.columns and ids(after) == sorted(r[0] for r in judged if not r[5])
    docs = after.cache()
    after = stages[3](spark, docs, folder)
    assert after.columns == docs.columns and ids(after) == ids(docs)
    assert secrets.secret_spans(after).filter("n_access + n_hex + n_random > 0").count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    clean = [r for r in after.collect() if not secrets.scan_text(texts[r["doc_id"]], secrets.default_models(secrets.SecretScan()), secrets.SecretScan())[1]]
    assert all((r["text"] or "") == texts[r["doc_id"]] for r in clean) and clean
    tokenizer, want = wordbpe.load(wordbpe.DEFAULT)[0], []
    for r in after.collect():
        held = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r["doc_id"], k, zlib.crc32(held[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(held), 2048))]
    final = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, final)) == sorted(want)


def test_stages_take_awkward_and_empty_documents(spark, awkward, empty, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, awkward, folder).count() == (7 if "dedup" in name else 8)
    good = corpus_pipeline.quality_stage(spark, awkward, folder)
    assert good.columns == awkward.columns and {r["doc_id"] for r in good.collect()} <= {None, *range(1, 7)}
    pieces = corpus_pipeline.packing_stage(spark, awkward, folder).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in pieces} == {None: 1, 1: 1, 2: 1, 3: 1, 4: 2, 5: 15, 6: 1}


def test_columns_of_any_kind_and_name(spark, awkward, folder):
    more = awkward.select("*", F.lit(1).alias("row_key"), F.lit(2).alias("_ROW_KEY"), F.create_map(F.lit("k"), F.lit("v")).alias("m"), F.lit(b"x").alias("raw"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, more, folder)
        assert got.schema.names == more.columns and got.count() == (7 if "near" in stage.__name__ else 8)


def test_the_session_keeps_its_settings(spark, folder):
    before = {name: spark.conf.get(name, None) for name in corpus_pipeline.ARROW_BOUNDS}
    corpus_pipeline.run(spark, folder)
    assert {name: spark.conf.get(name, None) for name in corpus_pipeline.ARROW_BOUNDS} == before


def test_near_copies_of_four_fifths_are_dropped(spark, make, folder):
    rows = crowd()
    want = {d for d, (_, _, kept) in brute_components(rows, 80).items() if kept}
    assert want < {d for d, (_, _, kept) in brute_components(rows, 85).items() if kept}
    df = make([(d, t, None, None, None) for d, t in rows])
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, df, folder).collect()} == want


def test_rows_that_share_an_id_are_told_apart(spark, make, folder):
    texts = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abc"}
    rows = [(1, texts["a"]), (2, texts["b"]), (2, texts["c"]), (2, texts["c"]), (3, texts["a"] + " x"), (0, texts["c"]), (None, texts["a"]), (4, ""), (5, None)]
    df = make([(d, t, None, None, None) for d, t in rows])
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, df, folder).collect()), key=repr)
    assert got == sorted([(1, texts["a"]), (2, texts["b"]), (0, texts["c"]), (None, texts["a"]), (4, ""), (5, None)], key=repr)
