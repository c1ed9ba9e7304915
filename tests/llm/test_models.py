"""Packing and the quality classifier; the pipeline's stages."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import decontamination, ngram_join, packing, quality_classifier

from . import tables

P = pytest.importorskip("public_tokenizers")


def ids_of(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return {d: [*t.encode(x or "", add_special_tokens=False).ids, 1] for d, x in rows}


@pytest.mark.parametrize("shares", [None, {"src0": 3.0, "src1": 1.0}])
def test_packing(spark, shares):
    rows = [*tables.odd_texts(), (20, "<|endoftext|> is 'll text 你好  \n\n x"), *[(30 + i, tables.text(150)) for i in range(60)]]
    out = packing.pack(tables.clashing(tables.documents(spark, rows)), P.path("byte_bpe_50k.json"), shares=shares, lanes=3).collect()
    ids = ids_of(rows)
    at = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at.get(r.doc_id, 0) and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id] = r.start + r.length
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(piece) == r.ids_crc32 and bytes(r.ids) == piece
    assert at == {d: len(x) for d, x in ids.items()}
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert sorted(filled) == list(range(len(filled))) and all(n <= 2048 and n & (n - 1) == 0 for n in filled.values())
    assert sum(n == 2048 for n in filled.values()) >= len(filled) - 3 * 11


def test_packing_empty_and_copies(spark):
    assert packing.pack(tables.documents(spark, []), P.path("byte_bpe_50k.json")).count() == 0
    twice = packing.pack(tables.documents(spark, [(1, "a b c")] * 3), P.path("byte_bpe_50k.json")).collect()
    assert sum(r.length for r in twice) == 3 * len(ids_of([(1, "a b c")])[1])


def test_proportions_and_accounts():
    queues = {"a": [(i, 1000) for i in range(60)], "b": [(100 + i, 50) for i in range(400)]}
    lane = packing.Lane(queues, {"a": 0.75, "b": 0.25}, {}, least=64)
    lane.run(0)
    share = {}
    for d, _, n, seq, _ in lane.pieces:
        share.setdefault(seq, [0, 0])[d >= 100] += n
    full = [x for x in share.values() if sum(x) == 2048]
    assert len(full) == 80_000 // 2048 and abs(np.mean([x[0] for x in full]) / 2048 - 0.75) < 0.02
    # An account of 500 owed to b is paid first.
    owed = packing.Lane({s: list(q) for s, q in queues.items()}, {"a": 0.75, "b": 0.25}, {"b": 500.0, "a": -500.0}, least=64)
    owed.run(0)
    assert sum(n for d, _, n, seq, _ in owed.pieces if seq == 0 and d >= 100) > share[0][1]


def test_packing_keeps_ids_as_they_are(spark):
    ids = [None, 2**60 + 1, 2**53 + 1, -1]
    out = packing.pack(tables.documents(spark, [(i, "a b c") for i in ids]), P.path("byte_bpe_50k.json"), lanes=1).collect()
    assert sorted(({r.doc_id for r in out}), key=str) == sorted(ids, key=str) and sum(r.length for r in out) == 4 * out[0].doc_tokens
    named = packing.pack(tables.documents(spark, [(1, "x")]).withColumn("doc_id", F.lit("one")), P.path("byte_bpe_50k.json")).collect()
    assert [r.doc_id for r in named] == ["one"]


def test_copies_of_a_row_are_dealt_to_many_lanes(spark):
    df = tables.documents(spark, [(1, tables.text(300))]).crossJoin(spark.range(200)).drop("id")
    out = packing.pack(df, P.path("byte_bpe_50k.json"), lanes=8)
    assert out.agg(F.sum("length")).first()[0] == 200 * out.first().doc_tokens
    # Every lane that has rows ends in sequences shorter than a window.
    sizes = [r["n"] for r in out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(n < packing.LENGTH for n in sizes) >= 8 and all(n & (n - 1) == 0 for n in sizes)


def labelled(spark, n=400):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        t = tables.text(rng.randint(20, 80), rng)
        texts.append((i, t if good else " ".join(w + rng.choice(["***", "!!"]) for w in t.split())))
        labels.append((i, int(good if rng.random() < 0.98 else not good), 0))
    return tables.documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier(spark):
    docs, labels = labelled(spark)
    out = quality_classifier.score_documents(tables.clashing(docs), labels)
    rows = {r.doc_id: r for r in out.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for d, r in rows.items())
    held = [d for d, r in rows.items() if r.held_out]
    assert len(held) > 60 and np.mean([rows[d].predicted == truth[d] for d in held]) > 0.93
    # Held-out labels teach nothing: turning them over changes no score.
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier.score_documents(docs, turned).collect()}
    assert again == {d: r.score for d, r in rows.items()}


def test_classifier_edge_cases(spark):
    docs, labels = labelled(spark, 40)
    odd = tables.documents(spark, tables.odd_texts())
    for l in (labels.limit(0), labels.withColumn("quality", F.lit(1)), labels.withColumn("quality", F.lit(None).cast("int")), labels):
        out = quality_classifier.score_documents(odd.union(odd), l).collect()
        assert len(out) == 22 and all(0 <= r.score <= 1 for r in out)
    assert quality_classifier.score_documents(tables.documents(spark, []), labels).count() == 0
    kept = quality_classifier.keep_good(docs, labels, cut=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = [t or "" for _, t in tables.odd_texts()]
    together = quality_classifier._batch_features(pa.array(texts))
    alone = np.concatenate([quality_classifier._batch_features(pa.array([t])) for t in texts])
    assert np.allclose(together, alone)


def test_scores_are_sums_of_table_entries(spark):
    """The vectorised score against looking up every table by hand."""
    import math

    docs, labels = labelled(spark, 200)
    model = quality_classifier.train(docs, labels)
    texts = [r.text for r in docs.collect()] + [t or "" for _, t in tables.odd_texts()]
    import pyarrow as pa

    x = quality_classifier._batch_features(pa.array(texts))
    for row, got in zip(x, model.score(x)):
        bin_ = lambda edges, v: sum(1 for e in edges if e <= v)
        z = model.base + sum(t[bin_(e, v)] for e, t, v in zip(model.edges, model.tables, row))
        z += sum(t[bin_(model.coarse[f], row[f])][bin_(model.coarse[g], row[g])] for f, g, t in model.pairs)
        assert abs(got - 1 / (1 + math.exp(-z))) < 1e-9
    assert model.pairs and any(t.any() for t in model.tables)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, labels = labelled(spark, 120)
    item = tables.text(20, random.Random(77)).replace("\n", " ")
    extra = [(1000, item + " " + tables.text(20)), (1001, tables.text(60) + ' token = "abcdef123456"'), (1002, None)]
    docs = docs.union(tables.documents(spark, extra)).union(docs.filter("doc_id = 3").withColumn("doc_id", F.lit(2000).cast("long")))
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    now = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        out.write.parquet(f"{sf}/out{i}")
        now = spark.read.parquet(f"{sf}/out{i}")
        seen.append({r.doc_id for r in now.select("doc_id").distinct().collect()})
        assert i == 4 or now.dtypes == docs.dtypes
    # Every stage against a plain version, on what its predecessor kept.
    before = {r.doc_id: r.text for r in docs.collect()}
    stage_docs = lambda i: {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/out{i}").collect()}
    model = quality_classifier.train(docs, labels)
    import pyarrow as pa

    score = dict(zip(before, model.score(quality_classifier._batch_features(pa.array(list(before.values()))))))
    assert stage_docs(0) == {d: t for d, t in before.items() if score[d] >= quality_classifier.CUT}
    groups = ngram_join.brute(list(stage_docs(0).items()))
    assert stage_docs(1) == {d: t for d, t in stage_docs(0).items() if groups[d][1] == d}
    assert stage_docs(2) == {d: t for d, t in stage_docs(1).items() if not decontamination.brute(t, [("1", item)])[4]}
    secret = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{6,})|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"
    assert stage_docs(3).keys() == stage_docs(2).keys()
    for d, t in stage_docs(2).items():
        assert (stage_docs(3)[d] == t) == (not re.search(secret, t or "")) and not re.search("abcdef123456", stage_docs(3)[d] or "")
    tokens = packing._encoder(P.path("byte_bpe_50k.json"))[1]
    packed = {}
    for r in now.collect():
        packed.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for d, t in stage_docs(3).items():
        n = len(tokens([t or ""])[0]) + 1
        assert sum(x[1] for x in packed[d]) == n and {x[2] for x in packed[d]} == {n}
    assert 1000 in seen[1] and 1000 not in seen[2] and 2000 not in seen[1] and 1001 in seen[4]
    assert corpus_pipeline.run(spark, sf).count() == now.count()


def test_pipeline_stages_bear_odd_tables(spark, tmp_path):
    """Empty tables, repeated rows, null ids and texts: every stage keeps its columns and gives a row or none for each."""
    import corpus_pipeline

    sf = str(tmp_path)
    _, labels = labelled(spark, 40)
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "a b c"), (None, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    odd = tables.documents(spark, tables.odd_texts() + [(None, None), (None, "one two")])
    for docs in (odd.union(odd), odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            n = out.count()
            assert name == "packing" or (out.columns == docs.columns and n <= docs.count())
