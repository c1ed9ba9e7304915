"""Exact deduplication against a plain version, over micro-batches, later batches and clashing digests."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rankloom.llm import exact_dedup as x

from . import tables


def plain(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (d, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(d)
    least = {t: min(ds, key=lambda d: (d is None, d or 0)) for t, ds in groups.items()}
    out, seen = [], set()
    for (d, _), t in sorted(zip(rows, norm), key=lambda z: (z[0][0] is None, z[0][0] or 0)):
        out.append((d, least[t], len(groups[t]), t not in seen, hashlib.sha256(t.encode()).hexdigest()))
        seen.add(t)
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def odd_rows():
    copies = [(100 + i, "the same  text\n of many") for i in range(60)] + [(400 - i, " the same text of many") for i in range(20)] + [(900, "the same text of many")]
    ids = [(None, "one"), (None, "one"), (3, "one"), (None, "alone"), (7, "a b"), (7, "a b"), (7, "a b"), (7, "a \x0b b"), (8, " "), (9, "\n\n"), (10, None), (11, "")]
    return [*tables.odd_texts(), *copies, *ids]


@pytest.mark.parametrize("digest", [lambda sha: sha, lambda sha: F.substring(sha, 1, 0), lambda sha: F.expr("substring(sha, 1, 1)")], ids=["whole", "none", "byte"])
def test_against_plain(spark, digest):
    rows = odd_rows()
    df = tables.clashing(tables.documents(spark, rows)).withColumn("file", F.lit("f")).withColumn("keep", F.lit(1)).withColumn("digest", F.lit(2)).withColumn("_metadata", F.lit("m"))
    assert result(x.exact_dedup(df, digest=digest)) == plain(rows)


def test_empty_and_all_null(spark):
    assert x.exact_dedup(tables.documents(spark, [])).count() == 0
    assert x.exact_dedup(spark.createDataFrame([], tables.SCHEMA).coalesce(1)).count() == 0
    assert result(x.exact_dedup(tables.documents(spark, [(None, None)] * 3))) == plain([(None, None)] * 3)


def test_in_place_and_micro_batches(spark, tmp_path):
    rows = odd_rows()
    path = str(tmp_path / "docs")
    tables.documents(spark, rows).repartition(7).write.parquet(path)
    assert result(x.exact_dedup(spark.read.parquet(path), in_place=True, batch_bytes=1)) == plain(rows)
    single = str(next((tmp_path / "docs").glob("*.parquet")))
    assert x.exact_dedup(spark.read.parquet(single), in_place=True).count() == spark.read.parquet(single).count()


def test_later_batches_and_a_repeated_one(spark, tmp_path):
    """State doesn't expire: copies that arrive later meet it, a smaller id takes over, a batch that is repeated counts once."""
    first, second = [(5, "a b"), (6, "c")], [(2, "a  b"), (7, "c"), (8, "new")]
    paths = []
    for i, rows in enumerate((first, second)):
        paths.append(str(tmp_path / f"in{i}"))
        tables.documents(spark, rows).write.parquet(paths[-1])
    index = x.DigestState(spark, str(tmp_path / "index"), batch_bytes=1)
    index.add(x.located(spark.read.parquet(paths[0])), "one")
    assert {(r["keep"]["doc_id"], r["group_size"]) for r in index.state().collect()} == {(5, 1), (6, 1)}
    again = x.DigestState(spark, str(tmp_path / "index"), batch_bytes=1)
    again.add(x.located(spark.read.parquet(paths[1])), "two")
    again.add(x.located(spark.read.parquet(paths[1])), "two")
    assert {(r["keep"]["doc_id"], r["group_size"]) for r in again.state().collect()} == {(2, 2), (6, 2), (8, 1)}
    scratch = x.Scratch(spark, "test-dedup")
    got, _ = x.decided(scratch, again, x.located(spark.read.parquet(*paths)))
    assert {(r["doc_id"], r["keep"]["doc_id"], r["group_size"]) for r in got.collect()} == {(5, 2, 2), (2, 2, 2), (6, 6, 2), (7, 6, 2), (8, 8, 1)}


def test_state_is_on_disk_without_expiry(spark):
    assert x.STATE["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    before = {k: spark.conf.get(k, None) for k in x.STATE}
    x.exact_dedup(tables.documents(spark, [(1, "a"), (2, "a")])).collect()
    assert before == {k: spark.conf.get(k, None) for k in x.STATE}


def test_keep_first_copies(spark):
    rows = odd_rows()
    df = tables.clashing(tables.documents(spark, rows)).withColumn("file", F.lit("mine"))
    got = x.keep_first_copies(df)
    assert got.columns == df.columns and got.filter("file = 'mine' and h = 7").count() == got.count()
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted((d for d, _, _, kept, _ in plain(rows) if kept), key=str)
