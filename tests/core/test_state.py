"""State in partitions, totals by signed changes, the dated upsert as a stateful stream, fills over hot keys, competing turns."""

import os
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from rankloom.operators import joins, merge, windows
from rankloom.operators.versions import DocumentTotals, PartitionedState
from rankloom.streaming import keyed


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


SCHEMA = "body string, k int, v string"


def state_at(spark, path):
    return PartitionedState(spark, str(path), SCHEMA, F.col("body"))


def test_partitions_are_replaced_and_others_left_alone(spark, tmp_path):
    state = state_at(spark, tmp_path)
    frame = lambda data: spark.createDataFrame(data, SCHEMA)
    assert state.version() == 0 and state.read().count() == 0
    assert state.replace(frame([("a", 1, "x"), ("a", 2, "y"), ("b/ü=1", 3, None), ("", 4, "z")])) == 1
    first = files(tmp_path / "data")
    assert state.replace(frame([("a", 9, "new")])) == 2
    assert rows(state.read()) == [("", 4, "z"), ("a", 9, "new"), ("b/ü=1", 3, None)]
    assert rows(state.read(only=["b/ü=1"])) == [("b/ü=1", 3, None)] and rows(state.read(version=1))[1:3] == [("a", 1, "x"), ("a", 2, "y")]
    assert first.items() <= files(tmp_path / "data").items()
    assert state.replace(frame([]), emptied=[""]) == 3 and {r[0] for r in rows(state.read())} == {"a", "b/ü=1"}
    state.drop_before(3)
    assert rows(state.read()) == [("a", 9, "new"), ("b/ü=1", 3, None)] and len(os.listdir(tmp_path / "versions")) <= 2
    with pytest.raises(Exception, match="without a partition"):
        state.replace(frame([(None, 1, "x")]))


def test_crash_before_the_switch_and_two_writers(spark, tmp_path, monkeypatch):
    state = state_at(spark, tmp_path)
    frame = lambda data: spark.createDataFrame(data, SCHEMA)
    state.replace(frame([("a", 1, "x"), ("b", 2, "y")]))
    with monkeypatch.context() as m:
        m.setattr(PartitionedState, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.replace(frame([("a", 5, "half"), ("c", 6, "half")]))
    assert rows(state_at(spark, tmp_path).read()) == [("a", 1, "x"), ("b", 2, "y")]
    assert state.replace(frame([("b", 7, "whole")])) == 2 and rows(state.read()) == [("a", 1, "x"), ("b", 7, "whole")]
    slow = state_at(spark, tmp_path)
    monkeypatch.setattr(slow, "version", lambda: 1)
    with pytest.raises(RuntimeError, match="another run"):
        slow.replace(frame([("a", 8, "late")]))
    assert state_at(spark, tmp_path).version() == 2


DOCS = "url string, d string, code string, n long"


def test_totals_equal_a_recount_after_random_corrections(spark, tmp_path):
    rng, plain = random.Random(2), {}
    totals = DocumentTotals(spark, str(tmp_path), DOCS, "url", ["d"], ["code"], "n", buckets=8)
    for step in range(5):
        batch = []
        for url in rng.sample([f"u{i}" for i in range(20)], 6 if step else 20):
            for version in range(rng.randint(1, 2)):  # of two versions in a batch the later counts
                doc = [(url, f"2026-0{step + 1}-0{version + 1}", rng.choice(["x", "y", "z", None]), rng.choice([None, 0, 1, 5])) for _ in range(rng.randint(1, 4))]
                batch += doc
                plain[url] = doc
        assert totals.apply(spark.createDataFrame(batch, DOCS)) == step + 1
        want = defaultdict(lambda: [0, 0])
        for doc in plain.values():
            for _, _, code, n in doc:
                want[code][0] += 1
                want[code][1] += n or 0
        assert {r["code"]: [r["n_rows"], r["total"]] for r in totals.totals().collect()} == dict(want)
        assert totals.state.read().count() == sum(map(len, plain.values()))


def test_a_correction_reads_its_own_buckets_only(spark, tmp_path):
    totals = DocumentTotals(spark, str(tmp_path), DOCS, "url", ["d"], ["code"], "n", buckets=16)
    totals.apply(spark.createDataFrame([(f"u{i}", "2026-01-01", "x", i) for i in range(200)], DOCS))
    before = files(tmp_path / "data")
    change = spark.createDataFrame([("u7", "2026-01-02", "y", 70)], DOCS)
    _, signed, buckets = totals.changes(change)
    assert len(buckets) == 1 and rows(signed.select("code", "n", "sign")) == [("x", 7, -1), ("y", 70, 1)]
    read = {f.split("/__part=")[1].split("/")[0] for f in signed.inputFiles() if "__part=" in f}
    assert len(read) == 1
    totals.apply(change)
    assert rows(totals.totals()) == [("x", 199, sum(range(200)) - 7), ("y", 1, 70)]
    assert before.items() <= files(tmp_path / "data").items() and len(files(tmp_path / "data/2")) <= 4
    assert rows(totals.totals(version=1)) == [("x", 200, sum(range(200)))]


EVENTS = "k string, d string, seq int, v string"


def test_stream_keeps_the_newest_over_late_rows_restarts_and_replay(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    batches = [
        [("a", "2026-01-02", 1, "first"), ("b", None, 1, "undated"), (None, "2026-01-01", 1, "no key")],
        [("a", "2026-01-01", 2, "late"), ("b", None, 2, "undated again"), ("c", "2026-01-01", 5, "x"), ("c", "2026-01-01", 6, "y")],
        [("a", "2026-01-02", 0, "same day, later batch"), ("b", "2025-01-01", 3, "dated"), ("c", "2026-01-03", 1, "z"), ("c", "2026-01-02", 9, "w")],
    ]
    state = spark.createDataFrame([], EVENTS)
    for batch in batches:
        df = spark.createDataFrame(batch, EVENTS)
        df.coalesce(1).write.mode("append").parquet(source)
        query = keyed.keep_newest(stream(), checkpoint, ["k"], "d", ["seq"])  # a restart for each batch
        query.awaitTermination()
        state = spark.createDataFrame(merge.dated_upsert(state, df, ["k"], "d", ["seq"]).collect(), EVENTS)
        assert rows(keyed.held_rows(spark, checkpoint)) == rows(state)
    # Nothing new: a replay of the same files changes nothing.
    keyed.keep_newest(stream(), checkpoint, ["k"], "d", ["seq"]).awaitTermination()
    assert rows(keyed.held_rows(spark, checkpoint)) == rows(state) and len(rows(state)) == 4


def test_fills_spread_over_a_hot_key(spark):
    rng = random.Random(6)
    data = [(("hot" if rng.random() < 0.9 else rng.choice(["x", None])), i, rng.choice([None] * 30 + ["a", "b"])) for i in range(3000)] + [("empty", i, None) for i in range(50)]
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(8)
    assert rows(windows.forward_fill(df, ["k"], ["t"], "v", "f", spread=True)) == rows(windows.forward_fill(df, ["k"], ["t"], "v", "f"))
    same = windows.forward_fill(df, ["k"], ["t"], "v", spread=True)
    assert same.columns == df.columns and rows(same) == rows(windows.forward_fill(df, ["k"], ["t"], "v"))
    assert windows.forward_fill(df.limit(0), ["k"], ["t"], "v", spread=True).count() == 0


@pytest.mark.parametrize("strict", [True, False])
def test_asof_and_blocks_spread_over_a_hot_key(spark, strict):
    rng = random.Random(7)
    key = lambda: "hot" if rng.random() < 0.9 else "x"
    a = spark.createDataFrame([(key(), rng.randint(0, 400), i) for i in range(900)], "k string, t int, i int")
    b = spark.createDataFrame([(key(), rng.randint(0, 400), f"v{i}") for i in range(60)], "k string, u int, v string")
    for f in (lambda s: joins.asof_join(a, b, ["k"], "t", "u", ["v"], strict=strict, spread=s), lambda s: joins.block_join(a, b, ["k"], "t", "u", ["v"], spread=s)):
        assert rows(f(True)) == rows(f(False))


def plain_turns(left, right):
    own, every, used, out = defaultdict(deque), defaultdict(deque), set(), []
    for i, e, k, o in sorted(right, key=lambda r: r[3]):
        own[e].append(i)
        every[k].append(i)
    for i, e, k, o in sorted(left, key=lambda r: r[3]):
        for tier, queue in ((1, own[e] if e is not None else deque()), (2, every[k] if k is not None else deque())):
            while queue and queue[0] in used:
                queue.popleft()
            if queue:
                used.add(queue[0])
                out.append((i, queue.popleft(), tier))
                break
    return sorted(out)


def test_competing_turns_against_plain(spark):
    schema = "i long, e string, k string, o int"
    # The record of exact key 'A B' is taken by an earlier row of 'AB', so the later row of 'A B' goes without.
    left, right = [(1, "AB", "AB", 1), (2, "AB", "AB", 2), (3, "A B", "AB", 3)], [(10, "AB", "AB", 1), (11, "A B", "AB", 2)]
    got = lambda x, z: rows(joins.occurrence_join_competing(spark.createDataFrame(x, schema), spark.createDataFrame(z, schema).withColumnRenamed("i", "j"), "e", "k", "i", "j", ["o"], ["o"]))
    assert got(left, right) == [(1, 10, 1), (2, 11, 2)] == plain_turns(left, right)
    rng = random.Random(12)
    for _ in range(3):
        make = lambda n, base: [(base + i, *rng.choice([("A B", "AB"), ("AB", "AB"), ("C", "C"), ("D E F", "DEF"), ("DE F", "DEF"), (None, "DEF"), (None, None)]), i) for i in range(n)]
        left, right = make(60, 0), make(40, 1000)
        assert got(left, right) == plain_turns([r for r in left if r[2]], [r for r in right if r[2]])
    assert got([], right) == [] == got(left, [])
