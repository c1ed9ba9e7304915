"""Similarity join and removal of repeated substrings, against brute force."""

import random

import numpy as np
import pytest

from rankloom.llm import ngram_join, run_length_index, substring_dedup

from . import tables


def repeats(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.remove_repeats(df).drop("kept").collect()}


def near(seed, n):
    rng = random.Random(seed)
    base = tables.text(70, rng).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(tables.WORDS) + "q"
        out.append((100 + i, " ".join(w)))
    return out


def test_index_matches_brute_force():
    rng = random.Random(3)
    join = lambda xs: (np.frombuffer(b"".join(xs), np.uint8), np.cumsum([0] + [len(x) for x in xs]))
    for trial in range(60):
        held = [bytes(rng.choice(b"ab" if trial % 2 else b"abcd") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 6))]
        asked = [bytes(rng.choice(b"abx") for _ in range(rng.randint(0, 10))) for _ in range(rng.randint(1, 5))]
        index = run_length_index.RunLengthIndex(*join(held))
        data, at = join(asked)
        length, place, row = index.matching_statistics(data, at)
        long, _, _ = index.matching_statistics(data, at, least=3)
        assert (long[length >= 3] == length[length >= 3]).all() and (long[length < 3] < 3).all()
        for j, p in enumerate(asked):
            for i in range(len(p)):
                best = max(m for m in range(len(p) - i + 1) if any(p[i : i + m] in x for x in held))
                assert length[at[j] + i] == best
                if best:
                    q = place[at[j] + i]
                    assert bytes((index.text[q : q + best] - index.m).astype(np.uint8)) == p[i : i + best]


@pytest.mark.parametrize("group_rows", [4, 1024])
def test_repeats(spark, monkeypatch, group_rows):
    monkeypatch.setattr(substring_dedup, "GROUP_ROWS", group_rows)
    rng = random.Random(5)
    passage = tables.text(24, rng)[:130]
    rows = tables.odd_texts() + near(1, 30) + [(300 + i, tables.text(8, rng) + passage[: rng.randint(95, 130)] + tables.text(8, rng)) for i in range(40)]
    assert repeats(tables.documents(spark, rows)) == substring_dedup.brute(rows)


def test_tags_keep_strings_apart():
    cut = np.array([0, 3, 6])
    data = np.frombuffer(b"abcabd", np.uint8)
    index = run_length_index.RunLengthIndex(data, cut, np.array([0, 5]))
    length, _, _ = index.matching_statistics(np.frombuffer(b"abdabd", np.uint8), cut, np.array([0, 5]))
    assert length.tolist() == [2, 1, 0, 3, 2, 1]
    assert not hasattr(index, "_rows") and len(index.head_position) == len(index.tail_position) == index.n_runs


def test_index_of_earlier_parts_decides(spark, monkeypatch):
    """What is removed where groups hold several parts comes from matching statistics over earlier parts: parts in the
    order of places, each against a plain search, and nothing is found over an empty index."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 123, 400).astype(np.uint8)
    parts = []
    for _ in range(60):
        a = int(rng.integers(0, 200))
        x = base[a : a + int(rng.integers(100, 160))].copy()
        if rng.random() < 0.5:
            x[int(rng.integers(0, len(x)))] = 65
        parts.append(x)
    offs = np.cumsum([0, *map(len, parts)])
    got = substring_dedup._repeats_of_earlier(np.concatenate(parts), offs, np.zeros(60, np.int64), np.arange(60))
    seen, want = set(), np.zeros(offs[-1], bool)
    for k, x in enumerate(parts):
        own = {x[i : i + 100].tobytes() for i in range(len(x) - 99)}
        for i in range(len(x) - 99):
            want[offs[k] + i] = x[i : i + 100].tobytes() in seen
        seen |= own
    assert (got == want).all() and want.any()
    passage = tables.text(24, random.Random(8))[:130]
    rows = [(i, tables.text(8, random.Random(i)) + passage + tables.text(8, random.Random(100 + i))) for i in range(12)]
    assert repeats(tables.documents(spark, rows)) == substring_dedup.brute(rows)


def test_repeats_edge_cases(spark):
    assert repeats(tables.documents(spark, [])) == {}
    rows = [(1, tables.text(40)), (2, None)]
    plain = repeats(tables.documents(spark, rows))
    assert repeats(tables.clashing(tables.documents(spark, rows))) == plain == substring_dedup.brute(rows)
    # Copies of a row are one document; both are returned whole.
    twice = substring_dedup.remove_repeats(tables.documents(spark, [rows[0], rows[0]])).collect()
    assert len(twice) == 2 and all(r.n_removed == 0 for r in twice)
    # Rows that share an id only are documents of their own.
    other = substring_dedup.remove_repeats(tables.documents(spark, [rows[0], (1, rows[0][1] + " more"), (None, rows[0][1])])).collect()
    assert len(other) == 3 and sorted(r.n_removed > 0 for r in other) == [False, True, True]


def links(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(df).collect()}


@pytest.mark.parametrize(("block", "rows_broadcast"), [(8, 0), (256, 200_000)])
def test_links(spark, monkeypatch, block, rows_broadcast):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", rows_broadcast)
    rng = random.Random(9)
    line = tables.text(12, rng)
    rows = tables.odd_texts() + near(2, 60) + near(4, 12)[:6] + [(500 + i, line + " " + tables.text(rng.randint(0, 9), rng)) for i in range(40)]
    rows = list(dict(rows).items())
    assert links(tables.documents(spark, rows)) == ngram_join.brute(rows)


def spread(seed, n):
    """Copies of one text with more or fewer words changed: many pairs lie on either side of the threshold."""
    rng = random.Random(seed)
    base = tables.text(150, rng).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(tables.WORDS) + str(rng.randint(0, 9))
        out.append((5000 + i, " ".join(w)))
    return out


@pytest.mark.parametrize(("productive", "block"), [(0, 16), (100, 256)])
def test_links_of_a_large_group(spark, monkeypatch, productive, block):
    """After one round of leaders (productive 0) all that is left is found by the comparison of blocks."""
    monkeypatch.setattr(ngram_join, "PRODUCTIVE", productive)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = spread(7, 160) + spread(8, 40) + near(3, 20)
    rows = list(dict((i, t) for i, (_, t) in enumerate(rows)).items())
    assert links(tables.documents(spark, rows)) == ngram_join.brute(rows)


def test_pivots_cut_the_global_order_evenly():
    counts = np.random.default_rng(1).integers(0, 50, 4096)
    part = ngram_join.pivots(counts, 8)
    order = np.argsort(counts, kind="stable")
    assert (np.diff(part[order]) >= 0).all() and set(part) == set(range(8))
    weight = np.bincount(part, counts)
    assert weight.max() - weight.min() < 2 * counts.max()
    assert (ngram_join.pivots(np.zeros(4, np.int64), 8) == 0).all()


def test_links_edge_cases(spark):
    assert links(tables.documents(spark, [])) == {}
    rows = tables.odd_texts()
    df = tables.documents(spark, rows)
    assert links(tables.clashing(df)) == ngram_join.brute(rows)
    twice = ngram_join.link_components(df.union(df)).collect()
    assert len(twice) == 2 * len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in twice} == ngram_join.brute(rows)
    # Near copies among repeated rows, and rows that share an id: counts are of sets, not of rows.
    close = near(6, 12)
    far = [(i, " ".join(t.split()[:20] + tables.text(50, random.Random(i)).split())) for i, t in close[:6]]
    many = tables.documents(spark, close)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(many.union(many)).collect()} == ngram_join.brute(close)
    shared_ids = ngram_join.link_components(tables.documents(spark, close + far + [(None, close[0][1])])).collect()
    assert len(shared_ids) == 19 and next(r for r in shared_ids if r.doc_id is None).component_id == ngram_join.brute(close)[close[0][0]][1]
    kept = ngram_join.keep_one_per_component(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
