"""Decontamination, secrets, rules, licences, shards and chats, against plain versions."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm import chat_formatting, decontamination, extendible_sharding, license_scan, quality_rules, secret_scan

from . import tables


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination(spark):
    rng = random.Random(1)
    bench = [(10, tables.text(30, rng)), (2, "Short, answer Ünïque"), (3, None), (4, " .. "), (5, tables.text(13, rng))]
    words = lambda t: re.sub(r"\W+", " ", t)
    rows = tables.odd_texts() + [(20, "x " + re.sub("[a-z]", lambda m: m[0].upper(), bench[0][1]) + " y"), (21, tables.text(300, rng) + words(bench[4][1])), (22, "a short ANSWER ünïque b"), (23, "a SHORT--answer; Ünïque b")]
    df = tables.documents(spark, rows)
    for block in (1, 1 << 20):
        got = {r.doc_id: r for r in decontamination.find_contamination(tables.clashing(df), items(spark, bench), block_bytes=block).collect()}
        for d, t in rows:
            n, hit, k, sha, _ = decontamination.brute(t, bench)
            assert (got[d].n_words, got[d].n_hit, len(got[d].item_ids)) == (n, hit, k)
            assert hashlib.sha256(",".join(got[d].item_ids).encode()).hexdigest() == sha
    assert [rows[-1][1][s.start : s.end] for s in got[23].spans] == ["SHORT--answer; Ünïque"]
    clean = decontamination.drop_contaminated(df, items(spark, bench))
    assert clean.columns == df.columns and {20, 23}.isdisjoint({r.doc_id for r in clean.collect()})
    assert decontamination.find_contamination(df, items(spark, [])).agg(F.sum("n_hit")).first()[0] == 0
    assert decontamination.find_contamination(tables.documents(spark, []), items(spark, bench)).count() == 0


def plain_secrets(t):
    out = []
    for kind, pattern, least in (("assign", secret_scan.ASSIGN, 6), ("access", secret_scan.ACCESS, 20), ("hex", secret_scan.HEX, 24)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(t or "") if len(m[2] if kind == "assign" else m[0]) >= least]
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


SECRET = 'token = "abcdef123456"'


def encoded():
    b64 = lambda b: base64.b64encode(b).decode()
    return {
        "base64": b64(SECRET.encode()),
        "gzip": b64(gzip.compress(SECRET.encode(), mtime=0)),
        "url": urllib.parse.quote(SECRET),
        "url twice": urllib.parse.quote(urllib.parse.quote(SECRET)),
        "unicode": SECRET.replace("o", "\\u006f"),
        "url in base64": b64(urllib.parse.quote(SECRET).encode()),
        "base64 in url": urllib.parse.quote(b64(SECRET.encode()) + "=="),
    }


@pytest.mark.parametrize("how", list(encoded()))
def test_decoded_layers(how):
    hidden = encoded()[how]
    text = f"é before {hidden} after"
    base, every, cut = secret_scan.scan_text(text)
    added = [s for s in every if s not in base]
    assert ("assign" in {s[0] for s in added} or how == "unicode") and not cut
    for _, a, b in added:
        assert 9 <= a < b <= 9 + len(hidden)


def test_secret_queries(spark):
    rng = random.Random(4)
    rows = tables.odd_texts() + [(20 + i, f"{tables.text(5, rng)} {x} {tables.text(5, rng)}") for i, x in enumerate([SECRET, "AKIA" + "A1" * 9, "AKIAshort", "0123456789abcdef" * 2, "PassWD:secret=abcdefg", "password='a' secret = token=abcdef", "%zz %41 \\u00 &#99999999;"])]
    df = tables.documents(spark, rows)
    got = {r.doc_id: r for r in secret_scan.scan_documents(tables.clashing(df)).collect()}
    for d, t in rows:
        assert got[d].base == secret_scan.joined(plain_secrets(t))
        assert got[d].base == "" or set(got[d].base.split(",")) <= set(got[d].spans.split(","))
    assert secret_scan.scan_text("A" * 30 + base64.b64encode(base64.b64encode(b"x" * 40)).decode())[2] is False  # layers end
    clean = secret_scan.redact_secrets(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    kept = {r.doc_id: r for r in clean.collect()}
    assert "abcdef123456" not in kept[20].text and kept[20].n_chars == len(kept[20].text) and kept[7].text == dict(rows)[7]
    assert secret_scan.scan_documents(tables.documents(spark, [])).count() == 0


def plain_rules(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    m = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(m)


@pytest.mark.parametrize("orders", [(1,), (1, 2)])
def test_rules(spark, orders):
    rng = random.Random(8)
    again = tables.text(15, rng).replace("\n", "")
    rows = tables.odd_texts() + [(30, again + " " + again), (31, "same line\nsame line\n\nsame line \n"), (32, "a b c d e f g h " * 9), (33, "#x *y| <z>")]
    junk = [(100 + i, " ".join(rng.choice(tables.WORDS[:9]) + "***" for _ in range(40))) for i in range(20)]
    good = [(200 + i, tables.text(60, rng)) for i in range(30)]
    df = tables.documents(spark, rows + junk + good)
    trusted = spark.createDataFrame([(d,) for d, _ in [*good, *rows[5:9]]], "doc_id long")  # the long texts too, or they set the raw model
    got = {r.doc_id: r for r in quality_rules.apply_rules(tables.clashing(df), trusted, n_buckets=4096, orders=orders).collect()}
    for d, t in rows + junk + good:
        r, (n, *rest) = got[d], plain_rules(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 20 or 100 * rest[-1] > 30 * n) and not (r.base_failed and r.kept)
    assert max(got[d].llr for d, _ in junk) < min(got[d].llr for d, _ in good)
    assert all(r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD) for r in got.values())
    assert quality_rules.apply_rules(df, trusted.limit(0)).agg(F.max(F.abs("llr"))).first()[0] == 0
    assert quality_rules.apply_rules(tables.documents(spark, []), trusted).count() == 0
    assert quality_rules.apply_rules(df.union(df), trusted).count() == 2 * df.count()


def test_licences(spark):
    mit = license_scan.SENTENCES["mit-grant"] + "\n" + license_scan.SENTENCES["mit-condition"]
    bsd = "\n\n".join(license_scan.SENTENCES[x] for x in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"))
    rows = tables.odd_texts() + [(20, "Intro.\nReleased under the MIT License.\nEnd"), (21, mit), (22, bsd), (23, license_scan.SENTENCES["mit-condition"] + "\n" + license_scan.SENTENCES["mit-grant"]), (24, "we RELEASED under the MIT   license!")]
    df = tables.documents(spark, rows)
    got = sorted((r.doc_id, r.rule) for r in license_scan.scan(tables.clashing(df)).collect())
    assert got == [(20, "mit-short"), (21, "mit-text"), (22, "bsd2-text"), (22, "bsd3-text")]
    assert license_scan.scan(df.union(df)).count() == len(got)
    assert license_scan.scan(tables.documents(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [100, 3000, 10**9])
def test_shards(spark, limit):
    rows = tables.odd_texts() + [(50 + i, tables.text(20)) for i in range(60)]
    df = tables.documents(spark, rows)
    got = extendible_sharding.assign_shards(tables.clashing(df), limit).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    size = Counter()
    for r in got:
        size[r.shard] += r.n_bytes
    for r in got:
        assert r.shard_bytes == size[r.shard] and (r.shard_bytes <= limit or r.oversized) and r.depth == len(r.shard)
    shards = set(size)
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    # Only what was too large was split: a parent's bytes exceed the limit.
    for s in shards - {""}:
        assert sum(n for x, n in size.items() if x.startswith(s[:-1])) > limit
    assert extendible_sharding.assign_shards(tables.documents(spark, []), limit).count() == 0


def test_shards_of_copies(spark, tmp_path):
    df = tables.documents(spark, [(1, "x" * 100)] * 5 + [(2, "y" * 50)])
    got = extendible_sharding.assign_shards(df, 120)
    assert got.count() == 6 and {(r.shard_bytes, r.oversized) for r in got.collect()} == {(500, True), (50, False)}
    assert extendible_sharding.write_shards(df, 120, str(tmp_path / "out")) == "shard"
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 6 and {"p" + r.shard for r in got.collect()} == {r.shard for r in back.select("shard").distinct().collect()}
    # One shard, and columns named as the working ones are.
    one = df.withColumns({"Shard": F.lit(1), "_h": F.lit(2), "p": F.lit(3)})
    assert extendible_sharding.write_shards(one, 10_000, str(tmp_path / "one")) == "_shard"
    back = spark.read.parquet(str(tmp_path / "one"))
    assert {r["_shard"] for r in back.collect()} == {"p"} and back.drop("_shard").columns == one.columns
    ids = extendible_sharding.assign_shards(tables.documents(spark, [(None, "x"), (None, "x"), (None, None), (3, None)]), 1).collect()
    assert sorted((r.doc_id is None, r.n_bytes, r.oversized) for r in ids) == [(False, 0, False), (True, 0, False), (True, 1, True), (True, 1, True)]


def test_chats(spark):
    odd = ["\\", "\\\\l", "<", "</turn>\n", "</cont>", "### a: b", "\\h\\", "", "é\n\n", ": "]
    rows = [(i, j, ["user", "assistant", "assistant", "a:b <x>", None][(i + j) % 5], odd[(i * 3 + j) % len(odd)] if (i + j) % 6 else None) for i in range(12) for j in range(i)]
    rows += [(None, 0, "user", "no id"), (50, 1, "assistant", "same"), (50, 1, "assistant", "same"), (51, None, "user", "null turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    made = chat_formatting.format_conversations(tables.clashing(df).withColumn("turns", F.lit(1)))
    got = {r.conv_id: r for r in chat_formatting.digest(made).collect()}
    text = {r.conv_id: r for r in made.collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", x or "") for k, t, role, x in rows if k == c))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == len(text[c].formatted) and len(text[c].loss_spans) == sum(r == "assistant" for *_, r, _ in turns)
        assert all(a.role != b.role for a, b in zip(text[c].blocks, text[c].blocks[1:]))
    assert chat_formatting.digest(chat_formatting.format_conversations(df.limit(0))).count() == 0


def test_rules_use_word_order(spark):
    rng = random.Random(9)
    order = tables.WORDS[:40]
    good = [(i, " ".join(order[(k + j) % 40] for k in [rng.randrange(40)] for j in range(60))) for i in range(40)]
    junk = [(100 + i, " ".join(rng.sample(order, 40) + rng.sample(order, 20))) for i in range(20)]
    trusted = spark.createDataFrame([(d,) for d, _ in good], "doc_id long")
    got = {r.doc_id: r for r in quality_rules.apply_rules(tables.documents(spark, good + junk), trusted).collect()}
    assert max(got[d].llr for d, _ in junk) < quality_rules.THRESHOLD < min(got[d].llr for d, _ in good)


def test_ngrams_of_rules(spark):
    rows = [(1, " a b\tc \n"), (2, "one"), (3, ""), (4, " \n"), (5, "a b a b")]
    got = Counter((r.doc_id, r.bucket) for r in quality_rules._exploded(tables.documents(spark, rows), ["doc_id"], 1 << 30, (1, 2, 3)).collect())
    assert [sum(n for (d, _), n in got.items() if d == k) for k in range(1, 6)] == [6, 1, 0, 0, 9]
    assert sorted(n for (d, _), n in got.items() if d == 5) == [1, 1, 1, 2, 2, 2]


def test_rules_count_every_trusted_document(spark):
    n = 200_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 500).alias("text"))
    docs = docs.union(spark.createDataFrame([(None, "w1"), (None, None), (7, "w1")], "doc_id long, text string"))
    out = quality_rules.ratio_table(docs, docs.select("doc_id").union(docs.select("doc_id")), smoothing=1e-9).collect()
    assert len(out) > 490 and max(abs(r.weight) for r in out) < 0.01  # target and raw differ by one row without an id


def test_rules_drop_what_scores_below_the_threshold(spark):
    rng = random.Random(10)
    good = [(i, tables.text(100, rng)) for i in range(40)]
    part = lambda k: " ".join(f"junk{rng.randrange(30)}" if rng.random() < k / 40 else rng.choice(tables.WORDS) for _ in range(100))
    mixed = [(100 + k, part(k)) for k in range(40)]
    trusted = spark.createDataFrame([(d,) for d, _ in good], "doc_id long")
    got = {r.doc_id: r for r in quality_rules.apply_rules(tables.documents(spark, good + mixed), trusted, n_buckets=512).collect()}
    between = [got[d] for d, _ in mixed if -0.4 <= got[d].llr < -0.2 and not got[d].base_failed]
    assert between and not any(r.kept for r in between) and all(got[d].kept for d, _ in good)


def glued():
    b64 = lambda b: base64.b64encode(b).decode()
    wrap = lambda x, n, by="\n": by.join(x[i : i + n] for i in range(0, len(x), n))
    one = b64(SECRET.encode())
    noise = bytes(random.Random(3).randrange(256) for _ in range(300))
    return {
        "equals": f"data={one}",
        "query": f"?q={one}&r=1",
        "path": f"https://a.b/x/yz/{one}/end",
        "dash": f"-{one}",
        "joined": f"ab_{one}-cd",
        "mime": wrap(b64(b"some words before " + SECRET.encode() + b" and some after"), 22, "\r\n"),
        "narrow": wrap(one, 5, "\n  "),
        "after a word": "attachment\n" + wrap(one, 16),
        "wrapped gzip": wrap(b64(gzip.compress(noise + SECRET.encode(), mtime=0)), 76),
        "gzip in path": "x/" + b64(gzip.compress(SECRET.encode(), mtime=0)),
        "utf-16": b64(SECRET.encode("utf-16")),
        "form feed": b64(("a\f" + SECRET).encode()),
        "binary": b64(noise + SECRET.encode() + noise),
    }


@pytest.mark.parametrize("how", list(glued()))
def test_base64_however_it_stands(how):
    hidden = glued()[how]
    base, every, cut = secret_scan.scan_text(f"before {hidden} after")
    added = [s for s in every if s not in base]
    assert "assign" in {s[0] for s in added} and not cut and all(7 <= a < b <= 7 + len(hidden) for _, a, b in added)


@pytest.mark.parametrize("name", ["bz2", "lzma", "zlib", "gzip"])
def test_compressed_layers_of_every_kind(name):
    import importlib

    pack = importlib.import_module(name).compress
    secret = b'password = "hunter2hunter2"'
    inner = base64.b64encode(pack(b"x " * 500 + secret)).decode()
    for text in ("see " + inner, "see " + base64.b64encode(pack(pack(secret))).decode(), "see " + base64.b64encode(b"head" + pack(b"no") + pack(secret)).decode()):
        base, every, unread = secret_scan.scan_text(text)
        assert not base and {(a, b) for _, a, b in every} and not unread


def test_equal_layers_of_other_places_are_both_read():
    """Two runs of one text, the second with a line break: the same characters from other places."""
    run = base64.b64encode(b'password = "hunter2hunter2"').decode()
    spans = secret_scan.scan_text(f"{run} and {run[:20]}\n{run[20:]}")[1]
    assert len(spans) == 2 and spans[0][2] <= len(run) < spans[1][1]


def test_redaction_bears_clashing_names(spark):
    df = tables.documents(spark, [(1, 'token = "abcdef123456"'), (2, "clean"), (None, None)])
    for c in ("spans", "clean", "base", "truncated", "n_hex"):
        df = df.withColumn(c, F.lit(7))
    df = df.withColumnRenamed("text", "Text")
    out = secret_scan.redact_secrets(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert "abcdef" not in rows[1].Text and rows[2].Text == "clean" and rows[None].Text is None and rows[1].spans == 7 and rows[1].n_chars == len(rows[1].Text)


def test_spans_of_glued_base64():
    one = base64.b64encode(SECRET.encode()).decode()
    text = f"see data={one} end"
    assert secret_scan.scan_text(text)[1] == [("assign", 9, 9 + len(one))]
    text = "x " + base64.b64encode(b"\xff\xfe" * 150 + SECRET.encode() + b"\xff\xfe" * 150).decode()
    ((kind, a, b),) = secret_scan.scan_text(text)[1]
    assert kind == "assign" and a == 2 + 400 and b - a < 40


def deep():
    b64 = lambda b: base64.b64encode(b).decode()
    gz = lambda b: gzip.compress(b, mtime=0)
    s = SECRET.encode()
    nested, packed = s, s
    for _ in range(15):
        nested, packed = base64.b64encode(nested), gz(packed)
    return {
        "url 15 times": "token" + "%" + "25" * 14 + "3Dabcdef123456",
        "base64 15 times": nested.decode(),
        "gzip 15 times": b64(packed),
        "second member": b64(gz(b"nothing here") + gz(b"nor here") + gz(s)),
        "beyond 64 MiB": b64(gz(b". " * (35 << 20) + s)),
        "beyond 64 MiB twice": b64(gz(gz(b". " * (35 << 20) + s))),
    }


@pytest.mark.parametrize("how", list(deep()))
def test_layers_to_the_end(how):
    hidden = deep()[how]
    base, every, cut = secret_scan.scan_text(f"before {hidden} after")
    assert "assign" in {s[0] for s in every if s not in base} and not cut


def test_stretches_overlap(monkeypatch):
    monkeypatch.setattr(secret_scan, "MAX_UNPACKED", 4096)
    monkeypatch.setattr(secret_scan, "OVERLAP", 512)
    monkeypatch.setattr(secret_scan, "PIECE", 256)
    inner = base64.b64encode(gzip.compress(SECRET.encode() + random.Random(5).randbytes(500), mtime=0))
    for lead in range(3000, 4300, 37):
        for body in (SECRET.encode(), inner, b"password" + b" " * 9000 + b"= abcdef123456"):
            hidden = base64.b64encode(gzip.compress(b". " * (lead // 2) + body + b" ." * 3000, mtime=0)).decode()
            base, every, cut = secret_scan.scan_text(hidden)
            assert "assign" in {s[0] for s in every} and not cut


def test_unread_payloads_are_redacted(spark, monkeypatch):
    noise = base64.b64encode(random.Random(6).randbytes(1100 << 10))  # more than one piece, then an error
    payload = bytearray(gzip.compress(noise, mtime=0))
    payload[-100_000:-99_000] = b"\xff" * 1000
    hidden = base64.b64encode(bytes(payload)).decode()
    df = tables.documents(spark, [(1, f"a {hidden} b"), (2, "plain")])
    assert secret_scan.scan_text(f"a {hidden} b")[2]
    got = {r.doc_id: r for r in secret_scan.redact_secrets(df).collect()}
    assert got[1].text == "a [REDACTED:payload] b" and got[1].n_chars == len(got[1].text) and got[2].text == "plain"


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_licences_as_published(spark):
    import textwrap

    fill = lambda *names: "\n\n".join(textwrap.fill(license_scan.SENTENCES[x], 70) for x in names)
    bsd = "Redistribution" + fill("bsd-grant")[14:] + "\n" + "\n".join(f"{i}. {textwrap.fill(license_scan.SENTENCES[x], 70)}" for i, x in enumerate(("bsd-source", "bsd-binary", "bsd-endorse"), 1))
    gpl = textwrap.fill(license_scan.SENTENCES["gpl-free"], 70) + "\n\n" + textwrap.fill(" ".join(license_scan.SENTENCES[x] for x in ("gpl-hope", "gpl-implied", "gpl-see")), 70)
    rows = [(1, fill("mit-grant", "mit-condition")), (2, APACHE), (3, "\n".join("# " + x for x in APACHE.split("\n"))), (4, bsd), (5, gpl), (6, fill("isc-grant")), (7, "Intro\nReleased under the MIT License\nend"), (8, "released\n\nunder the MIT License")]
    got = {}
    for r in license_scan.scan(tables.documents(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.rule] = (r.first_sentence, r.last_sentence)
    apache = {"apache-first", "apache-full", "apache-header"}
    assert {d: set(x) for d, x in got.items()} == {1: {"mit-text"}, 2: apache, 3: apache, 4: {"bsd2-text", "bsd3-text"}, 5: {"gpl3-header"}, 6: {"isc-text"}, 7: {"mit-short"}}
    n = fill("mit-grant").count("\n")
    assert got[1]["mit-text"] == (0, n + 2 + fill("mit-condition").count("\n")) and got[7]["mit-short"] == (1, 1)


def test_items_without_an_id(spark):
    item = tables.text(20, random.Random(12))
    got = decontamination.find_contamination(tables.documents(spark, [(1, item), (2, "other")]), items(spark, [(None, item), (5, "not there")])).collect()
    assert {r.doc_id: (r.n_hit, r.item_ids) for r in got} == {1: (20, []), 2: (0, [])}
    assert [r.doc_id for r in decontamination.drop_contaminated(tables.documents(spark, [(1, item), (2, "other")]), items(spark, [(None, item)])).collect()] == [2]


def plain_ratio(rows, trusted, n_buckets, orders):
    """llr of every text by two counters of n-gram buckets; hashes as Spark makes them (seed 42, columns chained)."""
    import math

    import xxhash

    def buckets(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        signed = lambda h: h - 2**64 if h >= 2**63 else h
        one = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in w]
        long = lambda h, seed: xxhash.xxh64(h.to_bytes(8, "little"), seed=seed).intdigest()
        two = [long(b, long(a, 42)) for a, b in zip(one, one[1:])]
        return [signed(h) % n_buckets for n, hs in ((1, one), (2, two)) if n in orders for h in hs]

    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(buckets(t))
        if d in trusted:
            target.update(buckets(t))
    all_raw, all_target = sum(raw.values()), sum(target.values())
    weight = {b: math.log((target[b] + 1) / (all_target + n_buckets)) - math.log((raw[b] + 1) / (all_raw + n_buckets)) for b in raw}
    return {d: sum(weight[b] for b in bs) / len(bs) if (bs := buckets(t)) else 0.0 for d, t in rows}


@pytest.mark.parametrize("orders", [(1,), (1, 2)])
def test_verdicts_of_rules_against_plain_counts(spark, orders):
    rng = random.Random(12)
    rows = tables.odd_texts()[:5] + [(30 + i, tables.text(40, rng)) for i in range(25)] + [(90 + i, " ".join(rng.choice(tables.WORDS[:6]) + "#" for _ in range(30))) for i in range(10)]
    trusted = {d for d, _ in rows if 30 <= d < 50}
    ids = spark.createDataFrame([(d,) for d in trusted], "doc_id long")
    want = plain_ratio(rows, trusted, 512, orders)
    got = quality_rules.apply_rules(tables.documents(spark, rows), ids, n_buckets=512, orders=orders, threshold=-0.05).collect()
    assert len(got) == len(rows) and {r.kept for r in got} == {True, False}
    for r in got:
        assert abs(r.llr - want[r.doc_id]) < 1e-6 and r.kept == (not r.base_failed and want[r.doc_id] >= -0.05)


def test_a_long_conversation(spark):
    """Thousands of turns in one conversation: the same result as turn by turn, at a cost in proportion."""
    import time

    said = [(1, j, "assistant" if j % 3 else "user", f"turn {j} <é#\\> " * (1 + j % 40)) for j in range(12_000)]
    df = spark.createDataFrame(said + [(2, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    began = time.time()
    got = {r.conv_id: r for r in chat_formatting.digest(chat_formatting.format_conversations(df)).collect()}
    assert time.time() - began < 60
    loss = "".join(t for _, _, r, t in said if r == "assistant")
    assert got[1].n_turns == 12_000 and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[1].loss_chars == len(loss)
    assert got[2].loss_chars == 1


def test_spans_across_parts(spark):
    text = "é𝄞x" * 5000
    spans = [(0, 0), (0, 4096), (4095, 4097), (4096, 8192), (8191, 14_999), (14_999, 15_000), (15_000, 15_000)]
    df = spark.createDataFrame([(text, spans), ("", [(0, 0)])], "t string, s array<struct<start:bigint,end:bigint>>")
    got = [r[0] for r in df.select(chat_formatting.cut_out(F.col("t"), F.col("s"))).collect()]
    assert sorted(got, key=len) == [[""], [text[a:b] for a, b in spans]]


def test_a_large_benchmark_in_bounded_blocks(spark):
    """A benchmark of many blocks says what one automaton says, and a worker's automaton stays small."""
    rng = random.Random(5)
    vocabulary = [a + b for a in tables.WORDS for b in tables.WORDS]
    bench = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 40, 60])))) for i in range(400)]
    rows = [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(60)) + " " + bench[i][1].upper()) for i in range(60)] + [(1, None), (2, "")]
    df, items_ = tables.documents(spark, rows + rows[:3]), items(spark, bench)
    key = lambda out: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), tuple(r.spans)) for r in out.collect())
    one = key(decontamination.find_contamination(df, items_, block_bytes=1 << 30))
    assert key(decontamination.find_contamination(df, items_, block_bytes=4000)) == one and sum(x[2] for x in one) > 100
    text = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(150)).encode()) for i in range(400)]
    size = sum(len(t) for _, t in text)
    stats = decontamination.Scanner(text).automaton.get_stats()
    assert stats["total_size"] < 100 * size and decontamination.BLOCK_BYTES * 100 <= 100 << 20


def test_filter_lets_every_window_through():
    """Words counted as a split counts them, and no text with a hit ruled out."""
    import pyarrow as pa

    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["é", "Ünï", "x"]
    for _ in range(60):
        bench = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 20))) for _ in range(6)]
        texts = [None, "", " .. "] + [rng.choice([" ", "--", "\n"]).join([*(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(bench), rng.choice(words).upper()]) for _ in range(8)]
        f = decontamination.Filter(5)
        f.add(pa.array([t.encode() for t in bench], pa.binary()))
        n, may = f.rows(pa.array(texts, pa.string()))
        assert n.tolist() == [len(decontamination.words_of((t or "").encode())) for t in texts]
        hit = [decontamination.brute(t, [(str(i), b) for i, b in enumerate(bench)], 5)[1] > 0 for t in texts]
        assert all(m for m, h in zip(may, hit) if h)
    clean = decontamination.Filter()
    clean.add(pa.array([tables.text(40, random.Random(1)).encode()], pa.binary()))
    assert not clean.rows(pa.array([tables.text(60, random.Random(2))]))[1].any()


def test_scanner_against_brute_force():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    for _ in range(200):
        bench = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randint(0, 18)))) for i in range(8)]
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(2):
            text[rng.randint(0, len(text)) : 0] = rng.choice(bench)[1].split()
        joined = " ".join(text)
        runs, who = decontamination.Scanner([(i, t.encode()) for i, t in bench], 5).hits(decontamination.words_of(joined.encode()))
        _, hit, n_items, *_ = decontamination.brute(joined, bench, 5)
        assert (sum(b - a for a, b in runs), len(who)) == (hit, n_items) and all(x[1] < y[0] for x, y in zip(runs, runs[1:]))


def test_rows_that_share_an_id_keep_their_own_bytes(spark):
    """Thousands of rows without an id: a repeat inside one of them takes no byte of another."""
    import random

    from rankloom.llm import substring_dedup

    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = word(150)
    rows = [(None, word(rng.randint(120, 350))) for _ in range(3000)] + [(None, passage + word(51) + passage), (7, word(200)), (7, word(200) + passage)]
    got = substring_dedup.remove_repeats(tables.documents(spark, rows)).collect()
    cut = sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got if r["n_removed"])
    assert len(got) == len(rows) and cut == [(350, 150, 1), (351, 150, 1)]


def test_chains_of_escapes_take_linear_time_and_odd_bytes_lose_nothing():
    import time

    from rankloom.llm import secret_scan

    secret, began = 'password = "hunter2hunter2"', time.perf_counter()
    for text in ("%" + "25" * 150_000 + "41 ", "\\" + "u005c" * 100_000 + "u0041 ", "&" + "#38;" * 100_000 + "#65; "):
        base, every, _ = secret_scan.scan_text(text + secret)
        assert ("assign", len(text), len(text) + len(secret) - 1) in every and set(base) <= set(every)
    assert time.perf_counter() - began < 60
    run = "".join(f"%{b:02x}" for b in secret.encode())
    for before in ("%ff", "%e9", "%c3%28", ""):
        for deeper in range(4):
            hidden = (before + run).replace("%", "%" + "25" * deeper)
            assert [s[0] for s in secret_scan.scan_text(hidden)[1]] == ["assign"], (before, deeper)
    assert [s[0] for s in secret_scan.scan_text("\\u005cu005cu0070assword=hunter2hunter2")[1]] == ["assign"]
    assert [s[0] for s in secret_scan.scan_text("&#38;#112;assword=hunter2hunter2")[1]] == ["assign"]
    # Kinds in turns: URL escapes of Unicode escapes of URL escapes.
    assert [s[0] for s in secret_scan.scan_text("%5cu0025" + "70assword=hunter2hunter2")[1]] == ["assign"]


def test_licences_on_one_line(spark):
    joined = " ".join(license_scan.SENTENCES[x] for x in ("mit-grant", "mit-condition", "mit-warranty", "mit-liability"))
    said = ["This project is licensed under the MIT license.", "This work is licensed under the terms of the Artistic License 2.0!", "licensed under the some license"]
    spdx = ["// SPDX-License-Identifier: MIT OR Apache-2.0", "SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND ISC OR Zlib", "SPDX-License-Identifier: MIT or ISC", "MIT OR ISC"]
    rows = list(enumerate([joined, "# " + joined, *said, *spdx, "x\n\nThis project is licensed\nunder the Artistic\nLicense 2.0.\ny"]))
    got = {i: set() for i, _ in rows}
    for r in license_scan.scan(tables.documents(spark, rows)).collect():
        got[r.doc_id].add((r.rule, r.license))
    mit = {("mit-text", "MIT"), ("mit-whole", "MIT")}
    assert [got[i] for i in range(5)] == [mit, mit, {("mit-said", "MIT")}, {("artistic-2.0-said", "Artistic-2.0")}, set()]
    assert [{k for _, k in got[i]} for i in range(5, 9)] == [{"MIT", "Apache-2.0"}, {"GPL-2.0", "ISC", "Zlib"}, set(), set()]
    assert got[9] == {("artistic-2.0-said", "Artistic-2.0")}


def test_marks_lose_no_sentence():
    known = [x for x, _ in license_scan.known_rows()]
    found = license_scan.marks(known)
    assert len(found) < 12 and all(any(m in x for m in found) for x in known)
    short = ["a b", "c de"]
    assert all(any(m in x for m in license_scan.marks(short)) for x in short)
    assert not any(" " in m for m in found)
