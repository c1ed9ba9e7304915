"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items are normalised to words (A-Z lowered, runs of other than letters, digits and non-ASCII cut), words get
numbers, and every window of 13 consecutive words of an item (all of a shorter one) becomes a pattern of one automaton
over these numbers. A document is normalised the same way and scanned once; hits are word places and, for the spans
that are returned, are mapped to offsets in the original text. Two neighbouring words that are neighbours in no item
end every match. That is looked up for all words of a batch at once, in a table of fixed size that errs on the side of
yes, and only texts with a stretch long enough for a pattern go on to the automaton.

The automaton takes about 700 bytes for each word of the benchmark, in every worker. So it is built for block_bytes of
benchmark text; a larger benchmark is cut into blocks of items by size, each with an automaton and a pass of its own
over the texts that the table lets through, of which a worker holds one at a time, and the hits of each text are
united. Results do not depend on the bound.

Defined cases: null and empty texts have no words, no hits and are not contaminated. An item without words has no
window. Repeated rows are each returned. Items that share an id count as one id; the words of an item
without an id (null) are hit and contaminate like others, but it is in no list of ids. An empty benchmark leaves all clean.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytes_ops
from .columns import pick, pick_as
from ..scratch import Scratch
from ..shipping import map_arrow

WINDOW = 13
BLOCK_BYTES = 1 << 20

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Bytes of UTF-8: A-Z to lower case, separators to a space; bytes of non-ASCII characters stay.
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if i in _KEEP else 32 for i in range(256))


_BYTES = np.frombuffer(_TABLE, np.uint8)
#: Places of the table of words that may follow each other.
SLOTS = 1 << 24


class Filter:
    """Rules texts out: a table, by hashes, of words that stand next to each other in an item, or alone in one."""

    def __init__(self, window: int = WINDOW):
        self.window, self.least = window, 0
        self.pairs, self.singles = np.zeros(SLOTS, bool), np.zeros(SLOTS, bool)

    @staticmethod
    def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of words, and the number of words before each row."""
        data = _BYTES[data]
        starts, ends, before = bytes_ops.words(data, offsets)
        return bytes_ops.RangeHash(data)(starts, ends), before

    @staticmethod
    def _slots(h: np.ndarray) -> np.ndarray:
        return (bytes_ops.mix(h[:-1] + (h[1:] << np.uint64(1))) & np.uint64(SLOTS - 1)).astype(np.int64)

    def add(self, texts: pa.Array) -> None:
        for _, data, offsets in bytes_ops.slices(texts):
            h, before = self._words(data, offsets)
            n = np.diff(before)
            joined = np.ones(max(0, len(h) - 1), bool)
            joined[before[1:-1][(before[1:-1] > 0) & (before[1:-1] < len(h))] - 1] = False
            self.pairs[self._slots(h)[joined]] = True
            self.singles[(h[before[:-1][n == 1]] & np.uint64(SLOTS - 1)).astype(np.int64)] = True
            sizes = np.minimum(n[n > 1], self.window)
            if len(sizes):
                self.least = min(self.least or self.window, int(sizes.min()))

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of words of each text, and whether a window may occur in it."""
        counts, may = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for _, data, offsets in bytes_ops.slices(texts):
            h, before = self._words(data, offsets)
            found = np.zeros(len(before) - 1, bool)
            alone = np.flatnonzero(self.singles[(h & np.uint64(SLOTS - 1)).astype(np.int64)])
            found[np.searchsorted(before, alone, "right") - 1] = True
            if self.least and len(h) > 1:
                joined = self.pairs[self._slots(h)]
                joined[before[1:-1][(before[1:-1] > 0) & (before[1:-1] < len(h))] - 1] = False
                edge = np.flatnonzero(np.diff(joined, prepend=False, append=False))
                first = edge[::2][edge[1::2] - edge[::2] + 1 >= self.least]
                found[np.searchsorted(before, first, "right") - 1] = True
            counts.append(np.diff(before))
            may.append(found)
        return np.concatenate(counts), np.concatenate(may)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Scanner:
    """The automaton over numbers of words."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        import ahocorasick

        self.ids = sorted({i for i, _ in items if i is not None})
        at = {x: k for k, x in enumerate(self.ids)}
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        neighbours: set[tuple[int, int]] = set()
        self.filter = Filter(window)
        self.filter.add(pa.array([t for _, t in items], pa.binary()))
        for item, text in items:
            w = [self.number.setdefault(x, len(self.number) + 1) for x in words_of(text)]
            n = min(window, len(w))
            neighbours.update(zip(w, w[1:]))
            for i in range(len(w) - n + 1) if w else ():
                who = owners.setdefault(tuple(w[i : i + n]), set())
                if item is not None:
                    who.add(at[item])
        self.single = {p[0]: tuple(who) for p, who in owners.items() if len(p) == 1}
        self.least = min((len(p) for p in owners if len(p) > 1), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for p, who in owners.items():
            if len(p) > 1:
                self.automaton.add_word(p, (len(p), tuple(who)))
        self.automaton.make_automaton()
        # Whether two numbers may be neighbours: a table that errs on the side of yes.
        bits = max(16, (32 * len(neighbours)).bit_length())
        self.mask = (1 << bits) - 1
        self.may_follow = np.zeros(1 << bits, bool)
        if neighbours:
            self.may_follow[self._slot(np.array(sorted(neighbours), np.int64).T)] = True
        self.is_single = np.zeros(len(self.number) + 1, bool)
        self.is_single[list(self.single)] = True

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return (pair[0] * 0x9E3779B1 + pair[1] * 0x85EBCA77 >> 7) & self.mask

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words (first, after last), and the items whose windows occur."""
        if not words or not self.number:
            return [], set()
        get = self.number.get
        w = np.fromiter([get(x, 0) for x in words], np.int64, len(words))
        found: list[tuple[int, int]] = []
        who: set[int] = set()
        for i in np.flatnonzero(self.is_single[w]).tolist():
            found.append((i, i + 1))
            who.update(self.single[int(w[i])])
        if self.least and len(w) > 1:
            joined = (w[:-1] > 0) & (w[1:] > 0) & self.may_follow[self._slot(np.stack([w[:-1], w[1:]]))]
            edge = np.flatnonzero(np.diff(joined, prepend=False, append=False))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a + 1 >= self.least:
                    for end, (n, owners) in self.automaton.iter(tuple(w[a : b + 1].tolist())):
                        found.append((a + end - n + 1, a + end + 1))
                        who.update(owners)
        return _united(found), {self.ids[k] for k in who}


def word_offsets(text: bytes) -> list[tuple[int, int]]:
    """Start and end of every word in the original, in code points."""
    import re

    return [m.span() for m in re.finditer("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text.decode("utf-8").translate({i: i + 32 for i in range(65, 91)}))]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of at most block_bytes of text (a larger item alone), read one block at a time."""
    items = pick(benchmark, "item_id", "text").filter("text is not null").select(F.col("item_id").cast("string").alias("item_id"), F.encode("text", "UTF-8").alias("text"))
    block, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        if block and size + len(r["text"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], bytes(r["text"])))
        size += len(r["text"])
    if block:
        yield block


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every document row, then n_words, n_hit, item_ids (sorted as strings), spans (code points
    of the original text, one for each maximal run of hit words)."""
    spark = documents.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, block_bytes)]
    names = [f"k_{i}" for i in range(len(keep))]
    work = pick_as(documents, dict(zip(names, keep)) | {"k_text": "text"})
    if len(blocks) > 1:
        # What is hit depends on the text alone: texts with hits in a block are kept by hash and length, and joined back.
        key = [F.xxhash64("k_text").alias("k_hash"), F.octet_length("k_text").alias("k_size")]
        every = Filter(window)
        for block in blocks:
            every.add(pa.array([t for _, t in block.value], pa.binary()))
        table = spark.sparkContext.broadcast(every)  # 2 SLOTS bytes
        fields = "k_hash bigint, k_size int, k_text string"
        scratch = Scratch(spark, "decontamination")
        texts, found = scratch.table(map_arrow(work.select(*key, "k_text"), _let_through(table), fields), "texts"), None
        for block in blocks:
            part = map_arrow(texts, _hits_in(block, window), "k_hash bigint, k_size int, runs array<struct<a:int,b:int>>, ids array<string>")
            found = part if found is None else found.unionByName(part)
        # A block says the same of copies, so one row of each is enough.
        found = found.dropDuplicates().groupBy("k_hash", "k_size").agg(F.flatten(F.collect_list("runs")).alias("k_runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("k_ids"))
        work = work.withColumns({"k_hash": key[0], "k_size": key[1]}).join(found, ["k_hash", "k_size"], "left").drop("k_hash", "k_size")
    fields = ", ".join(f"{n} {work.schema[n].dataType.simpleString()}" for n in names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _cached(blocks[0], window) if len(blocks) == 1 else None
        for batch in batches:
            n_hit, ids, spans = [], [], []
            raw = batch.column("k_text").cast(pa.binary())
            n_words, may = (scanner.filter if scanner else _COUNTER).rows(raw)
            known = (batch.column(c).to_pylist() for c in ("k_runs", "k_ids")) if len(blocks) > 1 else ([None] * batch.num_rows,) * 2
            for text, hope, own, own_ids in zip(raw, may.tolist(), *known):
                runs, who = (scanner.hits(words_of(text.as_py())) if hope else ([], [])) if scanner else (_united([(x["a"], x["b"]) for x in own or []]), own_ids or [])
                n_hit.append(sum(b - a for a, b in runs))
                ids.append(sorted(who))
                at = word_offsets(text.as_py()) if runs else []
                spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs])
            cols = [batch.column(n) for n in names]
            cols += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "n_words", "n_hit", "item_ids", "spans"])

    out = map_arrow(work, scan, f"{fields}, n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:int,end:int>>")
    return out.toDF(*keep, "n_words", "n_hit", "item_ids", "spans")


#: Counts words only.
_COUNTER = Filter()


def _let_through(table):
    """Texts in which a window may occur, with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, may = table.value.rows(batch.column("k_text").cast(pa.binary()))
            yield batch.filter(pa.array(may))

    return run


def _hits_in(block, window: int):
    """Of texts with hits in one block: their key, runs of hit words, and items."""
    run_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _cached(block, window)
        for batch in batches:
            rows, runs, ids = [], [], []
            raw = batch.column("k_text").cast(pa.binary())
            for i in np.flatnonzero(scanner.filter.rows(raw)[1]).tolist():
                found, who = scanner.hits(words_of(raw[i].as_py()))
                if found:
                    rows.append(i)
                    runs.append([{"a": a, "b": b} for a, b in found])
                    ids.append(sorted(who))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("k_hash").take(at), batch.column("k_size").take(at), pa.array(runs, run_type), pa.array(ids, pa.list_(pa.string()))], names=["k_hash", "k_size", "runs", "ids"])

    return run


def _united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_held: list = []


def _cached(block, window: int) -> Scanner:
    """The automaton that this worker made last, if it is this block's; only one is held."""
    if not _held or _held[0] is not block.value or _held[1] != window:
        _held.clear()
        value = block.value
        _held[:] = [value, window, Scanner(value, window)]
    return _held[2]


def _contaminated():
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of documents that are not contaminated, with the same columns."""
    found = find_contamination(documents, benchmark, keep=tuple(documents.columns))
    return found.filter(~_contaminated()).select(*documents.columns)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), _contaminated().alias("contaminated")
    )


OP6_SQL = r"""
WITH up AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, up),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, up),
iw AS (SELECT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS x
       FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS x
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, s, item_id FROM dw JOIN iw USING (n, x)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM hit)) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def brute(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, int, str, bool]:
    """The contract, word by word; for tests."""
    import re

    cut = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, who = cut(text), set(), set()
    for item, t in items:
        w = cut(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    who.add(str(item))
    return len(words), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)
