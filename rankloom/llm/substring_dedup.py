"""Removal of repeated 100-byte strings over a whole corpus, decided by run-length indexes.

An index of the whole corpus would be one object that grows with it, so the corpus is first cut into pieces that can
be indexed apart and still lose no repeat:

1. In every window of 100 bytes the 32-byte substring of least hash is its anchor (the leftmost of equals). Equal
   windows have equal anchors at the same place, and neighbouring windows mostly share theirs: the windows of one
   anchor make a piece of 100 to 168 bytes. Anchors are counted over all documents; a window whose anchor occurs once
   occurs once.
2. Of pieces whose anchor repeats, equal ones are taken together and keep their first place (doc_id, start). An
   anchor with one distinct piece needs no index: its first place holds the first copy of each of its windows.
3. Windows of an anchor are told apart by how far they reach to its left. That range is halved, and pieces fall into
   groups by the bytes that all windows of a half share; a part that is alone in its group repeats nothing. Equal
   parts are taken together. Groups that still hold very many distinct parts (a passage that many documents share,
   each in its own context) are halved again, which lengthens the shared bytes, until none is large. So no task gets
   more than a bounded group, and nothing is left out.
4. The parts of a group go to one block, many groups to a block, in the order of their places. A group is halved again
   and again: a run-length index (run_length_index) is built of the earlier half, and the parts of the later half are
   streamed over it; a window whose matching statistic is 100 bytes or more repeats an earlier one. Halves of one depth
   share an index, where tags keep them apart; a part of which every window has been found is not looked at again.

What is a window's first copy stays; all other windows with repeating anchors are removed, bytes once each.

Order of documents: doc_id, then a hash of the text. Defined cases: null text is empty. Rows alike in doc_id and text
count as one document and are all returned, cut alike. Rows that share only doc_id are told apart by 64 bits of a hash
of the text. A null doc_id comes first. Texts under 100 bytes are untouched. An empty table gives no rows; extra
columns are ignored. doc_id must be an integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytes_ops
from .columns import pick
from .run_length_index import RunLengthIndex
from ..scratch import Scratch
from ..shipping import map_arrow

DEPTH, GRAM = 100, 32
SPAN = DEPTH - GRAM + 1  # grams in a window
#: Distinct pieces of a group that are indexed together, and bytes of a block.
GROUP_ROWS, BLOCK_BYTES = 1024, 2 << 20
#: A place in a text (doc, th: its id and its hash) is packed as: 32 bits of start, 7 bits of windows - 1, 7 bits of
#: anchor offset.
_CHUNK = 4 << 20


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of many texts: row, first window, last window, anchor (places in data), hash of the anchor, hash of the piece."""
    n = len(data)
    if n < DEPTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    hashed = bytes_ops.RangeHash(data)
    gram = hashed.every(GRAM)
    # 40 bits of hash and 24 of place: the least is the leftmost of equals.
    least = (gram & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n - GRAM + 1, dtype=np.uint64)
    reach = 1
    low = least
    while reach * 2 <= SPAN:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: n - DEPTH + 1], low[SPAN - reach : SPAN - reach + n - DEPTH + 1])
    anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: n - DEPTH + 1]
    inside = np.arange(n - DEPTH + 1) + DEPTH <= offsets[1:][row]
    start = np.ones(len(anchor), bool)
    start[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(start & inside)
    ends = np.flatnonzero(np.r_[(start | ~inside)[1:], True] & inside)
    where = anchor[first]
    return row[first], first, ends, where, gram[where], hashed(first, ends + DEPTH)


def _batches(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Slices of texts; a text too long for one is cut in chunks that share 99 bytes, so each window is in one chunk."""
    for row, data, offsets in bytes_ops.slices(column):
        if len(offsets) == 2 and len(data) > _CHUNK:
            for a in range(0, len(data) - DEPTH + 1, _CHUNK):
                part = data[a : a + _CHUNK + DEPTH - 1]
                yield row, part, np.array([0, len(part)]), a
        else:
            yield row, data, offsets, 0


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets, _ in _batches(batch.column("text")):
            h, n = np.unique(_anchors(data, offsets)[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(n)], names=["h", "n"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, th = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
        for row, data, offsets, shift in _batches(batch.column("text")):
            r, first, last, where, h, piece = _anchors(data, offsets)
            start = first - (offsets[r] if not shift else 0) + shift
            packed = start << 14 | (last - first) << 7 | (where - first)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(_signed(piece)), pa.array(doc[row + r]), pa.array(th[row + r]), pa.array(packed)], names=["h", "ph", "doc", "th", "packed"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted pieces of each document."""
    for batch in batches:
        raw, wanted = batch.column("text").cast(pa.binary()), batch.column("wanted")
        offsets = wanted.offsets.to_numpy()
        flat = wanted.values
        h, packed = (flat.field(c).to_numpy()[offsets[0] : offsets[-1]] for c in ("h", "packed"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        start, more = packed >> 14 & 0xFFFFFFFF, packed >> 7 & 127
        held, texts = -1, []
        for i, a, b in zip(row.tolist(), start.tolist(), (start + more + DEPTH).tolist()):
            if i != held:
                held, text = i, raw[i].as_py() or b""
            texts.append(text[a:b])
        doc, th = (batch.column(c).to_numpy()[row] for c in ("doc", "th"))
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(th), pa.array(packed), pa.array(np.zeros(len(h), np.int32)), pa.array(texts, pa.binary())], names=["g", "doc", "th", "packed", "at", "piece"])


def _halves(size: int):
    """Splits every part by how far windows reach left of the anchor: the lower half of its range, and the rest."""
    half = (size + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, doc, th, packed, at, low = (batch.column(c).to_numpy() for c in ("g", "doc", "th", "packed", "at", "low"))
            for row, data, offsets in bytes_ops.slices(batch.column("piece")):
                n = len(offsets) - 1
                rows = np.arange(row, row + n)
                hashed = bytes_ops.RangeHash(data)
                anchor = offsets[:-1] + (packed[rows] & 127) - at[rows]
                for lo, hi in ((0, half - 1), (half, size - 1)):
                    a, b = low[rows] + lo, np.minimum(low[rows] + hi, SPAN - 1)
                    first, last = np.maximum(offsets[:-1], anchor - b), np.minimum(anchor - a, offsets[1:] - DEPTH)
                    ok = np.flatnonzero((a <= b) & (first <= last))
                    f, e, r = first[ok], last[ok] + DEPTH, rows[ok]
                    key = hashed((anchor - a)[ok], (anchor + DEPTH - b)[ok]) + a[ok].astype(np.uint64)
                    group = bytes_ops.mix(g[r].view(np.uint64) ^ bytes_ops.mix(key))
                    sizes = e - f
                    cuts = np.r_[0, np.cumsum(sizes)]
                    parts = data[np.arange(cuts[-1]) + np.repeat(f - cuts[:-1], sizes)]
                    piece = pa.Array.from_buffers(pa.binary(), len(ok), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(parts)])
                    columns = [_signed(group), _signed(hashed(f, e)), doc[r], th[r], packed[r], (at[r] + f - offsets[:-1][ok]).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), piece, pa.array(a[ok].astype(np.int32))], names=["g", "ph", "doc", "th", "packed", "at", "piece", "low"])

    return run


def _taken(data: np.ndarray, offs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of some parts, where each begins, and the places of these bytes in data."""
    sizes = offs[which + 1] - offs[which]
    cuts = np.r_[0, np.cumsum(sizes)]
    at = np.arange(cuts[-1]) + np.repeat(offs[which] - cuts[:-1], sizes)
    return data[at], cuts, at


def _repeats_of_earlier(data: np.ndarray, offs: np.ndarray, g: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every byte whether the window that begins there equals one of an earlier part of its group. order: parts by
    group and place; equal windows are always in one group, and never in one part."""
    n = len(order)
    new = np.ones(n, bool)
    new[1:] = g[order][1:] != g[order][:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    group, nth = np.empty(n, np.int64), np.empty(n, np.int64)
    group[order], nth[order] = np.cumsum(new), np.arange(n) - start
    repeats = np.zeros(len(data), bool)
    windows = offs[1:] - offs[:-1] - DEPTH + 1
    open_ = np.ones(n, bool)
    for level in reversed(range(int(nth.max()).bit_length() if n else 0)):
        half = nth >> level
        pair = half >> 1
        key = group * (n + 1) + pair
        earlier, later = open_ & (half & 1 == 0), open_ & (half & 1 == 1)
        held = np.flatnonzero(earlier & np.isin(key, key[later]))
        asked = np.flatnonzero(later & np.isin(key, key[held]))
        if not len(asked):
            continue
        bytes_held, cuts, _ = _taken(data, offs, held)
        index = RunLengthIndex(bytes_held, cuts, pair[held])
        bytes_asked, cuts, at = _taken(data, offs, asked)
        length, _, _ = index.matching_statistics(bytes_asked, cuts, pair[asked], DEPTH)
        repeats[at] |= length >= DEPTH
        found = np.add.reduceat(repeats[at].astype(np.int64), cuts[:-1])
        open_[asked[found == windows[asked]]] = False
    return repeats


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group. Blocks of whole groups are indexed and streamed; what returns are runs of windows
    that are first copies: doc, th, packed, offset of the first and last window in the piece."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush(rows: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        g, doc, th, packed, at = (rows.column(c).to_numpy() for c in ("g", "doc", "th", "packed", "at"))
        pieces = rows.column("piece")
        pieces = pieces.combine_chunks() if isinstance(pieces, pa.ChunkedArray) else pieces
        pieces = pieces.cast(pa.binary())
        offs = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, pieces.offset * 4).astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[offs[0] : offs[-1]]
        offs = offs - offs[0]
        repeats = _repeats_of_earlier(data, offs, g, np.lexsort(((packed >> 14 & 0xFFFFFFFF) + at, th, doc, g)))
        inner = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
        keep = np.flatnonzero(~repeats & (inner + DEPTH <= np.repeat(np.diff(offs), np.diff(offs))))
        p = np.searchsorted(offs, keep, "right") - 1
        w = inner[keep]
        cut = np.ones(len(keep), bool)
        cut[1:] = (p[1:] != p[:-1]) | (w[1:] != w[:-1] + 1)
        a = np.flatnonzero(cut)
        b = np.r_[a[1:], len(keep)] - 1 if len(a) else a
        return pa.RecordBatch.from_arrays([pa.array(doc[p[a]]), pa.array(th[p[a]]), pa.array(packed[p[a]]), pa.array((at[p[a]] + w[a]).astype(np.int32)), pa.array((at[p[b]] + w[b]).astype(np.int32))], names=["doc", "th", "packed", "a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("piece").nbytes
        if size >= BLOCK_BYTES:
            table = pa.Table.from_batches(held)
            g = table.column("g").to_numpy()
            # The last group may go on in the next batch.
            starts = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)]
            lengths = np.r_[0, np.cumsum(pc.binary_length(table.column("piece")).to_numpy())]
            done = 0
            for k in range(1, len(starts) - 1):
                if lengths[starts[k]] - lengths[done] >= BLOCK_BYTES or k == len(starts) - 2:
                    yield flush(table.slice(done, starts[k] - done))
                    done = int(starts[k])
            held = table.slice(done).to_batches()
            size = int(lengths[-1] - lengths[done])
    if held:
        yield flush(pa.Table.from_batches(held))


_FIRST = "doc bigint, th bigint, packed bigint, a int, b int"


def _blocks(parts: DataFrame) -> DataFrame:
    """First copies within groups of bounded size."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.select("g", "doc", "th", "packed", "at", "piece").repartition(n, "g").sortWithinPartitions("g", "doc", "th", "packed", "at")
    return map_arrow(rows, _first_copies, _FIRST)


def _first_windows(scratch: Scratch, docs: DataFrame, places: DataFrame) -> DataFrame:
    """places: h, ph, doc, th, packed of windows with repeating anchors -> runs of windows that are first copies."""
    first = F.min(F.struct("doc", "th", "packed")).alias("f")
    distinct = scratch.table(places.groupBy("h", "ph").agg(first).select("h", "f.*"), "distinct")
    sizes = distinct.groupBy("h").agg(F.count("*").alias("pieces"))
    distinct = scratch.table(distinct.join(sizes, "h"), "sized")
    single = distinct.filter("pieces = 1").select("doc", "th", "packed", F.lit(0).alias("a"), F.expr("int(shiftright(packed, 7) & 127)").alias("b"))
    wanted = distinct.filter("pieces > 1").groupBy("doc", "th").agg(F.collect_list(F.struct("h", "packed")).alias("wanted"))
    near = docs.join(wanted, ["doc", "th"]).select("doc", "th", "text", "wanted")
    rows = scratch.table(map_arrow(near, _fetch, "g bigint, doc bigint, th bigint, packed bigint, at int, piece binary").dropDuplicates(["g", "doc", "th", "packed"]), "pieces")
    out, rest, size = [single], rows.withColumn("low", F.lit(0)), SPAN
    while size > 1 and not rest.isEmpty():
        cut = map_arrow(rest.select("g", "doc", "th", "packed", "at", "piece", "low"), _halves(size), "g bigint, ph bigint, doc bigint, th bigint, packed bigint, at int, piece binary, low int")
        # By true place, as offsets in pieces differ: hash, then start and offset. Equal parts have equal bytes.
        place = F.struct("doc", "th", F.expr("(shiftright(packed, 14) & 4294967295) + at").alias("s"), "packed", "at", "low")
        parts = cut.groupBy("g", "ph").agg(F.min(place).alias("p"), F.first("piece").alias("piece")).select("g", "p.doc", "p.th", "p.packed", "p.at", "piece", "p.low")
        parts = scratch.table(parts, "parts")
        counted = scratch.table(parts.join(parts.groupBy("g").agg(F.count("*").alias("pieces")), "g"), "counted")
        scratch.drop(parts)
        out.append(counted.filter("pieces = 1").select("doc", "th", "packed", F.col("at").alias("a"), (F.col("at") + F.length("piece") - DEPTH).cast("int").alias("b")))
        out.append(scratch.table(_blocks(counted.filter((F.col("pieces") > 1) & (F.col("pieces") <= GROUP_ROWS))), "first"))
        rest, size = counted.filter(F.col("pieces") > GROUP_ROWS), (size + 1) // 2
    # A range of one is one window: its group has one part, so nothing large can be left.
    merged = out[0]
    for x in out[1:]:
        merged = merged.unionByName(x)
    return merged


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("text").cast(pa.binary())
        places, firsts = batch.column("places"), batch.column("firsts")
        n_bytes, n_removed, n_spans, shas, kept = [], [], [], [], []
        for i in range(batch.num_rows):
            text = raw[i].as_py() or b""
            gone = np.zeros(len(text) + 1, np.int32)
            if places[i].is_valid:
                p = np.asarray(places[i].values.to_numpy())
                start, more = p >> 14 & 0xFFFFFFFF, p >> 7 & 127
                later = np.zeros(len(text) + 1, np.int32)  # windows that repeat an earlier one
                np.add.at(later, start, 1)
                np.add.at(later, start + more + 1, -1)
                if firsts[i].is_valid:
                    f = firsts[i].values
                    fp, a, b = (f.field(c).to_numpy() for c in ("packed", "a", "b"))
                    at = fp >> 14 & 0xFFFFFFFF
                    np.add.at(later, at + a, -1)
                    np.add.at(later, at + b + 1, 1)
                where = np.flatnonzero(np.cumsum(later[:-1]) > 0)
                np.add.at(gone, where, 1)
                np.add.at(gone, np.minimum(where + DEPTH, len(text)), -1)
            removed = np.cumsum(gone[:-1]) > 0
            runs = int(removed[:1].sum() + (removed[1:] & ~removed[:-1]).sum())
            rest = np.frombuffer(text, np.uint8)[~removed].tobytes() if runs else text
            n_bytes.append(len(text))
            n_removed.append(int(removed.sum()))
            n_spans.append(runs)
            shas.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        cols = [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every document."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "substring-dedup")
    docs = pick(documents, "doc_id", "text").select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("th"), "text")
    source = docs.select("doc", "th", "text")
    grams = map_arrow(source.select("text"), _count_grams, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    repeated = scratch.table(grams, "grams")
    places = scratch.table(map_arrow(source, _pieces, "h bigint, ph bigint, doc bigint, th bigint, packed bigint").join(repeated, "h"), "places")
    scratch.drop(repeated)
    firsts = _first_windows(scratch, source, places)
    # By text and not by id alone: rows that share an id, such as those without one, are many.
    by_doc = places.groupBy("doc", "th").agg(F.collect_set("packed").alias("places"))
    of_doc = firsts.groupBy("doc", "th").agg(F.collect_set(F.struct("packed", "a", "b")).alias("firsts"))
    marks = scratch.table(by_doc.join(of_doc, ["doc", "th"], "left"), "marks")
    scratch.keep_only(marks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.join(marks, ["doc", "th"], "left").select("doc_id", "text", "places", "firsts")
    return map_arrow(joined, _cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")


OP2_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS x FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
bytes AS (SELECT doc_id, unnest(range(0, n)) AS p FROM d),
gone AS (SELECT bytes.doc_id, p, max((later.s IS NOT NULL)::INT) OVER (PARTITION BY bytes.doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS g
         FROM bytes LEFT JOIN later ON later.doc_id = bytes.doc_id AND later.s = bytes.p),
runs AS (SELECT *, lag(g, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS was FROM gone),
per AS (SELECT doc_id, sum(g) AS n_removed, sum((g = 1 AND was = 0)::INT) AS n_spans FROM runs GROUP BY 1),
stays AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM gone WHERE g = 0),
pieces AS (SELECT doc_id, min(p) AS a, count(*) AS m FROM stays GROUP BY doc_id, island),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * m), '' ORDER BY a) AS k FROM pieces JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def brute(rows: list[tuple[int, str | None]], depth: int = DEPTH) -> dict[int, tuple[int, int, int, str]]:
    """The contract with a dictionary of all windows; for tests."""
    seen: set[bytes] = set()
    out = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - depth + 1):
            w = raw[i : i + depth]
            if w in seen:
                gone[i : i + depth] = b"\1" * depth
            else:
                seen.add(w)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out
