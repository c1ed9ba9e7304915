"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of documents. A window of 2048 tokens is filled in turns: every window credits each source with
its target share of the window, a source is served up to its credit, and what it was owed or given too much stays on
its account for the windows after. Targets default to the sources' shares of all tokens, so that every window is a
sample of the whole corpus and all queues end together; given targets hold until a queue is empty, when the others
take over in proportion.

Documents are dealt to lanes by hash and place, so no source and no row, however often it is there, gathers in one
task; a lane gets LANE_BYTES of text at most on average, and packs its own windows. Token counts per lane and source
are summed first; from them every lane starts with the account that the lanes before it leave behind, and with the
number of its first sequence. These accounts stay in Spark and meet their lane there. What is left of a lane at its
end, less than a window, is cut into sequences whose lengths are powers of two, which need no padding.

Defined cases: null text is empty; its document is the end token alone. Null sources are one queue. A null doc_id is
returned as null, and ids of any type as they are. Repeated rows are packed each. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import pick
from ..scratch import Scratch
from ..shipping import map_arrow, ship

LENGTH, END_ID = 2048, 1
#: Text of a lane, on average; there are as many lanes as that takes, and no fewer than partitions.
LANE_BYTES = 32 << 20
#: A source is served once its credit reaches so many tokens (or its document's rest), which keeps pieces long.
LEAST_PIECE = 256

_encoders: dict = {}


def _encoder(path: str):
    """Functions from texts to ids: the one to use, and the tokenizer's own. tiktoken runs the same merges over the same
    vocabulary several times faster; the vocabulary's own file says what is special, and probe texts are compared here,
    the first texts of every task by the caller."""
    if path not in _encoders:
        import json

        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(path)
        fast = _byte_level(json.loads(slow.to_str()))
        plain = lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
        _encoders[path] = (fast if fast and fast(_PROBES) == plain(_PROBES) else plain, plain)
    return _encoders[path]


_PROBES = ["", "The end.\n\n  It's  'll 12a<|endoftext|>é Ünïcode — 你好 \t\r\n x y", " \n a  b　c​  ", "I'VE we've 'S 's ''s don't\n\tq 3.14 ½²٣ é"]


def _byte_level(spec: dict):
    """A tiktoken encoding for a byte-level BPE without normaliser; None for other kinds."""
    model = spec["model"]
    if model.get("type") != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
        return None
    import public_tokenizers
    import tiktoken

    # The byte alphabet of such vocabularies: printable bytes stand for themselves, the others follow from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    ranks = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    made = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    every = set(special)
    return lambda texts: [made.encode(t, allowed_special=every) if any(s in t for s in every) else made.encode_ordinary(t) for t in texts]


#: At the start of each task so many texts, and so many characters of each, are encoded both ways.
COMPARED_TEXTS, COMPARED_CHARS = 8, 2000


def tokenize(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, source, n, ids (little-endian unsigned, 2 bytes each, or 4 if any needs it, with width), nth (the row's
    place in its task)."""
    docs = pick(documents, "doc_id", "text", "source")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, plain = _encoder(tokenizer_path)
        done = 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                if not done and encode is not plain:
                    some = [t[:COMPARED_CHARS] for t in texts[:COMPARED_TEXTS]]
                    encode = encode if encode(some) == plain(some) else plain
                ids = encode(texts)
                widths, packed = [], []
                for x in ids:
                    a = np.array([*x, END_ID], np.uint32)
                    widths.append(2 if a.max() < 65536 else 4)
                    packed.append(a.astype("<u2" if widths[-1] == 2 else "<u4").tobytes())
                nth = pa.array(np.arange(done, done + part.num_rows))
                done += part.num_rows
                cols = [part.column("doc_id"), part.column("source").cast(pa.string()).fill_null(""), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array(widths, pa.int32()), pa.array(packed, pa.binary()), nth]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "source", "n", "width", "ids", "nth"])

    return map_arrow(docs, run, f"doc_id {kind}, source string, n bigint, width int, ids binary, nth bigint")


def n_sequences(tokens: int, length: int = LENGTH) -> int:
    return tokens // length + (tokens % length).bit_count()


class Lane:
    """Deficit round-robin over the queues of one lane. Plans pieces as (document, start, length, sequence, offset)."""

    def __init__(self, queues: dict[str, list[tuple[int, int]]], shares: dict[str, float], accounts: dict[str, float], length: int = LENGTH, least: int = LEAST_PIECE):
        self.names = sorted(queues)
        self.queues = {s: iter(q) for s, q in queues.items()}
        self.head: dict[str, list[int]] = {}
        self.shares, self.credit = shares, {s: accounts.get(s, 0.0) for s in self.names}
        self.length, self.least = length, least
        self.pieces: list[tuple[int, int, int, int, int]] = []
        self.left = {s: sum(n for _, n in q) for s, q in queues.items()}
        self.turn = 0

    def _take(self, s: str, most: int, sequence: int, offset: int) -> int:
        """Up to most tokens of the head document of s."""
        if s not in self.head:
            self.head[s] = [*next(self.queues[s]), 0]
        doc, n, start = self.head[s]
        got = min(most, n - start)
        self.pieces.append((doc, start, got, sequence, offset))
        if start + got == n:
            del self.head[s]
        else:
            self.head[s][2] += got
        self.left[s] -= got
        self.credit[s] -= got
        return got

    def _fill(self, size: int, sequence: int) -> None:
        active = [s for s in self.names if self.left[s]]
        total = sum(self.shares.get(s, 0.0) for s in active)
        for s in active:
            self.credit[s] += size * (self.shares.get(s, 0.0) / total if total > 0 else 1 / len(active))
        offset = 0
        # A round: from where the last one stopped, each source up to its credit, if that makes a piece of some length.
        for k in range(len(active)):
            s = active[(self.turn + k) % len(active)]
            while offset < size and self.left[s] and self.credit[s] >= min(self.least, self.left[s], size - offset):
                offset += self._take(s, min(size - offset, max(1, int(self.credit[s]))), sequence, offset)
            if offset == size:
                self.turn += k
                break
        # What the round leaves goes to whom most is owed; the account records it.
        while offset < size:
            s = max((x for x in active if self.left[x]), key=lambda x: self.credit[x])
            offset += self._take(s, min(size - offset, max(self.least, int(self.credit[s]))), sequence, offset)

    def run(self, first_sequence: int) -> list[tuple[int, int, int, int, int]]:
        total, sequence = sum(self.left.values()), first_sequence
        for _ in range(total // self.length):
            self._fill(self.length, sequence)
            sequence += 1
        rest = total % self.length
        while rest:
            size = 1 << (rest.bit_length() - 1)
            self._fill(size, sequence)
            sequence, rest = sequence + 1, rest - size
        return self.pieces


def pack(documents: DataFrame, tokenizer_path: str, shares: dict[str, float] | None = None, length: int = LENGTH, lanes: int | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids (of the piece)."""
    spark = documents.sparkSession
    ship(spark)
    scratch = Scratch(spark, "packing")
    n_lanes = lanes or _n_lanes(documents)
    lane = F.pmod(F.xxhash64("doc_id", F.crc32("ids"), "nth"), F.lit(n_lanes)).cast("int")
    rows = scratch.table(tokenize(documents, tokenizer_path).withColumn("lane", lane).drop("nth").repartition(n_lanes, "lane"), "ids")
    accounts = _accounts(scratch.table(rows.groupBy("lane", "source").agg(F.sum("n").alias("tokens")), "counts"), shares, length)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table, given: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _PIECES(table.schema.field("doc_id").type).empty_table()
        of = {a["source"]: a for a in given.to_pylist()}
        # Sources, then as long as ids sort: nulls last, copies by size.
        table = table.sort_by([("source", "ascending"), ("doc_id", "ascending"), ("n", "ascending")]).combine_chunks()
        queues: dict[str, list[tuple[int, int]]] = {}
        for i, (s, n) in enumerate(zip(table.column("source").to_pylist(), table.column("n").to_pylist())):
            queues.setdefault(s, []).append((i, n))
        first = next(iter(of.values()))["first"]
        pieces = Lane(queues, {s: a["share"] for s, a in of.items()}, {s: a["account"] for s, a in of.items()}, length).run(first)
        d, start, size, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
        ids, widths = table.column("ids"), table.column("width").to_pylist()
        held, cut = -1, []
        for k, a, n in zip(d.tolist(), start.tolist(), size.tolist()):
            if k != held:
                held, whole = k, np.frombuffer(ids[k].as_py(), "<u2" if widths[k] == 2 else "<u4").astype("<u4")
            cut.append(whole[a : a + n].tobytes())
        take = lambda c: table.column(c).take(pa.array(d))
        columns = [take("doc_id"), pa.array(start), pa.array(size), pa.array([zlib.crc32(x) for x in cut], pa.int64()), take("n"), pa.array(seq), pa.array(offset), take("source"), pa.array(cut, pa.binary())]
        return pa.Table.from_arrays(columns, schema=_PIECES(table.schema.field("doc_id").type))

    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string, ids binary"
    return rows.groupBy("lane").cogroup(accounts.groupBy("lane")).applyInArrow(run, schema)


def _PIECES(kind: pa.DataType) -> pa.Schema:
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return pa.schema([("doc_id", kind), *((n, pa.int64()) for n in names), ("source", pa.string()), ("ids", pa.binary())])


def _n_lanes(documents: DataFrame) -> int:
    spark = documents.sparkSession
    size = pick(documents, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), documents.rdd.getNumPartitions(), -(-size // LANE_BYTES))


def _accounts(counts: DataFrame, shares: dict[str, float] | None, length: int) -> DataFrame:
    """lane, source, share (of the source in a window), account (what the lanes before owe it), first (number of the
    lane's first sequence). counts: lane, source, tokens. Sums run over the lanes of a source, and over the lanes."""
    spark = counts.sparkSession
    if shares is None:
        target = counts.groupBy("source").agg(F.sum("tokens").cast("double").alias("weight"))
    else:
        target = spark.createDataFrame(list(shares.items()), "source string, weight double") if shares else counts.select("source", F.lit(0.0).alias("weight")).limit(0)
    whole = target.agg(F.sum("weight").alias("whole"))  # one row
    target = target.join(F.broadcast(whole)).select("source", F.when(F.col("whole") > 0, F.col("weight") / F.col("whole")).otherwise(0.0).alias("share"))
    before = lambda c, *keys: F.coalesce(F.sum(c).over(W.partitionBy(*keys).orderBy("lane").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sequences = F.floor(F.col("tokens") / F.lit(length)) + F.bit_count(F.pmod("tokens", F.lit(length)))
    # A row for each lane: their number is the text's size over a lane's.
    lanes = counts.groupBy("lane").agg(F.sum("tokens").alias("tokens")).withColumn("sequences", sequences)
    lanes = lanes.select("lane", before("tokens").alias("tokens_before"), before("sequences").cast("long").alias("first"))
    own = counts.select("lane", "source", before("tokens", "source").alias("own_before"))
    joined = own.join(lanes, "lane").join(target, "source", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return joined.select("lane", "source", "share", (F.col("share") * F.col("tokens_before") - F.col("own_before")).alias("account"), "first")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.drop("ids")
