"""Secret scan with a recursive decoding worklist.

Each text is scanned as it is, then as layers: URL escapes and Unicode escapes decoded in place, runs of base64
decoded (over line breaks, and at all four alignments, since what stands before may be of the alphabet too), and
compressed payloads (zlib, gzip, bzip2, xz) unpacked wherever they start in the bytes. Decoded bytes need not be text throughout. Every layer is scanned and put on the worklist until nothing
new appears; layers already seen, by the characters and the place they come from, are not decoded again, which ends
cycles. Each character of a layer knows the span of the original text it comes from, so a secret found three layers
down is reported at the characters of the original that encode it. Found in the text itself, spans are the base
spans; the method only adds.

No bound on the chain of layers: URL, Unicode and base64 steps shrink the text, so they end; time grows with the depth.
An escape of an escape (and so on) of one kind is a single step, so such chains take linear time; only texts that
nest different kinds in turns pay for each turn.
Compressed payloads are unpacked to their end, member after member, and scanned in stretches of MAX_UNPACKED bytes that
overlap, so memory is bounded however much they hold. `truncated` says where a payload could not be read whole: it
breaks off in error, or an encoded run inside it is as long as a stretch. redact_secrets takes such payloads out.

Defined cases: null text is empty and has no spans. Repeated rows are each returned. Equal spans of one kind are
returned once. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import pick_as
from ..shipping import map_arrow

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
#: As HEX with 24 or more: a run is taken whole, so the length can stand in the pattern.
LONG_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")

#: Bytes of unpacked text that are scanned at a time, what stretches share at least, and what is unpacked in one call.
MAX_UNPACKED = 64 << 20
OVERLAP = 1 << 20
PIECE = 1 << 20
MIN_BASE64 = 16

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_BYTES = re.compile(b"[0-9a-f]{24}")
#: An escape together with the escapes of its own sign before it: "%252541" stands for "%41" escaped twice more. All
#: levels are peeled in one step, so a chain costs its length, not its square; what lies between are parts of one run.
_URL = re.compile("(?:%(?:25)*[0-9A-Fa-f]{2})+")
_URL_ONE = re.compile("%(?:25)*([0-9A-Fa-f]{2})")
_UNICODE = re.compile(
    r"\\(?:u\{0*5[Cc]\}|u005[Cc]|U0000005[Cc]|x5[Cc])*(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))"
    r"|&(?:#x0*26;|#0*38;)*(?:#x([0-9A-Fa-f]{1,6});|#([0-9]{1,7});)"
)
#: A run on one line, or over line breaks (MIME). What is glued to it by characters of the alphabet is part of the run.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{4,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+|[A-Za-z0-9+/_-]{%d,})={0,2}" % MIN_BASE64)
_BREAKS = re.compile(r"\r?\n[\x20\t]*")
#: An encoded layer needs one of these; cheap to rule out.
_ENCODED = re.compile(rb"%%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f{]|&#|[A-Za-z0-9+/_-]{%d}|[A-Za-z0-9+/_-]{4}\r?\n[\x20\t]*[A-Za-z0-9+/_-]" % MIN_BASE64)
_PAYLOAD = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|[\x08\x18\x28\x38\x48\x58\x68\x78](?=[\x00-\xff])")
_PRINTABLE = re.compile(r"[\t-\r\x20-\x7e]{8,}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Of the text itself, by kind, in order of appearance."""
    out: list[Span] = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return out


class Layer:
    """A text and, for each of its characters, the span of the original it stands for; None: its own place plus shift.

    Places are kept as pieces (start in the layer, start in the original, whole span or None): a piece without a span
    maps one to one, a piece with a span maps as a whole. So memory follows the number of escapes, not of characters.
    """

    __slots__ = ("text", "pieces", "depth", "starts")

    def __init__(self, text: str, pieces: list[tuple[int, int, int, tuple[int, int] | None]], depth: int):
        self.text, self.pieces, self.depth = text, pieces, depth  # piece: (from, to, original start, whole)
        self.starts = [p[0] for p in pieces]

    def at(self, place: int) -> int:
        return max(0, bisect_right(self.starts, place) - 1)

    def origin(self, a: int, b: int) -> tuple[int, int]:
        """The original span of the characters a to b."""
        lo, hi = self.pieces[self.at(a)], self.pieces[self.at(b - 1)]
        start = lo[3][0] if lo[3] else lo[2] + a - lo[0]
        end = hi[3][1] if hi[3] else hi[2] + b - hi[0]
        return start, end


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded in place; None if nothing changed."""
    parts, pieces, at, last = [], [], 0, 0

    def keep(a: int, b: int) -> None:
        nonlocal at
        k = layer.at(a)
        while k < len(layer.pieces) and layer.pieces[k][0] < b:
            p = layer.pieces[k]
            x, y = max(a, p[0]), min(b, p[1])
            if x < y:
                pieces.append((at, at + y - x, p[2] + (0 if p[3] else x - p[0]), p[3]))
                at += y - x
            k += 1
        parts.append(layer.text[a:b])

    for m in pattern.finditer(layer.text):
        new = decode(m)
        if new is None or new == m[0]:
            continue
        keep(last, m.start())
        if new:
            span = layer.origin(m.start(), m.end())
            parts.append(new)
            pieces.append((at, at + len(new), span[0], span))
            at += len(new)
        last = m.end()
    if not last:
        return None
    keep(last, len(layer.text))
    return Layer("".join(parts), pieces, layer.depth + 1)


def _url(m: re.Match) -> str:
    """As UTF-8 where the run is that, else a character for each byte, as all that is looked for is ASCII."""
    raw = bytes.fromhex("".join(_URL_ONE.findall(m[0])))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _unicode(m: re.Match) -> str | None:
    n = int(m[6]) if m[6] else int(next(g for g in m.groups()[:5] if g), 16)
    return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else None


def _packed(raw: bytes) -> bool:
    """Whether bytes start as a gzip, bzip2, xz or zlib payload does."""
    if bytes(raw[4:10]) == b"1AY&SY" and bytes(raw[:3]) == b"BZh" or bytes(raw[:6]) == b"\xfd7zXZ\x00":
        return True
    return raw[:3] == b"\x1f\x8b\x08" or (len(raw) > 2 and raw[0] & 143 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0)


class _Buffered:
    """bzip2 and xz as zlib's objects are used: they keep what they have not unpacked yet themselves."""

    unconsumed_tail = b""

    def __init__(self, inner):
        self.inner = inner

    def decompress(self, data: bytes, most: int) -> bytes:
        return self.inner.decompress(data, most)

    eof = property(lambda self: self.inner.eof)
    unused_data = property(lambda self: self.inner.unused_data)


def _opened(head: bytes):
    if bytes(head[:3]) == b"BZh":
        return _Buffered(bz2.BZ2Decompressor())
    if bytes(head[:6]) == b"\xfd7zXZ\x00":
        return _Buffered(lzma.LZMADecompressor(lzma.FORMAT_XZ, MAX_UNPACKED))
    return zlib.decompressobj(47)


def _pieces(raw: bytes) -> Iterator[bytes]:
    return (raw[i : i + PIECE] for i in range(0, len(raw), PIECE))


class Unpacking:
    """The contents of the payload at the start of some bytes, member after member, in pieces. used: bytes that whole
    pieces came from; broken: it ended in error after some of it was read."""

    def __init__(self, source: Iterator[bytes]):
        self.source, self.used, self.broken = source, 0, False

    def __iter__(self) -> Iterator[bytes]:
        data, any_out = b"", False
        while _packed(data := self._more(data)):
            d = _opened(data)
            while not d.eof:
                try:
                    out = d.decompress(data, PIECE)
                except (zlib.error, OSError, lzma.LZMAError):
                    self.broken = any_out
                    return
                self.used += len(data) - len(d.unconsumed_tail) - len(d.unused_data)
                data = d.unconsumed_tail
                if out:
                    any_out = True
                    yield out
                elif not data and not d.eof and not (data := next(self.source, b"")):
                    return
            data = d.unused_data

    def _more(self, data: bytes) -> bytes:
        while len(data) < 10 and (x := next(self.source, b"")):
            data = bytes(data) + bytes(x)
        return data


def _stretches(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Pieces joined to stretches of about MAX_UNPACKED bytes, each starting with the last of the one before: OVERLAP
    bytes, or all of a run of characters of values and encodings that is longer; whether such a run had to be cut."""
    held, new, cut = b"", [], False
    size = 0
    for x in pieces:
        new.append(x)
        size += len(x)
        if len(held) + size >= MAX_UNPACKED:
            held = b"".join([held, *new])
            yield held, cut
            if held.endswith(b" "):  # no pattern tells many blanks from one
                held = held.rstrip(b" ") + b" "
            run = len(held) - len(held.rstrip(_RUN))
            if cut := run > MAX_UNPACKED // 2:
                run = 0
            held, new, size = held[-max(run, OVERLAP) :], [], 0
    if size:
        yield b"".join([held, *new]), cut


def _text_of(raw: bytes) -> Iterator[tuple[bytes, bool]]:
    """Stretches of what a payload holds and, while that is a payload itself, of what it holds too. One that holds
    itself ends there."""
    seen = set()
    whole, deep = raw, 1  # the last payload that is here as a whole; from it, levels that are not are unpacked again
    while True:
        source = _pieces(whole)
        chain = []
        for _ in range(deep):
            chain.append(Unpacking(source))
            source = iter(chain[-1])
        n, first, packed = 0, b"", False
        for n, (first, cut) in enumerate(_stretches(source), 1):
            packed = _packed(first) if n == 1 else packed
            yield first, cut
        if chain[-1].broken:
            yield b" ", True
        if not packed:
            return
        if n > 1:
            deep += 1
            continue
        if (key := hashlib.sha256(first).digest()) in seen:
            return
        seen.add(key)
        whole, deep = first, 1


_RUN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=.%\\&#;{}\r\n"


def _readings(run: str) -> Iterator[tuple[int, list[int] | range, bytes]]:
    """A base64 run read at each of the four alignments, as what it is glued to shifts it: the alignment, the place of
    every character of the run without its line breaks, the bytes."""
    body = run.rstrip("=")
    places: list[int] | range = range(len(body))
    if "\n" in body:
        gaps = [m.span() for m in _BREAKS.finditer(body)]
        places = [i for a, b in zip([0, *[g[1] for g in gaps]], [*[g[0] for g in gaps], len(body)]) for i in range(a, b)]
        body = _BREAKS.sub("", body)
    if len(body) < MIN_BASE64:
        return
    body = body.translate({45: 43, 95: 47})
    for k in range(4):
        part = body[k : len(body) - ((len(body) - k) % 4 == 1)]
        yield k, places, binascii.a2b_base64(part + "=" * (-len(part) % 4))


def _layers_of(layer: Layer, m: re.Match) -> Iterator[Layer | Iterator[tuple[Layer, bool]]]:
    """What the base64 run of a layer holds: text, text of two or four bytes a character, or the layers of a compressed
    payload. Bytes stand for one character each, as all that is looked for is ASCII."""
    for k, places, raw in _readings(m[0]):

        def span(a: int, b: int) -> tuple[int, int]:
            """The original characters that encode the bytes a to b; all of the run, padding too, for all of the bytes."""
            end = m.end() if b == len(raw) else m.start() + places[min(k + (b * 8 + 5) // 6, len(places)) - 1] + 1
            return layer.origin(m.start() + places[k + a * 8 // 6], end)

        if _may_hold(raw):
            text = raw.decode("latin-1")
            cuts = [0, len(raw)]
            if not _plain(raw):
                cuts = sorted({0, len(raw), *[x for t in _PRINTABLE.finditer(text) for x in t.span()]})
            pieces = [(a, b, (w := span(a, b))[0], w) for a, b in zip(cuts, cuts[1:])]
            yield Layer(text, pieces, layer.depth + 1)
        if b"\0" in raw and _may_hold(thin := raw.replace(b"\0", b"")):
            w = span(0, len(raw))
            yield Layer(thin.decode("latin-1"), [(0, len(thin), w[0], w)], layer.depth + 1)
        done, view = 0, memoryview(raw)
        for p in _PAYLOAD.finditer(raw):
            if p.start() >= done and (used := _used(view[p.start() :])):
                done = p.start() + used
                yield _unpacked_layers(raw[p.start() : done], span(p.start(), done), layer.depth + 1)


def _plain(raw: bytes) -> bool:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return not any(ord(c) < 32 and c not in "\t\n\r" for c in text)


def _used(raw: bytes) -> int:
    """Bytes that the compressed payload at the start takes; 0 if there is none."""
    if not _packed(raw):
        return 0
    opened = Unpacking(_pieces(raw))
    size = sum(len(x) for x in opened)
    return len(raw) if opened.broken else opened.used if size else 0


def _unpacked_layers(raw: bytes, span: tuple[int, int], depth: int) -> Iterator[tuple[Layer, bool]]:
    for out, cut in _text_of(raw):
        for text in (out, out.replace(b"\0", b"") if b"\0" in out else b""):
            if text and (cut or _may_hold(text)):
                yield Layer(text.decode("latin-1"), [(0, len(text), span[0], span)], depth), cut


def _scanned(text: str) -> tuple[list[Span], list[Span], set[tuple[int, int]]]:
    """Base spans, all spans, both sorted by start, then kind; spans of payloads that could not be read whole."""
    base = sorted(base_spans(text), key=_ORDER)
    found = set(base)
    work: list[Layer | Iterator[tuple[Layer, bool]]] = [Layer(text, [(0, len(text), 0, None)], 0)]
    seen = {_key(work[0])}
    unread = set()
    while work:
        layer = work.pop()
        if not isinstance(layer, Layer):  # a payload's stretches come one at a time
            inner = next(layer, None)
            if inner is None:
                continue
            work.append(layer)
            layer, cut = inner
            if cut:
                unread.add(layer.origin(0, len(layer.text)))
            if (key := _key(layer)) in seen:
                continue
            seen.add(key)
        if layer.depth:
            found.update((k, *layer.origin(a, b)) for k, a, b in base_spans(layer.text))
        new = [x for x in (_replaced(layer, _URL, _url), _replaced(layer, _UNICODE, _unicode)) if x is not None]
        new += [x for m in _BASE64.finditer(layer.text) for x in _layers_of(layer, m)]
        for x in new:
            if not isinstance(x, Layer):
                work.append(x)
            elif x.text and (key := _key(x)) not in seen:
                seen.add(key)
                work.append(x)
    return base, sorted(found, key=_ORDER), unread


def _key(x: Layer) -> bytes:
    """The characters and where each piece of them comes from."""
    return hashlib.sha256(x.text.encode("utf-8", "surrogatepass")).digest() + hashlib.sha256(repr(x.pieces).encode()).digest()


def _ORDER(s: Span) -> tuple[int, int, int]:
    return s[1], KINDS.index(s[0]), s[2]


def scan_text(text: str) -> tuple[list[Span], list[Span], bool]:
    """Base spans, all spans, whether a payload could not be read whole; both sorted by start, then kind."""
    base, every, unread = _scanned(text)
    return base, every, bool(unread)


def _may_hold(raw: bytes) -> bool:
    """False only if neither the text nor any layer of it can hold a secret."""
    if b"AKIA" in raw or _ENCODED.search(raw) or _HEX_BYTES.search(raw):
        return True
    low = raw.lower()
    return any(k in low for k in _KEYWORDS)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_documents(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), redact: bool = False) -> DataFrame:
    """The kept columns, then base and spans (strings of kind:start:end), counts of the base, truncated; with redact,
    text is returned with every span replaced by [REDACTED:kind] (overlapping spans together, by the first's kind), and
    payloads that could not be read whole by [REDACTED:payload]."""
    names = [f"k_{i}" for i in range(len(keep))]
    work = pick_as(documents, dict(zip(names, keep)) | {"k_text": "text"})
    fields = ", ".join(f"{n} {work.schema[n].dataType.simpleString()}" for n in names)
    made = "n_assign bigint, n_access bigint, n_hex bigint, base string, spans string, truncated boolean" + (", clean string" if redact else "")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column("k_text").cast(pa.binary()).to_pylist():
                if raw is None or not _may_hold(raw):
                    rows.append((0, 0, 0, "", "", False, None if raw is None else raw.decode("utf-8")))
                    continue
                text = raw.decode("utf-8")
                base, every, unread = _scanned(text)
                hide = sorted([*every, *[("payload", *x) for x in unread]], key=lambda s: (s[1], s[2])) if unread else every
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*n, joined(base), joined(every), bool(unread), redacted(text, hide) if redact and hide else text))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.bool_(), pa.string()]
            arrays = [batch.column(n) for n in names] + [pa.array(c, t) for c, t in list(zip(cols, kinds))[: 7 if redact else 6]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_assign", "n_access", "n_hex", "base", "spans", "truncated", *(["clean"] if redact else [])])

    out = map_arrow(work, scan, f"{fields}, {made}")
    return out.toDF(*keep, *[x.split(" ")[0] for x in made.split(", ")]) if not redact else out.toDF(*keep, "n_assign", "n_access", "n_hex", "base", "spans", "truncated", "clean")


def redacted(text: str, spans: list[Span]) -> str:
    parts, last = [], 0
    for k, a, b in spans:
        if a < last:
            last = max(last, b)
            continue
        parts += [text[last:a], f"[REDACTED:{k}]"]
        last = b
    return "".join([*parts, text[last:]])


def redact_secrets(documents: DataFrame) -> DataFrame:
    """All rows and columns of documents, with secrets in text replaced and n_chars, where there is one, counted anew."""
    found = scan_documents(documents, keep=tuple(documents.columns), redact=True)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    changed = (F.col("found_spans") != "") | F.col("truncated")
    # Columns of documents may be named as those of the scan are, or differ from the usual names in case.
    n = len(documents.columns)
    found = found.toDF(*[f"c{i}" for i in range(n)], "n_assign", "n_access", "n_hex", "base", "found_spans", "truncated", "clean")
    return found.select(*[(F.when(changed, new[c.lower()]).otherwise(F.col(f"c{i}")) if c.lower() in new else F.col(f"c{i}")).alias(c) for i, c in enumerate(documents.columns)])


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "truncated")
