"""Secret scans by a recursive decoding worklist.

Every text is scanned for three kinds of secrets. Then its layers are unwrapped: URL escapes and Unicode
escapes in place (so a match may join decoded and plain characters), base64 blobs and compressed data as
layers of their own. A blob is decoded at each of its four phases, as letters may stand right before it, and its
bytes may be UTF-8, UTF-16 or, if they are neither, single-byte characters. Each new layer is scanned and put on the
worklist again, until nothing new appears; a layer whose content was seen before (a cycle, or two ways to one content
at one place) is not taken again. Each character of a layer knows the range of the original text it came from, so spans
of any depth are given in code points of the original.

Compressed layers are streams: what an outer one gives goes on to the inner ones that are open as it comes, so layers
of any size and depth are read to their end, and memory holds a piece of each. A piece ends where no match, escape or
run of base64 letters can go on (`safe_cut`); a run longer than PIECE is held whole. Compressed layers inside
DEEP others are held whole, too, and known again by a digest, which ends those that hold themselves. A compressed layer's secrets
all stand for its whole place in the text. Formats are gzip, zlib, bzip2, xz and lzma; raw deflate has no beginning
that could be told and is not looked for.

Null and empty texts have no spans; a text of any length is scanned whole; an empty table has no rows. Rows are
independent: ties, repeats and other columns need no care, and ids may be null.
"""

from __future__ import annotations

import binascii
import bz2
import lzma
import re
import sys
import zlib
from hashlib import sha256
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import map_batches, plain_text, text_steps

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|%u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
#: A run begins where no letter stands before it and has 12 letters at once or goes on after a line end.
RUN = re.compile(r"(?x) [L](?<![L][L]) (?: [L]{11,} (?:(?:\r?\n[ \t]*|(?:\\r)?\\n)[L]+)* | [L]{0,10} (?:(?:\r?\n[ \t]*|(?:\\r)?\\n)[L]+)+ ) ={0,2}".replace("L", "A-Za-z0-9+/_-"))
#: The parts of a run: line ends, written out or not, or letters.
RUN_PART = re.compile(r"\r?\n[ \t]*|(?:\\r)?\\n|([A-Za-z0-9+/_-]+)")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: A run of percent escapes and the characters that percent-encoding leaves bare.
MIXED = re.compile(r"(?x) [%L](?<![%L]{2}) (?:(?<=%)|[L]*%) [%L]*".replace("L", "A-Za-z0-9_.~/+-"))
PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
#: zlib's first two bytes: method 8, one of eight windows, one of four levels, and a check sum that makes 31 divide them.
ZLIB = {bytes([cmf, level << 6 | -(cmf << 8 | level << 6) % 31]) for cmf in range(0x08, 0x79, 0x10) for level in range(4)}
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x5d\x00\x00|" + b"|".join(map(re.escape, sorted(ZLIB))))
#: Bytes that the longest of these takes, and bytes of compressed data that are unpacked at a time.
MAGIC_BYTES, FEED = 6, 64 << 10
#: What decoded bytes must hold to be worth a layer: a secret's beginning, an escape, or a run that may be base64.
TELLING = re.compile(rb"password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{32}|%[0-9a-f]{2}|\\[ux]|[a-z0-9+/_-]{12}", re.I)
WIDE = re.compile(rb"(?:[\x09-\x7e]\x00){6}")
#: Bytes of unpacked data that are scanned together, and nested streams from which data is held to be known again.
PIECE, DEEP = 4 << 20, 16
#: Places before which no pattern goes on: signs that none of them holds, the first byte of a longer character, and a
#: space between words, also with two bytes a letter.
SAFE = re.compile(rb"[!#$&()*,;<>?@\[\]^`|\x01-\x08\x0b\x0c\x0e-\x1f\x7f\xc2-\xf4]|(?<=[A-Za-z0-9.])\x20(?=[A-Za-z0-9])|(?<=[A-Za-z0-9.]\x00)\x20(?=\x00[A-Za-z0-9])")
FEWEST = 12


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of each secret as it stands, leftmost and without overlap within a kind."""
    lower = text.lower()  # the words are looked for first, which is quicker than the pattern
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8] if any(w in lower for w in WORDS) else []
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """Decoded text and, per character, the range of the original it stands for; or one place for all of it; or the text itself."""

    def __init__(self, text: str, low: np.ndarray | None = None, high: np.ndarray | None = None, place: tuple[int, int] | None = None):
        self.text, self.low, self.high, self.place = text, low, high, place

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.place is not None:
            return self.place
        if self.low is None:
            return start, end
        return int(self.low[start:end].min()), int(self.high[start:end].max())

    def borders(self) -> tuple[np.ndarray, np.ndarray]:
        if self.low is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.low, self.high


def safe_cut(data: bytes) -> int:
    """The last place in data where a piece may end, 0 if there is none."""
    high = len(data)
    while high > 0:
        low = max(0, high - (16 << 10))
        last = None
        for last in SAFE.finditer(data, low, high):  # noqa: B007 - the last one counts
            pass
        if last is not None:
            return last.start()
        high = low + 1 if low else 0
    return 0


def readable(raw: bytes) -> list[str]:
    """raw as text: UTF-8, UTF-16 of mostly narrow letters, or one byte a character where that may tell something."""
    out = []
    if (m := WIDE.search(raw)) is not None:
        odd = m.start() % 2  # big-endian data, one byte on, read the same where letters are narrow
        out.append((raw[odd:] + b"\x00" * ((len(raw) - odd) % 2)).decode("utf-16-le", "replace"))
    try:
        out.append(raw.decode())
    except UnicodeDecodeError:
        if TELLING.search(raw) is not None:
            out.append(raw.decode("latin-1"))
    return out


def with_bytes(raw: bytes) -> list[tuple[str, np.ndarray]]:
    """readable(raw), each text with the first byte of its characters and the end."""
    out = []
    for text in readable(raw):
        if len(text) == len(raw):
            at = np.arange(len(raw) + 1)
        elif WIDE.search(raw) is not None and 2 * len(text) <= len(raw) + 2:
            odd = WIDE.search(raw).start() % 2
            at = np.minimum(odd + np.cumsum([0, *(2 if c < "\U00010000" else 4 for c in text)]), len(raw))
        else:
            at = np.cumsum([0] + [len(c.encode()) for c in text])
        out.append((text, at))
    return out


class Member:
    """A compressed layer that bytes are pushed into: member after member, until they end or are damaged."""

    def __init__(self, scan: Scan, place: tuple[int, int], depth: int):
        self.content, self.d, self.head, self.open = Content(scan, place, depth), None, b"", True

    def push(self, data) -> None:
        view = memoryview(data)
        for at in range(0, len(view), FEED):
            if not self.open:
                return
            self._feed(bytes(view[at : at + FEED]))

    def _feed(self, data: bytes) -> None:
        while self.open and data:
            if self.d is None:
                self.head += data
                if len(self.head) < MAGIC_BYTES:
                    return
                data, self.head = self.head, b""
                self.d = decompressor(data)
                if self.d is None:
                    return self.close()
            try:
                out = self.d.decompress(data, PIECE)
                while True:
                    if out:
                        self.content.push(out)
                    if self.d.eof:
                        break
                    rest = getattr(self.d, "unconsumed_tail", b"")
                    if not rest and (not hasattr(self.d, "needs_input") or self.d.needs_input):
                        return
                    out = self.d.decompress(rest, PIECE)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return self.close()
            data, self.d = self.d.unused_data, None

    def close(self) -> None:
        if self.open:
            self.open, self.d = False, None
            self.content.close()


class Held:
    """A compressed layer deep inside others: its bytes are kept until they end, then opened unless seen before."""

    def __init__(self, scan: Scan, place: tuple[int, int], depth: int):
        self.scan, self.place, self.depth, self.data, self.open = scan, place, depth, bytearray(), True

    def push(self, data) -> None:
        self.data += data

    def close(self) -> None:
        if self.open:
            self.open = False
            self.scan.unpack(memoryview(bytes(self.data)), self.place, self.depth)


class Content:
    """What a compressed layer holds, as it is unpacked: scanned piece by piece, and passed on to layers inside."""

    def __init__(self, scan: Scan, place: tuple[int, int], depth: int):
        self.scan, self.place, self.depth = scan, place, depth
        self.text, self.size, self.tail, self.inner = [], 0, b"", []

    def push(self, piece: bytes) -> None:
        for inner in self.inner:
            inner.push(piece)
        self._open(piece, last=False)
        self.inner = [x for x in self.inner if x.open]
        self.text.append(piece)
        self.size += len(piece)
        if self.size >= PIECE:
            data = b"".join(self.text)
            cut = safe_cut(data)
            self._read(data[:cut])
            self.text, self.size = [data[cut:]], 0  # a run that goes on is looked at again when as much has come

    def _open(self, piece: bytes, last: bool) -> None:
        """Begin the layers inside whose first bytes are here; the last bytes wait for those behind them."""
        data = self.tail + piece
        until = len(data) if last else max(0, len(data) - MAGIC_BYTES + 1)
        for m in MAGIC.finditer(data):
            if m.start() >= until:
                break
            inner = (Held if self.depth >= DEEP else Member)(self.scan, self.place, self.depth + 1)
            inner.push(memoryview(data)[m.start() :])
            if inner.open:
                self.inner.append(inner)
        self.tail = data[until:]

    def _read(self, data: bytes) -> None:
        if data and (TELLING.search(data) is not None or WIDE.search(data) is not None):
            for text in readable(data):
                self.scan.visit(Layer(text, place=self.place))

    def close(self) -> None:
        self._open(b"", last=True)
        for inner in self.inner:
            inner.close()
        self._read(b"".join(self.text))
        self.text, self.inner = [], []


def decompressor(data: bytes):
    """What unpacks data that begin like this, or None."""
    if data[:3] == b"\x1f\x8b\x08" or data[:2] in ZLIB:
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor(memlimit=1 << 28) if data[:6] == b"\xfd7zXZ\x00" or data[:3] == b"\x5d\x00\x00" else None


class Scan:
    """The worklist of one text: spans found, layers seen."""

    def __init__(self):
        self.found: set[tuple[int, int, int]] = set()
        self.seen: set = set()

    def visit(self, layer: Layer) -> None:
        """Scan a layer, if it is new, and all that is inside."""
        work = [layer]
        while work:
            layer = work.pop()
            place = (sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), *layer.origin(0, len(layer.text))) if layer.text else None
            if place is None or place in self.seen:
                continue
            self.seen.add(place)
            self.found.update((kind, *layer.origin(start, end)) for kind, start, end in base_spans(layer.text))
            if "%" in layer.text or "\\" in layer.text:
                work += undo_escapes(layer, self)
            work += undo_base64(layer, self)

    def unpack(self, raw: memoryview, place: tuple[int, int], depth: int = 0) -> None:
        """Open the compressed layer that raw begins with, unless it was opened at this place."""
        member = Member(self, place, depth)
        member.push(raw[:FEED])
        if not member.open and not member.content.size and not member.content.text:
            return  # only looked like one
        key = (sha256(raw).digest(), place)
        if key not in self.seen:
            self.seen.add(key)
            member.push(raw[FEED:])
            member.close()


def undo_escapes(layer: Layer, scan: Scan) -> list[Layer]:
    """The layer with its URL and Unicode escapes decoded; compressed bytes in a run of escapes are unpacked by scan."""
    text, more = layer.text, []
    low, high = (None, None) if layer.place is not None else layer.borders()
    parts, lows, highs, at = [], [], [], 0
    for m in ESCAPE.finditer(text):
        token = m[0]
        if token[1] in "uU" or token[0] == "\\":
            code = int(token.strip("\\%uUx{}"), 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                continue
            chars, widths = chr(code), [len(token)]
        else:
            raw = bytes.fromhex(token.replace("%", ""))
            if MAGIC.match(raw):
                scan.unpack(memoryview(raw), layer.origin(m.start(), m.end()))
            try:
                chars = raw.decode()
                widths = [3 * len(c.encode()) for c in chars]
            except UnicodeDecodeError:
                chars, widths = raw.decode("latin-1"), [3] * len(raw)
        parts += [text[at : m.start()], chars]
        if low is not None:
            ends = m.start() + np.cumsum(widths)
            lows += [low[at : m.start()], low[ends - widths]]
            highs += [high[at : m.start()], high[ends - 1]]
        at = m.end()
    for m in MIXED.finditer(text):
        if PERCENT.search(m[0]) is None:
            continue
        for raw in {unquote_to_bytes(m[0]), unquote_to_bytes(m[0].replace("+", " "))}:
            for start in MAGIC.finditer(raw):
                scan.unpack(memoryview(raw)[start.start() :], layer.origin(m.start(), m.end()))
    if parts:
        decoded = "".join([*parts, text[at:]])
        more.append(Layer(decoded, place=layer.place) if low is None else Layer(decoded, np.concatenate([*lows, low[at:]]), np.concatenate([*highs, high[at:]])))
    return more


def blobs(text: str) -> list[tuple[int, int]]:
    """Runs of base64 letters of both alphabets, over line breaks too, and their parts: wrapped blocks and lines."""
    found = set()
    for m in RUN.finditer(text):
        if m.end() - m.start() < FEWEST:
            continue
        found.add(m.span())
        if "\n" not in m[0]:
            continue
        lines = [x.span() for x in LINE.finditer(text, m.start(), m.end())]
        found.update((a, b) for a, b in lines if b - a >= FEWEST)
        first = 0
        for i, (a, b) in enumerate(lines):  # a wrapped block: lines of one width, and a last one that is no longer
            width = lines[first][1] - lines[first][0]
            if b - a != width or i == len(lines) - 1:
                last = i if b - a <= width else i - 1
                found.add((lines[first][0], lines[last][1]))
                found.add((lines[first][0], lines[max(i - 1, first)][1]))
                first = i
    return sorted(x for x in found if x[1] - x[0] >= FEWEST)


def undo_base64(layer: Layer, scan: Scan) -> list[Layer]:
    """A layer for each run of base64 letters (either alphabet, any phase) that holds something telling; compressed data are unpacked by scan."""
    out = []
    for start, end in blobs(layer.text):
        run = layer.text[start:end].rstrip("=")
        parts = [m for m in RUN_PART.finditer(run) if m[1] is not None] if not run.isascii() or "\n" in run or "\\" in run else None
        letters = (run if parts is None else "".join(m[1] for m in parts)).replace("-", "+").replace("_", "/")
        places = np.arange(start, start + len(run)) if parts is None else np.concatenate([np.arange(start + m.start(), start + m.end()) for m in parts])
        for phase in range(4):
            used = letters[phase:]
            if len(used) % 4 == 1:
                used = used[:-1]
            raw = binascii.a2b_base64(used + "=" * (-len(used) % 4))
            at, view = places[phase:], memoryview(raw)
            for magic in MAGIC.finditer(raw):
                scan.unpack(view[magic.start() :], layer.origin(int(at[magic.start() // 3 * 4 + magic.start() % 3]), end))
            if TELLING.search(raw) is None and WIDE.search(raw) is None:
                continue
            if layer.place is not None:
                out += [Layer(text, place=layer.place) for text in readable(raw)]
                continue
            low, high = layer.borders()
            for text, byte in with_bytes(raw):
                first = at[np.minimum(byte[:-1] // 3 * 4 + byte[:-1] % 3, len(at) - 1)]
                last = at[np.minimum((byte[1:] - 1) // 3 * 4 + (byte[1:] - 1) % 3 + 1, len(at) - 1)]
                out.append(Layer(text, low[first], high[last]))
    return out


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and these with the spans of all layers; both by start, then kind, then end."""
    base, scan = base_spans(text), Scan()
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # streams inside streams
    scan.visit(Layer(text))
    order = lambda s: (s[1], s[0], s[2])
    return sorted(base, key=order), sorted(scan.found | set(base), key=order)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """text with every maximal run of overlapping spans replaced by mark."""
    out, at, end = [], 0, -1
    for start, stop in sorted((s, e) for _, s, e in spans):
        if start >= end:
            out += [text[at:start], mark]
        at = end = max(end, stop)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of base secrets by kind, digest of base spans, all spans, n_hidden (found in layers only)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part, _ in text_steps(batches):
            rows = []
            for text in part.column(1).to_pylist():
                base, full = all_spans(text)
                kinds = [k for k, _, _ in base]
                rows.append([kinds.count(0), kinds.count(1), kinds.count(2), sha256(spans_text(base).encode()).hexdigest(), spans_text(full), len(full) - len(set(base))])
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names)

    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_hidden"]
    rows = docs.select(docs[id_col], plain_text(text_col).alias("text"))
    return map_batches(rows, run, f"`{id_col}` {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_hidden long")


def redact_secrets(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret, of any layer, replaced by mark in the text; null stays null, other columns as they are."""
    schema = docs.schema

    def run(batches):
        for part, _ in text_steps(batches, text_col):
            at = part.schema.get_field_index(text_col)
            texts = [None if t is None else (redact(t, s, mark) if (s := all_spans(t)[1]) else t) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return map_batches(docs, run, schema)
