"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A pre-token is halved until single bytes are left; two encoded neighbours are joined by re-encoding a window
of tokens around their border. The window grows until the tokens outside provably stay: a sequence of tokens
is the BPE encoding of its bytes exactly if every pair of neighbours in it is the encoding of that pair's own
bytes, so only the two pairs at the window's edges have to be looked at. Encodings of successive pre-tokens
are joined by concatenation. Decoding concatenates token bytes up a tree of blocks.

Null text is an empty one; rows are independent, so ties, repeats and other columns need no care.
"""

from __future__ import annotations

import base64
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import map_batches, plain_text, text_steps, vocabulary

#: Entries that a worker's memories hold before they start anew (results stay the same).
REMEMBERED = 300_000
#: Longest byte string whose encoding is remembered inside the tree.
SHORT = 12
#: Bytes from which a window is encoded with a heap.
LONG = 48


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class TreeCodec:
    """Encoder and decoder over ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.fits: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, tuple[int, ...]] = {}
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}

    def _window(self, raw: bytes) -> list[int]:
        """Encode a window by merging its lowest-ranked pair, leftmost on ties, until none is left."""
        if len(raw) > LONG:
            return self._long_window(raw)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        rank = self.ranks.get
        while len(parts) > 1:
            low, at = None, 0
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (low is None or r < low):
                    low, at = r, i
            if low is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _long_window(self, raw: bytes) -> list[int]:
        """The same with a heap of pairs: n log n steps."""
        n, rank = len(raw), self.ranks.get
        part: list[bytes | None] = [raw[i : i + 1] for i in range(n)]
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, raw[i : i + 2]) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i] if part[i] is not None else -1
            if j < 0 or part[i] + part[j] != pair:
                continue
            part[i], part[j] = pair, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank(pair + part[k])) is not None:
                    heappush(heap, (r, i, pair + part[k]))
            if (h := before[i]) >= 0 and (r := rank(part[h] + pair)) is not None:
                heappush(heap, (r, h, part[h] + pair))
        return [self.ranks[p] for p in part if p is not None]

    def _fit(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart when their bytes are encoded together."""
        found = self.fits.get((a, b))
        if found is None:
            found = self.fits[a, b] = self._window(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of left's and right's bytes together."""
        if not left or not right:
            return left + right
        if self._fit(left[-1], right[0]):
            return left + right
        i, j, step = len(left) - 1, 1, 1
        while True:
            middle = self._window(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))
            ok_left = i == 0 or self._fit(left[i - 1], middle[0])
            ok_right = j == len(right) or self._fit(middle[-1], right[j])
            if ok_left and ok_right:
                return left[:i] + tuple(middle) + right[j:]
            step *= 2
            if not ok_left:
                i = max(0, i - step)
            if not ok_right:
                j = min(len(right), j + step)

    def _tree(self, raw: bytes) -> tuple[int, ...]:
        if len(raw) <= SHORT and (found := self.short.get(raw)) is not None:
            return found
        if len(raw) == 1:
            out: tuple[int, ...] = (self.ranks[raw],)
        else:
            half = len(raw) // 2
            out = self.join(self._tree(raw[:half]), self._tree(raw[half:]))
        if len(raw) <= SHORT:
            self.short[raw] = out
        return out

    def encode_piece(self, raw: bytes) -> tuple[int, ...]:
        """The ids of one pre-token."""
        rank = self.ranks.get(raw)
        return (rank,) if rank is not None else self._tree(raw)

    def _piece(self, piece: str) -> tuple[tuple[int, ...], str]:
        ids = self.encode_piece(piece.encode())
        return ids, " ".join(map(str, ids))

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a text, and the same as decimals joined by one space."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for memory in (self.short, self.fits):
            if len(memory) > 2 * REMEMBERED:
                memory.clear()
        found = []
        for piece in self.pattern.findall(text):
            hit = known.get(piece)
            if hit is None:
                hit = known[piece] = self._piece(piece)
            found.append(hit)
        return list(chain.from_iterable([x[0] for x in found])), " ".join([x[1] for x in found])

    def decode(self, ids: list[int], block: int = 4096) -> bytes:
        """The bytes of ids: blocks of tokens, then neighbours pairwise up the tree."""
        get = self.bytes_of.__getitem__
        level = [b"".join(map(get, ids[i : i + block])) for i in range(0, len(ids), block)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


_codecs: dict[str, TreeCodec] = {}


def codec(ranks_file: str = "byte_bpe_50k.tiktoken") -> TreeCodec:
    import public_tokenizers

    if ranks_file not in _codecs:
        _codecs[ranks_file] = TreeCodec(load_ranks(vocabulary(ranks_file)), public_tokenizers.PATTERN)
    return _codecs[ranks_file]


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks_file: str = "byte_bpe_50k.tiktoken", digests: bool = False) -> DataFrame:
    """Per row: id, n_tokens, and ids array<int> and decoded binary, or with digests only their SHA-256."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = codec(ranks_file)
        for part, _ in text_steps(batches):
            n, first, second = [], [], []
            for text in part.column(1).to_pylist():
                ids, decimals = c.encode(text)
                raw = c.decode(ids)
                n.append(len(ids))
                first.append(sha256(decimals.encode()).hexdigest() if digests else ids)
                second.append(sha256(raw).hexdigest() if digests else raw)
            types = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(first, types[0]), pa.array(second, types[1])], names)

    names = [id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    kinds = ("string", "string") if digests else ("array<int>", "binary")
    rows = docs.select(docs[id_col], plain_text(text_col).alias("text"))
    return map_batches(rows, run, f"`{id_col}` {id_type}, n_tokens long, {names[2]} {kinds[0]}, {names[3]} {kinds[1]}")
