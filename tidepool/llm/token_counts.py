"""Token counts: BPE by rank-synchronous array merging.

Pre-tokens of a step are held as one ragged numpy array of symbols. In each round every sequence finds the
lowest rank among its neighbouring pairs and merges all places of that pair at once; all sequences move in
step. A merge can only create pairs of a higher rank, as the merged symbol was learned before any pair that
holds it, so a round equals the one-at-a-time order. A sequence is done when no pair of it has a rank; its
surviving symbols are its tokens.

A pre-token of over LONG bytes is a sequence of its own: its places are kept in arrays by the rank of their pair,
so a round touches the places of the lowest rank and their neighbours only, and work grows in proportion.

Null and empty texts have no tokens; an empty table has no rows. Ties, repeated rows and null ids need no care:
rows are independent. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import map_batches, plain_text, text_steps, vocabulary

#: Distinct pre-tokens whose counts a worker remembers; beyond it the memory starts anew (counts stay the same).
REMEMBERED = 400_000
NONE = np.int64(1 << 40)
#: Bytes of a pre-token from which it is merged alone.
LONG = 256


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts of tokens for pre-tokens, from a byte_bpe .json file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], np.arange(len(pairs))[order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, pre_tokens: list[bytes]) -> np.ndarray:
        """The number of tokens of each non-empty pre-token."""
        n = len(pre_tokens)
        sizes = np.fromiter(map(len, pre_tokens), np.int64, n)
        symbols = self.byte_id[np.frombuffer(b"".join(pre_tokens), np.uint8)]
        result = sizes.copy()
        seq = np.repeat(np.arange(n), sizes)
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            same = seq[:-1] == seq[1:]
            at = np.flatnonzero(same)
            rank[at] = self._rank(symbols[at], symbols[at + 1])
            first = np.flatnonzero(np.r_[True, ~same])
            low = np.minimum.reduceat(rank, first)
            each = np.repeat(low, np.diff(np.r_[first, len(symbols)]))
            hit = (rank == each) & (each < NONE)
            # of places that overlap (a a a), every second one from the left
            where = np.flatnonzero(hit)
            if len(where):
                new_run = np.r_[True, np.diff(where) != 1]
                start = where[np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))]
                where = where[(where - start) % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = self.merged[rank[where]]
            keep = each < NONE  # sequences without a pair of any rank are done
            keep[where + 1] = False
            done = low >= NONE
            result[seq[first[done]]] = np.diff(np.r_[first, len(symbols)])[done]
            symbols, seq = symbols[keep], seq[keep]
        return result

    def count_long(self, raw: bytes) -> int:
        """The number of tokens of one long pre-token."""
        symbols = self.byte_id[np.frombuffer(raw, np.uint8)]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        now = np.full(n + 1, NONE)  # rank of the pair that begins at a place
        now[: n - 1] = self._rank(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        tokens = n

        def wait(places: np.ndarray):
            places = places[now[places] < NONE]
            places = places[np.argsort(now[places], kind="stable")]
            ranks = now[places]
            for part in np.split(places, np.flatnonzero(np.diff(ranks)) + 1) if len(places) else ():
                rank = int(now[part[0]])
                if rank not in waiting:
                    waiting[rank] = []
                    heappush(queue, rank)
                waiting[rank].append(part)

        wait(np.arange(n))
        while queue:
            rank = heappop(queue)
            parts = waiting.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[now[at] == rank]
            if len(at) > 1:  # of places that overlap (a a a), every second one from the left
                new_run = np.r_[True, after[at[:-1]] != at[1:]]
                start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            following = after[gone]
            symbols[at] = self.merged[rank]
            now[gone] = NONE
            after[at] = following
            inner = following < n
            before[following[inner]] = at[inner]
            left = before[at]
            touched = np.unique(np.r_[at, left[left >= 0]])
            ends = after[touched] >= n
            now[touched[ends]] = NONE
            touched = touched[~ends]
            now[touched] = self._rank(symbols[touched], symbols[after[touched]])
            wait(touched)
            tokens -= len(at)
        return tokens

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text; special strings in a text are one token each."""
        split, extra = [], []
        for text in texts:
            if self.cut is not None and (specials := self.cut.findall(text)):
                split.append([p for part in self.cut.split(text) for p in self.pattern.findall(part)])
                extra.append(len(specials))
            else:
                split.append(self.pattern.findall(text))
                extra.append(0)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({p for pre in split for p in pre} - self.known.keys())
        if new:
            raw = [p.encode() for p in new]
            short = [b for b in raw if len(b) <= LONG]
            n_short = iter(self.count(short).tolist())
            self.known.update((p, next(n_short) if len(b) <= LONG else self.count_long(b)) for p, b in zip(new, raw))
        get = self.known.__getitem__
        return [sum(map(get, pre)) + e for pre, e in zip(split, extra)]


_mergers: dict[str, RankMerger] = {}


def merger(path: str, pattern: str) -> RankMerger:
    if path not in _mergers:
        _mergers[path] = RankMerger(path, pattern)
    return _mergers[path]


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import public_tokenizers

        m = merger(vocabulary(tokenizer), public_tokenizers.PATTERN)
        for part, texts in text_steps(batches):
            n = m.counts(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(texts.offs)), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[id_col], plain_text(text_col).alias("text"))
    return map_batches(rows, run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
