"""Cross-tokenizer alignment: two tokenizers' tokens over the same bytes, by segment deduplication.

A is a byte-level BPE (a tokenizers .json), B a piece model with byte fallback (a sentencepiece .model) that puts a
space before its text; both are held against the bytes of space + text. Texts are cut before runs of white space,
only at characters where neither vocabulary can merge across (`Pair` reads this off the vocabularies). So a text's
tokens are its segments' tokens end to end, and each segment border is a border of both.

1. Tasks cut their documents into chunks of about CHUNK_BYTES and write, per chunk, its distinct segments with their
   uses and each document as numbers of segments. The table is stored, so chunks stay as they are when tasks rerun.
2. Segments are made distinct over the corpus, tokenised and aligned once.
3. How often an id pair is linked is summed over distinct segments times uses; each B id's highest count follows.
4. Each segment's sums of these counts go back to the chunks that use it, and documents are composed chunk by chunk,
   one half of the chunks after the other, so that no more than about half of these rows is in a shuffle at a time.
   A group of m and n tokens, which share no inner border, has m + n - 1 links, so the groups' text tells the rest.

A chunk holds CHUNK_BYTES or one longer document, so no task holds more than that and its segments' alignments; a
frequent segment occurs once per chunk, whatever its uses, and the join by segments may split it further.

Null and empty texts, and texts that one tokenizer doesn't give back byte for byte (for B: with a U+2581), have no
tokens: zeros and ''. Repeated rows and null ids are rows of their own; their texts count as often as they occur.
A B id whose highest count is shared has several best pairs. An empty table gives no rows. Columns other than the id
and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import discard, map_batches, materialise, plain_text, text_steps, vocabulary
from .token_counts import byte_letters

#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 16 << 20
#: Portions of the chunks that are composed one after the other.
PORTIONS = 2
#: Linked id pairs whose counts a task may hold as arrays (20 bytes each); beyond it they are joined by a shuffle.
PAIRS_HELD = 4_000_000
#: Segments that are tokenised together, in number and characters.
TOGETHER, TOGETHER_CHARS = 5_000, 1 << 20
#: White space before which texts may be cut, if the vocabularies allow.
CUTS = " \t\n\r\v\f"


class Pair:
    """Two tokenizers, the bytes of their ids, and where texts can be cut."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(vocabulary(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(b))
        letters = byte_letters()
        entries = self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        in_bytes = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if raw else p.replace("▁", " ").encode() for p, raw in zip(pieces, in_bytes)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.space = self.b.piece_to_id("▁")

        model = spec.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        normal = model.normalizer_spec
        #: B changes nothing but spaces to U+2581 and puts one in front
        self.faithful = not normal.precompiled_charsmap and not normal.remove_extra_whitespaces and normal.add_dummy_prefix
        with open(vocabulary(a), encoding="utf-8") as f:
            before = json.load(f)["pre_tokenizer"] or {}
        by_pattern = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        merged = [p for p, raw in zip(pieces, in_bytes) if not raw]
        self.cuts = "".join(c for c in CUTS if self.faithful and by_pattern and self._no_piece_across(c, merged))
        other = re.escape(self.cuts)
        whole = r"\s*\S+(?:[^\S%s]\s*(?:\S+|\Z))*|\s+" % other if self.cuts else r"(?s:.+)"
        self.segments = re.compile(whole).findall

    def _no_piece_across(self, c: str, pieces: list[str]) -> bool:
        """No entry of A or B joins c to a character before it that is not white space, nor B's first space to c."""
        in_b = c if c != " " else "▁"
        joined = re.compile(r"[^\s▁]" + re.escape(in_b))
        after_space = "▁" + in_b
        return (
            not any(joined.search(p) for p in pieces)
            and (c == " " or not any(after_space in p for p in pieces))
            and not any(re.search(r"\S" + re.escape(c), x.decode(errors="replace")) for x in self.a_bytes)
        )

    def alike(self, text: str) -> bool:
        """Both tokenizers give space + text back."""
        if not text:
            return False
        if self.faithful:
            return "▁" not in text
        return b"".join(self.b_bytes[i] for i in self.b.encode(text)) == (" " + text).encode()

    def a_ids(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]

    def b_ids(self, segments: list[str]) -> list[list[int]]:
        """As the ids of each segment within a text; B's own space is the segment's, or is taken away."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for i, s in enumerate(segments):
            if s == " ":
                found[i] = [self.space]
            elif s[0] != " ":
                if found[i][0] != self.space:
                    raise ValueError(f"the piece model joins its first space to {s[0]!r}")
                del found[i][0]
        return found

    def align(self, segments: list[str]) -> dict[str, list | np.ndarray]:
        """Per segment: the groups as text, and the linked ids."""
        a_lists, b_lists = self.a_ids(segments), self.b_ids(segments)
        n_a, n_b = np.fromiter(map(len, a_lists), np.int64, len(segments)), np.fromiter(map(len, b_lists), np.int64, len(segments))
        a = np.fromiter((i for x in a_lists for i in x), np.int64, n_a.sum())
        b = np.fromiter((i for x in b_lists for i in x), np.int64, n_b.sum())
        raw = "".join(segments).encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw:
            raise ValueError("a segment's tokens don't give its bytes")
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_start, b_start = a_end - self.a_sizes[a], b_end - self.b_sizes[b]
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_last, b_last = np.cumsum(n_a), np.cumsum(n_b)
        last_group = a_group[a_last - 1] + 1
        n_groups = np.diff(np.r_[0, last_group])

        low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        each = high - low
        linked_a = np.repeat(a, each)
        linked_b = b[np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)]
        link_end = np.cumsum(each)[a_last - 1]

        a_cut, b_cut = np.flatnonzero(np.diff(a_group)) + 1, np.flatnonzero(np.diff(b_group)) + 1
        texts_a, texts_b = _joined(a, a_cut), _joined(b, b_cut)
        groups = iter([f"{x}|{y}" for x, y in zip(texts_a, texts_b)])
        return {
            "groups": [";".join(islice(groups, n)) for n in n_groups.tolist()],
            "a": pa.ListArray.from_arrays(pa.array(np.r_[0, link_end], pa.int32()), pa.array(linked_a, pa.int32())),
            "b": pa.ListArray.from_arrays(pa.array(np.r_[0, link_end], pa.int32()), pa.array(linked_b, pa.int32())),
        }


def _joined(ids: np.ndarray, cuts: np.ndarray) -> list[str]:
    """The ids between cuts, in decimal, with commas between."""
    text = list(map(str, ids.tolist()))
    edges = [0, *cuts.tolist(), len(text)]
    return [text[s] if e == s + 1 else ",".join(text[s:e]) for s, e in zip(edges, edges[1:])]


def packed(numbers: np.ndarray) -> bytes:
    """Compressed int32 numbers, all their low bytes first."""
    return zstandard.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def group_sizes(groups: list[str]) -> np.ndarray:
    """Rows n_a, n_b, n_groups, n_links of the groups of each segment."""
    text = np.frombuffer(";".join([*groups, ""]).encode(), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, groups), np.int64, len(groups)) + 1)
    bar, semicolon, comma = (text == ord(c) for c in "|;,")
    before_bar = np.cumsum(bar) == np.cumsum(semicolon)
    upto = lambda hit: np.diff(np.r_[0, np.cumsum(hit)[ends - 1]]) if len(ends) else np.zeros(0, np.int64)
    n = upto(semicolon)
    a, b = upto(comma & before_bar) + n, upto(comma & ~before_bar) + n
    return np.stack([a, b, n, a + b - n])


_pairs: dict[tuple[str, str], Pair] = {}


def tokenizer_pair(a: str, b: str) -> Pair:
    if (a, b) not in _pairs:
        _pairs[a, b] = Pair(a, b)
    return _pairs[a, b]


def _chunked(docs: DataFrame, id_col: str, text_col: str, a: str, b: str) -> DataFrame:
    """Rows of documents (id, its segment numbers) and of segments (number, segment, uses) by chunk."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        pair = tokenizer_pair(a, b)
        first = TaskContext.get().partitionId() << 32
        ids, lists, number, uses, held, n = [], [], {}, [], 0, 0
        id_field = None

        def flush():
            k = len(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + n] * len(ids)), pa.array(ids, id_field), pa.array(lists, pa.binary()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.int64())],
                names,
            )
            words, counts = list(number), np.bincount(np.concatenate(uses), minlength=k) if uses else np.zeros(k, np.int64)
            for at in range(0, k, 50_000):
                part = slice(at, min(at + 50_000, k))
                size = part.stop - at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + n] * size), pa.nulls(size, id_field), pa.nulls(size, pa.binary()), pa.array(np.arange(at, part.stop), pa.int32()), pa.array(words[part], pa.string()), pa.array(counts[part], pa.int64())],
                    names,
                )

        for part, _ in text_steps(batches):
            id_field = part.schema.field(0).type
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if ids and held + len(text) > CHUNK_BYTES:
                    yield from flush()
                    ids, lists, number, uses, held, n = [], [], {}, [], 0, n + 1
                found = pair.segments(" " + text) if pair.alike(text) else []
                get = number.setdefault
                at = np.fromiter((get(s, len(number)) for s in found), np.int32, len(found))
                ids.append(key)
                lists.append(packed(at))
                uses.append(at)
                held += len(text)
        if ids:
            yield from flush()

    names = ["chunk", "id", "at", "number", "segment", "uses"]
    rows = docs.select(docs[id_col].alias("id"), plain_text(text_col).alias("text"))
    return map_batches(rows, run, f"chunk long, id {id_type}, at binary, number int, segment string, uses long")


def _aligned(segments: DataFrame, a: str, b: str) -> DataFrame:
    """segments(segment, uses) with a number of its own, groups and linked ids."""

    def run(batches):
        pair = tokenizer_pair(a, b)
        key = TaskContext.get().partitionId() << 40
        for part, _ in text_steps(batches, "segment", TOGETHER_CHARS):
            for at in range(0, part.num_rows, TOGETHER):
                piece = part.slice(at, TOGETHER)
                out = pair.align(piece.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(key, key + piece.num_rows)),
                        piece.column(0),
                        piece.column(1),
                        pa.array(out["groups"], pa.string()),
                        out["a"],
                        out["b"],
                    ],
                    ["key", "segment", "uses", "groups", "a", "b"],
                )
                key += piece.num_rows

    kinds = "key long, segment string, uses long, groups string, a array<int>, b array<int>"
    return map_batches(segments, run, kinds)


def _links(aligned: DataFrame, *more: str) -> DataFrame:
    pairs = aligned.select(*more, F.explode(F.arrays_zip("a", "b")).alias("pair"))
    return pairs.select(*more, F.col("pair.a").alias("a"), F.col("pair.b").alias("b"))


def _pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (links of the corpus), best (1 where no other A id has more links with b)."""
    counts = _links(aligned, "uses").groupBy("a", "b").agg(F.sum("uses").alias("n"))
    return counts.withColumn("best", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).cast("long"))


def _summed(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """segment, groups, n_best, count_sum: sums over each segment's links."""
    if counted.count() > PAIRS_HELD:
        sums = _links(aligned, "key").join(counted, ["a", "b"]).groupBy("key").agg(F.sum("best").alias("n_best"), F.sum("n").alias("count_sum"))
        return aligned.join(sums, "key").select("segment", "groups", "n_best", "count_sum")
    table = counted.select((F.col("a").cast("long") * (1 << 32) + F.col("b")).alias("pair"), "n", "best").toArrow().sort_by("pair")
    held = aligned.sparkSession.sparkContext.broadcast([table.column(k).to_numpy() for k in ("pair", "n", "best")])

    def run(batches):
        pair, n, best = held.value
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            a, b = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
            at = np.searchsorted(pair, a << 32 | b)
            ends = np.cumsum(sizes)
            upto = lambda x: np.diff(np.r_[0, np.cumsum(x)[ends - 1]]) if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(upto(best[at])), pa.array(upto(n[at]))], ["segment", "groups", "n_best", "count_sum"])

    return map_batches(aligned.select("segment", "groups", "a", "b"), run, "segment string, groups string, n_best long, count_sum long")


def id_pairs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """Per linked pair of ids: a, b, n (how many links of all documents hold it), best (1 or 0)."""
    stored = materialise(_chunked(docs, id_col, text_col, a, b), "zstd")
    segments = stored.filter("segment is not null").groupBy("segment").agg(F.sum("uses").alias("uses"))
    return _pair_counts(materialise(_aligned(segments, a, b), "zstd"))


def align_tokens(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    a: str = "byte_bpe_50k.json",
    b: str = "piece_bpe_32k.model",
    digests: bool = False,
) -> DataFrame:
    """One row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, and groups (or groups_sha256 if digests)."""
    stored = materialise(_chunked(docs, id_col, text_col, a, b), "zstd")
    in_chunks = stored.filter("segment is not null")
    aligned = materialise(_aligned(in_chunks.groupBy("segment").agg(F.sum("uses").alias("uses")), a, b), "zstd")
    counted = materialise(_pair_counts(aligned))
    values = materialise(_summed(aligned, counted), "zstd")
    discard(aligned, counted)
    used = in_chunks.select(F.col("chunk").alias("in_chunk"), "number", "segment").join(values, "segment").drop("segment")
    used = materialise(used, "zstd")
    discard(values)
    documents = stored.filter("at is not null").select("chunk", "id", "at")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def compose(rows: pa.Table, segments: pa.Table) -> pa.Table:
        segments = segments.select(["number", "groups", *numbers[4:]]).sort_by("number")
        groups = segments.column("groups").to_pylist()
        # some at a time, as this takes tens of bytes per byte of the groups' text
        sizes = np.concatenate([group_sizes(groups[k : k + 20_000]) for k in range(0, max(len(groups), 1), 20_000)], axis=1)
        table = np.vstack([sizes, *(segments.column(k).to_numpy().astype(np.int64)[None, :] for k in numbers[4:])])
        del segments
        sums, texts = [], []
        for raw in rows.column("at").to_pylist():
            at = unpacked(raw)
            sums.append(table[:, at].sum(axis=1))
            text = ";".join(map(groups.__getitem__, at.tolist()))
            texts.append(hashlib.sha256(text.encode()).hexdigest() if digests and text else text)
        sums = np.array(sums, np.int64).reshape(-1, len(numbers))
        pa.default_memory_pool().release_unused()
        return pa.table([rows.column("id"), *(pa.array(sums[:, k]) for k in range(len(numbers))), pa.array(texts, pa.string())], names=[id_col, *numbers, last])

    last = "groups_sha256" if digests else "groups"
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{k} long" for k in numbers) + f", {last} string"
    portions = []
    for k in range(PORTIONS):  # a chunk's number counts tasks in steps of 1 << 32, so the remainders take turns
        mine, own = (df.filter(F.pmod(c, F.lit(PORTIONS)) == k).groupBy(c) for df, c in ((documents, "chunk"), (used, "in_chunk")))
        portions.append(materialise(mine.cogroup(own).applyInArrow(compose, schema), "zstd"))
    discard(stored, used)
    return reduce(DataFrame.unionAll, portions)
