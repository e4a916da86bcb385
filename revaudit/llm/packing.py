"""Token-ID / binary output: best-fit-decreasing packing of whole documents (operator 1).

Every text is encoded; a document longer than the context is split into full rows and a rest,
nothing is dropped.  The pieces of a window of documents are packed longest first,
each into the row with the least room that still holds it.  That row is found in a segment
tree over capacities: leaf c counts the open rows with room c, and the search goes
to the first non-empty leaf at or above the piece's length in logarithmic time.

A row of the result is one row of the packed id matrix: ``ids`` (``context`` little-endian uint16
or uint32, filled up with ``pad``), ``cu_seqlens`` (0, cumulative segment lengths), ``position_ids``
(uint16 / uint32 like ids; they start again at 0 with each segment), and for each segment the document and
the token at which the piece begins in it, so that every document can be put together again.

Packing happens where the documents lie: a task packs windows of ``window_tokens`` tokens, so there
is no shuffle, memory is bounded, and a lost task is made again alike.  ``shard`` is the input
partition, ``window`` counts in it.

Encoding: see ``Encoder``.

Nulls and empty texts have no tokens and appear in no row.  A null doc_id stays null in ``doc_ids``.  Repeated rows are
packed each.  An empty table gives no rows.  Other input columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import text as tx
from .tables import read

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's splitting rule and first free id; fixed values.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PAD = 50256
CONTEXT = 2048
WINDOW_TOKENS = 1 << 22
PARTS = 300_000

ROWS = ("shard int, window int, row int, n_tokens int, doc_ids array<long>, doc_starts array<long>, "
        "cu_seqlens array<int>, ids binary, position_ids binary")


_WHITE = tx.byte_table([(0x09, 0x0D), (0x20, 0x20)])


class Encoder:
    """Encodes slices of texts; a text's ids are those of encoding it alone.

    The splitting rule never joins a white-space run to what stands before it, so a text may be
    cut where a run begins.  Each distinct part of a slice is encoded once, all new parts
    as one string (token lengths tell the parts apart again), and up to PARTS parts are
    remembered by hash.  The parts' ids are then copied together by numpy.
    """

    def __init__(self, path: str = TOKENIZER):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        self.width[list(ranks.values())] = [len(k) for k in ranks]
        self.known, self.at, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and n + 1 offsets."""
        raw, offs = tx.buffers(column)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        starts = self._parts(raw, offs)
        ends = np.append(starts[1:], len(raw))
        hashes = tx.span_hashes(raw, starts, ends)
        kinds, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, kinds), max(0, len(self.known) - 1))
        have = self.known[place] == kinds if len(self.known) else np.zeros(len(kinds), bool)
        new = np.flatnonzero(~have)
        new_ids, new_at = self._encode_parts(raw, starts[first[new]], ends[first[new]])
        # One table of this slice's parts: remembered ones, then new ones.
        pool = np.concatenate([self.ids, new_ids])
        begin = np.empty(len(kinds), np.int64)
        count = np.empty(len(kinds), np.int64)
        begin[have], count[have] = self.at[place[have]], np.diff(self.at)[place[have]]
        begin[new], count[new] = new_at[:-1] + len(self.ids), np.diff(new_at)
        many = count[of]
        owner, inside = tx.ragged(many)
        ids = pool[begin[of][owner] + inside]
        token_offs = np.concatenate([[0], np.cumsum(many)])[np.searchsorted(starts, offs)]
        sizes = np.concatenate([[0], np.cumsum(self.width[ids])])
        if not np.array_equal(sizes[token_offs], offs):  # two parts with one hash
            texts = [np.array(self.whole(raw[a:b].tobytes().decode()), np.int32) for a, b in zip(offs[:-1], offs[1:])]
            return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self._remember(kinds[new], new_ids, new_at)
        return ids, token_offs

    @staticmethod
    def _parts(raw, offs):
        """Where parts begin: at the texts' starts, and at white space after something else."""
        white = _WHITE[raw]
        begins = np.zeros(len(raw), bool)
        begins[1:] = white[1:] & ~white[:-1]
        # Not after a non-ASCII blank (its first byte is C2, E1, E2 or E3).
        begins[2:] &= raw[:-2] != 0xC2
        begins[3:] &= (raw[:-3] < 0xE1) | (raw[:-3] > 0xE3)
        begins[offs[:-1][offs[:-1] < offs[1:]]] = True
        return np.flatnonzero(begins)

    def _encode_parts(self, raw, starts, ends):
        """Ids of the parts one after the other, and their offsets."""
        plain = _WHITE[raw[starts]] & ~_WHITE[raw[ends - 1]] if len(starts) else np.zeros(0, bool)
        plain &= ends - starts < 256
        # Parts that end in a non-ASCII blank must not meet the next one either.
        plain &= (raw[np.maximum(ends - 2, 0)] != 0xC2) & ((raw[np.maximum(ends - 3, 0)] < 0xE1) | (raw[np.maximum(ends - 3, 0)] > 0xE3))
        size = np.where(plain, ends - starts, 0)
        owner, inside = tx.ragged(size)
        joined = raw[starts[owner] + inside].tobytes().decode() if len(owner) else ""
        ids = np.array(self.whole(joined), np.int32)
        sizes = np.concatenate([[0], np.cumsum(self.width[ids])])
        at = np.searchsorted(sizes, np.concatenate([[0], np.cumsum(size)]))
        if plain.all():
            return ids, at
        count = np.diff(at)
        alone = {k: np.array(self.whole(raw[starts[k]:ends[k]].tobytes().decode()), np.int32) for k in np.flatnonzero(~plain).tolist()}
        count[list(alone)] = [len(v) for v in alone.values()]
        whole_at = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(whole_at[-1], np.int32)
        owner, inside = tx.ragged(np.where(plain, count, 0))
        out[whole_at[owner] + inside] = ids
        for k, v in alone.items():
            out[whole_at[k]:whole_at[k] + len(v)] = v
        return out, whole_at

    def _remember(self, kinds, ids, at):
        room = PARTS - len(self.known)
        if room <= 0 or not len(kinds):
            return
        kinds, at = kinds[:room], at[:room + 1]
        hashes = np.concatenate([self.known, kinds])
        begin = np.concatenate([self.at[:-1], at[:-1] + len(self.ids)])
        count = np.concatenate([np.diff(self.at), np.diff(at)])
        pool = np.concatenate([self.ids, ids[:at[-1]]])
        by = np.argsort(hashes)
        owner, inside = tx.ragged(count[by])
        self.known, self.ids = hashes[by], pool[begin[by][owner] + inside]
        self.at = np.concatenate([[0], np.cumsum(count[by])])


class Rooms:
    """Open rows by the room they have, in a segment tree over 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << max(1, size.bit_length())
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room that is at least ``least``."""
        count, node = self.count, least + self.leaves
        while not count[node]:
            while node & 1:  # a right child: go up until there is a right sibling
                node >>= 1
            if not node:
                return None
            node += 1
            if node == 1 or node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node <<= 1
            if not count[node]:
                node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Row number of each piece (1 <= length <= size), and the number of rows."""
    order = np.argsort(-lengths, kind="stable")
    row_of = np.empty(len(lengths), np.int64)
    full = int(np.searchsorted(-lengths[order], -size, side="right"))
    row_of[order[:full]] = np.arange(full)
    rooms, n_rows = Rooms(size), full
    for piece, length in zip(order[full:].tolist(), lengths[order[full:]].tolist()):
        found = rooms.take(length)
        if found is None:
            room, row = size, n_rows
            n_rows += 1
        else:
            room, row = found
        row_of[piece] = row
        if room > length:
            rooms.add(room - length, row)
    return row_of, n_rows


def pack(doc_ids: list, tokens: list[np.ndarray], size: int, pad: int, shard: int, window: int) -> Iterator[pa.RecordBatch]:
    """ROWS for one window of encoded documents."""
    n = np.array([len(t) for t in tokens], np.int64)
    pieces = -(-n // size)
    doc = np.repeat(np.arange(len(n)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
    length = np.minimum(n[doc] - start, size)
    if not len(length):
        return
    row_of, n_rows = best_fit_decreasing(length, size)
    by = np.argsort(row_of, kind="stable")
    edges = np.searchsorted(row_of[by], np.arange(n_rows + 1))
    kind = np.dtype("<u2") if pad < 1 << 16 and size <= 1 << 16 else np.dtype("<u4")
    for r0 in range(0, n_rows, 512):
        r1 = min(n_rows, r0 + 512)
        part = by[edges[r0]:edges[r1]]
        at = edges[r0:r1 + 1] - edges[r0]
        size_of = length[part]
        begin = np.cumsum(size_of) - size_of
        column = begin - np.repeat(begin[at[:-1]], np.diff(at))   # where a segment begins in its row
        stream = np.concatenate([tokens[d][a:a + n] for d, a, n in zip(doc[part].tolist(), start[part].tolist(), size_of.tolist())]).astype(kind)
        inside = (np.arange(len(stream)) - np.repeat(begin, size_of)).astype(kind)
        ids = np.full((r1 - r0, size), pad, kind)
        places = np.zeros((r1 - r0, size), kind)
        bounds = np.append(begin, len(stream))[at].tolist()
        for r, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])):
            ids[r, :y - x], places[r, :y - x] = stream[x:y], inside[x:y]
        cu = [np.append(column[a:b], column[b - 1] + length[part[b - 1]]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(r1 - r0, shard, np.int32)), pa.array(np.full(r1 - r0, window, np.int32)),
            pa.array(np.arange(r0, r1, dtype=np.int32)), pa.array(np.array([c[-1] for c in cu], np.int32)),
            pa.array([[doc_ids[d] for d in doc[part[a:b]]] for a, b in zip(at[:-1], at[1:])], pa.list_(pa.int64())),
            pa.array([start[part[a:b]] for a, b in zip(at[:-1], at[1:])], pa.list_(pa.int64())),
            pa.array([c.astype(np.int32) for c in cu], pa.list_(pa.int32())),
            pa.array([r.tobytes() for r in ids], pa.binary()), pa.array([r.tobytes() for r in places], pa.binary())],
            names=["shard", "window", "row", "n_tokens", "doc_ids", "doc_starts", "cu_seqlens", "ids", "position_ids"])


def packed_rows(docs: DataFrame, size: int = CONTEXT, tokenizer: str = TOKENIZER, pad: int = PAD,
                window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """ROWS over all rows of ``docs`` (doc_id, text)."""
    def task(batches):
        from pyspark import TaskContext
        shard, encoder = TaskContext.get().partitionId(), Encoder(tokenizer)
        ids, tokens, held, window = [], [], 0, 0
        for batch in batches:
            for part in tx.slices(batch, "text"):
                got, at = encoder.encode(part.column("text"))
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    if a < b:
                        ids.append(doc), tokens.append(got[a:b])
                held += len(got)
                if held >= window_tokens:
                    yield from pack(ids, tokens, size, pad, shard, window)
                    ids, tokens, held, window = [], [], 0, window + 1
        if ids:
            yield from pack(ids, tokens, size, pad, shard, window)

    return docs.select("doc_id", "text").mapInArrow(task, ROWS)


def op1_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(read(spark, sf_dir, "documents"))
