"""Suffix-array dedup of repeated byte strings across all documents (operator 2).

Removes every byte that a ``LENGTH``-byte string covers which also starts earlier: in a document of smaller
doc_id, or earlier in the same one.  Strings are judged on the input.

1. Anchors.  The anchor of a 100-byte window is the least hash of the ``GRAM``-byte grams in it, so equal
   windows have equal anchors.  Each shard (a few MB of documents) sends its distinct anchors to
   hash buckets; what occurs once in the corpus cannot belong to a repeated window.  Only windows whose
   anchor occurs again are looked at further.  This leaves out most text, and never a repeated window.
2. Shard suffix arrays.  The shard's remaining text is suffix-sorted (Larsson-Sadakane), Kasai common prefixes of
   ``LENGTH`` bytes and more tell which windows are equal; all but the first of the shard are marked.  So a
   text that lies in a shard a thousand times leaves it once.
3. Merge.  The first windows go, as short pieces of text, to the bucket of their anchor.  There equal
   pieces are folded, and what is left is cut into runs in document order; a run is suffix-sorted, and
   each of its windows is looked up by binary search in the sorted windows of the runs before.  What is found
   there is marked, the rest joins them.  An anchor that lies at ``HOT_PLACES`` places or more (a common line with another
   text around it each time; places alike in one shard count once) sends no pieces: each of its windows goes by itself, as
   a 128-bit hash, to the bucket of that hash, where all but the first of equal ones are marked.  So one bucket never has to hold all of an anchor.
4. The marks return to the shards, which cut the texts.

Documents are shuffled once, by shard; steps 1, 2 and 4 read that same exchange.

Nulls: a null text is empty; a null doc_id comes before all others.  Rows with equal doc_id follow each other by a
hash of their text, identical rows in any order (they are the same), so the later ones lose what repeats.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .suffix import common_prefixes, suffix_array
from .tables import read, text_bytes

LENGTH = 100
GRAM = 24
SHARD_BYTES = 3 << 20
#: Anchors and pieces are about one for each 39 and one for each 10 bytes of text.
BUCKET_BYTES = 24 << 20
MERGE_BYTES = 4 << 20
RUN_BYTES = 1 << 20
HOT_PLACES = 4096
_DEPTH = 128
_HOT = np.uint64(1 << 63)


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place (the last ones end beyond the array and are left out)."""
    eight = tx.eight_bytes(raw)
    grams = max(0, len(raw) - GRAM + 1)
    h = eight[:grams] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += eight[8:8 + grams]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += eight[16:16 + grams]
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of every ``width`` consecutive values."""
    out, so_far = values, 1
    while 2 * so_far <= width:
        out = best(out[:-so_far], out[so_far:])
        so_far *= 2
    more = width - so_far
    return best(out[:len(out) - more], out[more:]) if more else out


def window_anchors(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of the window at every place, whether a window of LENGTH bytes begins there, and all gram hashes."""
    n = len(raw)
    left = np.repeat(offs[1:], np.diff(offs)) - np.arange(n)
    valid = left >= LENGTH
    out = np.zeros(n, np.uint64)
    if n < LENGTH:
        return out, valid, np.zeros(0, np.uint64)
    h = _gram_hashes(raw)
    least = _sliding(h, LENGTH - GRAM + 1, np.minimum)
    out[:len(least)] = least
    return out, valid, h


def _runs(mask: np.ndarray, key: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True (of one key)."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, finishes = mask.copy(), mask.copy()
    joined = mask[1:] & mask[:-1]
    if key is not None:
        joined &= key[1:] == key[:-1]
    begins[1:] &= ~joined
    finishes[:-1] &= ~joined
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


class Shard:
    """A shard's documents in order, as one byte array."""

    def __init__(self, table: pa.Table):
        doc = table.column("doc").to_numpy()
        print_ = table.column("print").to_numpy()
        by = np.lexsort((print_, doc))
        texts = table.column("text").take(pa.array(by))
        self.raw, self.offs = tx.buffers(texts)
        self.table, self.by, self.doc = table, by, doc[by]
        # Rows alike in doc and print get running numbers in the print's low bits.
        p = print_[by]
        new = np.ones(len(by), bool)
        new[1:] = (self.doc[1:] != self.doc[:-1]) | (p[1:] != p[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0)) if len(by) else np.zeros(0, np.int64)
        self.sub = ((p >> 20) << 20) + (np.arange(len(by)) - first)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors of the shard's windows, whether each lies at several places, and with how many texts around it.

        A gram is an anchor's place if it is the least of some window; in repetitive text a window, and
        a run of windows with one anchor, may hold several places of it.
        """
        anchor, valid, h = window_anchors(self.raw, self.offs)
        if not valid.any():
            return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
        width = LENGTH - GRAM + 1
        padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(valid, anchor, np.uint64(0))[:len(h)]])
        place = np.flatnonzero(h == _sliding(padded, width, np.maximum))
        value, of, count = np.unique(h[place], return_inverse=True, return_counts=True)
        texts = np.ones(len(value), np.int64)
        several = np.flatnonzero(count[of] > 1)
        if len(several):
            at = place[several]
            around = np.zeros(len(at), np.uint64)
            for k in (GRAM - LENGTH, -2 * GRAM, -GRAM, GRAM, 2 * GRAM, LENGTH - GRAM):
                around = tx.mix(around + h[np.clip(at + k, 0, len(h) - 1)])
            by = np.lexsort((around, of[several]))
            kind, around = of[several][by], around[by]
            new = np.ones(len(by), bool)
            new[1:] = (kind[1:] != kind[:-1]) | (around[1:] != around[:-1])
            texts = np.maximum(texts, np.bincount(kind[new], minlength=len(value)))
        return value, count > 1, texts


def _packed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return (tx.mix(anchors) % np.uint64(buckets)).astype(np.int64)


def shard_anchor_table(table: pa.Table, buckets: int) -> pa.Table:
    shard = Shard(table)
    value, twice, texts = shard.anchors()
    value = (value & ~np.uint64(1)) | twice.astype(np.uint64)  # the lowest bit tells of a second occurrence
    bucket = _bucket(value >> np.uint64(1), buckets)
    by = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[by], np.arange(buckets + 1))
    s = table.column("shard")[0].as_py()
    rows = []
    for b in np.unique(bucket).tolist():
        k = by[edge[b]:edge[b + 1]]
        rows.append((b, s, value[k].tobytes(), texts[k][twice[k]].astype("<i4").tobytes()))  # one text where not twice
    return _packed(rows, ["bucket", "shard", "anchors", "texts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])


def repeated_anchors(table: pa.Table, hot_places: int = HOT_PLACES) -> pa.Table:
    """Of one bucket's anchors from all shards, those that occur again, back to each shard that has them.

    The highest bit tells of a hot one.
    """
    shards = table.column("shard").to_numpy()
    raw, offs = tx.buffers(table.column("anchors"))
    value = np.frombuffer(raw.tobytes(), "<u8")
    owner = np.repeat(np.arange(len(shards)), np.diff(offs) // 8)
    key, twice = value >> np.uint64(1), (value & np.uint64(1)).astype(bool)
    kinds, of, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count > 1
    again[of[twice]] = True
    texts = np.ones(len(key), np.int64)
    texts[twice] = _longs(table.column("texts"), "<i4")
    hot = np.bincount(of, texts, len(kinds)) >= hot_places
    keep = again[of]
    owner, key = owner[keep], np.where(hot[of], key | _HOT, key)[keep]
    by = np.argsort(owner, kind="stable")
    edge = np.searchsorted(owner[by], np.arange(len(shards) + 1))
    rows = [(int(shards[k]), key[by[edge[k]:edge[k + 1]]].tobytes()) for k in np.unique(owner).tolist()]
    return _packed(rows, ["shard", "anchors"], [pa.int64(), pa.binary()])


def sorted_windows(raw: np.ndarray) -> np.ndarray:
    """A number for the LENGTH-byte string at every place: equal strings have equal numbers, in the strings' order.

    Neighbours that differ within the last sorted length below LENGTH are apart, those alike in the whole depth are the
    same; only for the others does the common prefix decide.
    """
    opened: dict[int, np.ndarray] = {}
    order, _ = suffix_array(tx.eight_bytes(raw), 8, _DEPTH, opened)
    apart = opened[max(k for k in opened if k <= LENGTH)].copy()
    if max(opened) > LENGTH:
        open_ = opened[max(opened)] & ~apart
        if open_.any():
            apart |= open_ & (common_prefixes(raw, order, _DEPTH, wanted=open_) < LENGTH)
    number = np.empty(len(raw), np.int64)
    number[order] = np.cumsum(apart)
    return number


PIECES = ["bucket", "shard", "anchor", "doc", "sub", "start", "windows", "size", "text", "key"]
_PIECE_KINDS = [pa.int64(), pa.int64()] + [pa.binary()] * 8
MARKS = ["shard", "doc", "sub", "begin", "end"]
_MARK_KINDS = [pa.int64()] + [pa.binary()] * 4


def shard_pieces(table: pa.Table, repeated: pa.Table, merge_buckets: int) -> pa.Table:
    """Step 2: marks of the shard (in a row without text) and the pieces for the merge, by bucket."""
    names, kinds = PIECES, _PIECE_KINDS
    shard = Shard(table)
    blob, _ = tx.buffers(repeated.column("anchors")) if repeated.num_rows else (np.zeros(0, np.uint8), None)
    known = np.frombuffer(blob.tobytes(), "<u8")
    hot, known = np.unique(known[known >= _HOT] ^ _HOT), np.unique(known & ~_HOT)
    anchor, valid, _ = window_anchors(shard.raw, shard.offs)
    begin, end = _runs(valid, anchor)
    again = _among(anchor[begin] >> np.uint64(1), known)
    begin, end = begin[again], end[again]
    if not len(begin):
        return _packed([], names, kinds)
    # The remaining text: all bytes of the windows that may repeat.
    step = np.zeros(len(shard.raw) + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, end - 1 + LENGTH, -1)
    source = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    number = sorted_windows(shard.raw[source])
    owner, inside = tx.ragged(end - begin)
    window = begin[owner] + inside                     # places of the windows, in document order
    here = number[np.searchsorted(source, window)]
    _, first = np.unique(here, return_index=True)
    repeat = np.ones(len(window), bool)
    repeat[first] = False

    s = table.column("shard")[0].as_py()
    rows = []
    marked = np.zeros(len(shard.raw), bool)
    marked[window[repeat]] = True
    lo, hi = _runs(marked, _doc_numbers(shard))
    d = np.searchsorted(shard.offs, lo, side="right") - 1
    rows.append((s % merge_buckets, s, b"", shard.doc[d].tobytes(), shard.sub[d].tobytes(), (lo - shard.offs[d]).tobytes(),
                 (hi - 1 + LENGTH - shard.offs[d]).tobytes(), b"", None, None))
    # Pieces: runs of first windows of one anchor.
    fresh = np.zeros(len(shard.raw), bool)
    fresh[window[~repeat]] = True
    hot_run = _among(anchor[begin] >> np.uint64(1), hot)
    if hot_run.any():
        alone = np.zeros(len(shard.raw), bool)
        owner, inside = tx.ragged((end - begin)[hot_run])
        alone[begin[hot_run][owner] + inside] = True
        rows += _hot_rows(shard, s, np.flatnonzero(fresh & alone), merge_buckets)
        fresh &= ~alone
    lo, hi = _runs(fresh, anchor)
    # Runs of one anchor never join two documents: a document's last LENGTH - 1 places begin no window.
    d = np.searchsorted(shard.offs, lo, side="right") - 1
    bucket = _bucket(anchor[lo] >> np.uint64(1), merge_buckets)
    by = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[by], np.arange(merge_buckets + 1))
    size = hi - lo + LENGTH - 1
    for b in np.unique(bucket).tolist():
        k = by[edge[b]:edge[b + 1]]
        owner, inside = tx.ragged(size[k])
        rows.append((b, s, anchor[lo[k]].tobytes(), shard.doc[d[k]].tobytes(), shard.sub[d[k]].tobytes(),
                     (lo[k] - shard.offs[d[k]]).tobytes(), (hi - lo)[k].tobytes(), size[k].tobytes(),
                     shard.raw[lo[k][owner] + inside].tobytes(), None))
    return _packed(rows, names, kinds)


def _window_keys(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """128-bit hash (two columns) of the LENGTH bytes at each place."""
    eight = tx.eight_bytes(raw)
    out = np.zeros((len(place), 2), np.uint64)
    for k in list(range(0, LENGTH - 7, 8)) + ([LENGTH - 8] if LENGTH % 8 else []):
        part = eight[place + k]
        out[:, 0] = tx.mix(out[:, 0] * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(1))
        out[:, 1] = tx.mix((out[:, 1] ^ part) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(2))
    return out


def _hot_rows(shard: Shard, s: int, place: np.ndarray, merge_buckets: int) -> list[tuple]:
    """Windows of hot anchors, each to the bucket of its hash; these buckets follow those of the pieces."""
    if not len(place):
        return []
    key = _window_keys(shard.raw, place)
    d = np.searchsorted(shard.offs, place, side="right") - 1
    bucket = _bucket(key[:, 0], merge_buckets)
    by = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[by], np.arange(merge_buckets + 1))
    rows = []
    for b in np.unique(bucket).tolist():
        k = by[edge[b]:edge[b + 1]]
        rows.append((merge_buckets + b, s, None, shard.doc[d[k]].tobytes(), shard.sub[d[k]].tobytes(),
                     (place[k] - shard.offs[d[k]]).tobytes(), None, None, None, key[k].tobytes()))
    return rows


def merge_hot(table: pa.Table) -> list[tuple]:
    """Marks of all but the first of equal windows, in rows of MARKS."""
    shards = table.column("shard").to_numpy()
    key = _longs(table.column("key"), "<u8").reshape(-1, 2)
    doc, sub, start = (_longs(table.column(c)) for c in ("doc", "sub", "start"))
    shard = np.repeat(shards, [len(x.as_py()) // 8 for x in table.column("start")])
    by = np.lexsort((start, sub, doc, key[:, 1], key[:, 0]))
    gone = by[1:][(key[by][1:] == key[by][:-1]).all(axis=1)]
    gone = gone[np.lexsort((start[gone], sub[gone], doc[gone], shard[gone]))]
    if not len(gone):
        return []
    # Windows that follow each other become one mark.
    new = np.ones(len(gone), bool)
    for column, step in ((shard, 0), (doc, 0), (sub, 0), (start, 1)):
        new[1:] &= column[gone][1:] == column[gone][:-1] + step
    new[1:] = ~new[1:]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(gone)) - 1
    a, b = gone[first], gone[last]
    rows = []
    for k in np.split(np.arange(len(a)), np.flatnonzero(np.diff(shard[a])) + 1):
        rows.append((int(shard[a[k[0]]]), doc[a[k]].tobytes(), sub[a[k]].tobytes(), start[a[k]].tobytes(),
                     (start[b[k]] + LENGTH).tobytes()))
    return rows


def _doc_numbers(shard: Shard) -> np.ndarray:
    return np.repeat(np.arange(len(shard.doc)), np.diff(shard.offs))


def _longs(column, kind="<i8") -> np.ndarray:
    raw, _ = tx.buffers(column)
    return np.frombuffer(raw.tobytes(), kind)


class Windows:
    """Sorted distinct windows (anchor, then text) of the runs so far; looked up by binary search."""

    def __init__(self, raw: np.ndarray):
        self.eight = np.concatenate([tx.eight_bytes(raw), np.zeros(LENGTH, np.uint64)])
        self.anchor, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0, 1 for the windows at a against those at b."""
        out = np.zeros(len(a), np.int8)
        live = np.arange(len(a))
        for k in list(range(0, LENGTH - 7, 8)) + ([LENGTH - 8] if LENGTH % 8 else []):
            x, y = self.eight[a[live] + k], self.eight[b[live] + k]
            out[live] = np.where(x < y, -1, np.where(x > y, 1, 0))
            live = live[x == y]
            if not len(live):
                break
        return out

    def find(self, anchor: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each window is here, and where it belongs."""
        low = np.searchsorted(self.anchor, anchor, side="left")
        high = np.searchsorted(self.anchor, anchor, side="right")
        found = np.zeros(len(anchor), bool)
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            side = self.order(place[live], self.place[mid])
            found[live[side == 0]] = True
            low[live] = np.where(side > 0, mid + 1, low[live])
            high[live] = np.where(side > 0, high[live], mid)
            live = live[(low[live] < high[live]) & ~found[live]]
        return found, low

    def insert(self, at: np.ndarray, anchor: np.ndarray, place: np.ndarray) -> None:
        self.anchor, self.place = np.insert(self.anchor, at, anchor), np.insert(self.place, at, place)


def merge_bucket(table: pa.Table, run_bytes: int = RUN_BYTES) -> pa.Table:
    """Step 3: marks of one bucket's pieces, and the shards' own marks passed on."""
    hot = pc.is_valid(table.column("key"))
    rows = merge_hot(table.filter(hot)) if pc.any(hot).as_py() else []
    table = table.filter(pc.invert(hot))
    own = table.filter(pc.is_null(table.column("text")))
    for r in own.to_pylist():
        rows.append((r["shard"], r["doc"], r["sub"], r["start"], r["windows"]))
    table = table.filter(pc.is_valid(table.column("text")))
    if table.num_rows:
        counts = np.array([len(x.as_py()) // 8 for x in table.column("anchor")])
        shard = np.repeat(table.column("shard").to_numpy(), counts)
        anchor, doc, sub = _longs(table.column("anchor"), "<u8"), _longs(table.column("doc")), _longs(table.column("sub"))
        start, windows, size = (_longs(table.column(c)) for c in ("start", "windows", "size"))
        raw, _ = tx.buffers(table.column("text"))
        at = np.cumsum(size) - size
        print_ = tx.span_hashes(raw, at, at + size)
        # Equal pieces: the first stands for all, the others repeat as a whole.
        by = np.lexsort((start, sub, doc, print_, anchor))
        same = np.zeros(len(by), bool)
        same[1:] = (anchor[by][1:] == anchor[by][:-1]) & (print_[by][1:] == print_[by][:-1]) & (size[by][1:] == size[by][:-1])
        gone = by[same]
        marks = [(gone, np.zeros(len(gone), np.int64), windows[gone])]
        rest = by[~same]
        kinds, of, n = np.unique(anchor[rest], return_inverse=True, return_counts=True)
        rest = rest[n[of] > 1]                          # several texts with one anchor: compare their windows
        rest = rest[np.lexsort((start[rest], sub[rest], doc[rest]))]
        if len(rest):
            owner, inside = tx.ragged(size[rest])
            text = raw[at[rest][owner] + inside]
            place = np.cumsum(size[rest]) - size[rest]
            so_far = Windows(text)
            run = place // run_bytes
            for k in np.unique(run).tolist():
                some = np.flatnonzero(run == k)
                lo, hi = place[some[0]], place[some[-1]] + size[rest[some[-1]]]
                number = sorted_windows(text[lo:hi])
                piece, inside = tx.ragged(windows[rest[some]])
                piece = some[piece]
                where = place[piece] + inside
                label = anchor[rest[piece]]
                by = np.lexsort((np.arange(len(where)), number[where - lo], label))
                new = np.ones(len(by), bool)
                new[1:] = (label[by][1:] != label[by][:-1]) | (number[where[by] - lo][1:] != number[where[by] - lo][:-1])
                first = by[new]
                found, belongs = so_far.find(label[first], where[first])
                so_far.insert(belongs[~found], label[first][~found], where[first][~found])
                again = np.ones(len(where), bool)
                again[first[~found]] = False
                a, b = _runs(again, piece)
                marks.append((rest[piece[a]], inside[a], inside[b - 1] + 1))
        piece = np.concatenate([m[0] for m in marks])
        begin = start[piece] + np.concatenate([m[1] for m in marks])
        end = start[piece] + np.concatenate([m[2] for m in marks]) - 1 + LENGTH
        by = np.argsort(shard[piece], kind="stable")
        edge = np.flatnonzero(np.diff(shard[piece[by]], prepend=-1))
        for k in np.split(by, edge[1:]) if len(by) else []:
            p = piece[k]
            rows.append((int(shard[p[0]]), doc[p].tobytes(), sub[p].tobytes(), begin[k].tobytes(), end[k].tobytes()))
    return _packed(rows, MARKS, _MARK_KINDS)


def cut_texts(table: pa.Table, marks: pa.Table, with_text: bool) -> pa.Table:
    """Step 4: the shard's documents without the marked bytes."""
    shard = Shard(table)
    step = np.zeros(len(shard.raw) + 1, np.int64)
    if marks.num_rows:
        doc, sub, begin, end = (_longs(marks.column(c)) for c in MARKS[1:])
        key = {k: i for i, k in enumerate(zip(shard.doc.tolist(), shard.sub.tolist()))}
        at = shard.offs[np.array([key[k] for k in zip(doc.tolist(), sub.tolist())], np.int64)] if len(doc) else np.zeros(0, np.int64)
        np.add.at(step, at + begin, 1)
        np.add.at(step, at + end, -1)
    gone = np.cumsum(step[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(gone)])
    first, _ = _runs(gone, _doc_numbers(shard))
    removed = total[shard.offs[1:]] - total[shard.offs[:-1]]
    spans = np.searchsorted(first, shard.offs[1:]) - np.searchsorted(first, shard.offs[:-1])
    prints, texts = [], []
    for a, b, r in zip(shard.offs[:-1].tolist(), shard.offs[1:].tolist(), removed.tolist()):
        kept = (shard.raw[a:b] if not r else shard.raw[a:b][~gone[a:b]]).tobytes()
        prints.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            texts.append(kept)
    out = {"doc_id": table.column("doc_id").take(pa.array(shard.by)).cast(pa.int64()), "n_bytes": pa.array(np.diff(shard.offs)),
           "n_removed": pa.array(removed), "n_spans": pa.array(spans), "kept_sha256": pa.array(prints, pa.string())}
    if with_text:
        out["kept"] = pa.array(texts, pa.binary())
    return pa.table(out)


def without_repeats(docs: DataFrame, with_text: bool = True, shard_bytes: int = SHARD_BYTES,
                    bucket_bytes: int = BUCKET_BYTES, merge_bytes: int = MERGE_BYTES, hot_places: int = HOT_PLACES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (``with_text``) kept: the bytes left, for each row."""
    total = text_bytes(docs)
    shards = max(1, -(-total // shard_bytes))
    buckets, merge_buckets = max(1, -(-total // bucket_bytes)), max(1, -(-total // merge_bytes))
    value = F.coalesce("text", F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("text"),
                         F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("doc"),
                         F.xxhash64(value).alias("print"))
    source = source.withColumn("shard", F.pmod(F.xxhash64("doc", "print"), F.lit(shards))).repartition("shard")
    anchors = source.groupBy("shard").applyInArrow(lambda t: shard_anchor_table(t, buckets), "bucket long, shard long, anchors binary, texts binary")
    repeated = anchors.groupBy("bucket").applyInArrow(lambda t: repeated_anchors(t, hot_places), "shard long, anchors binary")
    pieces = source.groupBy("shard").cogroup(repeated.groupBy("shard")).applyInArrow(
        lambda t, r: shard_pieces(t, r, merge_buckets) if t.num_rows else _packed([], PIECES, _PIECE_KINDS),
        "bucket long, shard long, anchor binary, doc binary, sub binary, start binary, windows binary, size binary, text binary, key binary")
    marks = pieces.groupBy("bucket").applyInArrow(lambda t: merge_bucket(t), "shard long, doc binary, sub binary, begin binary, end binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return source.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(
        lambda t, m: cut_texts(t, m, with_text), schema)


def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)


def brute_force(texts: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256) by a set of all strings seen; for tests (unique doc_ids)."""
    seen: set[bytes] = set()
    out = {}
    for doc, value in sorted(texts, key=lambda x: x[0]):
        data = (value or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - LENGTH + 1):
            piece = data[k:k + LENGTH]
            if piece in seen:
                gone[k:k + LENGTH] = b"\1" * LENGTH
            else:
                seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
