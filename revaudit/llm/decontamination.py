"""Benchmark decontamination by training suffix arrays (operator 9).

A task takes its documents in shards of a few MB.  For a shard it sorts the suffixes of its
word sequence (Larsson-Sadakane refinement, words as symbols) and looks up every test
suffix, one for each word of each item, by binary search: word by word the range of the array
narrows, so it knows the longest verbatim match and all its places.  Suffixes that cannot
begin a match are left out of the array: those whose first words (four, or as many as a
shorter item has) begin no test suffix.  Documents never leave their task: there is no
shuffle and nothing about a document is gathered elsewhere.

A window is ``window`` consecutive words of an item; a shorter item, not an empty one, is one
window.  A document's word inside any occurrence of a window is hit.

The items are the query set, and it is held against all documents in blocks of at most
``block_words`` words; that is what is sent to the tasks at once.  With more than one block each one's
findings are written before the next is fetched, and joined by row.

Nulls: a null text has no words; items with null text or without words take no part; a null
item_id is reported as an empty string.  Items with equal ids count once.  Empty tables: no rows, or
no hits.  Repeated rows and equal doc_ids are judged each for itself.  Other columns of
``docs`` are kept by ``drop_contaminated`` whatever their names; ``find_hits`` returns its own.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .suffix import suffix_array
from .tables import read, stored

WINDOW = 13
BLOCK_WORDS = 2_000_000
#: A document is contaminated when hit words are at least one in so many.
ONE_IN = 20
_GRAM = 4

HITS = ("n_words long, n_hit long, hit_starts array<int>, hit_ends array<int>, items array<string>, longest int, "
        "longest_item string, longest_at int, longest_item_at int")


class Items:
    """A block of test items: their words' hashes and all their suffixes."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        raw, offs = tx.buffers(pa.array(texts, pa.large_string()))
        raw = tx.LOWER[raw]
        starts, ends, at = tx.words(raw, offs, tx.ALNUM)
        self.words, self.window = tx.span_hashes(raw, starts, ends), window
        self.names = ["" if i is None else str(i) for i in ids]
        n = np.diff(at)
        self.item, self.place = tx.ragged(n)
        self.left = np.repeat(n, n) - self.place          # words from here to the item's end
        self.n_item = np.repeat(n, n)
        # A suffix begins a window if it is long enough, or is a whole short item.
        self.is_window = (self.left >= window) | ((self.n_item < window) & (self.place == 0))
        self.grams = {}
        for k in range(1, _GRAM + 1):
            begins = (self.left >= k) & ((self.n_item >= _GRAM) if k == _GRAM else (self.n_item == k))
            got = tx.gram_hashes(self.words, k)
            self.grams[k] = np.unique(got[begins[:len(got)]])

    def find(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix number, place, length) of every occurrence of a window in a shard's word sequence.

        ``at``: n + 1 offsets of the documents' words.
        """
        none = np.zeros(0, np.int64)
        n = len(words)
        end = np.repeat(at[1:], np.diff(at))
        keep = np.zeros(n, bool)
        for k, known in self.grams.items():
            if len(known) and n >= k:
                got = tx.gram_hashes(words, k)
                keep[:len(got)] |= _among(got, known) & (np.arange(len(got)) + k <= end[:len(got)])
        kept = np.flatnonzero(keep)
        if not len(kept):
            return none, none, none
        # The kept suffixes' first words as one sequence, with a blank (0) after each piece.
        stop = np.minimum(kept + self.window, end[kept])
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] > stop[:-1]) | (end[kept[1:]] != end[kept[:-1]])
        begin, finish = kept[new], np.append(stop[:-1][new[1:]], stop[-1])
        piece, inside = tx.ragged(finish - begin + 1)
        source = begin[piece] + inside
        blank = source == finish[piece]
        known, symbol = np.unique(words[source[~blank]], return_inverse=True)
        line = np.zeros(len(source), np.int64)
        line[~blank] = symbol + 1
        order, _ = suffix_array(line, 1, self.window)
        wanted = np.zeros(len(source), bool)
        wanted[~blank] = keep[source[~blank]]
        array = order[wanted[order]]
        line = np.concatenate([line, np.zeros(self.window, np.int64)])

        # Binary search of all test suffixes together, word by word.
        near = np.minimum(np.searchsorted(known, self.words), len(known) - 1)
        test = np.where(known[near] == self.words, near + 1, -1)
        live = np.flatnonzero(self.is_window)
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(array))
        done, done_low, done_high = [], [], []
        for k in range(self.window):
            value = test[live + k]
            low, high = _bound(line, array, k, value, low, high, False), _bound(line, array, k, value, low, high, True)
            found = low < high
            live, low, high = live[found], low[found], high[found]
            whole = np.minimum(self.left[live], self.window) == k + 1
            done.append(live[whole]), done_low.append(low[whole]), done_high.append(high[whole])
            live, low, high = live[~whole], low[~whole], high[~whole]
        suffix, low, high = np.concatenate(done), np.concatenate(done_low), np.concatenate(done_high)
        owner, nth = tx.ragged(high - low)
        place = source[array[low[owner] + nth]]
        return suffix[owner], place, np.minimum(self.left[suffix[owner]], self.window)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a small sorted array; a bitmap turns most values down."""
    bitmap = np.zeros(1 << 20, bool)
    bitmap[(known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    found = bitmap[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]
    some = np.flatnonzero(found)
    at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    found[some] = known[at] == values[some]
    return found


def _bound(line, array, k, value, low, high, upper):
    """First place in array[low:high] whose k-th symbol is at least (upper: above) the value."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) >> 1
        symbol = line[array[mid] + k]
        right = (symbol <= value[live]) if upper else (symbol < value[live])
        low[live] = np.where(right, mid + 1, low[live])
        high[live] = np.where(right, high[live], mid)
        live = live[low[live] < high[live]]
    return low


def _runs(suffix, place, length, item_place, item, doc):
    """Longest verbatim match of each document: neighbouring windows on one diagonal grow into one match."""
    by = np.lexsort((place, place - item_place, item, doc))
    doc, item, p, q, length = doc[by], item[by], place[by], item_place[by], length[by]
    new = np.ones(len(by), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by)) - 1
    size = p[last] + length[last] - p[first]
    best = np.lexsort((p[first], -size, doc[first]))
    head = np.ones(len(best), bool)
    head[1:] = doc[first][best][1:] != doc[first][best][:-1]
    pick = best[head]
    return doc[first][pick], size[pick], item[first][pick], p[first][pick], q[first][pick]


def shard_hits(column: pa.Array, items: Items) -> dict[str, list]:
    """One entry of each HITS column for each text of the shard."""
    raw, offs = tx.buffers(column)
    raw = tx.LOWER[raw]
    starts, ends, at = tx.words(raw, offs, tx.ALNUM)
    words = tx.span_hashes(raw, starts, ends)
    n_docs = len(offs) - 1
    suffix, place, length = items.find(words, at)
    n_words = np.diff(at)
    out = {"n_words": n_words.tolist(), "n_hit": [0] * n_docs, "hit_starts": [[]] * n_docs, "hit_ends": [[]] * n_docs,
           "items": [[]] * n_docs, "longest": [0] * n_docs, "longest_item": [None] * n_docs,
           "longest_at": [None] * n_docs, "longest_item_at": [None] * n_docs}
    if not len(place):
        return out
    doc = np.searchsorted(at, place, side="right") - 1
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, place, 1)
    np.add.at(step, place + length, -1)
    hit = np.cumsum(step[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    pairs = np.unique(np.stack([doc, items.item[suffix]]), axis=1)
    where, size, what, from_, of = _runs(suffix, place, length, items.place[suffix], items.item[suffix], doc)
    for d, s, w, f, o in zip(where.tolist(), size.tolist(), what.tolist(), from_.tolist(), of.tolist()):
        a, b = at[d], at[d + 1]
        out["n_hit"][d] = int(total[b] - total[a])
        # A run of hits may go on in the next document: cut it at the texts' ends.
        i, j = np.searchsorted(closes, a, side="right"), np.searchsorted(opens, b)
        out["hit_starts"][d] = (np.maximum(opens[i:j], a) - a).tolist()
        out["hit_ends"][d] = (np.minimum(closes[i:j], b) - a).tolist()
        lo, hi = np.searchsorted(pairs[0], d), np.searchsorted(pairs[0], d, side="right")
        out["items"][d] = sorted({items.names[k] for k in pairs[1, lo:hi]})
        out["longest"][d], out["longest_item"][d] = s, items.names[w]
        out["longest_at"][d], out["longest_item_at"][d] = int(f - a), o
    return out


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[Items]:
    """The items in blocks of about ``block_words`` words, one after the other."""
    ids, texts, size = [], [], 0
    for item, value in benchmark.select("item_id", "text").where("text IS NOT NULL").dropDuplicates().toLocalIterator():
        ids.append(item), texts.append(value)
        size += len(value) // 2 + 1
        if size >= block_words:
            yield Items(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, window)


def one_or_more(blocks: Iterator[Items], window: int = WINDOW) -> tuple[Items | None, Iterator[Items]]:
    """The only block (an empty one for no items), or None and all blocks.  Whoever lets go of each before the next has two on the driver at most."""
    held = list(itertools.islice(blocks, 2))
    if len(held) < 2:
        return held[0] if held else Items([], [], window), iter(())

    def every():
        while held:
            yield held.pop(0)
        yield from blocks
    return None, every()


def find_hits(docs: DataFrame, items: Items, keep: Iterable[str] = ("doc_id",), column: str = "text") -> DataFrame:
    """The kept columns and HITS of each row for one block of items."""
    keep = list(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [HITS])

    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, column):
                found = shard_hits(part.column(column), items)
                yield pa.RecordBatch.from_pylist([]) if part.num_rows == 0 else pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(v, _ARROW[k]) for k, v in found.items()],
                    names=keep + list(found))

    return docs.select(*dict.fromkeys([*keep, column])).mapInArrow(task, schema)


_ARROW = {"n_words": pa.int64(), "n_hit": pa.int64(), "hit_starts": pa.list_(pa.int32()), "hit_ends": pa.list_(pa.int32()),
          "items": pa.list_(pa.string()), "longest": pa.int32(), "longest_item": pa.string(), "longest_at": pa.int32(),
          "longest_item_at": pa.int32()}


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS,
                  window: int = WINDOW) -> DataFrame:
    """doc_id and HITS of each row of ``docs`` against all items."""
    only, blocks = one_or_more(item_blocks(benchmark, block_words, window), window)
    if only is not None:
        return find_hits(docs, only)
    # Several blocks: number the rows once, so that equal rows stay apart, and join the blocks' findings.
    rows = stored(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "decontamination")
    found = [stored(find_hits(rows, items, ("row", "doc_id")), "decontamination-block") for items in blocks]
    return united(found, "row", ["doc_id"]).drop("row")


def united(parts: list[DataFrame], row: str, keep: Iterable[str] = ()) -> DataFrame:
    """The row number, the kept columns and HITS of each row over the findings of several blocks of items."""
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    marks = F.flatten(F.collect_list(F.arrays_zip("hit_starts", "hit_ends")))
    best = F.max_by(F.struct("longest", "longest_item", "longest_at", "longest_item_at"),
                    F.struct("longest", -F.coalesce("longest_at", F.lit(0))))
    joined = found.groupBy(row).agg(*[F.first(c).alias(c) for c in keep], F.first("n_words").alias("n_words"),
                                    F.array_sort(marks).alias("m"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                    best.alias("best"))
    union = F.aggregate("m", F.array().cast("array<struct<hit_starts:int,hit_ends:int>>"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["hit_starts"] <= F.get(acc, F.size(acc) - 1)["hit_ends"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.get(acc, F.size(acc) - 1)["hit_starts"].alias("hit_starts"),
            F.greatest(F.get(acc, F.size(acc) - 1)["hit_ends"], x["hit_ends"]).alias("hit_ends")))))
        .otherwise(F.concat(acc, F.array(x))))
    joined = joined.withColumn("m", union)
    hit = F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: acc + (x["hit_ends"] - x["hit_starts"]))
    return joined.select(row, *keep, "n_words", hit.alias("n_hit"), F.col("m.hit_starts").alias("hit_starts"),
                         F.col("m.hit_ends").alias("hit_ends"), "items", "best.*")


def contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS,
                      window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns.

    One block of items: a filter inside each task.  Several: a row's hits are united over all blocks before it is judged.
    """
    only, blocks = one_or_more(item_blocks(benchmark, block_words, window), window)
    if only is not None:
        def task(batches):
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    found = shard_hits(part.column("text"), only)
                    hit, n = np.array(found["n_hit"]), np.array(found["n_words"])
                    yield part.filter(pa.array(~((hit > 0) & (hit * ONE_IN >= n))))
        return docs.mapInArrow(task, docs.schema)
    row = "row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination")
    found = [stored(find_hits(rows, items, (row,)).where("n_hit > 0"), "decontamination-block") for items in blocks]
    return rows.join(united(found, row).where(contaminated()).select(row), row, "left_anti").drop(row)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontaminate(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"), "longest", "longest_item", "longest_at")


def brute_force(texts: list[str | None], items: list[tuple[object, str | None]], window: int = WINDOW) -> list[tuple]:
    """(n_words, n_hit, item names, items_sha256) of each text, plainly; for tests."""
    def split(value):
        out, word = [], bytearray()
        for b in (value or "").encode():
            if tx.ALNUM[tx.LOWER[b]]:
                word.append(tx.LOWER[b])
            elif word:
                out.append(bytes(word))
                word = bytearray()
        return out + [bytes(word)] * bool(word)
    windows: dict[tuple, set] = {}
    for name, value in items:
        w = split(value)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k:k + window]), set()).add("" if name is None else str(name))
    out = []
    for value in texts:
        w, hit, names = split(value), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    names |= found
        out.append((len(w), len(hit), sorted(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return out
