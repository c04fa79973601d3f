"""Benchmark decontamination by greedy string tiling.

Texts become lower-cased words; ASCII punctuation separates words. Karp-Rabin hashes of `seed` consecutive words are
joined between benchmark items and documents; a bitmap of fixed size, set from the items' hashes, keeps almost all
other document windows out of the shuffle. A pair goes on only if its shared seeds could cover enough of the item.
Then tiling marks the longest match of unmarked words again and again, in any order of passages, and the share of
the item's words that are covered decides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged
from ledgerloom.llm.units import free_encoders

_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class TilingSettings:
    """`seed`: shortest tile in words; `coverage`: share of an item's words that makes a document contaminated;
    `bitmap_bits`: log2 of the size of the seed bitmap, whatever the benchmark's size (fuller maps only let more
    windows reach the exact join)."""

    seed: int = 5
    coverage: float = 0.6
    bitmap_bits: int = 24


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATE).split()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of `size` words, as signed 64-bit integers."""
    n = len(codes) - size + 1
    if n < 1 or size < 1:
        return np.empty(0, np.int64)
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(30)
    return mixed.view(np.int64)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Words:
    """Words of which some are marked, with hashes of windows of any length."""

    def __init__(self, codes: np.ndarray):
        one, inverse = np.ones(1, np.uint64), np.uint64(pow(int(_FACTOR), -1, 2**64))
        powers = np.cumprod(np.concatenate((one, np.full(len(codes), _FACTOR))))
        self.undo = np.cumprod(np.concatenate((one, np.full(len(codes), inverse))))
        self.sums = np.concatenate((one - one, np.cumsum(codes * powers[:-1])))
        self.free = np.ones(len(codes), bool)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the windows without a marked word."""
        marked = np.concatenate(([0], np.cumsum(~self.free)))
        at = np.flatnonzero(marked[size:] == marked[: len(marked) - size])
        return at, (self.sums[at + size] - self.sums[at]) * self.undo[at]


def _tile_repetitive(item: list[bytes], doc: list[bytes], shortest: int) -> list[tuple[int, int, int]]:
    """The same tiles, by searching the greatest length at which unmarked windows match again after each tile. Memory
    is linear in the texts; the time is that of a few passes over them for each tile."""
    numbers: dict[bytes, int] = {}
    codes = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64) for words in (item, doc)]
    mixed = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, len(numbers), np.uint64)
    left, right = (_Words(mixed[c]) for c in codes)

    def match(size: int) -> tuple[int, int] | None:
        a, x = left.windows(size)
        b, y = right.windows(size)
        found = np.flatnonzero(np.isin(x, y))
        if not len(found):
            return None
        return int(a[found[0]]), int(b[np.flatnonzero(y == x[found[0]])[0]])

    tiles, longest = [], min(len(item), len(doc))
    while longest >= shortest:
        low, place = shortest - 1, None
        while low < longest:
            middle = (low + longest + 1) // 2
            at = match(middle)
            if at is None:
                longest = middle - 1
            else:
                low, place = middle, at
        if place is None:
            break
        for words, start in zip((left, right), place, strict=True):
            words.free[start : start + low] = False
        tiles.append((*place, low))
        longest = low
    return tiles


def tile(item: list[bytes], doc: list[bytes], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, length) of non-overlapping matches, the longest
    unmarked one first, ties to the earlier item and document position."""
    if not item or len(item) < shortest:
        return []
    left, right = window_hashes(word_codes(item), shortest), window_hashes(word_codes(doc), shortest)
    order = np.argsort(left, kind="stable")
    lo, hi = np.searchsorted(left[order], right), np.searchsorted(left[order], right, side="right")
    hit = np.flatnonzero(hi > lo)
    counts = hi[hit] - lo[hit]
    if counts.sum() > 32 * (len(item) + len(doc)):  # windows that come again and again: too many pairs to list
        return _tile_repetitive(item, doc, shortest)
    d = np.repeat(hit, counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    i = order[np.repeat(lo[hit], counts) + within]
    true = [k for k, (a, b) in enumerate(zip(i.tolist(), d.tolist(), strict=True)) if item[a : a + shortest] == doc[b : b + shortest]]
    i, d = i[true], d[true]
    if not len(i):
        return []
    # Windows that follow each other on a diagonal make one maximal match.
    run = np.lexsort((i, d - i))
    i, d = i[run], d[run]
    new = np.ones(len(i), bool)
    new[1:] = (d[1:] - i[1:] != d[:-1] - i[:-1]) | (i[1:] != i[:-1] + 1)
    first = np.flatnonzero(new)
    lengths = np.diff(np.append(first, len(i))) + shortest - 1
    queue = [(-n, a, b) for n, a, b in zip(lengths.tolist(), i[first].tolist(), d[first].tolist(), strict=True)]
    heapq.heapify(queue)
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles = []
    while queue:
        n, a, b = heapq.heappop(queue)
        free = item_free[a : a - n] & doc_free[b : b - n]
        if free.all():
            item_free[a : a - n] = doc_free[b : b - n] = False
            tiles.append((a, b, -n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= shortest:
                heapq.heappush(queue, (start - end, a + start, b + start))
    return tiles


def _seeds(items: DataFrame, s: TilingSettings) -> DataFrame:
    """(item_id, seed, n_words, size, places): distinct seeds per item, with the number of positions of each; an item
    shorter than a seed is one seed itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                size = min(s.seed, len(words))
                seeds, places = np.unique(window_hashes(word_codes(words), size), return_counts=True)
                out += [(item_id, h, len(words), size, n) for h, n in zip(seeds.tolist(), places.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "seed", "n_words", "size", "places"])

    return items.mapInArrow(run, "item_id long, seed long, n_words int, size int, places long")


def _bitmap(seeds: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """Bitmap of the seeds, and the window sizes in use (at most `seed` of them). Words of the bitmap are combined
    on the executors; the driver receives 2 ** bits bits at most."""
    place = f"shiftrightunsigned(seed, {64 - bits})"
    bit = F.expr(f"shiftleft(1L, cast({place} % 32 as int))")
    words = seeds.groupBy(F.expr(f"cast({place} / 32 as long)").alias("at")).agg(F.bit_or(bit).alias("word"))
    table = words.toArrow()
    filled = np.zeros(1 << max(bits - 5, 0), "<u4")
    filled[table.column("at").to_numpy()] = table.column("word").to_numpy().astype(np.uint32)
    sizes = [r["size"] for r in seeds.select("size").distinct().collect()]
    return filled.view(np.uint8), sorted(sizes)


def contaminated_pairs(docs: DataFrame, items: DataFrame, settings: TilingSettings = TilingSettings()) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) of every document (doc_id, text) that covers at least
    `settings.coverage` of the words of an item (item_id, text).

    Null, empty and wordless texts match nothing. Texts are compared whole, however long, in memory linear in their
    words, also where words or passages come again and again. An item of fewer words than a seed must occur whole. Rows that
    repeat a doc_id or item_id give one row per pair, with the highest coverage; null ids are ids of their own.
    Other columns are ignored. Empty tables give an empty result.
    """
    s = settings
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item_text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seeds = staged(_seeds(items, s).distinct(), "seeds")
    bitmap, sizes = _bitmap(seeds, s.bitmap_bits)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2 ** bitmap_bits bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        bits, shift = shared.value, np.uint64(64 - s.bitmap_bits)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                codes = word_codes(words_of(text))
                hits = []
                for size in sizes:
                    hashes = window_hashes(codes, size)
                    at = hashes.view(np.uint64) >> shift
                    hits.append(hashes[(bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0])
                hits = np.unique(np.concatenate(hits)) if hits else []
                if len(hits):
                    rows.append(row)
                    found.append(hits.tolist())
            kept = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "text", "seeds"],
            )

    hit = staged(docs.mapInArrow(run, "doc_id long, text string, seeds array<long>"), "hits")
    pairs = hit.select("doc_id", F.explode("seeds").alias("seed")).join(seeds, "seed")
    # The words that tiles cover lie at positions of shared seeds, each of which covers `size` words at most.
    enough = F.col("k") * F.col("size") >= F.lit(s.coverage) * F.col("n_words")
    pairs = pairs.groupBy("doc_id", "item_id", "n_words", "size").agg(F.sum("places").alias("k")).where(enough)
    pairs = pairs.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i")).distinct()
    both = pairs.join(hit.select("doc_id", "text"), F.col("d").eqNullSafe(F.col("doc_id"))).drop("d")
    both = both.join(items, F.col("i").eqNullSafe(F.col("item_id"))).select("doc_id", "item_id", "text", "item_text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, (text, item_text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                item = words_of(item_text)
                tiles = tile(item, words_of(text), min(s.seed, len(item)))
                covered = sum(n for _, _, n in tiles)
                if tiles and covered >= s.coverage * len(item):
                    out.append((row, covered / len(item), len(tiles), max(n for _, _, n in tiles)))
            row, coverage, n, longest = zip(*out, strict=True) if out else ([],) * 4
            kept = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(coverage, pa.float64()), pa.array(n, pa.int64()), pa.array(longest, pa.int64())],
                names=["doc_id", "item_id", "coverage", "n_tiles", "longest"],
            )

    measured = both.mapInArrow(measure, "doc_id long, item_id long, coverage double, n_tiles long, longest long")
    best = F.max(F.struct("coverage", "longest", (-F.col("n_tiles")).alias("fewest"))).alias("best")
    return measured.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.coverage", (-F.col("best.fewest")).alias("n_tiles"), "best.longest"
    )
