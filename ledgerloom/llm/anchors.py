"""Exact repeated passages, found through fixed-block anchors.

A window of `window` words always covers one whole block of an earlier text, if that text is cut into blocks of half
the length that don't overlap. So the blocks of all texts are indexed, the index is probed with every rolling window of
a block's length, and a hit is extended to every full window over it: such a window is looked up at full length for the
first place where it starts. Adjacent windows that start earlier elsewhere make up the maximal repeats, whose words are
removed.

Documents travel in chunks of bounded size, one compressed row each. What a chunk sends to the index are its distinct
hashes, each once, dealt into buckets by their leading bits; what comes back is one bit a hash. So no pair of equal
passages is ever written, and a passage that every document holds costs one entry a chunk: a bucket holds about
`bucket_entries`, and one entry a chunk for each of its very frequent windows. The first look-up works on 32 bits beside
the bucket and can only let too much through; the second one decides on 80 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged

# Order of documents: unnamed ones last, then by id, then by the hash of the text.
_HEAD = np.dtype([("unnamed", "u1"), ("id", "<i8"), ("text", "<u8")])


@dataclass(frozen=True)
class RepeatSettings:
    """`window`: fewest words of a repeat. `chunk_bytes`: text of one chunk, unless a single text is longer.
    `bucket_entries`: hashes compared at a time, on average; both bound the memory of a task."""

    window: int = 20
    chunk_bytes: int = 2 << 20
    bucket_entries: int = 2_000_000

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


def _chunks(docs: DataFrame, s: RepeatSettings) -> DataFrame:
    """(chunk, n_words, heads, payload): documents in their order, words joined by one space, one line each."""

    def pack(number: int, held: list[tuple]) -> pa.RecordBatch:
        heads = np.array([h for h, _ in held], _HEAD)
        order = np.argsort(heads, order=("unnamed", "id", "text"), kind="stable")
        words = sum(line.count(b" ") + bool(line) for _, line in held)
        payload = zstandard.ZstdCompressor(level=3).compress(b"\n".join(held[i][1] for i in order.tolist()))
        columns = [[number], [words], [heads[order].tobytes()], [payload]]
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["chunk", "n_words", "heads", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text, mark in zip(*(batch.column(i) for i in range(3)), strict=True):
                doc_id, line = doc_id.as_py(), b" ".join((text.as_py() or b"").split())
                if held and size + len(line) > s.chunk_bytes:
                    yield pack(number, held)
                    number, held, size = number + 1, [], 0
                held.append(((doc_id is None, doc_id or 0, mark.as_py() & (2**64 - 1)), line))
                size += len(line)
        if held:
            yield pack(number, held)

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("mark"))
    return rows.mapInArrow(run, "chunk long, n_words long, heads binary, payload binary")


def _rolling(codes: np.ndarray, size: int, factor: int) -> np.ndarray:
    """A hash of every run of `size` codes."""
    mixed = np.full(max(0, len(codes) - size + 1), size, np.uint64)
    for i in range(size if len(mixed) else 0):
        mixed = mixed * np.uint64(factor) + codes[i : i + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    return _spread(mixed)


def _spread(mixed: np.ndarray) -> np.ndarray:
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(63)) >> np.uint64(1) if bits == 0 else hashes >> np.uint64(64 - bits)


def _cuts(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending bucket numbers."""
    if not len(buckets):
        return []
    edges = np.concatenate(([0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)])).tolist()
    return [(int(buckets[a]), a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _unpack_bits(data: list[bytes], sizes: list[int]) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(d, np.uint8), count=n) for d, n in zip(data, sizes, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


class Chunk:
    """The words of some documents as hashes, and the windows over them."""

    def __init__(self, heads: bytes, payload: bytes, s: RepeatSettings):
        self.s = s
        self.heads = np.frombuffer(heads, _HEAD)
        lines = zstandard.ZstdDecompressor().decompress(payload).split(b"\n")
        self.words = [line.split(b" ") if line else [] for line in lines]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        n = int(self.lengths.sum())
        self.codes = np.fromiter((xxhash.xxh64_intdigest(w) for doc in self.words for w in doc), np.uint64, n)
        self.rest = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(n)  # words to the document's end
        self.short = _rolling(self.codes, s.block, 0x9E3779B97F4A7C15)
        self.probes = np.flatnonzero(self.rest[: len(self.short)] >= s.block)
        self.distinct, self.which = np.unique(self.short[self.probes], return_inverse=True)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Per distinct hash: whether it is that of a block, and whether several windows have it."""
        place = self.probes - np.repeat(self.starts, self.lengths)[self.probes]
        block = np.zeros(len(self.distinct), bool)
        block[self.which[place % self.s.block == 0]] = True
        return block, np.bincount(self.which, minlength=len(self.distinct)) > 1

    def shared(self, found: list[tuple[int, bytes]], bits: int) -> np.ndarray:
        """Whether each distinct hash is shared, from the bits per bucket that came back."""
        out, back = np.zeros(len(self.distinct), bool), dict(found)
        for bucket, a, b in _cuts(_bucket(self.distinct, bits)):
            if bucket in back:
                out[a:b] = _unpack_bits([back[bucket]], [b - a])
        return out

    def extend(self, shared: np.ndarray) -> None:
        """Full windows over a hit: their starts, the first place of each distinct one, and what is sent of it."""
        s = self.s
        hit = np.zeros(len(self.codes) + 1, np.int64)
        hit[self.probes + 1] = shared[self.which]
        seen = np.cumsum(hit)
        full = np.flatnonzero(self.rest >= s.window)
        self.windows = full[seen[full + s.window - s.block + 1] > seen[full]]
        tail = s.window - s.block
        other = _rolling(self.codes, s.block, 0xD6E8FEB86659FD93)
        ends = self.windows + tail
        self.long = _spread(self.short[self.windows] * np.uint64(0x9E3779B97F4A7C15) + self.short[ends])
        check = _spread(other[self.windows] * np.uint64(0xD6E8FEB86659FD93) + other[ends])
        keys, first, self.same = np.unique(self.long, return_index=True, return_inverse=True)
        self.first, self.keys = first, keys  # first: index into `windows`
        self.check = (check[first] >> np.uint64(48)).astype("<u2")

    def dealt(self, bits: int) -> list[tuple[int, np.ndarray]]:
        """Distinct full windows of each bucket, in the order of their first places."""
        return [(k, a + np.argsort(self.first[a:b], kind="stable")) for k, a, b in _cuts(_bucket(self.keys, bits))]

    def document(self, windows: np.ndarray) -> np.ndarray:
        """Number of the document in which each window starts."""
        return np.searchsorted(self.starts + self.lengths, windows, side="right")

    def removed(self, is_first: np.ndarray) -> np.ndarray:
        """Whether each word lies in a window that starts earlier elsewhere; `is_first` per distinct full window."""
        kept = is_first[self.same] & (np.arange(len(self.windows)) == self.first[self.same])
        edges = np.zeros(len(self.codes) + 1, np.int64)
        later = self.windows[~kept]
        np.add.at(edges, later, 1)
        np.add.at(edges, later + self.s.window, -1)
        return np.cumsum(edges)[:-1] > 0


def _planes(sorted_values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences in byte planes, of which the high ones are nearly empty."""
    steps = np.diff(sorted_values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _from_planes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


_PROBE = "bucket long, chunk long, n long, rest binary, flags binary"
_BITS = "kind int, chunk long, bucket long, bits binary"
_FULL = "bucket long, chunk long, n long, long binary, check binary, heads binary, runs binary"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def _probes(chunks: DataFrame, bits: int, s: RepeatSettings) -> DataFrame:
    """Distinct hashes of each chunk's rolling windows, a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, heads, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                chunk, number, out = Chunk(heads.as_py(), payload.as_py(), s), number.as_py(), []
                block, many = chunk.anchors()
                rest = ((chunk.distinct << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                for bucket, a, b in _cuts(_bucket(chunk.distinct, bits)):
                    flags = np.packbits(block[a:b]).tobytes() + np.packbits(many[a:b]).tobytes()
                    out.append((bucket, number, b - a, _planes(rest[a:b]), flags))
                yield from _table(out, _PROBE).to_batches()

    return chunks.select("chunk", "heads", "payload").mapInArrow(run, _PROBE)


def _shared(probes: DataFrame) -> DataFrame:
    """A bit per hash sent: several windows have it, and one of them is a block."""

    def match(table: pa.Table) -> pa.Table:
        sizes, flags = table.column("n").to_pylist(), table.column("flags").to_pylist()
        rest = np.concatenate([_from_planes(d, n) for d, n in zip(table.column("rest").to_pylist(), sizes, strict=True)])
        half = [len(f) // 2 for f in flags]
        block = _unpack_bits([f[:h] for f, h in zip(flags, half, strict=True)], sizes)
        many = _unpack_bits([f[h:] for f, h in zip(flags, half, strict=True)], sizes)
        order = np.argsort(rest)
        ranked = rest[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        at = np.flatnonzero(new)
        several = np.diff(at, append=len(rest)) > 1
        good = np.logical_or.reduceat(block[order], at) & (several | np.logical_or.reduceat(many[order], at))
        back = np.empty(len(rest), bool)
        back[order] = good[np.cumsum(new) - 1]
        out, bucket, edge = [], table.column("bucket")[0].as_py(), np.cumsum(sizes).tolist()
        for number, n, end in zip(table.column("chunk").to_pylist(), sizes, edge, strict=True):
            if back[end - n : end].any():
                out.append((0, number, bucket, np.packbits(back[end - n : end]).tobytes()))
        return _table(out, _BITS)

    return probes.groupBy("bucket").applyInArrow(match, _BITS)


def _back(right: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    rows = zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True)
    return [(bucket, bits) for k, bucket, bits in rows if k == kind]


def _extended(chunks: DataFrame, hits: DataFrame, bits: int, s: RepeatSettings) -> DataFrame:
    """Distinct full windows over hits, a row per chunk and bucket, with the documents of their first places."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist() if right.num_rows else []:
            chunk = Chunk(row["heads"], row["payload"], s)
            chunk.extend(chunk.shared(_back(right, 0), bits))
            for bucket, some in chunk.dealt(bits):
                docs = chunk.document(chunk.windows[chunk.first[some]])
                at = np.concatenate(([0], np.flatnonzero(np.diff(docs)) + 1))
                runs = np.diff(at, append=len(docs)).astype("<u4")
                parts = (chunk.keys[some].astype("<u8"), chunk.check[some], chunk.heads[docs[at]], runs)
                out.append((bucket, row["chunk"], len(some), *(p.tobytes() for p in parts)))
        return _table(out, _FULL)

    pairs = chunks.groupBy("chunk").cogroup(hits.groupBy("chunk"))
    return pairs.applyInArrow(run, _FULL)


def _first_places(full: DataFrame) -> DataFrame:
    """A bit per window sent: it starts nowhere before."""

    def match(table: pa.Table) -> pa.Table:
        joined = {c: b"".join(table.column(c).to_pylist()) for c in ("long", "check", "heads", "runs")}
        keys, check = np.frombuffer(joined["long"], "<u8"), np.frombuffer(joined["check"], "<u2")
        heads, runs = np.frombuffer(joined["heads"], _HEAD), np.frombuffer(joined["runs"], "<u4")
        sizes, numbers = table.column("n").to_numpy(), table.column("chunk").to_numpy()
        # Each run of windows belongs to one document of one chunk.
        owner = np.repeat(numbers, sizes)[np.cumsum(runs) - runs]
        rank = np.empty(len(runs), np.int64)
        rank[np.lexsort((owner, heads["text"], heads["id"], heads["unnamed"]))] = np.arange(len(runs))
        order = np.lexsort((np.repeat(rank, runs), check, keys))
        a, b = keys[order], check[order]
        first = np.zeros(len(keys), bool)
        first[order] = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        out, bucket, edge = [], table.column("bucket")[0].as_py(), np.cumsum(sizes).tolist()
        for number, n, end in zip(numbers.tolist(), sizes.tolist(), edge, strict=True):
            out.append((1, number, bucket, np.packbits(first[end - n : end]).tobytes()))
        return _table(out, _BITS)

    return full.groupBy("bucket").applyInArrow(match, _BITS)


def without_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_removed, spans, kept.

    Words are runs of anything but ASCII white space. A word is removed if it lies in a window of `window` words of its
    document whose words also start earlier: in a document that comes before, or further up in the same one. Windows
    are those of the input. `spans` lists the maximal runs of removed words (start, end; in words, from 0, end
    exclusive); `kept` is the rest, joined by one space.

    Documents come in ascending order of doc_id, null last; rows of one id in the order of a hash of their text, and of
    equal rows one, whichever, is first. A text that is null, empty or only white space has no words. A text is held by
    one task, however long; nothing is cut. Other columns are ignored. An empty table gives an empty result.
    """
    s = settings
    chunks = staged(_chunks(docs, s), "chunks")
    words = chunks.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    bits = max(0, words // s.bucket_entries).bit_length()
    hits = staged(_shared(_probes(chunks, bits, s)), "anchors")
    chunks = chunks.select("chunk", "heads", "payload")
    firsts = _first_places(_extended(chunks, hits, bits, s))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            chunk = Chunk(row["heads"], row["payload"], s)
            gone = np.zeros(len(chunk.codes), bool)
            back = dict(_back(right, 1))
            if back:
                chunk.extend(chunk.shared(_back(right, 0), bits))
                is_first = np.empty(len(chunk.keys), bool)
                for bucket, some in chunk.dealt(bits):
                    is_first[some] = _unpack_bits([back[bucket]], [len(some)])
                gone = chunk.removed(is_first)
            for head, doc, start in zip(chunk.heads, chunk.words, chunk.starts.tolist(), strict=True):
                mine = gone[start : start + len(doc)]
                turns = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                spans = [{"start": x, "end": y} for x, y in zip(turns[::2], turns[1::2], strict=True)]
                kept = [w for w, drop in zip(doc, mine.tolist(), strict=True) if not drop] if spans else doc
                out.append((None if head["unnamed"] else int(head["id"]), len(doc), int(mine.sum()), spans, b" ".join(kept)))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.binary())
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    told = hits.unionByName(firsts)
    done = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(finish, schema)
    return done.withColumn("kept", F.col("kept").cast("string"))
