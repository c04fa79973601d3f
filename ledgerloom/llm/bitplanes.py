"""Token ids in bit-plane files.

Ids go in ascending doc_id order into blocks of a fixed number of ids. A block is transposed into byte or bit planes
(all lowest bytes first, and so on), and each plane is compressed by itself with zstandard: high planes of small ids
are almost free. A token folder holds one row per block: the chunk index (shard, block, position of the first id,
number of ids, documents that start in or go on through the block) beside the block's own bytes. Parquet is only the
container, so that Spark commits all shards at once, in any store and after lost executors.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.units import Memo, distinct_pieces, distinct_units, ragged, slices, splitter, worker_encoder

BLOCK_IDS = 65_536
_MAGIC = b"LLBP"
_HEAD = struct.Struct("<4sBBHI")  # magic, kind (0 byte, 1 bit), planes, zero, ids
_LAYOUT = (
    "shard int, block int, first long, n_ids int, doc_seq array<long>, doc_id array<long>, doc_len array<int>, planes binary"
)


def pack_block(ids: np.ndarray, kind: str = "byte", level: int = 1) -> bytes:
    """One block: header, compressed length of each plane, planes. Only planes up to the highest bit set are kept."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()).bit_length() if len(ids) else 0
    compressor = zstandard.ZstdCompressor(level=level)
    if kind == "byte":
        lanes = ids.view(np.uint8).reshape(-1, 4)
        planes = [lanes[:, i].tobytes() for i in range((top + 7) // 8)]
    else:
        planes = [np.packbits(((ids >> np.uint32(i)) & np.uint32(1)).astype(np.uint8)).tobytes() for i in range(top)]
    packed = [compressor.compress(p) for p in planes]
    head = _HEAD.pack(_MAGIC, kind != "byte", len(packed), 0, len(ids))
    return head + struct.pack(f"<{len(packed)}I", *map(len, packed)) + b"".join(packed)


def unpack_block(data: bytes) -> np.ndarray:
    """Ids of a block as little-endian unsigned 32-bit integers."""
    magic, bits, n_planes, _, n = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    lengths = struct.unpack_from(f"<{n_planes}I", data, _HEAD.size)
    at = _HEAD.size + 4 * n_planes
    ids = np.zeros(n, "<u4")
    lanes = ids.view(np.uint8).reshape(-1, 4)
    plain = zstandard.ZstdDecompressor()
    for i, length in enumerate(lengths):
        plane = np.frombuffer(plain.decompress(data[at : at + length]), np.uint8)
        if bits:
            ids |= np.unpackbits(plane, count=n).astype(np.uint32) << np.uint32(i)
        else:
            lanes[:, i] = plane
        at += length
    return ids


class LibraryEncoder:
    """Units to ids with the tokenizers library, given as little-endian unsigned 32-bit bytes.

    Pieces go to the library's own BPE model; `pattern` is the split of its byte-level pre-tokenizer. Strings of added
    tokens in a text are ordinary text, or with `added` those tokens, as the library has it by default: a text with
    such a string goes through the library as a whole.
    """

    def __init__(self, path: str, pattern: str, memo_units: int = 500_000, added: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.memo = Memo(memo_units)
        self.pieces, self.find = splitter(pattern)
        # Fixed values of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.shown = dict(zip(shown + hidden, [*map(chr, shown), *(chr(256 + i) for i in range(len(hidden)))], strict=True))

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and the number of ids of each."""
        joined = "\0".join(pieces)
        if joined.count("\0") == len(pieces) - 1:
            shown = joined.encode("utf-8").decode("latin-1").translate(self.shown).split(self.shown[0])
        else:
            shown = [p.encode("utf-8").decode("latin-1").translate(self.shown) for p in pieces]
        tokens = [[t.id for t in self.model.tokenize(p)] for p in shown]
        return np.fromiter(chain.from_iterable(tokens), "<u4"), np.fromiter(map(len, tokens), np.int64, len(tokens))

    def _encode(self, units: list[str]) -> list[bytes]:
        pieces, numbers, counts = distinct_pieces(units, self.pieces, self.find)
        ids, sizes = self._pieces(pieces)
        joined = ids[ragged((np.cumsum(sizes) - sizes)[numbers], sizes[numbers])].tobytes()
        ends = np.concatenate(([0], np.cumsum(sizes[numbers])))[np.concatenate(([0], np.cumsum(counts)))]
        return [joined[a:b] for a, b in pairwise((4 * ends).tolist())]

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def texts(self, texts: list[str | None], units: int = 1 << 18) -> list[bytes]:
        """Ids of each text; they are put together from those of `units` units at a time."""
        whole = {i: self._whole(t) for i, t in enumerate(texts) if t and any(a in t for a in self.added)}
        keys, numbers, counts = distinct_units(["" if i in whole else t or "" for i, t in enumerate(texts)], self.find)
        known = self.memo.encode(keys, self._encode)
        forms = list(map(known.__getitem__, keys))
        sizes = np.fromiter(map(len, forms), np.int64, len(forms)) // 4
        table, starts = np.frombuffer(b"".join(forms), "<u4"), np.cumsum(sizes) - sizes
        parts = [numbers[i : i + units] for i in range(0, len(numbers), units)]
        ids = b"".join([table[ragged(starts[p], sizes[p])].tobytes() for p in parts])
        ends = np.concatenate(([0], np.cumsum(sizes[numbers])))[np.concatenate(([0], np.cumsum(counts)))]
        cuts = (4 * ends).tolist()
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(pairwise(cuts))]


def library_encoder(path: str, pattern: str, added: bool = False) -> LibraryEncoder:
    """The worker's encoder; its memo outlives a task."""
    return worker_encoder(LibraryEncoder, path, pattern, 500_000, added)


def write_token_ids(
    docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int = 0, block_ids: int = BLOCK_IDS, kind: str = "byte",
    added: bool = False,
) -> None:
    """Encode (doc_id, text) and write a token folder at `path`; `added` as in `LibraryEncoder`.

    Every document gets `end_id` at its end; null and empty texts consist of it alone. Documents go in ascending
    doc_id order, null first; rows that repeat a doc_id stay, ordered by text. Other columns are ignored. A shard is
    one range of doc_id and is written as it is encoded, so a task holds a slice of texts and one open block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder = library_encoder(tokenizer, pattern, added)
        end = struct.pack("<I", end_id)
        held, n_held, docs_held = [], 0, []  # open block: bytes, ids, (doc_seq, doc_id, ids) of its documents
        seq, block, first = 0, 0, 0

        def closed() -> pa.RecordBatch:
            row = (shard, block, first, n_held, *map(list, zip(*docs_held, strict=True)), pack_block(np.frombuffer(b"".join(held), "<u4"), kind))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            names = [part.split()[0] for part in _LAYOUT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for part in slices(batch, 1, 4_000_000):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.texts(part.column(1).to_pylist()), strict=True):
                    ids += end
                    at = 0
                    while at < len(ids):
                        piece = ids[at : at + 4 * (block_ids - n_held)]
                        held.append(piece)
                        docs_held.append((seq, doc_id, len(piece) // 4))
                        n_held += len(piece) // 4
                        at += len(piece)
                        if n_held == block_ids:
                            yield closed()
                            held, docs_held, block, first, n_held = [], [], block + 1, first + n_held, 0
                    seq += 1
        if n_held:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spread = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = spread.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    ordered.mapInArrow(run, _LAYOUT).write.parquet(path)


def _shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before. The driver sums one number per shard."""
    sizes = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    rows, total = [], 0
    for shard in sorted(sizes):
        rows.append((shard, total))
        total += sizes[shard]
    return blocks.sparkSession.createDataFrame(rows, "shard int, base long")


def _decoded(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The blocks of a token folder, and (shard, doc_seq, doc_id, local_start, n_ids, ids) per document and block,
    decoded where the blocks are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = unpack_block(row["planes"]).tobytes(), 0
                starts, parts = [], []
                for n in row["doc_len"]:
                    starts.append(row["first"] + at // 4)
                    parts.append(ids[at : at + 4 * n])
                    at += 4 * n
                k = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * k, pa.int32()), pa.array(row["doc_seq"], pa.int64()),
                        pa.array(row["doc_id"], pa.int64()), pa.array(starts, pa.int64()),
                        pa.array(row["doc_len"], pa.int64()), pa.array(parts, pa.binary()),
                    ],
                    names=["shard", "doc_seq", "doc_id", "local_start", "n_ids", "ids"],
                )

    blocks = spark.read.schema(_LAYOUT).parquet(path)
    pieces = blocks.mapInArrow(run, "shard int, doc_seq long, doc_id long, local_start long, n_ids long, ids binary")
    return blocks, pieces


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_seq, doc_id, start, n_ids, ids): one row per document and block, start counted over all shards,
    ids as little-endian unsigned 32-bit bytes."""
    blocks, pieces = _decoded(spark, path)
    based = pieces.join(_shard_starts(blocks), "shard")
    return based.select("shard", "doc_seq", "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_ids", "ids")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document, ids as in `read_pieces`."""
    parts = F.sort_array(F.collect_list(F.struct("start", "ids")))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    grouped = read_pieces(spark, path).groupBy("shard", "doc_seq", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n_ids").alias("n_tokens"), parts.alias("parts")
    )
    return grouped.select("doc_id", "start", "n_tokens", whole.alias("ids"))


def _times(matrix: list[int], vector: int) -> int:
    """Product over GF(2) of a matrix, given by its columns, and the bits of a vector."""
    out = 0
    while vector:
        out ^= matrix[(vector & -vector).bit_length() - 1]
        vector &= vector - 1
    return out


@lru_cache(maxsize=64)
def _crc_step(k: int) -> list[int]:
    """Matrix that takes a crc32 register over 2 ** k zero bits, by squaring the one-bit step."""
    if not k:
        return [0xEDB88320, *[1 << i for i in range(31)]]  # fixed polynomial of crc32
    half = _crc_step(k - 1)
    return [_times(half, c) for c in half]


def _crc_zeros(crc: int, n: int) -> int:
    """crc32 register after n more zero bytes."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            crc = _times(_crc_step(k + 3), crc)
    return crc


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation, from (crc32, bytes) of its parts in order."""
    total = 0
    for crc, n in parts:
        total = _crc_zeros(total, n) ^ crc
    return total


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of a token folder. Only numbers are shuffled: the crc32 of
    a document that spans blocks is combined from those of its pieces."""
    blocks, pieces = _decoded(spark, path)
    pieces = pieces.select("shard", "doc_seq", "doc_id", F.col("local_start").alias("start"), "n_ids", F.crc32("ids").alias("crc"))
    grouped = pieces.groupBy("shard", "doc_seq", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n_ids").alias("n_tokens"), F.count("*").alias("k"), F.first("crc").alias("crc"),
        F.sort_array(F.collect_list(F.struct("start", "crc", "n_ids"))).alias("parts"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = [
                crc if k == 1 else crc32_joined([(p["crc"], 4 * p["n_ids"]) for p in parts])
                for k, crc, parts in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    parts = F.when(F.col("k") > 1, F.col("parts"))
    grouped = grouped.join(_shard_starts(blocks), "shard").withColumn("start", F.col("base") + F.col("start"))
    out = grouped.select("doc_id", "start", "n_tokens", "k", "crc", parts.alias("parts"))
    return out.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
