"""Byte-level BPE by corpus-level merge replay.

The distinct pieces of a block of the corpus are laid out once as a chain of symbols. An inverted index maps each
mergeable pair (by its rank) to the positions where it stands, and merges are replayed over the whole block in rank
order: each touches only the positions in its own list and their two neighbours. New pairs enter the index as they
arise; one that ranks below its parent is simply next. Since pieces never interact, a block can be any set of pieces:
every task replays the merges over the pieces it has not met before, and no vocabulary of the corpus is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.units import Memo, distinct_pieces, distinct_units, slices, splitter, worker_encoder


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ReplayEncoder:
    """Encodes and decodes units; `memo_units` bounds what a worker remembers, `pairs` the table of looked-up pairs."""

    def __init__(self, path: str, pattern: str, memo_units: int = 400_000, pairs: int = 2_000_000):
        self.ranks = load_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.pieces, self.find = splitter(pattern)
        self.memo = Memo(memo_units)  # unit -> (decimal ids joined by commas, decoded bytes)
        self.base = np.array(self.single, np.int32)
        rank = [self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.byte_pairs = np.array(rank, np.int32).reshape(256, 256)
        # Rank of the token that a pair merges into, or -1, of the pairs met: by left and right symbol, and by right and left.
        self.by_left: defaultdict[int, dict[int, int]] = defaultdict(dict)
        self.by_right: defaultdict[int, dict[int, int]] = defaultdict(dict)
        self.n_pairs, self.max_pairs = 0, pairs

    def _rank(self, left: int, right: int) -> int:
        """Rank of the token that a pair merges into, or -1; kept in the tables of pairs."""
        rank = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        self.by_left[left][right] = self.by_right[right][left] = rank
        self.n_pairs += 1
        return rank

    def replay(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. A piece that is a token as a whole is that token."""
        if self.n_pairs > self.max_pairs:
            self.by_left.clear()
            self.by_right.clear()
            self.n_pairs = 0
        out = [[] if whole is None else [whole] for whole in map(self.ranks.get, pieces)]
        cut = [i for i, (piece, ids) in enumerate(zip(pieces, out, strict=True)) if piece and not ids]
        if not cut:
            return out
        data = np.frombuffer(b"".join([pieces[i] for i in cut]), np.uint8)
        ends = np.cumsum([len(pieces[i]) for i in cut])
        starts = np.concatenate(([0], ends[:-1]))
        ranks = np.full(len(data), -1, np.int32)  # of the pair that starts here; -1 none
        ranks[:-1] = self.byte_pairs[data[:-1], data[1:]]
        ranks[ends - 1] = -1
        places = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0) :]
        found, at = np.unique(ranks[places], return_index=True)
        index = {rank: p.tolist() for rank, p in zip(found.tolist(), np.split(places, at[1:]), strict=True)} if len(found) else {}
        left, right = np.arange(-1, len(data) - 1), np.arange(1, len(data) + 1)
        left[starts] = right[ends - 1] = -1
        symbols, before, after, rank_at = self.base[data].tolist(), left.tolist(), right.tolist(), ranks.tolist()

        queue, rank_of = list(index), self._rank
        heapq.heapify(queue)
        while queue:
            merged = heapq.heappop(queue)
            places = index.pop(merged)
            places.sort()
            with_right, with_left = self.by_left[merged], self.by_right[merged]
            for x in places:
                if rank_at[x] != merged:
                    continue  # a neighbour has merged since
                y = after[x]
                z = after[x] = after[y]
                symbols[x] = merged
                rank_at[y] = rank_at[x] = -1
                if z >= 0:
                    before[z] = x
                    rank = with_right.get(symbols[z])
                    if rank is None:
                        rank = rank_of(merged, symbols[z])
                    if rank >= 0:
                        rank_at[x] = rank
                        if rank in index:
                            index[rank].append(x)
                        else:
                            index[rank] = [x]
                            heapq.heappush(queue, rank)
                w = before[x]
                if w >= 0:
                    rank = with_left.get(symbols[w])
                    if rank is None:
                        rank = rank_of(symbols[w], merged)
                    rank_at[w] = rank
                    if rank >= 0:
                        if rank in index:
                            index[rank].append(w)
                        else:
                            index[rank] = [w]
                            heapq.heappush(queue, rank)
        # A symbol that was merged away is no longer the one after the symbol before it.
        left = np.array(before)
        alive = (left < 0) | (np.array(after)[left] == np.arange(len(left)))
        kept = np.concatenate(([0], np.cumsum(alive)))
        ids = np.array(symbols)[alive].tolist()
        for i, a, b in zip(cut, kept[starts].tolist(), kept[ends].tolist(), strict=True):
            out[i] = ids[a:b]
        return out

    def _encode(self, units: list[str]) -> Iterator[tuple[str, bytes]]:
        pieces, numbers, counts = distinct_pieces(units, self.pieces, self.find)
        made = self.replay([p.encode("utf-8") for p in pieces])
        done = [(",".join(map(str, ids)), self.decode(ids)) for ids in made]
        numbers, at = numbers.tolist(), 0
        for n in counts.tolist():
            if n == 1:
                yield done[numbers[at]]
            else:
                parts = [done[k] for k in numbers[at : at + n]]
                yield ",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
            at += n

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a sequence of ids."""
        return b"".join([self.tokens[i] for i in ids])

    def texts(self, texts: list[str | None]) -> list[tuple[str, bytes]]:
        """(decimal ids joined by commas, bytes decoded from them) of each text."""
        keys, numbers, counts = distinct_units([t or "" for t in texts], self.find)
        known = self.memo.encode(keys, self._encode)
        ids, data = zip(*map(known.__getitem__, keys), strict=True) if keys else ((), ())
        out = []
        for a, b in pairwise([0, *np.cumsum(counts).tolist()]):
            units = numbers[a:b].tolist()
            out.append((",".join(map(ids.__getitem__, units)), b"".join(map(data.__getitem__, units))))
        return out


def replay_encoder(path: str, pattern: str) -> ReplayEncoder:
    """The worker's encoder; its memo outlives a task."""
    return worker_encoder(ReplayEncoder, path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`docs` (doc_id, text) -> (doc_id, n_tokens, ids: array<int>, decoded_sha256), row by row; the digest is that of
    the bytes decoded from the ids. Null and empty texts have no ids; rows with null or repeated doc_id are encoded
    like any other. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = replay_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                made = encoder.texts(part.column(1).to_pylist())
                ids = [np.fromstring(s, np.int32, sep=",") for s, _ in made]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(ends, np.concatenate(ids)),
                        pa.array([hashlib.sha256(data).hexdigest() for _, data in made], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded_sha256"],
                )

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, decoded: binary). Null ids give empty bytes; an id outside the vocabulary fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = replay_encoder(path, pattern)
        for batch in batches:
            data = [encoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: the round trip without moving the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = replay_encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                made = encoder.texts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in made], pa.int64()),
                        pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids, _ in made], pa.string()),
                        pa.array([hashlib.sha256(data).hexdigest() for _, data in made], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
