"""Splitting texts into units that byte-level BPE encodes independently, with a bounded memo per Python worker.

Both vocabularies split text by the same pattern, in which a single space always opens a new piece when something
other than white space follows, and a lone line break after a non-space is a piece of its own unless the text ends there. Texts
without any other white space can therefore be split by plain string methods; all others go through the pattern. A unit is
encoded once per worker as long as the memo has room, which costs a look-up per unit afterwards.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, filterfalse, islice
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex


def splitter(pattern: str) -> tuple[Callable[[str], list[str]], Callable[[str], list[str]]]:
    """Functions from a unit, and from any text, to the pieces that `pattern` cuts it into."""
    find = regex.compile(pattern).findall
    ends = {",", "."}

    def pieces(unit: str) -> list[str]:
        body = unit[1:] if unit[0] == " " else unit
        if body.isalpha() and body.isascii():
            return [unit]
        if body[-1:] in ends and body[:-1].isalpha() and body.isascii():
            return [unit[:-1], unit[-1]]
        return find(unit)

    return pieces, find


def _spaced(text: str) -> str | None:
    """A text whose units stand between single spaces, None where only the pattern can cut it."""
    spaced = text.replace("\n", " \n")
    if spaced[0] == " " or spaced[-1] == " " or "  " in spaced or "\n\n" in text or text[-1] == "\n":
        return None
    return spaced if text.replace("\n", "").isprintable() else None


def units_of(text: str, find: Callable[[str], list[str]]) -> list[str]:
    """Keys of a text's units, in order. The key of a unit that opens with a space leaves the space out, one that
    opens with a line break is the unit itself, and any other is marked by a leading zero character."""
    if not text:
        return []
    spaced = _spaced(text)
    if spaced is None:
        return ["\0" + piece for piece in find(text)]
    return ("\0" + spaced).split(" ")


def distinct_units(texts: list[str], find: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct keys in some texts, the number of the key of every unit, and the number of units of each text.

    Arrow cuts and numbers the units of all texts in one go, so that only distinct ones become Python strings.
    """
    spaced = [_spaced(t) if t else "" for t in texts]
    counts = np.array([s.count(" ") + 1 if s else 0 for s in spaced], np.int64)
    plain = " ".join(["\0" + s for s in spaced if s])
    keys, numbers = [], np.empty(0, np.int32)
    if plain:
        units = pc.split_pattern(pa.array([plain], pa.large_string()), " ").values.dictionary_encode()
        numbers = units.indices.to_numpy()
        words = pa.ListArray.from_arrays([0, len(units.dictionary)], units.dictionary.cast(pa.string()))
        keys = pc.binary_join(words, " ")[0].as_py().split(" ")
    hard = np.flatnonzero([s is None for s in spaced])
    if not len(hard):
        return keys, numbers, counts
    # Texts that the pattern cuts come after the others, and then back into the order of the texts.
    cut = [["\0" + piece for piece in find(texts[i])] for i in hard.tolist()]
    counts[hard] = list(map(len, cut))
    place = {k: i for i, k in enumerate(keys)}
    more = [place.setdefault(k, len(place)) for k in chain.from_iterable(cut)]
    first = np.concatenate((np.setdiff1d(np.arange(len(texts)), hard), hard))
    starts = np.empty(len(texts), np.int64)
    starts[first] = np.cumsum(counts[first]) - counts[first]
    return list(place), np.concatenate((numbers, np.array(more, np.int32)))[ragged(starts, counts)], counts


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of several runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def unit_text(key: str) -> str:
    """The unit that a key stands for."""
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


def distinct_pieces(
    units: list[str], pieces: Callable[[str], list[str]], find: Callable[[str], list[str]]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of some units (given by key), the number of every piece, and the number of pieces of each
    unit. Units that open with a space are cut in one go: only their first pieces do."""
    spaced = [u for u in units if u[0] not in "\0\n"]
    cut = pa.array(find(" " + " ".join(spaced)) if spaced else [], pa.large_string())
    starts = np.flatnonzero(pc.starts_with(cut, " "))
    if len(starts) == len(spaced) < len(units):
        apart = [[] if u[0] not in "\0\n" else pieces(unit_text(u)) for u in units]
        own = pa.array(list(chain.from_iterable(apart)), pa.large_string())
        counts = np.fromiter(map(len, apart), np.int64, len(units))
        hard = np.array([u[0] in "\0\n" for u in units])
        first = np.empty(len(units), np.int64)
        first[hard] = len(cut) + np.cumsum(counts[hard]) - counts[hard]
        first[~hard], counts[~hard] = starts, np.diff(starts, append=len(cut))
        numbered = pa.concat_arrays([cut, own]).dictionary_encode()
        numbers = numbered.indices.to_numpy()[ragged(first, counts)]
    else:
        counts = np.diff(starts, append=len(cut))
        if len(starts) != len(spaced):
            apart = [pieces(unit_text(u)) for u in units]
            cut = pa.array(list(chain.from_iterable(apart)), pa.large_string())
            counts = np.fromiter(map(len, apart), np.int64, len(units))
        numbered = cut.dictionary_encode()
        numbers = numbered.indices.to_numpy()
    return numbered.dictionary.to_pylist(), numbers, counts


class Memo(dict):
    """Unit -> encoded form. Holds at most `limit` units: beyond it, units are encoded again where they occur. A full
    memo stays, since it has the frequent units, until it knows less than half of what is asked of it: then the next
    task starts afresh. So memory stays bounded and the memo follows the texts at hand."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.over: dict = {}  # units of the groups at hand that found no room
        self.asked = self.unknown = 0  # of the full memo, in this task

    def __missing__(self, unit: str):
        return self.over[unit]

    def start_task(self) -> None:
        """Call at the start of a task. Units make millions of small objects and no cycles, so the worker looks for
        cycles less often. What Arrow has kept of an earlier task's texts goes back."""
        gc.set_threshold(1_000_000, 50, 100)
        pa.default_memory_pool().release_unused()
        if 2 * self.unknown > self.asked:
            self.clear()
        self.asked = self.unknown = 0

    def encode(self, units: Sequence[str], encode: Callable[[list[str]], Iterable]) -> dict:
        """A mapping that has every one of some distinct units, until the next call."""
        self.over = {}
        missing = list(filterfalse(self.__contains__, units))
        if len(self) >= self.limit:
            self.asked += len(units)
            self.unknown += len(missing)
        if missing:
            made = zip(missing, encode(missing), strict=True)
            self.update(islice(made, max(0, self.limit - len(self))))
            self.over = dict(made)
        return self


_ENCODERS: dict[tuple, Any] = {}  # of this worker; one at most


def worker_encoder(make: type, *args: Any) -> Any:
    """The worker's encoder, made if it has another one or none; its memo outlives a task."""
    if (make, args) not in _ENCODERS:
        free_encoders()
        _ENCODERS[make, args] = make(*args)
    _ENCODERS[make, args].memo.start_task()
    return _ENCODERS[make, args]


def free_encoders() -> None:
    """Frees the encoder that an earlier task has left, some 200 MB. A worker serves all queries of a session, so
    operators that read whole texts and encode nothing call this when a task starts."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: int, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about `chars` bytes of text each, one row at least."""
    texts, start, held = batch.column(column), 0, 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for row, size in enumerate(sizes):
        if held and held + size > chars:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
