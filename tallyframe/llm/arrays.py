"""Vectorised text work on Arrow batches: bytes, words, lines and 64-bit hashes of them in numpy.

A text column becomes one byte buffer and the offsets of its texts. Null texts count as
empty. All functions see whole texts; ``pieces`` only bounds how many texts are in memory
as 64-bit columns at once.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

U64 = np.uint64
#: Bytes per piece; a single longer text is a piece of its own.
PIECE = 1 << 18
#: Bytes of text that a task packs together, about, and rows of the batches that come to it.
GATHER = 6 << 20
RECORDS = 500
#: Bytes of such a batch, about; one row may be larger.
BATCH_BYTES = 4 << 20

#: The white space of the contracts, ``[\x20\x09-\x0D]``.
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[SPACES] = False

#: Odd multiplier of the hashes of word runs.
_RUN = 0xC2B2AE3D27D4EB4F
# a span hash is a pair of polynomials modulo two primes; modulo a power of two, some pairs of texts collide under every base
_PRIMES = (2147483647, 2147483629)
_BASES = ((1640531527, 1013904223), (1181783497, 1597334677))
_powers: dict[int, tuple[tuple[np.ndarray, np.ndarray], ...]] = {}
#: Terms of a polynomial that a 64-bit sum surely holds without reducing them first.
_SHORT = 1 << 23

_stage: list[int] = []


def release_memory() -> None:
    """Give back what tasks of an earlier stage left in this worker: tables, Arrow's pool and the free heap."""
    context = TaskContext.get()
    if context is None or _stage == [context.stageId()]:
        return
    _stage[:] = [context.stageId()]
    _powers.clear()
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    """Give back the free memory of this worker, which is idle while the JVM works."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64), one per seed."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts, from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``size`` bytes each, and one text at least."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def bound_batches(spark) -> None:
    """Let Arrow batches have at most ``RECORDS`` rows and about ``BATCH_BYTES``, unless the session has numbers of its own.

    The default of 10,000 texts of a few kB is tens of MB per buffer, several of which a task holds. Rows of two sets of
    shingles have up to some hundred kB each, so that 500 of them are as much.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, RECORDS)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size) == "67108864b":
        spark.conf.set(size, BATCH_BYTES)


def gathered(batches: Iterator[pa.RecordBatch], text: int, size: int = GATHER) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of the text column, and one text at least."""
    release_memory()
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        _, offsets = text_buffer(batch.column(text))
        for first, last in pieces(offsets, size):
            held.append(batch.slice(first, last - first))
            n += int(offsets[last] - offsets[first])
            if n >= size:
                yield pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield pa.concat_batches(held)
        held = []
    trim_memory()


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and how many each text has."""
    inside = _IN_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = np.unique(offsets)
    starts_of_texts = edges[edges < len(data)]
    begins[starts_of_texts] = inside[starts_of_texts]
    ends_of_texts = edges[edges > 0] - 1
    ends[ends_of_texts] = inside[ends_of_texts]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.diff(np.searchsorted(starts, offsets))


def _powers_of(base: int, prime: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo ``prime``."""
    table = np.ones(n, U64)
    done, factor = 1, base % prime
    while done < n:
        more = min(done, n - done)
        table[done : done + more] = table[:more] * U64(factor) % U64(prime)
        factor = factor * factor % prime
        done += more
    return table.astype(np.uint32)


def _power_table(which: int, n: int) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """Per prime the powers of the base and of its inverse."""
    have = _powers.get(which)
    if have is None or len(have[0][0]) <= n:
        size = -(-max(n, 1) // PIECE) * PIECE + 1
        table = tuple(
            (_powers_of(base, prime, size), _powers_of(pow(base, -1, prime), prime, size))
            for base, prime in zip(_BASES[which], _PRIMES)
        )
        if size > 17 * PIECE:  # one very long text does not stay in memory
            return table
        have = _powers[which] = table
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes wherever they stand."""
    values, sums = data.astype(U64) + U64(1), np.zeros(len(data) + 1, U64)
    whole = np.zeros(len(starts), U64)
    for (power, inverse), prime in zip(_power_table(which, len(data)), _PRIMES):
        terms = values * power[: len(data)]
        if len(data) > _SHORT:
            terms %= U64(prime)
        np.cumsum(terms, out=sums[1:])
        part = (sums[stops] - sums[starts]) % U64(prime) * inverse[starts] % U64(prime)
        whole = (whole << U64(32)) | part
    with np.errstate(over="ignore"):
        return mix(whole + (stops - starts).astype(U64) * U64(_RUN), which)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and how many each text has.

    A text of fewer words, but not none, gives its whole sequence as one.
    """
    n = len(words)
    first = np.concatenate([[0], np.cumsum(counts)])
    left = np.repeat(first[1:], counts) - np.arange(n)  # words from here to the end of the text
    length = np.minimum(left, size)
    total = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        factor = U64(1)
        for j in range(min(size, n)):
            part = np.zeros(n, U64)
            part[: n - j] = words[j:]
            total += np.where(j < length, part, U64(0)) * factor
            factor *= U64(_RUN)
        hashes = mix(total + length.astype(U64), 7)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    place = np.arange(n) - np.repeat(first[:-1], counts)
    return hashes[place < np.repeat(made, counts)], made


def distinct_per_text(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text once and ascending, and how many there are."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[keep], np.bincount(text[keep], minlength=len(counts)).astype(np.int64)


def text_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values; an empty run gives 0."""
    total = np.zeros(len(values) + 1, values.dtype)
    with np.errstate(over="ignore"):
        np.cumsum(values, out=total[1:])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]
