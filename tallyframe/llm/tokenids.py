"""Token ids in binary files, packed with a word-aligned code in 64-bit words (Simple-8b).

A word is a selector (the upper 4 bits) and as many ids of equal width as fit into 60 bits.
Ids of ``ESCAPE`` and more stand as ``ESCAPE`` in the words and in full in the list of escapes.
Every block of ``BLOCK`` ids starts a new word, so that all blocks of a file can be packed and
unpacked at once in numpy; the file has the first word of each block.

A file set is a Parquet folder. A row is a chunk of whole documents in order: its place
(``part``, ``chunk``, ids ``before`` it in the part), the documents' ids and lengths, and ``words``, ``block_words`` and
``escapes`` as little-endian arrays. Documents are range-partitioned and sorted by ``doc_id``
(nulls first, equal ids by text), so parts and chunks in order are the documents in order.

Null texts are empty: they have the end id only. Every row is a document of its own, also
with a repeated id. Only ``doc_id`` and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import arrays
from tallyframe.session import shuffles_removed

END_ID = 2
#: Fixed values of the code: bits per id by selector; 60 // bits ids are in a word.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
PER_WORD = 60 // WIDTHS
ESCAPE = (1 << 20) - 1
BLOCK = 240
#: Text bytes of a chunk, about; it has at least one document.
CHUNK_BYTES = 2 << 20

_FILE = "part int, chunk int, before long, n_ids long, docs binary, no_id binary, lengths binary, words binary, block_words binary, escapes binary"
U64 = np.uint64


def _selectors(wide: np.ndarray) -> np.ndarray:
    """For every place the code with the most ids that fit from there on, by the ids' bits."""
    n = len(wide)
    most = {1: wide}  # largest of the next 1, 2, 4, ... ids
    for k in (1, 2, 4, 8, 16):
        most[2 * k] = most[k].copy()
        np.maximum(most[k][: n - k], most[k][k:], out=most[2 * k][: n - k])
    best = np.full(n, len(WIDTHS) - 1, np.int8)
    for s in range(len(WIDTHS) - 2, -1, -1):
        run = int(PER_WORD[s])
        k = 1 << (run.bit_length() - 1)
        top = most[min(k, 32)]
        fits = top <= WIDTHS[s]
        if not fits.any():
            break
        for shift in (run - min(k, 32),) if run <= 32 else (run - 32,):
            if shift:
                fits[: n - shift] &= top[shift:] <= WIDTHS[s]
        best[fits] = s
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, escapes."""
    big = ids >= ESCAPE
    escapes = ids[big].astype(np.uint32)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, U64), np.zeros(0, np.uint32), escapes
    values = np.zeros(blocks * BLOCK, np.uint32)
    values[: len(ids)] = np.where(big, ESCAPE, ids)
    left = np.full(blocks, BLOCK)
    left[-1] = len(ids) - (blocks - 1) * BLOCK
    stride = BLOCK + int(PER_WORD[0])  # past its end a block has zeros, which fit everywhere
    lanes = np.zeros((blocks, stride), np.uint32)
    lanes[:, :BLOCK] = values.reshape(blocks, BLOCK)
    lanes = lanes.reshape(-1)
    best = _selectors(np.frexp(lanes.astype(np.float32))[1].astype(np.int8))

    # all blocks go from word to word together
    begin = np.arange(blocks) * stride
    at, stop = begin.copy(), begin + left
    places, chosen = [], []
    while len(at):
        s = best[at]
        places.append(at)
        chosen.append(s)
        at = at + PER_WORD[s]
        more = at < stop
        at, stop = at[more], stop[more]
    where, selector = np.concatenate(places), np.concatenate(chosen)
    order = np.argsort(where)
    where, selector = where[order], selector[order].astype(np.int64)
    words = selector.astype(U64) << U64(60)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        from_, packed_ = where[mine], words[mine]
        for j in range(PER_WORD[s]):
            packed_ |= lanes[from_ + j].astype(U64) << U64(j * WIDTHS[s])
        words[mine] = packed_
    return words, np.searchsorted(where, begin).astype(np.uint32), escapes


def unpack(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids that were packed."""
    if not n:
        return np.zeros(0, np.uint32)
    selector = (words >> U64(60)).astype(np.int64)
    per = PER_WORD[selector]
    block = np.repeat(np.arange(len(block_words)), np.diff(block_words, append=len(words)))
    upto = np.cumsum(per) - per
    inside = upto - upto[block_words.astype(np.int64)][block]  # place of the word's first id in its block
    lanes = np.zeros((len(block_words), BLOCK + int(PER_WORD[0])), np.uint32)
    flat = lanes.reshape(-1)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        shifts = (np.arange(PER_WORD[s]) * WIDTHS[s]).astype(U64)
        mask = U64((1 << int(WIDTHS[s])) - 1)
        values = (words[mine][:, None] >> shifts[None, :]) & mask
        place = (block[mine] * lanes.shape[1] + inside[mine])[:, None] + np.arange(PER_WORD[s])[None, :]
        flat[place] = values
    ids = lanes[:, :BLOCK].reshape(-1)[:n].copy()
    ids[ids == ESCAPE] = escapes
    return ids


# A piece of a text is what the tokenizer surely splits off: it ends before a space that a word follows,
# between an ASCII letter and punctuation, and around a single newline. Pieces are tokenized by themselves,
# and equal ones once. Bytes that may begin white space or letters elsewhere make no border.
_LETTER, _MARK, _SOLID = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_SOLID[[*range(0x21, 0x7F), *range(0x80, 0x100)]] = True
_SOLID[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_WORD = re.compile("\x20?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02AF]+")
# byte-level vocabularies write a byte as the character of that number if it is printable, else as one from 256 on
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_CHARS = [chr(_BYTE_CHARS.get(b, b)) for b in range(256)]
#: Pieces that a worker remembers between batches.
REMEMBERED = 800_000


class Encoder:
    """Ids of texts by a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()
        # a byte-level tokenizer that splits at spaces leaves a word whole, so the word goes to the model at once
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ab c") if self.tokenizer.pre_tokenizer else []
        self.byte_level = self.tokenizer.normalizer is None and [x for x, _ in split] == ["\u0120ab", "\u0120c"]
        self.model = self.tokenizer.model

    def _ids(self, piece: bytes) -> list[int]:
        text = piece.decode()
        if self.byte_level and _WORD.fullmatch(text):
            return [t.id for t in self.model.tokenize("".join(map(_CHARS.__getitem__, piece)))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _all_ids(self, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> list[list[int]]:
        """The ids of each piece; words of ASCII letters, which are most of them, go to the model straight from the text."""
        if not self.byte_level:
            return [self._ids(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        data = np.frombuffer(raw, np.uint8)
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        begins = starts + (data[starts] == 32)
        plain = (letters[stops] - letters[begins] == stops - begins) & (stops > begins)
        text, tokenize, heads = raw.decode("latin-1"), self.model.tokenize, ("", _CHARS[32])
        return [
            [t.id for t in tokenize(heads[c - a] + text[c:b])] if word else self._ids(raw[a:b])
            for a, c, b, word in zip(starts.tolist(), begins.tolist(), stops.tolist(), plain.tolist(), strict=True)
        ]

    def forget(self) -> None:
        """Known pieces as arrays: hashes, ascending, with begin and number of their ids in ``ids``."""
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _look_up(self, hashes: np.ndarray, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of the ids of distinct pieces in ``ids``; unknown ones are tokenized and added."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        fresh = np.flatnonzero(new)
        fresh = fresh[np.argsort(hashes[fresh])]
        found = self._all_ids(raw, starts[fresh], stops[fresh]) if len(fresh) else []
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        begins = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))])
        self.hashes, self.begins, self.lengths = (
            np.insert(old, at[fresh], some) for old, some in ((self.hashes, hashes[fresh]), (self.begins, begins), (self.lengths, lengths))
        )
        at = np.searchsorted(self.hashes, hashes)
        return self.begins[at], self.lengths[at]

    def _borders(self, data: np.ndarray, raw: bytes) -> np.ndarray:
        """Places before which a piece ends."""
        now, next_ = data[:-1], data[1:]
        solid = _SOLID[data]
        after_space = np.flatnonzero((now == 32) & solid[1:])
        if any(a in raw for a in self.added):  # such a token can have borders inside
            return after_space
        letter, mark = _LETTER[data], _MARK[data]
        border = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        line = np.flatnonzero((data[1:-1] == 10) & solid[:-2] & solid[2:]) + 1
        border[line - 1] = border[line] = True
        border[np.flatnonzero(now == 32)] = False
        return np.sort(np.concatenate([after_space, np.flatnonzero(border) + 1]), kind="stable")

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        counts = np.diff(offsets)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(counts), np.int64)
        raw = data.tobytes()
        starts = np.sort(np.concatenate([offsets[:-1][counts > 0], self._borders(data, raw)]), kind="stable")
        starts = starts[np.diff(starts, prepend=-1) > 0]
        stops = np.append(starts[1:], len(data))
        which, distinct = pd.factorize(arrays.span_hashes(data, starts, stops))
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        begins, lengths = self._look_up(distinct, raw, starts[first], stops[first])
        per_piece = lengths[which]
        ends = np.cumsum(per_piece)
        shift = begins[which] - (ends - per_piece)
        ids = self.ids[np.repeat(shift, per_piece) + np.arange(ends[-1])]
        upto = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
        return ids, np.diff(upto)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer stays in the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(lengths), end_id).astype(np.uint32)


def _encode_part(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        part, chunk, before = TaskContext.get().partitionId(), 0, 0
        for batch in arrays.gathered(batches, 1, CHUNK_BYTES):
            data, offsets = arrays.text_buffer(batch.column(1))
            docs = batch.column(0)
            no_id = docs.is_null().to_numpy(zero_copy_only=False)
            docs = docs.fill_null(0).to_numpy(zero_copy_only=False)
            for first, last in arrays.pieces(offsets, CHUNK_BYTES):
                ids, lengths = encode(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                ids = _with_end(ids, lengths, end_id)
                words, block_words, escapes = pack(ids)
                blobs = [
                    docs[first:last].astype("<i8"), no_id[first:last], (lengths + 1).astype("<u4"),
                    words.astype("<u8"), block_words.astype("<u4"), escapes.astype("<u4"),
                ]
                heads = [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([before]), pa.array([len(ids)])]
                names = ["part", "chunk", "before", "n_ids", "docs", "no_id", "lengths", "words", "block_words", "escapes"]
                yield pa.RecordBatch.from_arrays(heads + [pa.array([b.tobytes()], pa.binary()) for b in blobs], names)
                chunk, before = chunk + 1, before + len(ids)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, text: str = "text", end_id: int = END_ID) -> None:
    """Tokenize ``docs`` and write them to the folder ``path`` in ascending ``doc_id`` order."""
    arrays.bound_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = slim.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    with shuffles_removed(docs.sparkSession):  # what is read later is the folder
        ordered.mapInArrow(_encode_part(tokenizer, end_id), _FILE).write.option("compression", "none").parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            get = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: B023, E731
            lengths = get("lengths", "<u4").astype(np.int64)
            ids = unpack(get("words", "<u8"), get("block_words", "<u4"), get("escapes", "<u4"), row["n_ids"]).astype("<u4")
            ends = np.cumsum(lengths)
            raw = ids.tobytes()
            n = len(lengths)
            blobs = [raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["part"], np.int32)), pa.array(get("docs", "<i8"), mask=get("no_id", bool)),
                    pa.array(row["before"] + ends - lengths), pa.array(lengths), pa.array(blobs, pa.binary()),
                ],
                ["part", "doc_id", "inside", "n_tokens", "ids"],
            )


_READ = "part int, doc_id long, inside long, n_tokens long, ids binary"


def read_ids(spark, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (bytes)."""
    files = spark.read.parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part, of which there are as many as shuffle partitions
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    found = files.mapInArrow(_decode, _READ).join(F.broadcast(parts), "part")
    return found.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids")


def packed(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write the ids of ``docs`` to ``path`` and read them back."""
    write_ids(docs, path, tokenizer)
    return read_ids(docs.sparkSession, path)


def ids_query(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    return packed(docs, path, tokenizer).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
