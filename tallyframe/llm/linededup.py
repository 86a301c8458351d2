"""Line deduplication: documents probe sharded minimal perfect hashes of the repeated lines.

A line's key is the line without white space at both ends and with A-Z lower-cased, held as
two independent 64-bit hashes. Tasks count the documents of each key in their own rows
before anything is shuffled. The keys of more than one document are cut into shards by their
first hash; a shard's minimal perfect hash (levels of bit arrays with ranks) numbers its keys
without gaps, and at those numbers stand a fingerprint (the second hash), the number of
documents, by which the probing line knows whether they are enough, and the document that keeps
the line. Shards go to the executors in groups of at most ``GROUP_BYTES``; each group is one pass
in which every line of every document probes the arrays. Lines are never joined. Where there are several
groups, the documents are numbered and written once, and a pass writes the numbers of the lines it drops.

Null and empty texts are one empty line. A row is a document, so repeated ids count as
often as they occur and all keep the line if their id is the largest. A null id is below
every other; if no holder has an id, all keep the line. Other columns pass through.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays
from tallyframe.session import staged

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Keys of one shard, about, and bytes of shards that are broadcast at once.
SHARD_KEYS = 50_000
GROUP_BYTES = 64 << 20

NO_ID = -(1 << 63)
U64 = np.uint64
_KEYS = "h1 long, h2 long, docs long, keeper long"


class PerfectHash:
    """A minimal perfect hash of distinct pairs (h1, h2): level by level, keys alone in their slot get its rank."""

    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray]]):
        self.levels = levels  # slots, bits as 64-bit words, rank before each word

    @staticmethod
    def _slots(h1: np.ndarray, h2: np.ndarray, level: int, slots: int) -> np.ndarray:
        return (arrays.mix(h1 ^ arrays.mix(h2, level), level) % U64(slots)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels, base = [], 0
        while len(h1):
            slots = 2 * len(h1) + 64
            at = cls._slots(h1, h2, len(levels), slots)
            alone = np.bincount(at, minlength=slots) == 1
            padded = np.zeros(-(-slots // 64) * 64, bool)
            padded[:slots] = alone
            words = np.packbits(padded, bitorder="little").view(U64)
            ranks = base + np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            levels.append((slots, words, ranks[:-1]))
            base = int(ranks[-1])
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each key; some number or -1 for what is not a key."""
        found, open_ = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (slots, words, ranks) in enumerate(self.levels):
            at = self._slots(h1[open_], h2[open_], level, slots)
            word, bit = words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
            found[open_[hit]] = (ranks[at >> 6] + below)[hit]
            open_ = open_[~hit]
        return found


class Shard:
    """A perfect hash with the fingerprint, the count (32 bits, any more stand as the most) and the keeper of each key."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, docs: np.ndarray, keeper: np.ndarray):
        self.hash = PerfectHash.build(h1, h2)
        at = self.hash.find(h1, h2)
        self.fingerprint, self.docs, self.keeper = np.empty_like(h2), np.empty(len(docs), np.uint32), np.empty_like(keeper)
        self.fingerprint[at], self.docs[at], self.keeper[at] = h2, np.minimum(docs, 0xFFFFFFFF), keeper

    def keepers(self, h1: np.ndarray, h2: np.ndarray, least_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the lines stand in at least ``least_docs`` documents, and the keeper of each."""
        at = self.hash.find(h1, h2)
        known = at >= 0
        known[known] = (self.fingerprint[at[known]] == h2[known]) & (self.docs[at[known]] >= least_docs)
        return known, np.where(known, self.keeper[at], NO_ID)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key hashes, code points of the key and number of lines per text."""
    begins = np.sort(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]), kind="stable")
    counts = np.bincount(np.searchsorted(offsets[1:], np.flatnonzero(data == 10), "right"), minlength=len(offsets) - 1) + 1
    # a line ends before the next one, and before the newline unless it is the text's last
    stops = np.empty_like(begins)
    last = np.cumsum(counts) - 1
    stops[:-1] = begins[1:] - 1
    stops[last] = offsets[1:]
    solid = np.flatnonzero(~np.isin(data, arrays.SPACES))
    first, after = np.searchsorted(solid, begins), np.searchsorted(solid, stops)
    full = after > first
    start, stop = begins.copy(), begins.copy()
    start[full], stop[full] = solid[first[full]], solid[after[full] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lowered = arrays.lower(data)
    hashes = [arrays.span_hashes(lowered, start, stop, which) for which in (0, 1)]
    return hashes[0], hashes[1], points[stop] - points[start], counts


def _line_batches(text: pa.Array) -> Iterator[tuple[int, int, tuple]]:
    data, offsets = arrays.text_buffer(text)
    for first, last in arrays.pieces(offsets):
        yield first, last, lines(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])


def _count_keys(least_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.gathered(batches, 1):
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            parts = []
            for first, last, (h1, h2, points, counts) in _line_batches(batch.column(1)):
                row = np.repeat(np.arange(first, last), counts)
                long = points >= least_chars
                parts.append((h1[long], h2[long], row[long]))
            if not parts:
                continue
            h1, h2, row = (np.concatenate(x) for x in zip(*parts, strict=True))
            if not len(h1):
                continue
            order = np.lexsort((row, h2, h1))
            h1, h2, row = h1[order], h2[order], row[order]
            new_key = np.ones(len(h1), bool)
            new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new_key.copy()
            new_doc[1:] |= row[1:] != row[:-1]
            starts = np.flatnonzero(new_key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1[starts].view(np.int64)),
                    pa.array(h2[starts].view(np.int64)),
                    pa.array(np.add.reduceat(new_doc.astype(np.int64), starts)),
                    pa.array(np.maximum.reduceat(ids[row], starts)),
                ],
                ["h1", "h2", "docs", "keeper"],
            )

    return count


def _pack(group: pa.Table) -> pa.Table:
    columns = [group[c].to_numpy().tobytes() for c in ("h1", "h2", "docs", "keeper")]
    return pa.table({"shard": group["shard"][:1], "keys": pa.array([columns], pa.list_(pa.binary()))})


def _shard(blobs: list[bytes]) -> Shard:
    h1, h2, docs, keeper = (np.frombuffer(b, np.int64) for b in blobs)
    return Shard(h1.view(U64), h2.view(U64), docs, keeper)


def _shard_of(h1: np.ndarray, bits: int) -> np.ndarray:
    return (h1 >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h1), np.int64)


def _build(bits: int):
    def build(group: pa.Table) -> pa.Table:
        shard = _shard(_pack(group)["keys"][0].as_py())
        return pa.table({"shard": group["shard"][:1], "blob": pa.array([pickle.dumps(shard)], pa.binary())})

    return build


def index(docs: DataFrame, text: str, least_chars: int) -> tuple[DataFrame, int]:
    """One row per shard (shard, blob) of the keys of more than one document, and how many leading bits of the first hash name it."""
    counted = docs.select("doc_id", text).mapInArrow(_count_keys(least_chars), _KEYS)
    repeated = counted.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))
    repeated = staged(repeated.filter(F.col("docs") > 1), "repeated-lines")
    bits = max(0, (repeated.count() // SHARD_KEYS)).bit_length()
    shard = F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)
    built = repeated.withColumn("shard", shard).groupBy("shard").applyInArrow(_build(bits), "shard int, blob binary")
    return staged(built, "line-shards"), bits


def _probe(shards: dict[int, Shard], bits: int, least_chars: int, least_docs: int, text: pa.Array, ids: pa.Array) -> pa.Array:
    """Per text the numbers of its lines to drop; null where these shards drop none."""
    ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
    out: list[bytes | None] = [None] * len(text)
    for first, last, (h1, h2, points, counts) in _line_batches(text):
        drop = np.zeros(len(h1), bool)
        row = np.repeat(np.arange(first, last), counts)
        long = np.flatnonzero(points >= least_chars)
        name = _shard_of(h1[long], bits)
        order = np.argsort(name, kind="stable")
        cuts = np.flatnonzero(np.diff(name[order], prepend=-1, append=-2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = long[order[a:b]]
            if (shard := shards.get(int(name[order[a]]))) is not None:
                known, keeper = shard.keepers(h1[some], h2[some], least_docs)
                drop[some] = known & (keeper != ids[row[some]])
        ends = np.cumsum(counts)
        for i in np.unique(row[drop]) - first:
            mine = np.flatnonzero(drop[ends[i] - counts[i] : ends[i]]).astype(np.int32)
            out[first + i] = mine.tobytes()
    return pa.array(out, pa.binary())


def deduplicated(
    docs: DataFrame, text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Add the struct ``_lines``: n_lines, n_dropped and the ``kept`` text. A line stays in every case if ``least_docs`` is 1 and one document has it."""
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    shards, bits = index(docs, text, least_chars)
    sizes = sorted((r["shard"], r["n"]) for r in shards.select("shard", F.length("blob").alias("n")).collect())
    groups: list[list[int]] = [[]]
    held = 0
    for shard, n in sizes:
        if groups[-1] and held + n > group_bytes:
            groups.append([])
            held = 0
        groups[-1].append(shard)
        held += n

    def sent(group: list[int]):
        blobs = {r["shard"]: r["blob"] for r in shards.filter(F.col("shard").isin(group)).collect()} if group else {}
        return spark.sparkContext.broadcast(blobs)

    def dropped_lines(shared) -> Column:
        return _prober(shared, bits, least_chars, least_docs)(F.col(text), F.col("doc_id").cast("long"))

    @F.arrow_udf("n_lines long, n_dropped long, kept string")
    def keep(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for whole, drop in zip(texts.to_pylist(), dropped.to_pylist(), strict=True):
            whole = whole or ""
            out = set(np.frombuffer(drop, np.int32).tolist()) if drop else ()
            n_lines.append(whole.count("\n") + 1)
            n_dropped.append(len(out))
            kept.append("\n".join(x for j, x in enumerate(whole.split("\n")) if j not in out) if out else whole)
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept"]
        )

    if len(groups) == 1:
        return docs.select("*", keep(F.col(text), dropped_lines(sent(groups[0]))).alias("_lines"))
    stored = staged(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("row")), "numbered")
    marks = []
    for group in groups:  # one group's arrays in memory at a time
        shared = sent(group)
        found = stored.select("row", "whole.doc_id", f"whole.{text}").select("row", dropped_lines(shared).alias("dropped"))
        marks.append(staged(found.filter(F.col("dropped").isNotNull()), "dropped-lines"))
        shared.unpersist()
    together = F.aggregate(F.collect_list("dropped"), F.lit(bytearray()), lambda a, x: F.concat(a, x))
    marked = stored.join(reduce(DataFrame.unionByName, marks).groupBy("row").agg(together.alias("dropped")), "row", "left")
    return marked.select("whole.*", keep(F.col(f"whole.{text}"), F.col("dropped")).alias("_lines"))


_opened: dict[str, dict[int, Shard]] = {}


def _prober(shared, bits: int, least_chars: int, least_docs: int):
    name = uuid.uuid4().hex

    @F.arrow_udf("binary")
    def probe(text: pa.Array, ids: pa.Array) -> pa.Array:
        if name not in _opened:  # unpacked once per worker and group
            _opened.clear()
            _opened[name] = {k: pickle.loads(b) for k, b in shared.value.items()}
        return _probe(_opened[name], bits, least_chars, least_docs, text, ids)

    return probe


def lines_query(docs: DataFrame) -> DataFrame:
    found = deduplicated(docs)
    digest: Column = F.sha2(F.col("_lines.kept").cast("binary"), 256)
    return found.select("doc_id", "_lines.n_lines", "_lines.n_dropped", digest.alias("kept_sha256"))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.keeper AS gone FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
