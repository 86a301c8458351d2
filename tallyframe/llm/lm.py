"""Language-model scoring with a hierarchical Pitman-Yor model.

Two levels of Chinese restaurants: one restaurant per context, a context being the 64-bit hash
of the word before, and their shared parent, whose base is uniform over the
words seen and one for all others. A customer of a context restaurant is a token; its tables
are the customers of the parent. A Gibbs step takes all customers of one dish (word) out of a
restaurant and seats them again one after the other, each at a new table with probability in
proportion to (strength + discount * tables) * parent's probability. Customers after the first
``EXACT`` of a dish are seated in runs of an eighth of those before, with the probability
held within a run. All dishes of a part are sampled together in numpy; the numbers of
tables per context are brought together after every round: each part sends the sums of the
contexts that it has to the context's home, which answers with the sums of all. Words, contexts and counts are
written once, in buckets, and so is the order in which a home answers; a round moves numbers of tables alone, of
one or two bytes mostly. Probabilities are averaged over the samples of the last ``SAMPLES`` rounds.

Everything of a word (count, seating, scores of its tokens) is in the part that its hash
names, also the contexts of texts that teach nothing, with a count of 0. Tasks count the (word, context) pairs of a batch before sending them. Tokens to be
scored travel as packed arrays of a batch; words that make up more than half of an average
part are spread over several parts, each with a copy of that word's seating. What goes to
all tasks is a few sums, and at most ``2 * parts`` frequent words.

Null and empty texts are the end token alone. Rows with a null ``doc_id`` are not held out but
teach nothing. Repeated rows count each for itself. Only ``doc_id`` and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays
from tallyframe.llm.langid import held_out
from tallyframe.session import discard, shuffles_removed, staged

STRENGTH = 1.0
EXACT = 256
BURN_IN, SAMPLES = 1, 2
#: Bytes of text for each part of the model, and for each home of contexts; a task holds one part or one home.
PART_BYTES, HOME_BYTES = 8 << 20, 32 << 20
LEAST_PARTS = 12
#: Shares of the documents that are scored one after the other: tokens of one share at a time are on disk.
SHARES = 3

U64 = np.uint64
START, END = U64(0x5EED0001), U64(0x5EED0002)

# what a part never changes: words, pairs of each, per pair the context's place in the part's keys and the count;
# how many of its keys each home has, and for each of these the keys with their customers in this part
_FIXED = (
    "part int, words binary, runs binary, contexts binary, counts binary, homes binary,"
    " asked array<struct<home: int, keys: binary, customers: binary>>"
)
_SCALARS = ["n", "v", "t", "r", "once", "twice", "root_once", "root_twice"]
# what a round changes: tables per pair and sample, the parent's tables per word and sample (latest last), the
# sums of tables per context by its home, in the order of the keys, and sums over the part
_ROUND = (
    "tables array<binary>, roots array<binary>, sent array<struct<home: int, seats: array<binary>>>, "
    + ", ".join(f"{c} long" for c in _SCALARS)
)
# per home: the parts that asked, how many contexts each has, the place of each among the home's, and customers of these
_ROUTES = "home int, parts binary, sizes binary, places binary, customers binary"
_ANSWER = "part int, home int, seats array<binary>"
# a part of the finished model; seats are customers and tables per sample of its contexts, over all parts
_STATE = (
    "part int, words binary, runs binary, contexts binary, counts binary, tables array<binary>, roots array<binary>,"
    " keys binary, seats array<binary>"
)
_COUNTED = "part int, words binary, runs binary, contexts binary, counts binary"
_ASKED = pa.list_(pa.struct([("home", pa.int32()), ("keys", pa.binary()), ("customers", pa.binary())]))
_SENT = pa.list_(pa.struct([("home", pa.int32()), ("seats", pa.list_(pa.binary()))]))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest, after one byte that tells how many."""
    width = next(k for k in (1, 2, 4, 8) if k == 8 or not len(values) or int(values.max()) < 1 << 8 * k)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def part_count(texts: DataFrame) -> int:
    """Parts that the bytes of the texts ask for, however the session deals its shuffles.

    What parts and homes send each other is a row per part and home that share a context, so their numbers follow the texts.
    """
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_PARTS, -(-size // PART_BYTES))


def dealt(blocks: DataFrame, parts: int) -> DataFrame:
    """Rows by part, in as many tasks as there are parts: each then fetches and sorts little."""
    return blocks.repartition(parts, "part")


def _parts_of(words: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of the hashes."""
    return ((words >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with the end token, contexts, tokens per text."""
    words, counts = [], []
    for first, last in arrays.pieces(offsets):
        some = arrays.lower(data[offsets[first] : offsets[last]])
        starts, stops, n = arrays.word_spans(some, offsets[first : last + 1] - offsets[first])
        words.append(np.insert(arrays.span_hashes(some, starts, stops), np.cumsum(n), END))
        counts.append(n + 1)
    if not words:
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64)
    word, n = np.concatenate(words), np.concatenate(counts)
    before = np.concatenate([[START], word[:-1]]).astype(U64)
    before[np.cumsum(n) - n] = START
    return word, before, n


def _grouped(words: np.ndarray, contexts: np.ndarray, counts: np.ndarray | None = None):
    """Distinct words, pairs per word, contexts and counts of the distinct pairs, in order."""
    order = np.argsort(contexts, kind="stable")
    order = order[np.argsort(words[order], kind="stable")]
    words, contexts = words[order], contexts[order]
    new_word = np.ones(len(words), bool)
    new_word[1:] = words[1:] != words[:-1]
    new_pair = new_word.copy()
    new_pair[1:] |= contexts[1:] != contexts[:-1]
    pairs = np.flatnonzero(new_pair)
    if counts is None:
        counts = np.diff(pairs, append=len(words))
    else:
        counts = np.add.reduceat(counts[order], pairs) if len(pairs) else counts[:0]
    heads = np.flatnonzero(new_word[pairs])
    return words[pairs][heads], np.diff(heads, append=len(pairs)), contexts[pairs], counts


def _count(n_parts: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.gathered(batches, 0):
            word, context, n = tokens(*arrays.text_buffer(batch.column(0)))
            learned = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), n)
            words, runs, contexts, counts = _grouped(word, context, learned)
            parts = _parts_of(words, n_parts)
            cuts = np.flatnonzero(np.diff(parts, prepend=-1, append=-2))
            at = np.concatenate([[0], np.cumsum(runs)])
            rows = [
                (int(parts[a]), words[a:b].tobytes(), runs[a:b].astype("<u4").tobytes(),
                 contexts[at[a] : at[b]].tobytes(), counts[at[a] : at[b]].astype("<u4").tobytes())
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                ["part", "words", "runs", "contexts", "counts"],
            )

    return count


@dataclass
class Seating:
    """One part of the model; words, keys and seats are only there where they are needed."""

    words: np.ndarray
    runs: np.ndarray
    contexts: np.ndarray
    counts: np.ndarray
    tables: list[np.ndarray]
    roots: list[np.ndarray]
    keys: np.ndarray
    seats: list[np.ndarray]

    @classmethod
    def read(cls, row: dict) -> Seating:
        hashes = lambda name: np.frombuffer(row.get(name) or b"", "<u8")
        many = lambda name: [unpack(b) for b in row.get(name) or []]
        return cls(
            hashes("words"), unpack(row["runs"]), unpack(row["contexts"]), unpack(row["counts"]),
            many("tables"), many("roots"), hashes("keys"), many("seats"),
        )

    def fixed(self) -> dict[str, pa.Array]:
        blob = lambda b: pa.array([b], pa.binary())
        return {
            "words": blob(self.words.tobytes()), "runs": blob(pack(self.runs)),
            "contexts": blob(pack(self.contexts)), "counts": blob(pack(self.counts)),
        }

    def row(self, part: int) -> pa.Table:
        many = lambda x: pa.array([[pack(v) for v in x]], pa.list_(pa.binary()))
        return pa.table(
            {
                "part": pa.array([part], pa.int32()), **self.fixed(), "tables": many(self.tables), "roots": many(self.roots),
                "keys": pa.array([self.keys.tobytes()], pa.binary()), "seats": many(self.seats),
            }
        )

    def round(self, homes: np.ndarray, whole: bool) -> dict[str, pa.Array]:
        """What a round changes, with the sums per context of the latest tables, or of all that are kept."""
        many = lambda x: pa.array([[pack(v) for v in x]], pa.list_(pa.binary()))
        sums = [self.per_context(x) for x in (self.tables if whole else self.tables[-1:])]
        sent = [{"home": h, "seats": [pack(x[a:b]) for x in sums]} for h, a, b in _spans(homes)]
        scalars = dict(zip(_SCALARS, self.scalars(), strict=True))
        return {
            "tables": many(self.tables), "roots": many(self.roots), "sent": pa.array([sent], _SENT),
            **{c: pa.array([int(x)], pa.int64()) for c, x in scalars.items()},
        }

    def scalars(self) -> list[int]:
        """What ``_SCALARS`` names, of the part."""
        per_word = self.per_word(self.tables[-1])
        return [
            self.counts.sum(), (self.per_word(self.counts) > 0).sum(), per_word.sum(), self.roots[-1].sum(),
            (self.counts == 1).sum(), (self.counts == 2).sum(), (per_word == 1).sum(), (per_word == 2).sum(),
        ]

    def per_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.contexts, values).astype("<i8")

    def per_word(self, values: np.ndarray) -> np.ndarray:
        return arrays.text_sums(values, self.runs)


def _spans(homes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Homes with keys of a part, and where these begin and end."""
    ends = np.cumsum(homes)
    for h in np.flatnonzero(homes).tolist():
        yield h, int(ends[h] - homes[h]), int(ends[h])


def _merge(n_homes: int):
    def merge(group: pa.Table) -> pa.Table:
        words, contexts, counts = [], [], []
        for row in group.to_pylist():
            words.append(np.repeat(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["runs"], "<u4")))
            contexts.append(np.frombuffer(row["contexts"], "<u8"))
            counts.append(np.frombuffer(row["counts"], "<u4").astype(np.int64))
        w, runs, c, n = _grouped(*map(np.concatenate, (words, contexts, counts)))
        keys, places = np.unique(c, return_inverse=True)
        tables = np.minimum(n, 1)
        mine = Seating(w, runs, places, n, [tables], [np.minimum(arrays.text_sums(tables, runs), 1)], keys, [])
        homes = np.bincount(_parts_of(keys, n_homes), minlength=n_homes)
        customers = mine.per_context(n)
        asked = [{"home": h, "keys": keys[a:b].tobytes(), "customers": pack(customers[a:b])} for h, a, b in _spans(homes)]
        return pa.table(
            {
                "part": group["part"].slice(0, 1), **mine.fixed(), "homes": pa.array([pack(homes)], pa.binary()),
                "asked": pa.array([asked], _ASKED), **mine.round(homes, False),
            }
        )

    return merge


@dataclass(frozen=True)
class Totals:
    """Sums over all parts for one sample."""

    tokens: float
    words: float
    root_customers: float
    root_tables: float
    discount: float
    root_discount: float

    def root_base(self) -> float:
        return 1 / (self.words + 1)


def totals(moved: DataFrame) -> Totals:
    found = moved.groupBy().sum(*_SCALARS).first()
    n, v, t, r, once, twice, root_once, root_twice = (float(x or 0) for x in found)
    discount = lambda a, b: float(np.clip(a / max(a + 2 * b, 1), 0.05, 0.95))
    return Totals(n, v, t, r, discount(once, twice), discount(root_once, root_twice))


def _route(group: pa.Table) -> pa.Table:
    """How a home answers: kept for all rounds, as parts and their contexts stay the same."""
    rows = sorted(group.to_pylist(), key=lambda r: r["part"])
    keys = [np.frombuffer(r["keys"], "<u8") for r in rows]
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    customers = np.bincount(places, np.concatenate([unpack(r["customers"]) for r in rows]), len(distinct)).astype(np.int64)
    blobs = [pack(np.array(x, np.int64)) for x in ([r["part"] for r in rows], [len(k) for k in keys])]
    columns = [*blobs, pack(places), pack(customers)]
    names = ["parts", "sizes", "places", "customers"]
    return pa.table({"home": group["home"].slice(0, 1), **{c: pa.array([b], pa.binary()) for c, b in zip(names, columns, strict=True)}})


def _answer(whole: bool):
    """To each part, the sums over all parts for its contexts, in their order; with ``whole`` the customers come first."""

    def answer(routes: pa.Table, sent: pa.Table) -> pa.Table:
        route = {c: x[0] for c, x in routes.to_pydict().items()}
        parts, sizes, places, customers = (unpack(route[c]) for c in ("parts", "sizes", "places", "customers"))
        rows = sorted(sent.to_pylist(), key=lambda r: r["part"])
        if [r["part"] for r in rows] != parts.tolist():
            raise ValueError("the parts of a home have changed")
        sums = [customers] if whole else []
        for column in zip(*[r["seats"] for r in rows], strict=True):
            sums.append(np.bincount(places, np.concatenate([unpack(b) for b in column]), len(customers)).astype(np.int64))
        spans = [places[end - n : end] for n, end in zip(sizes, np.cumsum(sizes), strict=True)]
        return pa.table(
            {
                "part": pa.array(parts, pa.int32()), "home": pa.array(np.full(len(parts), route["home"]), pa.int32()),
                "seats": pa.array([[pack(x[at]) for x in sums] for at in spans], pa.list_(pa.binary())),
            }
        )

    return answer


def _moved(moved: pa.Table) -> tuple[dict, list[np.ndarray]]:
    """What the last round changed, and the answers in the order of the part's contexts."""
    rows = moved.to_pylist()
    answers = sorted((r for r in rows if r["home"] is not None), key=lambda r: r["home"])
    last = next(r for r in rows if r["home"] is None)
    return last, [np.concatenate([unpack(b) for b in column]) for column in zip(*[r["seats"] for r in answers], strict=True)]


def seat(counts: np.ndarray, weight: np.ndarray, growth: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``counts`` customers, seated one after the other.

    A new table has the weight ``weight + growth * tables``, the old ones ``customers - discount * tables``.
    """
    order = np.argsort(-counts, kind="stable")
    c, w, g = counts[order], weight[order], growth[order]
    t = np.minimum(c, 1).astype(float)
    seated, last = 1, int(c[0]) if len(c) else 0
    while seated < last:
        step = 1 if seated < EXACT else max(seated // 8, 1)
        n = int(np.searchsorted(-c, -seated, "left"))  # dishes with more customers than are seated
        now = t[:n]
        new = w[:n] + g[:n] * now
        chance = new / (new + np.maximum(seated - discount * now, 1e-9))
        if step == 1:
            now += random.random(n) < chance
        else:
            now += random.binomial(np.minimum(step, c[:n] - seated), np.clip(chance, 0, 1))
        seated += step
    out = np.empty(len(c), np.int64)
    out[order] = t.astype(np.int64)
    return out


def root_probability(per_word: np.ndarray, roots: np.ndarray, all_: Totals) -> np.ndarray:
    new = (STRENGTH + all_.root_discount * all_.root_tables) * all_.root_base()
    return (np.maximum(per_word - all_.root_discount * roots, 0) + new) / (STRENGTH + all_.root_customers)


def _sample(all_: Totals, keep: int, round_: int, whole: bool):
    def sample(fixed: pa.Table, moved: pa.Table) -> pa.Table:
        row = fixed.to_pylist()[0]
        last, seats = _moved(moved)
        random = np.random.default_rng([round_, row["part"]])
        mine, everywhere = Seating.read(row | last), seats[-1]
        tables, roots = mine.tables[-1].copy(), mine.roots[-1]
        parent = np.repeat(root_probability(mine.per_word(tables), roots, all_), mine.runs)
        many = np.flatnonzero(mine.counts > 1)  # a single customer has a single table
        p = parent[many]
        others = np.maximum(everywhere[mine.contexts[many]] - tables[many], 0)
        tables[many] = seat(mine.counts[many], (STRENGTH + all_.discount * others) * p, all_.discount * p, all_.discount, random)
        base = all_.root_base()
        per_word = mine.per_word(tables)
        rest = np.maximum(all_.root_tables - roots, 0)
        roots = seat(
            per_word, (STRENGTH + all_.root_discount * rest) * base, np.full(len(rest), all_.root_discount * base), all_.root_discount, random
        )
        mine.tables = [*mine.tables[len(mine.tables) - keep + 1 :], tables] if keep > 1 else [tables]
        mine.roots = [*mine.roots[len(mine.roots) - keep + 1 :], roots] if keep > 1 else [roots]
        return pa.table({"part": fixed["part"], **mine.round(unpack(row["homes"]), whole)})

    return sample


def _settle(fixed: pa.Table, moved: pa.Table) -> pa.Table:
    row = fixed.to_pylist()[0]
    last, seats = _moved(moved)
    mine = Seating.read(row | last)
    mine.keys, mine.seats = np.concatenate([np.frombuffer(a["keys"], "<u8") for a in row["asked"]]), seats
    return mine.row(row["part"])


@dataclass(frozen=True)
class Model:
    """The seating by part with the sums of its contexts, stored, and the totals of each sample."""

    state: DataFrame
    samples: list[Totals]
    parts: int


@dataclass(frozen=True)
class Parts:
    """The tables of a model that is being fitted: parts and routes are bucketed, so only what a round changes moves."""

    fixed: DataFrame
    routes: DataFrame
    parts: int
    homes: int

    def answers(self, moved: DataFrame, whole: bool) -> DataFrame:
        """Per part, the sums of its contexts over all parts, in pieces by the contexts' homes."""
        sent = moved.select("part", F.explode("sent").alias("s")).select("s.home", "part", "s.seats")
        sent = sent.repartition(self.homes, "home").groupBy("home")
        return self.routes.groupBy("home").cogroup(sent).applyInArrow(_answer(whole), _ANSWER)

    def stepped(self, moved: DataFrame, whole: bool, step, columns: list[str], schema: str) -> DataFrame:
        """``step`` on each part, what the last round changed in it, and the answers to that."""
        its = moved.select("part", "tables", "roots").unionByName(self.answers(moved, whole), allowMissingColumns=True)
        return self.fixed.select("part", *columns).groupBy("part").cogroup(dealt(its, self.parts).groupBy("part")).applyInArrow(step, schema)


def fit(docs: DataFrame, learn: Column, text: str = "text", burn_in: int = BURN_IN, samples: int = SAMPLES) -> Model:
    """Learn from the texts of ``docs`` where ``learn`` holds; the contexts of the others are known too.

    Call it and ``score`` within ``shuffles_removed``, else shuffle files of finished steps stay for long.
    """
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    slim = docs.select(F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    parts = part_count(slim)
    homes = -(-parts * PART_BYTES // HOME_BYTES)
    counted = dealt(slim.mapInArrow(_count(parts), _COUNTED), parts).groupBy("part").applyInArrow(_merge(homes), f"{_FIXED}, {_ROUND}")
    fixed = staged(counted, "seating", "part", parts)
    asked = fixed.select("part", F.explode("asked").alias("a")).select("a.home", "part", "a.keys", "a.customers")
    routes = asked.repartition(homes, "home").groupBy("home").applyInArrow(_route, _ROUTES)
    model = Parts(fixed, staged(routes, "routes", "home", homes), parts, homes)
    moved, seen, rounds = fixed, [totals(fixed)], burn_in + samples
    for i in range(rounds):
        step = _sample(seen[-1], max(1, i - burn_in + 1), i, i == rounds - 1)
        new = staged(model.stepped(moved, False, step, ["runs", "contexts", "counts", "homes"], f"part int, {_ROUND}"), "round")
        if moved is not fixed:
            discard(moved)
        moved = new
        seen.append(totals(moved))
    state = staged(model.stepped(moved, True, _settle, ["words", "runs", "contexts", "counts", "asked"], _STATE), "model", "part", parts)
    for table in {id(t): t for t in (moved, fixed, model.routes)}.values():
        discard(table)
    return Model(state, seen[-samples:] if rounds else seen, parts)


def _frequent(least: float):
    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, runs, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = arrays.text_sums(unpack(counts), unpack(runs))
                hot = np.flatnonzero(n > least)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(words, "<i8")[hot]), pa.array(n[hot])], ["word", "n"])

    return frequent


def _place(n: int) -> str:
    """The kind of places in ``n`` keys."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _blocks(n_parts: int, hot: dict[int, int]):
    """Tokens by part; the row with ``docs`` describes the texts of the block."""
    hot_words = np.array(sorted(hot), U64)
    hot_copies = np.array([hot[int(w)] for w in hot_words], np.int64)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(arrays.gathered(batches, 2)):
            word, context, n = tokens(*arrays.text_buffer(batch.column(2)))
            doc = np.repeat(np.arange(len(n), dtype=np.uint32), n)
            order = np.argsort(word, kind="stable")
            word, context, doc = word[order], context[order], doc[order]
            heads = np.flatnonzero(np.concatenate([[len(word) > 0], word[1:] != word[:-1]]))
            words, runs = word[heads], np.diff(heads, append=len(word))
            parts = _parts_of(words, n_parts)
            if len(hot_words):
                at = np.minimum(np.searchsorted(hot_words, words), len(hot_words) - 1)
                spread = np.flatnonzero(hot_words[at] == words)
                parts[spread] = (parts[spread] + (task * 7919 + number) % hot_copies[at[spread]]) % n_parts
            by_part = np.argsort(parts, kind="stable")
            cuts = np.flatnonzero(np.diff(parts[by_part], prepend=-1, append=-2))
            block = (task << 24) + number
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = by_part[a:b]
                lengths = runs[some]
                take = np.repeat(heads[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
                kind = "<u2" if len(n) < 1 << 16 else "<u4"
                keys, places = np.unique(context[take], return_inverse=True)
                rows.append(
                    (int(parts[some[0]]), block, words[some].tobytes(), lengths.astype("<u4").tobytes(), keys.tobytes(),
                     places.astype(_place(len(keys))).tobytes(), doc[take].astype(kind).tobytes(), len(n), None, None, None)
                )
            ids = batch.column(0)
            rows.append(
                (block % n_parts, block, None, None, None, None, None, len(n),
                 ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                 (ids.is_null().to_numpy(zero_copy_only=False) + 2 * batch.column(1).to_numpy(zero_copy_only=False)).astype(np.uint8).tobytes(),
                 n.astype("<u4").tobytes())
            )
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.int32(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _BLOCK_NAMES)

    return blocks


_BLOCK = "part int, block long, words binary, runs binary, keys binary, contexts binary, docs binary, n int, ids binary, flags binary, sizes binary"
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]
_SUMS = "block long, n int, sums binary, ids binary, flags binary, sizes binary"


def _copies(hot: dict[int, int], n_parts: int):
    """The seating of frequent words for the other parts that score them."""

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                mine = Seating.read(row)
                ends = np.cumsum(mine.runs)
                for w in np.flatnonzero(np.isin(mine.words, np.array(sorted(hot), U64))):
                    run = slice(int(ends[w] - mine.runs[w]), int(ends[w]))
                    its = mine.contexts[run]  # in order, each once
                    one = Seating(
                        mine.words[w : w + 1], mine.runs[w : w + 1], np.arange(len(its)), mine.counts[run],
                        [t[run] for t in mine.tables], [r[w : w + 1] for r in mine.roots], mine.keys[its], [x[its] for x in mine.seats],
                    )
                    for k in range(1, hot[int(mine.words[w])]):
                        yield from one.row((row["part"] + k) % n_parts).to_batches()

    return copies


def _equal(values: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> bool:
    return bool((at < len(values)).all() and (values[at] == wanted).all())


def _score(samples: list[Totals]):
    def score(blocks: pa.Table, state: pa.Table) -> pa.Table:
        rows = blocks.to_pylist()
        parts = [Seating.read(r) for r in [*state.to_pylist(), *[r["copy"] for r in rows if r["copy"]]]]
        words = np.concatenate([p.words for p in parts]) if parts else np.zeros(0, U64)
        order = np.argsort(words)
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        words = words[order]
        runs = np.concatenate([p.runs for p in parts]) if parts else np.zeros(0, np.int64)
        join = lambda f: np.concatenate([f(p) for p in parts]) if parts else np.zeros(0, np.int64)
        known_keys, first = np.unique(np.concatenate([p.keys for p in parts]) if parts else np.zeros(0, U64), return_index=True)
        seats = [join(lambda p: p.seats[i])[first] for i in range(1 + len(samples))]  # noqa: B023
        size = max(len(known_keys), 1)
        keys = np.repeat(rank, runs) * size + join(lambda p: np.searchsorted(known_keys, p.keys)[p.contexts])
        by_key = np.argsort(keys)
        keys, counts = keys[by_key], join(lambda p: p.counts)[by_key]
        totals_ = join(lambda p: p.per_word(p.counts))[order]
        per_sample = []
        for i, all_ in enumerate(samples):
            tables = join(lambda p: p.tables[i])[by_key]  # noqa: B023
            p_root = root_probability(
                join(lambda p: p.per_word(p.tables[i]))[order], join(lambda p: p.roots[i])[order], all_  # noqa: B023
            )
            per_sample.append((tables, p_root))
        n_all, v_all = samples[-1].tokens, samples[-1].words
        out = []
        for row in rows:
            if row["copy"]:
                continue
            if row["words"] is None:
                out.append((row["block"], row["n"], None, row["ids"], row["flags"], row["sizes"]))
                continue
            some = np.frombuffer(row["words"], "<u8")
            lengths = np.frombuffer(row["runs"], "<u4").astype(np.int64)
            its = np.frombuffer(row["keys"], "<u8")
            found = np.searchsorted(known_keys, its)
            context = found[np.frombuffer(row["contexts"], _place(len(its)))]
            doc = np.frombuffer(row["docs"], "<u2" if row["n"] < 1 << 16 else "<u4")
            at = np.searchsorted(words, some)
            word = np.repeat(at, lengths)
            pair = np.searchsorted(keys, word * size + context)
            if not (_equal(words, at, some) and _equal(known_keys, found, its) and _equal(keys, pair, word * size + context)):
                raise ValueError("a word and its context are not in the model: fit it with the documents to be scored")
            c_word = totals_[at]
            known = c_word > 0
            base = np.log10((c_word + 0.5) / (n_all + 0.5 * (v_all + 1)))
            c = counts[pair]
            p = np.zeros(len(pair))
            for (tables, p_root), everywhere, all_ in zip(per_sample, seats[1:], samples, strict=True):
                back = (STRENGTH + all_.discount * everywhere[context]) * p_root[word]
                p += (np.maximum(c - all_.discount * tables[pair], 0) + back) / (STRENGTH + seats[0][context])
            n = row["n"]
            sums = np.stack(
                [
                    np.bincount(doc, np.log10(p / len(samples)), n),
                    np.bincount(doc, np.repeat(base, lengths), n),
                    np.bincount(doc, np.repeat(known, lengths), n),
                ]
            )
            here = np.flatnonzero(np.bincount(doc, minlength=n))
            out.append((row["block"], n, here.astype("<u4").tobytes() + sums[:, here].tobytes(), None, None, None))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(["block", "n", "sums", "ids", "flags", "sizes"], columns, kinds, strict=True)})

    return score


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _collect_block(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    n = rows[0]["n"]
    total = np.zeros((3, n))
    for row in rows:
        if row["sums"] is not None:
            k = len(row["sums"]) // 28
            here = np.frombuffer(row["sums"][: 4 * k], "<u4")
            total[:, here] += np.frombuffer(row["sums"][4 * k :], float).reshape(3, k)
        else:
            flags = np.frombuffer(row["flags"], np.uint8)
            ids = pa.array(np.frombuffer(row["ids"], "<i8"), mask=(flags & 1).astype(bool))
            sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    return pa.table(
        {
            "doc_id": ids, "held_out": pa.array((flags & 2) > 0), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.rint(total[2]).astype(np.int64)), "base_score": pa.array(total[1]), "score": pa.array(total[0]),
        }
    )


def score(docs: DataFrame, model: Model, held: Column, text: str = "text") -> DataFrame:
    """Per row of ``docs``, which ``model`` was fitted with: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Written share by share, by a hash of the id, so the tokens of one share only are on disk at a time.
    """
    parts = model.parts
    n = model.samples[-1].tokens
    least = max(n / parts / 2, 1)
    common = model.state.select("words", "runs", "counts").mapInArrow(_frequent(least), "word long, n long")
    # each has more than 1 / (2 parts) of all tokens, so there are fewer than 2 * parts
    hot = {r["word"] % (1 << 64): min(parts, int(r["n"] / least) + 1) for r in common.collect()}
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.col(text).alias("text"))
    homes = [int(h) for h in np.unique(_parts_of(np.array(sorted(hot), U64), parts))]
    copies = model.state.filter(F.col("part").isin(homes)).mapInArrow(_copies(hot, parts), _STATE)
    copies = copies.select("part", F.struct(*copies.columns).alias("copy"))
    found = []
    for share in range(SHARES):
        some = slim.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)) == share)
        sent = some.mapInArrow(_blocks(parts, hot), _BLOCK).unionByName(copies, allowMissingColumns=True)
        sums = dealt(sent, parts).groupBy("part").cogroup(model.state.groupBy("part")).applyInArrow(_score(model.samples), _SUMS)
        found.append(staged(sums.groupBy("block").applyInArrow(_collect_block, _RESULT), "scores"))
    return reduce(DataFrame.unionAll, found).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score"
    )


def lm_query(docs: DataFrame) -> DataFrame:
    held = held_out(parts=5, part=1)
    with shuffles_removed(docs.sparkSession):
        model = fit(docs, F.col("doc_id").isNotNull() & ~held)
        scores = score(docs, model, held)
    discard(model.state)
    return scores
