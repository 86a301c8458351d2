"""N-gram Jaccard join: rare-first prefix filtering, and the components of the links.

A document's set is its distinct runs of ``WORDS`` words, as 64-bit hashes (fewer words: the
whole sequence as one; none: empty, linked with nothing). Two documents link when
``100 * |intersection| >= PERCENT * |union|``. Equal sets are one class, known by two 64-bit
sums over the set, so copies cost one row each and are never paired.

1. Tasks send the shingles of a batch as sorted, packed deltas; the parts count them. The most
   frequent ones, as many as fit into ``FREQUENT`` entries, are broadcast with the logarithm of
   their count. (count level, hash) orders all shingles, rare first.
2. Each class sends the prefix of its set, which any linked set must meet. Shingles that
   only one class sent are dropped where they meet. Frequent ones are not gathered anywhere.
3. Per shared shingle, each class is paired with one class only, the hub: the class with the most
   frequent prefix, or the least of equals. Edits make new, rare shingles, so the hub of a group
   of near copies is close to what they were made from, and links with most of them. First each
   class meets the foremost of its hubs, then those that are still in another component. After
   length and positional filter a pair is checked once: suffix filter (shingles per hash range
   bound the intersection), then the sets themselves. Links give components.
4. Where the classes of a shingle are still in several components, the classes outside the
   largest one are paired with all classes of other components, and checked the same way.
   Pairs within a component need no check: they cannot change the components.

A row is a document, so repeated rows are copies; a null ``doc_id`` takes part but is never the
smallest id. Other columns are not read. ``docs`` is read several times and must give the
same rows each time, as a stored table does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import arrays
from tallyframe.llm.lm import dealt
from tallyframe.session import keep, numbered, scratch, shuffles_removed, staged

WORDS = 5
PERCENT = 75
#: Entries of the broadcast table of frequent shingles, and the least count of one.
FREQUENT = 1_000_000
LEAST_LEVEL = 3
#: Candidate documents up to which their ids are broadcast to the scan of the texts.
BROADCAST_IDS = 300_000
KEY_BITS = 24
RANGES = 64

U64 = np.uint64
_PROFILE = T.StructType().add("n", "long").add("f1", "long").add("f2", "long").add("ranges", "binary")
_SET = T.StructType().add("f1", "long").add("shingles", "binary")


def shingle_sets(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece of a batch: first and last row, distinct shingles row by row ascending, how many."""
    data, offsets = arrays.text_buffer(text)
    for first, last in arrays.pieces(offsets):
        some = arrays.lower(data[offsets[first] : offsets[last]])
        starts, stops, counts = arrays.word_spans(some, offsets[first : last + 1] - offsets[first])
        hashes, made = arrays.shingle_hashes(arrays.span_hashes(some, starts, stops), counts, WORDS)
        yield first, last, *arrays.distinct_per_text(hashes, made)


def class_sums(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple(arrays.text_sums(arrays.mix(hashes, seed), counts).view(np.int64) for seed in (11, 12))


def part_bits(spark) -> int:
    """Bits that name a part: four to eight parts per shuffle partition, which a task takes one by one."""
    return (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


@F.arrow_udf(_PROFILE)
def profile(text: pa.Array) -> pa.Array:
    """Size, class and shingles per hash range (16 bits each; 65535 stands for any more)."""
    arrays.release_memory()
    n, f1, f2, ranges = [], [], [], []
    for first, last, hashes, counts in shingle_sets(text):
        a, b = class_sums(hashes, counts)
        n.append(counts)
        f1.append(a)
        f2.append(b)
        row = np.repeat(np.arange(last - first), counts)
        table = np.bincount(row * RANGES + (hashes >> U64(58)).astype(np.int64), minlength=(last - first) * RANGES)
        ranges += [r.tobytes() for r in np.minimum(table, 65535).astype("<u2").reshape(-1, RANGES)]
    join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
    return pa.StructArray.from_arrays([join(n), join(f1), join(f2), pa.array(ranges, pa.binary())], ["n", "f1", "f2", "ranges"])


def _count_blocks(bits: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.gathered(batches, 0):
            found = [(h >> U64(64 - bits - KEY_BITS)).astype(np.int64) for _, _, h, _ in shingle_sets(batch.column(0))]
            keys = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
            parts = keys >> KEY_BITS
            cuts = np.flatnonzero(np.diff(parts, prepend=-1, append=-2))
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                deltas = np.diff(keys[a:b] & ((1 << KEY_BITS) - 1), prepend=0)
                wide = bool(deltas.max() > 65535)
                rows.append((int(parts[a]), wide, deltas.astype("<u4" if wide else "<u2").tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            kinds = (pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "wide", "deltas"])

    return blocks


def _count_part(group: pa.Table) -> pa.Table:
    keys = np.concatenate(
        [np.cumsum(np.frombuffer(d, "<u4" if w else "<u2").astype(np.int64)) for w, d in zip(group["wide"].to_pylist(), group["deltas"].to_pylist(), strict=True)]
    )
    keys, counts = np.unique(keys, return_counts=True)
    level = np.frexp(counts.astype(float))[1] - 1  # floor of the logarithm
    part = group["part"][0].as_py()
    rows = [(part, int(x), (level == x).sum(), ((part << KEY_BITS) + keys[level == x]).astype("<i8").tobytes()) for x in np.unique(level) if x >= LEAST_LEVEL]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table({k: pa.array(c, t) for k, c, t in zip(("part", "level", "n", "keys"), columns, kinds, strict=True)})


def frequent_shingles(docs: DataFrame, text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent shingles, ascending, and the level of each."""
    blocks = docs.select(text).mapInArrow(_count_blocks(bits), "part int, wide boolean, deltas binary")
    counted = staged(dealt(blocks, 1 << bits).groupBy("part").applyInArrow(_count_part, "part int, level int, n long, keys binary"), "frequent")
    held, least = 0, 64
    for row in sorted(counted.groupBy("level").agg(F.sum("n").alias("n")).collect(), reverse=True):
        held += row["n"]
        if held > FREQUENT:
            break
        least = row["level"]
    rows = counted.filter(F.col("level") >= least).select("level", "keys").collect()  # at most FREQUENT keys
    keys = np.concatenate([np.frombuffer(r["keys"], "<i8") for r in rows]) if rows else np.zeros(0, np.int64)
    levels = np.concatenate([np.full(len(r["keys"]) // 8, r["level"], np.int8) for r in rows]) if rows else np.zeros(0, np.int8)
    order = np.argsort(keys)
    return keys[order], levels[order]


def prefix_length(n):
    """Rarest shingles of a set of ``n`` of which every linked set has at least one."""
    return n - (PERCENT * n + 99) // 100 + 1


def _prefixes(shared, bits: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, levels = shared.value
        seen: set[int] = set()
        rows = []
        for number, batch in enumerate(arrays.gathered(batches, 0)):
            parts = []
            for _, _, hashes, counts in shingle_sets(batch.column(0)):
                f1, _ = class_sums(hashes, counts)
                row = np.repeat(np.arange(len(counts)), counts)
                level = np.zeros(len(hashes), np.int64)
                if len(keys):
                    key = (hashes >> U64(64 - bits - KEY_BITS)).astype(np.int64)
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    level = np.where(keys[at] == key, levels[at].astype(np.int64), 0)
                order = np.argsort(row * 64 + level, kind="stable")  # by hash within a level
                hashes, level = hashes[order], level[order]
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                new = np.zeros(len(counts), bool)
                for i, (f, n) in enumerate(zip(f1.tolist(), counts.tolist(), strict=True)):
                    if n and f not in seen:  # copies within a task are sent once
                        seen.add(f)
                        new[i] = True
                inside = place < prefix_length(counts)[row]
                sums = np.bincount(row[inside], level[inside], len(counts))
                weight = (256 * sums / np.maximum(prefix_length(counts), 1)).astype(np.int64)
                use = new[row] & inside
                parts.append((hashes[use], f1[row[use]], counts[row[use]], place[use], weight[row[use]], level[use] > 0))
            if not parts:
                continue
            token, f1, n, place, weight, hot = map(np.concatenate, zip(*parts, strict=True))
            part = (token >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(token), np.int64)
            part = np.where(hot, (number * 7919 + np.arange(len(part)) // 4096) % (1 << bits), part)
            order = np.lexsort((token, part, hot))
            cuts = np.flatnonzero(np.diff(part[order] * 2 + hot[order], prepend=-1, append=-2))
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                s = order[a:b]
                small = [x[s].astype("<u4").tobytes() for x in (n, place, weight)]
                rows.append((int(part[s[0]]), bool(hot[s[0]]), token[s].tobytes(), f1[s].tobytes(), *small))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 5)
            names = ["part", "hot", "token", "class", "n", "place", "weight"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return prefixes


def _shared_only(group: pa.Table) -> pa.Table:
    """Postings of shingles that more than one class sent; frequent ones pass."""
    out = []
    for hot in (False, True):
        rows = [r for r in group.to_pylist() if r["hot"] == hot]
        if not rows:
            continue
        kinds = {"token": "<i8", "class": "<i8", "n": "<u4", "place": "<u4", "weight": "<u4"}
        token, f1, n, place, weight = (np.concatenate([np.frombuffer(r[c], k) for r in rows]) for c, k in kinds.items())
        order = np.lexsort((f1, token))
        token, f1 = token[order], f1[order]
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (f1[1:] != f1[:-1])
        order, token, f1 = order[keep], token[keep], f1[keep]
        if not hot:
            same = token[1:] == token[:-1]
            shared = np.zeros(len(token), bool)
            shared[1:] |= same
            shared[:-1] |= same
            order, token, f1 = order[shared], token[shared], f1[shared]
        small = {c: x[order].astype(np.int64) for c, x in (("n", n), ("place", place), ("weight", weight))}
        out.append(pa.table({"token": token, "class": f1, **small}))
    return pa.concat_tables(out)


_POSTING = "token long, class long, n long, place long, weight long"


def may_link(n: Column, place: Column, m: Column, other: Column) -> Column:
    """Length and positional filter for sets of sizes ``n`` and ``m`` with a shared shingle at these places."""
    # |x & y| >= PERCENT / (100 + PERCENT) * (n + m); at the first shared shingle nothing before it is
    # shared, so linked sets pass there, and it does not matter that they may fail at a later one
    most = 1 + F.least(n - place - 1, m - other - 1)
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * most >= PERCENT * (n + m))


@F.arrow_udf(T.BooleanType())
def suffix_filter(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    """Whether the shingles per hash range leave room for the intersection that a link needs."""
    table = lambda x: np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, RANGES).astype(np.int64)
    least = np.minimum(table(a), table(b))
    total = n.to_numpy() + m.to_numpy()
    room = np.where((least == 65535).any(1), total, least.sum(1))
    return pa.array((100 + PERCENT) * room >= PERCENT * total)


def _packed(column: pa.Array) -> Iterator[np.ndarray]:
    """The packed hashes of each row, without a copy."""
    for x in column:
        yield np.frombuffer(x.as_buffer(), "<u8")


@F.arrow_udf(T.BooleanType())
def sets_link(a: pa.Array, b: pa.Array) -> pa.Array:
    arrays.release_memory()
    out = []
    for x, y in zip(_packed(a), _packed(b), strict=True):
        if len(x) > len(y):
            x, y = y, x
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        both = int((y[at] == x).sum())
        out.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


@F.arrow_udf(_SET)
def shingles_of(text: pa.Array) -> pa.Array:
    arrays.release_memory()
    f1, sets = [], []
    for _, _, hashes, counts in shingle_sets(text):
        f1.append(class_sums(hashes, counts)[0])
        ends = np.cumsum(counts)
        sets += [hashes[e - c : e].astype("<u8").tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(f1) if f1 else np.zeros(0, np.int64)), pa.array(sets, pa.binary())], ["f1", "shingles"]
    )


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose classes are not in one component yet."""
    side = lambda k: known.select(F.col("node").alias(k), F.col("component").alias(f"in_{k}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The pairs (a, b) of classes whose sets link."""
    side = lambda k: classes.select(F.col("class").alias(k), F.col("n").alias(f"n_{k}"), F.col("ranges").alias(f"r_{k}"))
    ranged = pairs.join(side("a"), "a").join(side("b"), "b").filter(suffix_filter("r_a", "r_b", "n_a", "n_b"))
    left = staged(ranged.select("a", "b"), "pairs")
    wanted = left.select(F.col("a").alias("class")).union(left.select("b")).distinct().join(classes.select("class", "doc_id"), "class")
    wanted = staged(wanted, "wanted")
    # a few ids go to the scan; many are joined, where Spark puts a Bloom filter before the shuffle
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col(text).alias("_text")).join(ids, F.col("_id").eqNullSafe(F.col("doc_id")))
    # not deterministic: else Spark evaluates it once more for the filter
    sets = texts.select("class", shingles_of.asNondeterministic()("_text").alias("s")).filter(F.col("s.f1") == F.col("class")).select("class", "s.shingles")
    sets = staged(sets.dropDuplicates(["class"]), "sets")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("s_b")), "b")
    both = both.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("s_a")), "a")
    return staged(both.filter(sets_link("s_a", "s_b")).select("a", "b"), "links")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that links lead to, for every node of a link.

    Rounds of taking the least component among neighbours and then that component's own, until
    nothing changes. Nothing is collected but the number of changes.
    """
    there = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = staged(there.union(there.select("v", "u")).distinct(), "edges")
    known = staged(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("component")).withColumnRenamed("u", "node"), "components")
    while True:
        near = edges.join(known.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        stepped = known.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        jump = known.select(F.col("node").alias("via"), F.col("component").alias("beyond"))
        new = stepped.join(jump, "via", "left").select("node", "old", F.least("via", "beyond").alias("component"))
        new = staged(new, "components")
        known = new.select("node", "component")
        if not new.filter("old <> component").limit(1).count():
            return known


def _classes(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Size and class of each document, and the component of each class."""
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    bits = part_bits(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), profile(F.col(text)).alias("p")).select("doc_id", "p.*")
    profiles = staged(slim, "profiles")
    classes = profiles.filter("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.any_value("ranges").alias("ranges")
    )
    classes = staged(classes.withColumnRenamed("f1", "class"), "classes")

    shared = spark.sparkContext.broadcast(frequent_shingles(docs, text, bits))
    packed = docs.select(text).mapInArrow(_prefixes(shared, bits), "part int, hot boolean, token binary, class binary, n binary, place binary, weight binary")
    postings = staged(dealt(packed, 1 << bits).groupBy("part").applyInArrow(_shared_only, _POSTING), "postings").distinct()

    order = F.struct((-F.col("weight")).alias("first"), "class", "n", "place")
    hubs = postings.groupBy("token").agg(F.min(order).alias("hub"))
    star = postings.join(hubs, "token").filter(F.col("class") != F.col("hub.class"))
    star = star.filter(may_link(F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place")))
    met = staged(star.select("class", F.struct("hub.first", "hub.class").alias("hub")).distinct(), "stars")
    pair = [F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")]
    # in a large group nearly all have the same first hub, so one pair each joins most of it
    tried = staged(met.groupBy("class").agg(F.min("hub").alias("hub")).select(*pair).distinct(), "first")
    stars = staged(met.select(*pair).distinct(), "pairs")
    links = _verified(tried, classes, docs, text)
    others = _apart(stars, components(links)).join(tried, ["a", "b"], "left_anti")
    links = links.union(_verified(others, classes, docs, text))
    known = components(links)

    label = F.coalesce("component", "class").alias("component")
    placed = staged(postings.join(known.withColumnRenamed("node", "class"), "class", "left").select("token", "class", "n", "place", label), "placed")
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("size"))
    open_ = sizes.groupBy("token").agg(F.count("*").alias("several"), F.max(F.struct("size", "component")).alias("largest"))
    open_ = open_.filter("several > 1").select("token", F.col("largest.component").alias("largest"))
    still = placed.join(open_, "token")
    outside = still.filter(F.col("component") != F.col("largest")).select(
        "token", *[F.col(c).alias(f"o_{c}") for c in ("class", "n", "place", "component")]
    )
    other = (F.col("component") == F.col("largest")) | (F.col("o_class") < F.col("class"))
    cross = still.join(outside, "token").filter((F.col("component") != F.col("o_component")) & other)
    cross = cross.filter(may_link(F.col("n"), F.col("place"), F.col("o_n"), F.col("o_place")))
    rest = cross.select(F.least("class", "o_class").alias("a"), F.greatest("class", "o_class").alias("b")).distinct()
    links = links.union(_verified(rest.join(stars, ["a", "b"], "left_anti"), classes, docs, text))
    known = components(links)

    named = classes.join(known.withColumnRenamed("node", "class"), "class", "left").select("class", "f2", "n", "doc_id", "copies", label)
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return profiles, named.join(least, "component").select(F.col("class").alias("f1"), "f2", "n", "component_id", "copies")


def linked_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and the number of documents of its class."""
    with shuffles_removed(docs.sparkSession):  # every table that is read twice there is a stored one
        profiles, named = _classes(docs, text)
    out = profiles.select("doc_id", "f1", "f2", "n").join(named, ["f1", "f2", "n"], "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )


def components_query(docs: DataFrame) -> DataFrame:
    return linked_components(docs).select("doc_id", "n_shingles", "component_id")


def one_per_component(docs: DataFrame, stored: bool = False) -> DataFrame:
    """One row of each component: the one with the smallest id, ids that are missing coming last, of equal ids any one.

    Rows are numbered (``session.numbered``, which tells what ``stored`` says), and linked by these numbers, so rows that share an id
    are judged each by its own text. A row without words is linked with nothing and stays.
    """
    marked = numbered(docs, "rows", stored)
    with scratch() as tables:  # what finds the components goes when they are written
        linked = linked_components(marked.select(F.col("row").alias("doc_id"), "whole.text"))
        linked = keep(tables, staged(linked.select(F.col("doc_id").alias("row"), "component_id"), "linked"))
    named = linked.join(marked.select("row", F.col("whole.doc_id").cast("long").alias("id")), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select("first.row")
    dropped = linked.select("row").join(kept, "row", "left_anti")
    return marked.join(dropped, "row", "left_anti").select("whole.*")
