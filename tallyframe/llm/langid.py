"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every gram of every learning text in numpy inside the tasks; a task sends
one array of ``BUCKETS`` counts per language, cut into slices, so what is shuffled depends
on the number of tasks and not on their rows. The log-probability matrix (``BUCKETS`` rows
by languages) has a fixed size and is broadcast; prediction adds up rows of it per text.

Null texts and texts without a letter get ``und`` and score 0. Rows with null ``lang`` or
null ``doc_id`` teach nothing; a null ``doc_id`` is not held out. With no learned language
everything is ``und``. Equal posteriors go to the first language by code point. Repeated
rows count and are predicted each for itself; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SLICES = 16
#: Code points per numpy step.
STEP = 1 << 21

_COUNTS = "lang string, slice int, texts long, counts binary"


@dataclass(frozen=True)
class LanguageModel:
    """``log_probs[bucket, language]`` and the log prior per language."""

    languages: list[str]
    log_probs: np.ndarray
    log_priors: np.ndarray


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32(doc_id as text) mod ``parts`` is ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with everything but letters as a space, and the lengths."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ascii_letter = (codes >= 97) & (codes <= 122)
    codes = np.where((codes < 128) & ~ascii_letter, np.uint64(32), codes)
    return codes, np.array([len(t) for t in lowered], np.int64)


def _grams(codes: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of ``order`` code points within a text, and how many each text has."""
    made = np.maximum(lengths - order + 1, 0)
    with np.errstate(over="ignore"):
        value = np.full(len(codes), order, np.uint64)
        for j in range(order):
            part = np.zeros(len(codes), np.uint64)
            part[: len(codes) - j] = codes[j:]
            value = (value * np.uint64(0x100000001B3)) ^ part
        buckets = ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    return buckets[left >= order], made


def _steps(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    rows: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        if text:
            rows.append(i)
            held += len(text)
            if held >= STEP:
                yield rows, [texts[j] for j in rows]
                rows, held = [], 0
    if rows:
        yield rows, [texts[j] for j in rows]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    seen: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            seen[lang] = seen.get(lang, 0) + len(mine)
            for _, some in _steps(mine):
                codes, lengths = _codes(some)
                for order in ORDERS:
                    total += np.bincount(_grams(codes, lengths, order)[0], minlength=BUCKETS)
    for lang, total in counts.items():
        for i, part in enumerate(np.split(total, SLICES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([i], pa.int32()), pa.array([seen[lang]], pa.int64()), pa.array([part.tobytes()])],
                ["lang", "slice", "texts", "counts"],
            )


def _add_up(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.int64) for b in group["counts"].to_pylist())
    return pa.table(
        {
            "lang": group["lang"][:1],
            "slice": group["slice"][:1],
            "texts": pa.array([sum(group["texts"].to_pylist())], pa.int64()),
            "counts": pa.array([total.tobytes()], pa.binary()),
        }
    )


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows of ``docs`` that have both a text and a language."""
    arrays.bound_batches(docs.sparkSession)
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    sums = known.mapInArrow(_count, _COUNTS).groupBy("lang", "slice").applyInArrow(_add_up, _COUNTS)
    rows = sorted(sums.collect())  # SLICES rows of fixed size per language
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    counts = np.stack(
        [np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows if r["lang"] == x]) for x in languages], 1
    )
    probs = (counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)
    texts = np.array([next(r["texts"] for r in rows if r["lang"] == x) for x in languages], float)
    return LanguageModel(languages, np.log(probs).astype(np.float32), np.log(texts / texts.sum()))


def scores(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    found, sure = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return found, sure
    for rows, some in _steps(texts):
        codes, lengths = _codes(some)
        total = np.tile(model.log_priors, (len(some), 1))
        for order in ORDERS:
            buckets, made = _grams(codes, lengths, order)
            used = np.flatnonzero(made)
            if len(used):
                starts = np.concatenate([[0], np.cumsum(made[used])[:-1]])
                for k in range(len(model.languages)):
                    total[used, k] += np.add.reduceat(model.log_probs[buckets, k].astype(np.float64), starts)
        best = total.argmax(1)
        top = total[np.arange(len(some)), best]
        share = 1 / np.exp(total - top[:, None]).sum(1)
        for i, text, b, s in zip(rows, some, best, share, strict=True):
            if any(map(str.isalpha, text)):
                found[i], sure[i] = model.languages[b], s
    return found, sure


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "_language") -> DataFrame:
    """Add the struct column ``name`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def identify(column: pa.Array) -> pa.Array:
        found, sure = scores(shared.value, column.to_pylist())
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(sure, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(name, identify(F.col(text)))


def identified(docs: DataFrame, name: str = "_language") -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out and predict all of them."""
    return predict(docs, fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out())), name=name)


def language_query(docs: DataFrame) -> DataFrame:
    return identified(docs.select("doc_id", "text", "lang")).select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents with a language that the model is sure of by at least ``least``."""
    packed = docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias("whole"))
    return identified(packed).filter(F.col("_language.score") >= least).select("whole.*")
