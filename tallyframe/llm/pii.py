"""Personal data: base patterns, and further spans by weak supervision.

Base spans are those of four fixed patterns with their checks. Candidates for more come from
looser patterns (a number next to another one that the base pattern swallowed and refused,
spelled-out addresses, assigned secrets). Labelers vote on every candidate for (1), against (-1) or
not at all (0): pattern labelers look at its shape, gazetteers at lists of known values, context
labelers at the words before it. Votes of all documents are counted by pattern of votes and
shape; expectation-maximisation on these counts estimates how reliable each labeler is, and the
posteriors train the span classifier, a logistic regression over votes and shape. Both see a
table whose size depends on the patterns only. Candidates with a probability of a half or more, and
not over a base span, are added.

Null texts are empty. Positions are in code points, ends exclusive. Every row is a document of its
own; repeated rows and ties are no special case. Without candidates nothing is added. Other columns
are not read. Long texts are searched whole, in a time that grows with their length alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = (*KINDS, "secret")

#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The same matches in a time that grows with the text alone: a run of digits or letters is looked at once, since a match
# that fails at its first character fails at all others.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")

_NOT_DIGIT = re.compile(r"[^0-9]")


def digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(number)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of ``EMAIL``: a run of name characters up to an ``@``, from the end of the span before if that cuts it."""
    free = 0
    for run in _LOCAL.finditer(text):
        end = run.end()
        if text[end : end + 1] != "@" or end <= free:
            continue
        domain = _DOMAIN.match(text, end + 1)
        if domain:
            yield max(run.start(), free), domain.end()
            free = domain.end()


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind as listed and then start."""
    out = []
    if "@" in text:
        out += [("email", *span) for span in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_is_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        number = digits(m[0])
        if 16 <= len(number) <= 19 and luhn(number):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


_CANDIDATES = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+[0-9]{1,3}[\x20-]?)?\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])"),
    "secret": re.compile(r"(?i:\b(?:token|password|passwd|pwd|secret|api[_-]?key)\b)\x20{0,2}[=:]\x20{0,2}\"?([A-Za-z0-9_\-/+]{8,})"),
}
_CUES = {
    "email": re.compile(r"(?i)\b(?:e-?mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|address|server)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|pay|account)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|fax|mobile)\b"),
    "secret": re.compile(r"(?i)(?:token|password|passwd|pwd|secret|key)"),
}
_AGAINST = re.compile(r"(?i)\b(?:version|page|isbn|figure|chapter|example|sha|commit)\W*$")
_HEX = re.compile(r"[0-9a-f]+")
#: Gazetteers: issuers' first digits, country codes, top-level domains.
CARD_STARTS = ("4", "5", "34", "37", "6011", "62", "35")
COUNTRY_CODES = ("1", "7", "30", "31", "33", "34", "39", "41", "43", "44", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu")
LABELERS = ("shape", "gazetteer", "context", "contrary", "variety")


def _votes(kind: str, found: str, before: str) -> tuple[int, ...]:
    number = digits(found)
    if kind == "card":
        shape, gazetteer = (1 if luhn(number) else -1), 1 if number.startswith(CARD_STARTS) else -1
    elif kind == "phone":
        shape = 1 if 10 <= len(number) <= 13 else -1
        gazetteer = (1 if number[:-10].startswith(COUNTRY_CODES) else -1) if "+" in found else 0
    elif kind == "ip":
        parts = [int(p) for p in found.split(".")]
        shape = 1 if all(p <= 255 for p in parts) else -1
        gazetteer = -1 if parts[0] in (0, 255) else 0
    elif kind == "email":
        shape, gazetteer = 1, 1 if found.lower().rstrip().endswith(DOMAINS) else -1
    else:
        shape = 1 if len(found) >= 12 or number else -1
        gazetteer = 1 if _HEX.fullmatch(found) else 0
    context = 1 if _CUES[kind].search(before) else 0
    contrary = -1 if _AGAINST.search(before) else 0
    variety = 1 if len(set(number or found)) > 3 else -1
    return shape, gazetteer, context, contrary, variety


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """(kind, start, end, key): candidates that meet no base span; the key is votes and shape."""
    out = []
    taken = sorted((s, e) for _, s, e in base)
    # the furthest end of the base spans up to each one, so that one look tells whether any reaches into a candidate
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    for kind, pattern in _CANDIDATES.items():
        for m in pattern.finditer(text):
            start, end = m.span(1) if m.re.groups else m.span()
            before = bisect_left(starts, end)
            if before and reach[before - 1] > start:
                continue
            found = text[start:end]
            votes = _votes(kind, found, text[max(0, start - 40) : start])
            out.append((kind, start, end, (MORE_KINDS.index(kind), *votes, min(len(found) // 8, 4))))
    return out


def _suspects(column: pa.Array) -> np.ndarray:
    """Texts that hold a digit, ``@``, ``=``, ``:`` or a bracketed word: no other text can have a span."""
    data, offsets = arrays.text_buffer(column)
    mark = np.zeros(256, np.int64)
    mark[[*range(48, 58), *b"@=:([+"]] = 1
    return np.flatnonzero(arrays.text_sums(mark[data], np.diff(offsets)))


def _count_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        column = batch.column(0)
        for i in _suspects(column):
            text = column[int(i)].as_py()
            counts.update(c[3] for c in candidates(text, base_spans(text)))
    rows = list(counts.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([list(k) for k, _ in rows], pa.list_(pa.int32())), pa.array([n for _, n in rows], pa.int64())], ["key", "n"]
    )


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns.

    Returns the posterior per pattern, P(vote | label) as [label, labeler, vote + 1], and P(label 1).
    Labelers start as better than chance, which names the two classes.
    """
    labelers = votes.shape[1]
    table = np.empty((2, labelers, 3))
    table[1], table[0] = [0.15, 0.35, 0.5], [0.5, 0.35, 0.15]
    prior, posterior = 0.5, np.full(len(n), 0.5)
    for _ in range(rounds):
        log = [np.log(p) + sum(np.log(table[y, j, votes[:, j] + 1]) for j in range(labelers)) for y, p in ((0, 1 - prior), (1, prior))]
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        prior = float(np.clip((posterior @ n) / n.sum(), 0.02, 0.98))
        for y, weight in ((0, (1 - posterior) * n), (1, posterior * n)):
            for j in range(labelers):
                seen = np.bincount(votes[:, j] + 1, weight, 3) + [0.5, 0.5, 0.5] + 2 * np.array([[0.5, 0.35, 0.15], [0.15, 0.35, 0.5]][y])
                table[y, j] = seen / seen.sum()
    return posterior, table, prior


def _features(keys: np.ndarray) -> np.ndarray:
    """Votes for and against, kind and length, each as 0 or 1."""
    kinds, votes, length = keys[:, 0], keys[:, 1 : 1 + len(LABELERS)], keys[:, -1]
    return np.hstack([votes == 1, votes == -1, kinds[:, None] == np.arange(len(MORE_KINDS)), length[:, None] == np.arange(5), np.ones((len(keys), 1))]).astype(float)


def train(keys: np.ndarray, n: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of the span classifier, a logistic regression on the posteriors."""
    posterior, _, _ = reliabilities(keys[:, 1 : 1 + len(LABELERS)], n)
    x, share = _features(keys), n / n.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= 2.0 * (x.T @ (share * (p - posterior)) + 1e-4 * weights)
    return weights


def fit(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """The classifier's weights from all texts; None if there is no candidate."""
    arrays.bound_batches(docs.sparkSession)
    counted = docs.select(text).mapInArrow(_count_votes, "key array<int>, n long")
    rows = counted.groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()  # one row per pattern of votes and shape
    if not rows:
        return None
    return train(np.array([r["key"] for r in rows]), np.array([r["n"] for r in rows], float))


_SPANS = "spans array<struct<kind: string, start: long, end: long, base: boolean>>"


def found_spans(docs: DataFrame, text: str = "text", name: str = "_pii") -> DataFrame:
    """Add ``name``: all spans (kind, start, end, base) by kind as listed and then start."""
    weights = fit(docs, text)

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, base: boolean>>")
    def find(column: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(column))]
        for i in _suspects(column):
            whole = column[int(i)].as_py()
            base = base_spans(whole)
            more = candidates(whole, base)
            if more:
                sure = _features(np.array([c[3] for c in more])) @ weights >= 0
                more = [c[:3] for c, yes in zip(more, sure, strict=True) if yes]
            spans = [(*s, True) for s in base] + [(*s, False) for s in more]
            spans.sort(key=lambda s: (MORE_KINDS.index(s[0]), s[1]))
            out[i] = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        return pa.array(out, pa.list_(kind))

    return docs.withColumn(name, find(F.col(text)))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def pii_query(docs: DataFrame) -> DataFrame:
    found = found_spans(docs)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("_pii", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("_pii")).alias("spans"))
