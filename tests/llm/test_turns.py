"""Repair of conversations against plain versions that know no tables."""

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import product

import numpy as np
import pytest

from tallyframe.llm import turns
from tallyframe.llm.queries import QUERIES, table

SMALL = "/root/testdata/sf0.01"
PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """(conv_id, turn, role, text) of the damaged conversations, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def plain(rows):
    """The contract's columns for the damaged rows of one conversation."""
    seen, kinds, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kinds.append(fault)
    known = [r[1] for r in rows if r[1] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    @lru_cache(None)
    def best(i, last, inserted=0):
        """(cost, edits, rows) from row i on when the output so far ends in ``last``."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        fits = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[fits]
        if inserted < 3:
            cost, edits, kept = best(i, fits, inserted + 1)
            found.append((cost + 2, "I" + edits, (f"{name}:", *kept)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, edits, kept = best(i + 1, last)
            found.append((cost + 3, "D" + edits, kept))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                cost, edits, kept = best(i + 1, fits)
                found.append((cost + 2 + more, "R" + edits, (f"{name}:{text}", *kept)))
                if role[:1] == fits or (role[:1] == "s" and last == ""):
                    cost, edits, kept = best(i + 1, role[:1])
                    found.append((cost + more, "K" + edits, (f"{role}:{text}", *kept)))
        return min(found, default=(10**9, "", ()))

    cost, audit, kept = best(0, "")
    assert PATTERN.fullmatch("".join(k[0] for k in kept))
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def check(found, rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    assert len(found) == len(groups)
    for r in found:
        wanted = plain(damage(groups[r.conv_id]))
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == wanted, r.conv_id


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op11_turn_repair"](spark, SMALL).collect(), rows)


SCHEMA = "conv_id long, turn long, role string, text string, position long, step int, piece long, edit string"


def odd(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)


def test_odd_rows(spark):
    long = "word " * 300_000
    rows = [
        (1, None, None, None), (1, None, "user", "a."), (1, 1, "user", "a."), (1, 1, "user", "a."), (1, 2, "tool", "b"),
        (None, 1, "system", "S."), (None, None, "assistant", "x!"), (None, 3, "", ""), (2, 1, "user", long),
        (2, 2, "assistant", long + "."), (2, 5, "user", "u?"), (3, -(1 << 63), "user", "u."), (3, (1 << 63) - 1, "assistant", "a."),
        *[(4, t, "uvwx"[t % 4], f"t{t}\v.\f") for t in range(30)], *[(5, 7, "assistant", "same.")] * 9, *[(6, t, "system", "s.") for t in range(7)],
    ]
    found = turns.repair_query(odd(spark, rows)).collect()
    check([r for r in found if r.conv_id != 3], [r for r in rows if r[0] != 3])
    assert len(found) == 7


def test_dropped_conversations_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    (row,) = turns.repair_query(odd(spark, [(gone, 1, "user", "a.")])).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert turns.repair_query(odd(spark, [])).collect() == []


def test_long_conversation_over_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(turns, "PIECE_ROWS", 7)
    rows = [(9, t, ("user", "assistant", "system", "user", "tool")[t * t % 5], ("", "a.", "b", f"c{t}.")[t * 3 % 4]) for t in range(200)]
    check(turns.repair_query(odd(spark, rows)).collect(), rows)


def test_repaired_rows(spark):
    rows = [(c, t, ("user", "assistant", "system")[(c * t) % 3], f"t{t * c % 5}.") for c in range(12) for t in range(9)]
    found = turns.repair(odd(spark, rows)).collect()
    for c in {r[0] for r in rows}:
        mine = sorted((r.place, r.edit, r.role, r.text) for r in found if r.conv_id == c)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        wanted = plain(damage([r for r in rows if r[0] == c]))
        assert hashlib.sha256("\n".join(f"{m[2]}:{m[3]}" for m in mine).encode()).hexdigest() == wanted[-1]
        assert "".join(m[1] for m in mine) == wanted[-2].replace("D", "")


@pytest.mark.parametrize("size", range(6))
def test_tables_against_all_words(size):
    """Every word of up to five codes (four of the kinds and faults at size 5) against the plain search."""
    codes = [0, 1, 2, 3, 4, 5, 6, 7, 8] if size < 4 else [0, 1, 2, 8] if size == 5 else [0, 1, 2, 5, 7, 8]
    roles = ["system", "user", "assistant", "tool"]
    for word in product(codes, repeat=size):
        rows = [(0, i, roles[c % 4], "" if c == 8 else f"{i}" if c >= 4 else f"{i}.") for i, c in enumerate(word)]
        assert turns.cheapest_edits(np.array(word, np.uint8)) == plain(rows)[5:7]
