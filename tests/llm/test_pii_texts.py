"""Base spans of long and awkward texts: the same as those of the plain patterns, in linear time."""

import random
import time

import pytest

from tallyframe.llm import pii


def plain(text):
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", pii.CARD, 16, 19), ("phone", pii.PHONE, 8, 15)):
        for m in pattern.finditer(text):
            number = pii.digits(m[0])
            if least <= len(number) <= most and (kind == "phone" or pii.luhn(number)):
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("alphabet", ["a@.-_", "a1@. ", "0123.", "4111 -", "+1( )-.2", "a@b.+1- é\n"])
def test_same_spans_as_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for n in (1, 3, 8, 20, 60):
        for _ in range(300):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert pii.base_spans(text) == plain(text), text


def test_known_texts():
    text = "a@b.com_x@y.org 1.2.3.4.5.6.7.8 00255.0.0.01 256.1.1.1 4111-1111 1111 1111 +49 (30) 1234567 x@@y.de"
    assert pii.base_spans(text) == plain(text)
    assert [text[a:b] for k, a, b in pii.base_spans(text) if k == "email"] == ["a@b.com", "_x@y.org"]


@pytest.mark.parametrize(
    "text",
    ["1" * 5000 + ".1.1.1", "1" * 1_000_000, "a" * 1_000_000 + " @", "1" * 1_000_000 + "@", "1." * 500_000, "a@" * 500_000,
     "+1" * 500_000, "1 " * 500_000, "a@b." * 250_000, "a.b-" * 250_000 + "[at]"],
)
def test_long_runs_take_a_second_at_most(text):
    began = time.perf_counter()
    pii.candidates(text, pii.base_spans(text))
    assert time.perf_counter() - began < 5.0


def test_candidates_beside_many_spans():
    text = "1.2.3.4 (555) 123-4567 " * 2000
    found = pii.candidates(text, pii.base_spans(text))
    assert len(found) == 2000 and {k for k, *_ in found} == {"phone"}
