"""PII: very long texts take time in proportion, long digit runs don't stop a task, base spans are the patterns'."""

import random
import re
import time

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    both = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in both) % 10 == 0


def plain_base(text):
    digits = lambda m: "".join(c for c in m[0] if c in "0123456789")
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(3)
    parts = ["a.b", "@", "x-1.com", ".", "..", " ", "\n", "1", "10.", "255", "256", "0007", "+1", "(212)", "-", "4111 1111 1111 1111", "4111-1111-1111-11", "٣", "é", "_%"]
    for _ in range(20_000):
        text = "".join(r.choices(parts, k=r.randint(1, 14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_digit_runs_are_no_octets():
    assert pii.all_spans("0" * 5000 + ".1.1.1")[0] == [(0, 1, 5006)]
    assert pii.all_spans("9" * 5000 + ".1.1.1")[0] == []
    assert pii.all_spans("1 (dot) 1 (dot) 1 (dot) 1")[1] == [(0, 1, 25)]


def test_long_texts_take_linear_time():
    n = 200_000
    texts = ["0" * n, "1." * (n // 2), "a" * n + "@", "a" * n + " (dot) x", "(" + " " * n + "(", "a@" * (n // 2), "x at y dot z " * (n // 13), ".a" * (n // 2) + "(at) b dot c", ("a" + " " * 50) * (n // 51) + "(dot)", "one " * (n // 4), "о" * n, "a@b.co " * (n // 7) + "jo (at) x (dot) com"]
    for text in texts:
        began = time.process_time()
        pii.all_spans(text)
        assert time.process_time() - began < 3, text[:20]


def test_a_rejected_sign_hides_no_later_address():
    spans = {t[a:b] for t in ["see x at y.com or jo (at) ex (dot) org"] for a, k, b in pii.all_spans(t)[1]}
    assert spans == {"jo (at) ex (dot) org"}
