"""The texts that are normalised hold all that normalising every text would find."""

import random
import re

from tidemark.llm import pii


def ungated(monkeypatch, text):
    with monkeypatch.context() as m:
        always = re.compile("")
        for name in ("_ODD", "_NUMBER", "_DISGUISES"):
            m.setattr(pii, name, always)
        return pii.all_spans(text)


def test_gated_is_ungated(monkeypatch):
    r = random.Random(4)
    parts = [*pii.DIGIT_WORDS, "plus", "más", "mas", "Plus", "ONE", "+", "1", "415", "0134", "10", "(dot)", "(dоt)", "dot", "(at)", "at", "@", "jo", "example", "com", "twо", "оne", "рlus", " ", "\u0085", "İx", "ſite", "oh,", "word", "4111"]
    for _ in range(6000):
        text = r.choice((" ", " ", "", "-", " ")).join(r.choices(parts, k=r.randint(1, 24)))
        if r.random() < 0.5:
            text = f"{r.choice(('plus', 'más', '', 'рlus'))} " + r.choice((" ", "-", ", ")).join(r.choices([*pii.DIGIT_WORDS, *"0123456789"], k=r.choice((10, 11, 14, 16))))
        assert pii.all_spans(text) == ungated(monkeypatch, text), text


def test_words_and_homoglyphs_that_were_lost():
    spans = lambda t: {(pii.KINDS[k], t[a:b]) for a, k, b in pii.all_spans(t)[1]}
    assert spans("call plus 1 415 555 0134") == {("phone", "plus 1 415 555 0134")}
    assert spans("4111 1111 1111 11 one one") == {("card", "4111 1111 1111 11 one one")}
    assert spans("+1 twо 1 2 5 5 5 1 2 3 4") >= {("phone", "+1 twо 1 2 5 5 5 1 2 3 4")}
    assert spans("host 10 (dоt) 0 (dоt) 0 (dоt) 7") == {("ip", "10 (dоt) 0 (dоt) 0 (dоt) 7")}
