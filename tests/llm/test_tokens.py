"""Ids by distinct words against the tokenizers library on whole texts."""

import random

import numpy as np
import pytest

from tidemark.llm import tokens
from tidemark.llm.tokens import WordTokenizer, tokenizer_path

PARTS = [" ", "\n", "\t", "a", "b.", "It's", "'s", ",", "###", "é", "é", "\x01", "12", "<|endoftext|>", "\x0b", "\x1f", "\xa0", "日本", "!", "_", "²", "\r\n", "\n\n", "İ", "ß", "̸"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_whole_texts(name):
    rng = random.Random(5)
    texts = ["", "İ_", "İ.", "a\nb", "\na", "a\n", " ", "x" * 3000]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    tok = WordTokenizer(tokenizer_path(name))
    for at in range(0, len(texts), 250):
        some = texts[at : at + 250]
        for text, ids in zip(some, tok.ids(some)):
            assert np.frombuffer(ids, tok.dtype).tolist() == tok.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_an_earlier_call_are_not_encoded_again(name, monkeypatch):
    monkeypatch.setattr(tokens, "HELD", 40)
    tok, seen = WordTokenizer(tokenizer_path(name)), []
    joined = tok._joined
    monkeypatch.setattr(tok, "_joined", lambda text: seen.append(text) or joined(text))
    first = [f"head alpha{chr(97 + i)} beta, {'long' * 20} 12 alpha{chr(97 + i)}." for i in range(20)]
    more = [f"head other{chr(97 + i // 5)}{chr(97 + i % 5)} beta {'long' * 20}" for i in range(25)]
    for number, texts in enumerate((first, first, more, first, more)):
        seen.clear()
        for text, ids in zip(texts, tok.ids(texts)):
            assert np.frombuffer(ids, tok.dtype).tolist() == tok.tokenizer.encode(text, add_special_tokens=False).ids, text
        assert any("alpha" in x for x in seen) == (number == 0)
        assert len(tok.held) <= 40 and not any("longlong" in w for w in tok.held)
