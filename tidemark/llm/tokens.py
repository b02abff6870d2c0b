"""Token ids of whole texts from a public tokenizer file, by their distinct words.

A text is cut at single spaces between two characters that aren't white space and before single line
ends there.  Both pre-tokenizers used here start a new piece at such a place and never join across it,
so the ids of the parts are the ids of the whole.  Arrow cuts the texts of one call and numbers their
distinct words; the tokenizers library encodes each of these once, many in one text, and numpy puts the
texts together again.  From one call to the next the ids of HELD words at most are kept, none of them long.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain, repeat
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Texts are best given in slices of about this many characters: more of their words repeat.
TOKEN_CHARS = 16_000_000
_IRREGULAR = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
_MARK = "\x01"
#: Letters that are one piece together, have no combining form and whose lower case is one letter.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_AT_ONCE = 1_000
#: Words whose ids are kept, and characters of such a word at most: some 50 MB a worker.
HELD, HELD_CHARS = 1 << 18, 48


def _form(word: str) -> str:
    """How a word stands in a text: after its line end, or after a space."""
    return word if word[:1] == "\n" else f" {word}"


def _gathered(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[start : start + size] of every pair, one after the other."""
    ends = np.cumsum(size)
    return pool[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


class WordTokenizer:
    """ids(texts) gives each text's ids as little-endian uint16 (uint32 for over 65,536 ids) bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.spaced = self._whole(" a") != self._whole("a")  # a leading space counts
        self.mark = np.frombuffer(self._whole(f" {_MARK}"), self.dtype)
        #: Ids that begin a word (a space or line end comes first) or, without spaces, that end one.
        self.edge = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token[:1] in ("Ġ", "Ċ") if self.spaced else token.endswith("</w>")
        #: Each kept word's number; the ids of all, one after the other, and how many each has.
        self.held: dict[str, int] = {}
        self.held_ids, self.held_size = np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _joined(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their numbers for words of letters only: each is one piece, whose edge shows."""
        ids = self._joined("".join(map(_form, words)))
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):
            return None
        return ids, np.diff(at, append=len(ids)) if self.spaced else np.diff(at, prepend=-1)

    def _marked(self, words: list[str]) -> list[bytes]:
        """The ids of each word, which has no inner cut; a mark after each shows where its ids end."""
        found: dict[str, bytes] = {}
        part = [w for w in words if len(w.split()) == 1 and not w[1:2].isspace() and not w[-1].isspace() and _MARK not in w]
        ids = self._joined(f" {_MARK}".join(["", *map(_form, part), ""]))
        n, m = len(self.mark), self.mark
        hits = np.flatnonzero(np.all([ids[i : len(ids) - n + 1 + i] == m[i] for i in range(n)], axis=0))
        if len(hits) == len(part) + 1:
            data, size = ids.tobytes(), self.dtype.itemsize
            found.update([(w, data[a:b]) for w, a, b in zip(part, (size * (hits[:-1] + n)).tolist(), (size * hits[1:]).tolist())])
        return [found[w] if w in found else self._whole(_form(w)) for w in words]

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these distinct words, one after the other, and how many each has."""
        some, known = words.to_pylist(), len(self.held)
        at = np.fromiter(map(self.held.get, some, repeat(-1)), np.int64, len(some))
        new = np.flatnonzero(at < 0)
        ids, size = self._unknown(words.take(pa.array(new)))
        at[new] = known + np.arange(len(new))
        pool, sizes = np.concatenate([self.held_ids, ids]), np.concatenate([self.held_size, size])
        starts = _starts(sizes)
        if room := HELD - known:
            keep = np.array([i for i in new.tolist() if len(some[i]) <= HELD_CHARS][:room], np.int64)
            self.held.update(zip([some[i] for i in keep.tolist()], range(known, known + len(keep))))
            self.held_ids = np.concatenate([self.held_ids, _gathered(pool, starts[at[keep]], sizes[at[keep]])])
            self.held_size = np.concatenate([self.held_size, sizes[at[keep]]])
        return _gathered(pool, starts[at], sizes[at]), sizes[at]

    def _unknown(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """_encoded for words that aren't kept."""
        plain = pc.match_substring_regex(words, f"^\n?[{_LETTERS}]+$")
        pools, size, base = [np.zeros(0, self.dtype)], np.zeros(len(words), np.int64), 0
        start = np.zeros(len(words), np.int64)
        for mask in (plain, pc.invert(plain)):
            where, some = np.flatnonzero(mask.to_numpy(zero_copy_only=False)), words.filter(mask).to_pylist()
            for at in range(0, len(some), _AT_ONCE):
                part = some[at : at + _AT_ONCE]
                found = self._letters(part) if mask is plain else None
                if found is None:
                    each = self._marked(part)
                    found = np.frombuffer(b"".join(each), self.dtype), np.fromiter(map(len, each), np.int64, len(each)) // self.dtype.itemsize
                size[where[at : at + len(part)]] = found[1]
                start[where[at : at + len(part)]] = base + _starts(found[1])
                base += len(found[0])
                pools.append(found[0])
        return _gathered(np.concatenate(pools), start, size), size

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As _encoded, by way of the words' stems.

        ASCII punctuation after a letter or digit begins a piece of its own to both pre-tokenizers.
        """
        bare = pc.utf8_rtrim(words, characters=punctuation)
        cut = pc.and_(pc.less(pc.binary_length(bare), pc.binary_length(words)), pc.match_substring_regex(bare, f"[0-9{_LETTERS}]$"))
        stem = pc.if_else(cut, bare, words)
        if not self.spaced:  # case and the white space before a word don't count either
            stem = pc.if_else(pc.string_is_ascii(stem), pc.ascii_lower(pc.ascii_ltrim(stem, characters="\n")), stem)
        stems = pc.dictionary_encode(stem)
        ends = [w[n:] for w, n in zip(words.filter(cut).to_pylist(), pc.utf8_length(bare.filter(cut)).to_pylist())]
        tails = pc.dictionary_encode(pa.array(ends, pa.large_string()))
        ids, size = self._encoded(stems.dictionary)
        known = [np.frombuffer(self._whole(x), self.dtype) for x in tails.dictionary.to_pylist()]
        tail_size = np.fromiter(map(len, known), np.int64, len(known))
        # For each word two runs: its stem's and its tail's.
        start, length = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        of_stem, of_tail = stems.indices.to_numpy(), tails.indices.to_numpy()
        start[:, 0], length[:, 0] = _starts(size)[of_stem], size[of_stem]
        has = cut.to_numpy(zero_copy_only=False)
        start[has, 1], length[has, 1] = len(ids) + _starts(tail_size)[of_tail], tail_size[of_tail]
        return _gathered(np.concatenate([ids, *known]), start.ravel(), length.ravel()), length.sum(1)

    def ids(self, texts: list[str]) -> list[bytes]:
        odd = [bool(_IRREGULAR.search(t)) for t in texts]
        order = sorted(range(len(texts)), key=odd.__getitem__)
        even = len(texts) - sum(odd)
        lines = pc.replace_substring(pa.array([texts[i] for i in order[:even]], pa.large_string()), "\n", " \n")
        parts = pc.split_pattern(lines, " ")
        others = [_CUT.split(texts[i]) for i in order[even:]]
        counts = np.concatenate([pc.list_value_length(parts).to_numpy().astype(np.int64), np.fromiter(map(len, others), np.int64, len(others))])
        flat = pa.concat_arrays([parts.flatten(), pa.array(list(chain.from_iterable(others)), pa.large_string())])
        first = np.zeros(len(flat), bool)
        first[_starts(counts)] = True
        heads = [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(flat.filter(pa.array(first)).to_pylist(), add_special_tokens=False)]
        words = pc.dictionary_encode(flat.filter(pa.array(~first)))
        del lines, parts, flat
        pool, size = self._distinct(words.dictionary)
        number = words.indices.to_numpy()
        each = size[number]
        data = _gathered(pool, _starts(size)[number], each).tobytes()
        bounds = self.dtype.itemsize * np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(counts - 1)])]
        out = [b""] * len(texts)
        for i, head, a, b in zip(order, heads, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = head + data[a:b]
        return out


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    return WordTokenizer(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
