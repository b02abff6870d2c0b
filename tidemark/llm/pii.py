"""PII: offset-preserving deobfuscation, detection on the normalised text, spans in the source.

The base patterns run on the source text.  Then transducers rewrite the text and keep, for each
normalised character, the source span it came from: homoglyphs and compatibility forms become ASCII,
zero-width characters go, spelled digits (zero to nine, in English, German, French and Spanish) become
digits, "plus" a plus, and at/dot disguises become @ and '.'.  Identifiers found in the normalised
text map back to the source; those that touch no base span of their kind, or that widen one over
disguised characters, are added.

Only a text that holds some sign of a disguise is normalised; a test holds that choice against
normalising every text.  Every pattern takes time in proportion to the text: identifiers are looked for
around their signs and in runs of digits, never from each character of a long word.  Offsets are code points, ends exclusive.  Counts (n_*) are of
base spans; n_added counts the others.

Defined results: a null or empty text has no spans; rows that repeat each get a row; null ids are
kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import doc_rows, prepare

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Four parts or more.
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3,}+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"\s")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """All matches of EMAIL, in linear time: one look to the left and one to the right of each @."""
    at, done = text.find("@"), 0
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield a, done
        at = text.find("@", max(at + 1, done))


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    """All matches of IP, in linear time: every four parts of a run of numbers and dots; (start, end, all parts fit)."""
    for run in _DOTTED.finditer(text):
        at, parts = run.start(), run[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i : i + 4])) + 3
            yield at, end, all(map(octet, parts[i : i + 4]))
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches that pass, in order of start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(a, 1, b) for a, b, fits in _ips(text) if fits]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out)


# Spelled digits by language, look-alikes that compatibility forms don't cover.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "υ": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "χ": "x", "γ": "y", "η": "n", "ω": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l", "։": ":", "٫": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "·": ".", "。": ".", "․": ".", "•": ".",
}
GONE = "\u00ad\u034f\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
#: Characters and blocks that homoglyphs come from; accented Latin letters aren't disguises.
_STRANGE = re.compile(
    "[\u00a0\u00ad\u00b2\u00b3\u00b7\u00b9\u0131\u0251\u0261\u034f\u0370-\u052f\u0589\u0660-\u066b\u06f0-\u06f9\u0966-\u096f\u180e"
    "\u2000-\u2015\u2022\u2024\u2028-\u202f\u205f-\u2064\u2070-\u2089\u2100-\u2149\u2212\u2460-\u249b\u24b6-\u24ea\u2776-\u2793\u3000\u3002\ufe52\ufe62\ufe63\ufeff\uff01-\uff5e"
    "\U0001d400-\U0001d7ff\U0001f100-\U0001f10a]"
)
#: These alone, at the edge of a base span, make no new span.
_DASHES_AND_DOTS = set("\u00b7\u2010\u2011\u2012\u2013\u2014\u2015\u2022\u2024\u2212\u3002")
#: Further characters that the rules below read as a space or, ignoring case, as a letter.
_ODD = re.compile(_STRANGE.pattern[:-1] + "\u0085\u0130\u017f\u1680]")
_PLUS = ("plus", "más", "mas")
_SPELLED = "|".join(DIGIT_WORDS)
#: A number of at least ten digits, some perhaps spelled, on lower-cased text; word edges are left to digit_runs.
_NUMBER = re.compile(rf"(?:{_SPELLED}|{'|'.join(_PLUS)}|[0-9])(?:[ ().,-]*(?:{_SPELLED}|[0-9])){{9}}")

_OPEN, _CLOSE = r"[(\[{<]", r"[)\]}>]"
#: The at-sign without the white space around it.
_AT = re.compile(rf"(?P<sign>{_OPEN}\s*(?:at|@|arroba|ät)\s*{_CLOSE}|@)|(?<=\s)(?P<word>at|arroba)(?=\s)", re.I)
_DOT = rf"(?:\s*{_OPEN}\s*(?:dot|punkt|point|punto|\.)\s*{_CLOSE}\s*|\s+(?:dot|punkt|punto)\s+|\s*\.(?=[A-Za-z0-9]))"
_NAME = r"[A-Za-z0-9_%+-]++"
_HOST = r"[A-Za-z0-9-]++"
_RIGHT = re.compile(rf"\s*+{_HOST}(?P<dots>(?:{_DOT}{_HOST})+)", re.I)
#: What stands before an at-sign, on the reversed text.
_TOD = rf"(?:\s*{_CLOSE}\s*(?:tod|tknup|tniop|otnup|\.)\s*{_OPEN}\s*|\s+(?:tod|tknup|otnup)\s+|(?<=[A-Za-z0-9])\.\s*)"
_LEFT = re.compile(rf"\s*+{_NAME}(?:{_TOD}{_NAME})*", re.I)
DISGUISED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_ONE_DOT = re.compile(_DOT, re.I)
_SPOKEN_DOT = re.compile(r"(?:dot|punkt|point|punto)|[(\[{<]", re.I)
_DISGUISES = re.compile(r"[(\[{<]\s*(?:at|@|arroba|ät|dot|punkt|point|punto|\.)\s*[)\]}>]|(?:^|\s)(?:dot|punkt|punto)\s", re.I)


@cache
def _plain(char: str) -> str:
    """One character's plain form: zero, one or more ASCII characters, or itself."""
    if char in GONE:
        return ""
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if char.isspace():
        return char if char.isascii() else " "
    if not _STRANGE.match(char):
        return char
    if unicodedata.decimal(char, None) is not None:
        return str(unicodedata.decimal(char))
    form = unicodedata.normalize("NFKC", char)
    return form if form.isascii() and len(form) <= 4 else char


def plain_characters(text: str) -> tuple[str, list[int]]:
    """The text with each character in plain form, and the source offset of each normalised character."""
    out, at = [], []
    for i, c in enumerate(text):
        p = c if c.isascii() else _plain(c)
        out.append(p)
        at += [i] * len(p)
    return "".join(out), at


_TOKENS = re.compile(r"[^\W\d_]+|[0-9]+|[+(). -]|.", re.S)


def digit_runs(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of digits, spelled or not, and of a phone's and a card's separators: text and offsets.

    Only runs with a spelled digit or "plus" come out; the base patterns have the others.
    """
    run: list[tuple[str, int, int]] = []
    spoken = False

    def done() -> Iterator[tuple[str, list[tuple[int, int]]]]:
        while run and not run[-1][0].isdigit():
            run.pop()
        if spoken and len(run) >= 10:
            yield "".join(x[0] for x in run), [(a, b) for x, a, b in run for _ in x]

    for m in _TOKENS.finditer(text):
        word = m[0].lower()
        if word[0].isdigit() and word.isascii():
            run.append((word, m.start(), m.end())) if len(word) == 1 else run.extend((c, m.start() + i, m.start() + i + 1) for i, c in enumerate(word))
        elif word in DIGIT_WORDS:
            run.append((DIGIT_WORDS[word], m.start(), m.end()))
            spoken = True
        elif word in _PLUS:
            yield from done()
            run, spoken = [("+", m.start(), m.end())], True
        elif word == "+":
            yield from done()
            run, spoken = [("+", m.start(), m.end())], False
        elif word in " -().," and run:
            run.append((" " if word == "," else word, m.start(), m.end()))
        elif run:
            yield from done()
            run, spoken = [], False
    yield from done()


def _spelled_numbers(text: str) -> Iterator[tuple[int, int, int]]:
    for run, at in digit_runs(text):
        # Words are apart by a space; between digits any single separator may stand.
        joined, where = [], []
        for c, span in zip(run, at):
            if c in " -" and joined and joined[-1] in " -+":
                continue
            joined.append(c)
            where.append(span)
        flat = "".join(joined)
        for kind, pattern, least, most in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
            for m in pattern.finditer(flat):
                digits = "".join(c for c in m[0] if c.isdigit())
                if least <= len(digits) <= most and (kind != 2 or luhn(digits)):
                    yield where[m.start()][0], kind, where[m.end() - 1][1]


def _disguised_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses around an at-sign in any form: one look to the left and one to the right of each."""
    back, n, done = None, len(text), 0
    for m in _AT.finditer(text):
        right = _RIGHT.match(text, m.end())
        if right is None:
            continue
        dots = right["dots"]
        # A bare "at" is a common word: then every dot must be spelled or bracketed too.
        if m["word"] and not all(_SPOKEN_DOT.search(d) for d in _ONE_DOT.findall(dots)):
            continue
        back = text[::-1] if back is None else back
        left = _LEFT.match(back, n - m.start(), n - done)
        if left is None:
            continue
        a, done = n - left.end(), right.end()
        if m[0] != "@" or _SPOKEN_DOT.search(dots) or not _SPACE.search(text, a, done):
            yield a, done


def disguised_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in the source of what the normalised text shows."""
    strange = not text.isascii() and _ODD.search(text) is not None
    flat, at = plain_characters(text) if strange else (text, None)
    # The transducers compose: the tests for spelled numbers and spoken signs see the text in plain form.
    spelled = _NUMBER.search(flat.lower()) is not None
    spoken = _DISGUISES.search(flat) is not None
    if not (strange or spelled or spoken):
        return []
    found = list(base_spans(flat)) if strange else []
    if spoken or strange:
        found += [(a, 0, b) for a, b in _disguised_emails(flat)]
    if spoken:
        for m in DISGUISED_IP.finditer(flat):
            if _SPOKEN_DOT.search(m[0]) and all(map(octet, re.findall(r"[0-9]+", m[0]))):
                found.append((m.start(), 1, m.end()))
    if spelled:
        found += _spelled_numbers(flat)
    if at is not None:
        found = [(at[a], k, at[b - 1] + 1) for a, k, b in found]
    return sorted(set(found))


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base spans with those that the normalised text adds."""
    base = base_spans(text)
    out = list(base)
    own = [[(a, b) for a, kind, b in base if kind == k] for k in range(4)]
    ends = [[b for _, b in spans] for spans in own]
    added: list[list[tuple[int, int]]] = [[], [], [], []]  # those that may still touch a later one
    for a, k, b in disguised_spans(text):
        i = bisect_right(ends[k], a)  # base spans of a kind don't overlap
        met = own[k][i : bisect_left(own[k], (b, 0))]
        added[k] = [x for x in added[k] if x[1] > a]
        met += added[k]
        # A span that only grows a known one must owe that to a disguised letter or digit.
        wider = met and all(a <= x and y <= b for x, y in met) and any(not c.isascii() and _STRANGE.match(c) and c not in _DASHES_AND_DOTS for x, y in met[:1] for c in text[a:x] + text[y:b])
        if not met or wider and (a, b) not in met:
            added[k].append((a, b))
            out.append((a, k, b))
    return base, sorted(out)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_EMPTY = hashlib.sha256(b"").hexdigest()
SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts = [], batch.column(1)
        for i in range(len(texts)):
            base, spans = all_spans(texts[i].as_py())
            counts = [sum(k == kind for _, k, _ in base) for kind in range(4)] if base else [0] * 4
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest() if base else _EMPTY, _joined(spans), len(spans) - len(base)))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [x.split()[0] for x in SPANS.split(", ")])


def detect(docs: DataFrame) -> DataFrame:
    """The columns of SPANS for every row of docs."""
    prepare(docs.sparkSession)
    return doc_rows(docs).mapInArrow(_detected, SPANS)


def op5_pii(spark, sf_dir: str) -> DataFrame:
    return detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
