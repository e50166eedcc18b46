"""A noisy channel for disguised words: a character language model and a Viterbi decoder.

Letters may have been replaced by look-alikes, repeated, or set apart. Each disguised word
becomes a lattice of what its characters may stand for; the most likely path under the
language model and the costs of the channel is the restored word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import slices

# Character classes: 0 is the gap between words, then a-z, then the letters U+00DF to U+00FF.
GAP, FIRST_LATIN, OTHER_LETTER, DIGIT, SYMBOL = 0, 27, 60, 61, 62
CLASSES = 63
_TABLE = 0x250

# What a character is often written for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~'`^/\\,:;·•"
# Channel costs, as negative logarithms of probabilities.
LOOKALIKE_COST, DROP_COST, SPLIT_COST, SHORTEN_COST = 1.0, 0.7, 4.0, 0.5
# Longer tokens (addresses, phrases in hyphens) are read part by part, and what cannot be parted in overlapping pieces of this length.
LONGEST = 40

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "«»“”„‘’…–—¿"
_DECORATED = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$")
_DISGUISED = re.compile(
    r"[^\W\d_][\d@$!|+€£¡]|[\d@$!|+€£¡][^\W\d_]"
    rf"|[^\W\d_][{re.escape(SEPARATORS)}][^\W\d_][{re.escape(SEPARATORS)}]"
    r"|([^\W\d_])\1\1|([^\W\d_])\2.*([^\W\d_])\3"
)
# Marks that may be letters where a word begins or ends. Behind a word only a single + or | may be one: doubled marks there are decoration, as in `word$$$`.
_EDGE_LETTERS = re.compile(r"^[^\w!|+@$€£]*((?:[!|+€£]|([@$])\2)[!|+@$€£]*[^\W\d_]\S*?|[^\W\d_][^+|]*[+|])[^\w+|@$€£]*$")
_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+€£¡])(?:\s{1,4}(?:[^\W_]|[@$!|+€£¡])){2,}(?!\S)")
_SPACED_HINT = re.compile(r"(?<!\S)\S\s{1,4}\S\s{1,4}\S(?!\S)")
_PARTS = re.compile(r"[^\w@$!|+€£¡]+|_+")


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(_TABLE, OTHER_LETTER, np.uint8)
    for c in range(_TABLE):
        ch = chr(c)
        if ch.isspace():
            out[c] = GAP
        elif "a" <= ch <= "z":
            out[c] = 1 + c - ord("a")
        elif 0xDF <= c <= 0xFF and c != 0xF7:
            out[c] = FIRST_LATIN + c - 0xDF
        elif ch.isdigit():
            out[c] = DIGIT
        elif not ch.isalpha():
            out[c] = SYMBOL
    return out


def classes_of(text: str) -> np.ndarray:
    """The class of each character; general punctuation counts as symbols."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _classes()
    out = table[np.minimum(codes, _TABLE - 1)]
    odd = codes >= _TABLE
    if odd.any():
        out[odd] = np.where((codes[odd] >= 0x2000) & (codes[odd] < 0x2070), SYMBOL, OTHER_LETTER)
    return out


def _trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    count = np.zeros(CLASSES**3, np.int64)
    for batch in batches:
        texts = [t.lower() if isinstance(t, str) else "" for t in batch["text"]]
        for a, b in slices(texts):
            c = classes_of(f" \n{' \n'.join(texts[a:b])} \n").astype(np.int32)
            count += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(count))
    found = np.flatnonzero(count)
    yield pd.DataFrame({"trigram": found.astype(np.int32), "n": count[found]})


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative logarithms) of each class after any two, from the texts of all documents.

    The table has 63 x 63 x 63 cells at any size of the input; only it reaches the driver.
    """
    rows = docs.select("text").mapInPandas(_trigrams, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    n3 = np.zeros(CLASSES**3)
    n3[found["trigram"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    n3 = n3.reshape(CLASSES, CLASSES, CLASSES)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1.sum() + CLASSES)
    p2 = (n2 + 5 * p1) / (n2.sum(axis=1, keepdims=True) + 5)
    p3 = (n3 + 5 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 5)
    return (-np.log(p3)).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """What each run of equal characters of a token may stand for, with its channel cost."""
    out = []
    for run in re.finditer(r"(.)\1*", token, re.DOTALL):
        ch, n = run[1], len(run[0])
        if ch.isalpha():
            if n == 1:
                out.append([(ch, 0.0)])
            elif n == 2:
                out.append([(ch * 2, 0.0), (ch, SHORTEN_COST)])
            else:
                out.append([(ch, SHORTEN_COST), (ch * 2, 2 * SHORTEN_COST)])
            continue
        options = [(ch * min(n, 3), 0.0)] if ch not in SEPARATORS and ch != " " else [(" ", SPLIT_COST), ("", DROP_COST if ch != " " else 0.0)]
        for letter in LOOKALIKES.get(ch, ""):
            options += [(letter, LOOKALIKE_COST + SHORTEN_COST * (n > 1))]
            if n > 1:
                options.append((letter * 2, LOOKALIKE_COST + 2 * SHORTEN_COST))
        out.append(options)
    return out


@lru_cache(4096)
def _class(ch: str) -> int:
    return int(classes_of(ch)[0])


def decode(token: str, costs: np.ndarray) -> str:
    """The most likely reading of a token. Of equally likely readings the first found stands."""
    best: dict[tuple[int, int], tuple[float, str]] = {(GAP, GAP): (0.0, "")}
    for options in [*lattice(token), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for emitted, extra in options:
                x, y, total = a, b, cost + extra
                for ch in emitted:
                    z = _class(ch)
                    total += float(costs[x, y, z])
                    x, y = y, z
                known = after.get((x, y))
                if known is None or total < known[0]:
                    after[x, y] = (total, text + emitted)
        best = after
    return min(best.values(), key=lambda c: c[0])[1]


def stripped(token: str) -> str:
    """A token without the marks around it; a doubled mark at an edge is decoration."""
    return _DECORATED.sub("", token).strip(_EDGES)


def restored(token: str, costs: np.ndarray) -> list[str]:
    """The words that a lower-case token stands for.

    A token with marks at its edges that may be letters (`!diot`, `shi+`, `$$hit`) has two readings, without and with them; the
    words of both are given.
    """
    words = _read(stripped(token), costs)
    edge = _EDGE_LETTERS.match(token)
    if edge and edge[1] != stripped(token) and len(edge[1]) <= LONGEST:
        words += [w for w in _decoded(edge[1], costs) if w not in words]
    return words


def _decoded(word: str, costs: np.ndarray) -> list[str]:
    short = re.sub(r"(.)\1{3,}", r"\1\1\1", word, flags=re.DOTALL)
    return [w for w in re.findall(r"\w+", decode(short, costs)) if not w.isdigit()]


def _read(word: str, costs: np.ndarray) -> list[str]:
    """The words of a token without the marks around it."""
    if not word or word.isdigit():
        return []
    if word.isalpha() and not _DISGUISED.search(word):
        return [word]
    if " " not in word and not _DISGUISED.search(word):
        return re.findall(r"\w+", word)
    short = re.sub(r"(.)\1{3,}", r"\1\1\1", word, flags=re.DOTALL)
    if len(short.replace(" ", "")) <= LONGEST or " " in short:
        return _decoded(short, costs)
    parts = [p for p in _PARTS.split(short) if p]
    if len(parts) > 1 and 2 * sum(len(p) == 1 for p in parts) < len(parts):
        return list(dict.fromkeys(w for p in parts for w in _read(stripped(p), costs)))
    pieces = (short[i : i + LONGEST] for i in range(0, len(short) - LONGEST // 2, LONGEST // 2))
    return list(dict.fromkeys([*re.findall(r"\w+", word), *(w for p in pieces if _DISGUISED.search(p) for w in _decoded(p, costs))]))


def tokens(text: str) -> set[str]:
    """Distinct lower-case tokens of a text; single characters set apart make one token."""
    low = text.lower()
    if _SPACED_HINT.search(low):
        joined = [re.sub(r"\s", " ", m[0]) for m in _SPACED.finditer(low)]
        if joined:
            return {*_SPACED.sub(" ", low).split(), *joined}
    return set(low.split())
