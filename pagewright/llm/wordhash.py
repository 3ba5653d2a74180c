"""Words of many texts as hash arrays: lower case, no diacritics, runs of letters and digits."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Characters handled at once; a longer text is handled alone.
CHUNK_CHARS = 1_000_000
#: Marks in the table: no word character, dropped, several characters after decomposition.
_GAP, _DROP, _MANY = 0, 1, 2
_WORD = re.compile(r"[^\W_]+")


def plain(text: str) -> str:
    """Lower case, compatibility decomposition, combining marks dropped."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def words_of(text: str) -> list[str]:
    return _WORD.findall(plain(text))


@lru_cache(1)
def _table() -> np.ndarray:
    """For each character of the basic plane its plain letter or digit, or a mark."""
    table = np.zeros(0x10000, np.uint32)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        p = plain(chr(code))
        if not p:
            table[code] = _DROP
        elif len(p) > 1:
            table[code] = _MANY
        elif _WORD.fullmatch(p):
            table[code] = ord(p)
    return table


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _MIX
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(text: str):
    """A long text cut at blanks, so that no piece needs powers beyond its own length."""
    start = 0
    while len(text) - start > CHUNK_CHARS:
        gap = re.compile(r"\s").search(text, start + CHUNK_CHARS)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each word's text."""
    if all(len(t) <= CHUNK_CHARS for t in texts):
        return _word_hashes(texts)
    parts = [(_word_hashes([piece])[0], i) for i, t in enumerate(texts) for piece in _pieces(t)]
    return np.concatenate([h for h, _ in parts]), np.repeat(np.array([i for _, i in parts], np.int64), [len(h) for h, _ in parts])


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _table()[np.minimum(codes, 0xFFFF)]
    if (kind == _MANY).any() or (codes > 0xFFFF).any():
        texts = [t if t.isascii() else plain(t).replace("\n", " ") for t in texts]
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _table()[np.minimum(codes, 0xFFFF)]
        high = codes > 0xFFFF
        if high.any():
            kind = kind.copy()
            kind[high] = [c if _WORD.fullmatch(chr(c)) else _GAP for c in codes[high].tolist()]
        kind = np.where(kind == _MANY, np.uint32(_GAP), kind)
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    kept = kind != _DROP
    if not kept.all():
        owner_ends = np.cumsum(lengths + 1)
        dropped = np.concatenate([[0], np.cumsum(~kept)])
        ends = owner_ends - dropped[np.minimum(owner_ends, len(kind))]
        kind = kind[kept]
    else:
        ends = np.cumsum(lengths + 1)
    inside = np.concatenate([[False], kind != _GAP, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = 1 << int(len(kind)).bit_length()
    up, down = _powers(max(size, 1 << 21) if size <= 1 << 21 else size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(kind.astype(np.uint64) * up[: len(kind)], dtype=np.uint64)])
        hashes = (sums[stops] - sums[starts]) * down[starts]
    return mixed(hashes ^ (stops - starts).astype(np.uint64)), np.searchsorted(ends, starts, "right")


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, by its first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * _BASE + words[j : j + n]
    return mixed(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by the first one."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span : width - span + n])


def chunks(texts: list[str]):
    """Slices of ``texts`` with about ``CHUNK_CHARS`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)
