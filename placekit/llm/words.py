"""Words as bytes, shared by the operators that work on word sequences.

A word is a maximal run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z were
lower-cased, so digits, a-z and everything outside ASCII belong to words.  On
UTF-8 bytes this is one 256-entry translation and a split on blanks.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _translation() -> bytes:
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        if c.isascii() and c.isupper():
            out[b] = ord(c.lower())
        elif not (c.isdigit() or c.islower()):
            out[b] = 0x20
    return bytes(out)


TRANSLATION = _translation()


def word_list(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text (null: none), lower-cased."""
    return text.translate(TRANSLATION).split() if text else []


_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_BLOCK = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def _block_hashes(b: np.ndarray) -> np.ndarray:
    """Hashes of the words in blank-separated bytes: differences of one running
    sum of byte * base**position, divided by base**start."""
    word = np.concatenate(([False], b != 32, [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers(max(len(b), _BLOCK))
    with np.errstate(over="ignore"):
        run = np.concatenate(([np.uint64(0)], np.cumsum(b.astype(np.uint64) * up[:len(b)])))
        return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 texts, one after the other, and the
    number of words of each text (null: none)."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    held, size = [], 0

    def flush():
        nonlocal held, size
        if held:
            joined = b" ".join(t for _, t in held)
            b = np.frombuffer(joined, np.uint8)
            hashes.append(_block_hashes(b))
            word = np.concatenate(([False], b != 32))
            starts = np.concatenate(([0], np.cumsum(word[1:] & ~word[:-1])))
            at = np.cumsum([0] + [len(t) + 1 for _, t in held])
            np.add.at(counts, [i for i, _ in held], np.diff(starts[np.minimum(at, len(b))]))
        held, size = [], 0

    for i, t in enumerate(texts):
        t = t.translate(TRANSLATION) if t else b""
        while len(t) > _BLOCK:  # a long text in blocks that end at a blank
            cut = t.find(b" ", _BLOCK)
            if cut < 0:
                break
            flush()
            held = [(i, t[:cut])]
            t = t[cut + 1:]
            flush()
        if t:
            if size + len(t) > _BLOCK:
                flush()
            held.append((i, t))
            size += len(t) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words inside each text, one text after the
    other, and their number for each text.  A text of fewer words, but some,
    has one shingle: all its words."""
    grams = gram_hashes(hashes, k)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)[:len(grams)]
    inside = np.arange(len(grams)) + k <= ends[owner]
    number = np.maximum(counts - k + 1, 0)
    out = grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([gram_hashes(hashes[ends[i] - counts[i]:ends[i]], int(counts[i]))[0] for i in short],
                         np.uint64)
        out = np.insert(out, np.concatenate(([0], np.cumsum(number)))[short], whole)
        number[short] = 1
    return out, number


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
            out ^= out >> np.uint64(29)
        return mix(out)
