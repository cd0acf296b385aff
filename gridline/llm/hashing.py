"""Word and shingle hashes of whole batches of texts, as numpy work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240229)
# One random 64-bit value per byte, A-Z as a-z; a word's hash is a polynomial in an odd base, mixed.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_EXACT = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)     # the same with A-Z apart, and a second value
_OTHER = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SEPARATORS = _SPACE.copy()        # white space and ASCII punctuation
SEPARATORS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 20   # bytes hashed at once, so that the arrays stay small
SIZE = 5          # words of a shingle


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n + 1 powers; kept for chunks of the usual size, made anew for a longer text."""
    if len(_POWERS.get(base, ())) > n:
        return _POWERS[base][:n + 1]
    size = max(n, CHUNK + (1 << 16))
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])
    if n <= 4 * CHUNK:
        _POWERS[base] = powers
    return powers[:n + 1]


def chunks(texts: list[str] | list[bytes], limit: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts as UTF-8, in lists of about ``limit`` bytes; a longer text is a list of its own."""
    out, size = [], 0
    for t in texts:
        b = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
        if out and size + len(b) > limit:
            yield out
            out, size = [], 0
        out.append(b)
        size += len(b) + 1
    if out:
        yield out


def word_spans(texts: list[bytes], blanks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts joined by a space: bytes, first and end of each word, and its text's number."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = blanks[joined]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return joined, first, end, np.searchsorted(starts, first, "right") - 1


def distinct_pieces(joined: bytes, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts cut where white space begins: first and end of each piece, its kind, and a piece of each kind.

    ``stops`` are the ends of the texts. Pieces are of a kind if their hashes are equal and, which is
    then checked, their lengths and the sums of another value per byte.
    """
    data = np.frombuffer(joined, np.uint8)
    blank = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = ~blank[:-1] & blank[1:]
    cut[stops] = True
    cut[0] = False
    end = np.flatnonzero(cut)
    first = np.concatenate([[0], end[:-1]])[:len(end)]
    n = len(data)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_EXACT[data] * _powers(_BASE, n)[:n])])
    key = (total[end] - total[first]) * _powers(_INVERSE, n)[first]
    other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OTHER[data])])
    check = (other[end] - other[first]) + (end - first).astype(np.uint64)
    _, pick, kind = np.unique(key, return_index=True, return_inverse=True)
    if not np.array_equal(check, check[pick][kind]):
        _, pick, kind = np.unique(np.stack([key, check], 1), axis=0, return_index=True, return_inverse=True)
    return first, end, kind.reshape(-1), pick


def word_hashes(texts: list[bytes], blanks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) and the number of each word's text.

    Words are the runs of bytes that ``blanks`` doesn't mark: by default ASCII white space.
    """
    joined, first, end, of = word_spans(texts, blanks)
    return span_hashes(joined, first, end), of


def span_hashes(joined: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(joined)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[joined] * _powers(_BASE, n)[:n])])
    raw = (total[end] - total[first]) * _powers(_INVERSE, n)[first]
    return mix64(raw + (end - first).astype(np.uint64) * _PLACE[7])


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Per text its distinct shingles of five words, as sorted hashes; shorter texts are one shingle."""
    words, of = word_hashes(texts)
    counts = np.bincount(of, minlength=len(texts))
    ends = np.cumsum(counts)
    grams = np.zeros(0, np.uint64)
    if len(words) >= SIZE:
        m = len(words) - SIZE + 1
        grams = mix64(sum((words[j:j + m] * _PLACE[j] for j in range(1, SIZE)), words[:m] * _PLACE[0]))
    out = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= SIZE:
            out.append(np.unique(grams[end - n:end - SIZE + 1]))
        elif n:
            short = sum((words[end - n + j:end - n + j + 1] * _PLACE[j] for j in range(n)), np.full(1, n, np.uint64))
            out.append(mix64(short ^ _PLACE[6]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
