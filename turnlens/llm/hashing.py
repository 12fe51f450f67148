"""Words and characters of texts as integer arrays."""

from __future__ import annotations

import functools
import re

import numpy as np
import xxhash

#: A word: letters and digits of any script.
WORD = re.compile(r"\w+")
#: Latin-1 characters in lower case, with spaces for those that are in no word.
LATIN = bytes(ord(c.lower()) if WORD.fullmatch(c) else 32 for c in map(chr, range(256)))
#: The same, but line ends stay.
LATIN_LINES = LATIN[:10] + b"\n" + LATIN[11:]
#: What is in no word and ends no line.
GAP = re.compile(r"[^\w\n]")


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound; the hash is the same on every machine."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def words(text: str) -> list[str]:
    """The words in lower case. Most texts are Latin-1, which a table cuts faster than a pattern."""
    try:
        return text.encode("latin-1").translate(LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(text.lower())


def offset(seed: int) -> np.uint64:
    return np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """Another well-spread unsigned hash of each value, one per seed."""
    return scramble(values.astype(np.uint64) + offset(seed))


#: Words are hashed as sums of their characters' values times powers of a number that has an inverse.
STEP = 0xD6E8FEB86659FD93
BACK = pow(STEP, -1, 1 << 64)

#: Characters whose words are hashed at once.
CHARS_AT_ONCE = 1 << 20


def letters(chars: np.ndarray) -> np.ndarray:
    """The value of each character; none for spaces and line ends, which are in no word."""
    return np.where(chars > 32, scramble(chars.astype(np.uint64) + offset(61)), np.uint64(0))


LETTERS = letters(np.arange(256))


@functools.lru_cache(4)
def powers(base: int, places: int) -> np.ndarray:
    """The first ``places`` powers."""
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(places - 1, base, np.uint64))))


def word_hash(word: str) -> int:
    """64 bits of a word in lower case; ``cut`` gives the same for many at once."""
    total = 0
    for i, value in enumerate(letters(code_points(word)).tolist()):
        total += value * pow(STEP, i, 1 << 64)
    return int(scramble(np.array([(total + len(word)) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def characters(text: str) -> np.ndarray:
    """The text in lower case with spaces for all that is in no word, line ends excepted."""
    try:
        return np.frombuffer(text.encode("latin-1").translate(LATIN_LINES), np.uint8)
    except UnicodeEncodeError:
        return code_points(GAP.sub(" ", text.lower()))


def cut(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of characters and line of each word, from ``characters``."""
    hashes, sizes, lines = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    first = line = 0
    while first < len(chars):
        end = min(first + CHARS_AT_ONCE, len(chars))
        if end < len(chars):  # a piece ends where no word is cut
            gaps = np.flatnonzero(chars[first:end] <= 32)
            if not len(gaps):
                gaps = np.flatnonzero(chars[first:] <= 32)[:1]
            end = first + int(gaps[-1]) + 1 if len(gaps) else len(chars)
        piece = chars[first:end]
        inside = piece > 32
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, size, ends = edges[::2], edges[1::2] - edges[::2], np.flatnonzero(piece == 10)
        if len(starts):
            places = 1 << (len(piece) - 1).bit_length()
            values = (LETTERS[piece] if piece.dtype == np.uint8 else letters(piece)) * powers(STEP, places)[: len(piece)]
            hashes.append(scramble(np.add.reduceat(values, starts) * powers(BACK, places)[starts] + size.astype(np.uint64)))
            sizes.append(size)
            lines.append(np.searchsorted(ends, starts) + line)
        line += len(ends)
        first = end
    return np.concatenate(hashes), np.concatenate(sizes), np.concatenate(lines)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` values, in order; empty if there are fewer."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x100000001B3) + mix(values[i : i + n], i)
    return mix(out, size)


def parities(tokens: np.ndarray, lengths: np.ndarray, longs: int) -> np.ndarray:
    """One row of longs a text: whether the number of its words that fall to each bit is odd.

    ``tokens`` holds the words of all texts. A word taken away or added turns one bit, a changed
    one two, so that texts differ in no more bits than twice their edits.
    """
    places = 64 * longs
    text = np.repeat(np.arange(len(lengths)), lengths)
    bit = (mix(tokens, 59) % np.uint64(places)).astype(np.int64)
    odd = np.bincount(text * places + bit, minlength=len(lengths) * places).astype(np.uint8).reshape(-1, places) & 1
    return np.packbits(odd, axis=1).view(np.int64).reshape(-1, longs)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
