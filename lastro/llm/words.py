"""Words, lines and window hashes of whole texts, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# Words are maximal runs without these six ASCII characters. ``bytes.split()``
# parts at exactly them, which ``str.split()`` does not.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text looked at together; a longer text is one piece of its own.
PIECE_BYTES = 4 << 20


class WordHash(dict):
    """64-bit hash of a word, remembered. Forgets all beyond a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def pieces(texts: list[str | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Index of the first text and the texts, encoded, in pieces of about ``limit`` bytes."""
    first, piece, held = 0, [], 0
    for index, text in enumerate(texts):
        data = b"" if text is None else text.encode()
        if piece and held + len(data) > limit:
            yield first, piece
            first, piece, held = index, [], 0
        piece.append(data)
        held += len(data)
    if piece:
        yield first, piece


def word_hashes(texts: list[bytes], known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after the other, and each text's number of words."""
    split = [text.split() for text in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    every = (word for words in split for word in words)
    return np.fromiter(map(known.__getitem__, every), dtype=np.uint64, count=int(counts.sum())), counts


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; windows may cross texts."""
    length = len(hashes) - size + 1
    if length <= 0:
        return np.zeros(0, dtype=np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    out = hashes[:length].copy()
    for offset in range(1, size):
        out *= factor
        out += hashes[offset : offset + length]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out
