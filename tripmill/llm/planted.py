"""Changes that the contracts of operators 12 and 13 make to texts before they are searched."""

from __future__ import annotations

import zlib


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Let the tail of one document in ten repeat; a null id changes nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def drop_letter(doc_id: str, word: str) -> str:
    """Drop a letter of one word in 31."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]
