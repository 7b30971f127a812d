"""Brute-force versions the operators are tested against."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "don't we'll 're 'r x'rx 'lll", "''s '' s !'s", "x<|endoftext|> y <|endoftext|><|endoftext|>",
    "a\x1cb !\x1c! \x85 \xa0 　x", "१२३ ½ ² x²", "a" * 3000, "ab" * 500 + " " * 50 + "x", "\t\t\tx ​ zero",
    "日本語のテキスト", "\U0001f642\U0001f642 é", "\r\n \r\n x", "word " * 9000, "Z" * 70_000, "<|endoftext|>", "\x00 \x00a",
]


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(fps: list[int], distance: int) -> list[int]:
    """Smallest index reachable from each index."""
    low = list(range(len(fps)))

    def find(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def statistics(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if runs[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
