"""Regular expressions that match a whole keyword dictionary in one scan of a text.

The patterns are evaluated by Spark's own ``regexp_extract_all``. Keywords with a common
beginning share it in the pattern, so the work per character follows the keyword length and
not the size of the dictionary.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

_SPECIAL = set("\\^$.|?*+()[]{}-&~#\"'<>!=:/@,;%`")
_MAX_FLAT = 6  # so many first characters are tried one by one; more are bisected


def quote(text: str) -> str:
    """The pattern that matches ``text`` literally."""
    return "".join("\\" + c if c in _SPECIAL else c for c in text)


def alternation(keywords: Sequence[str]) -> str:
    """A pattern for the first entry of ``keywords`` that matches at a position.

    Equals ``a|b|c`` with every entry quoted. Entries with different first characters exclude
    one another, so only the order within a common beginning has to be kept.
    """
    by_head: dict[str, list[str]] = {}
    may_end = False
    for word in keywords:
        if not word:
            may_end = True
            break  # the empty rest always matches: what follows cannot be reached
        by_head.setdefault(word[0], []).append(word)
    branches = []
    for head in sorted(by_head):
        words = by_head[head]
        shared = os.path.commonprefix(words)
        branches.append((head, quote(shared) + alternation([w[len(shared):] for w in words])))
    if not branches:
        return ""
    if len(branches) == 1 and not may_end:
        return branches[0][1]
    return f"(?:{_bisect(branches)}{'|' if may_end else ''})"


def _bisect(branches: list[tuple[str, str]]) -> str:
    if len(branches) <= _MAX_FLAT:
        return "|".join(body for _, body in branches)
    middle = len(branches) // 2
    halves = branches[:middle], branches[middle:]
    return "|".join(
        f"(?=[\\x{{{ord(half[0][0]):x}}}-\\x{{{ord(half[-1][0]):x}}}])(?:{_bisect(half)})"
        for half in halves
    )


def nesting(pattern: str) -> int:
    """How deeply the groups of a pattern are nested."""
    depth = deepest = 0
    escaped = False
    for c in pattern:
        if escaped or c == "\\":
            escaped = not escaped
        elif c in "()":
            depth += 1 if c == "(" else -1
            deepest = max(deepest, depth)
    return deepest


def longest_first(keywords: Sequence[str]) -> str:
    """A pattern for the longest keyword at a position."""
    return alternation(sorted(keywords, key=len, reverse=True))


def last_wins(keywords: Sequence[str]) -> str:
    """A pattern for the keyword latest in the dictionary at a position."""
    return alternation(list(keywords)[::-1])


def prefix_layers(keywords: Sequence[str]) -> list[list[str]]:
    """Split keywords so that within a layer none is the beginning of another."""
    layers: list[list[str]] = []
    open_prefixes: list[str] = []
    for word in sorted(set(keywords)):
        while open_prefixes and not word.startswith(open_prefixes[-1]):
            open_prefixes.pop()
        if len(open_prefixes) == len(layers):
            layers.append([])
        layers[len(open_prefixes)].append(word)
        open_prefixes.append(word)
    return layers


def separator(keywords: Sequence[str]) -> str:
    """A character that occurs in no keyword."""
    used = set().union(*map(set, keywords)) if keywords else set()
    return next(chr(code) for code in range(1, 0x110000) if chr(code) not in used)
