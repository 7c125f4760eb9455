"""Plain forms of what several tests hold the operators against."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

from quizloom.llm import fingerprint


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def pieces(t: str | None) -> Counter:
    """The pieces of a text: how often each occurs."""
    out: Counter = Counter()
    for p in filter(lambda p: p.strip(" "), re.split(fingerprint.CUT, t or "")):
        out.update(p[k : k + fingerprint.LONGEST] for k in range(0, len(p), fingerprint.LONGEST))
    return out


def likeness(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def edited_and_next(rows: list[tuple]) -> list[tuple]:
    """(key, text, edited text, next text) of (key, text) rows: next in descending order of the key, nulls last, equal keys by text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        k = len(t) // 3
        out.append((i, t, t[: len(t) - k] + after[:k], after))
    return out
