"""Span lists of the finders: ``kind:start:end`` items (code points, end exclusive) and their digests."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
