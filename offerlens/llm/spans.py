"""Spans of a text as (start, end, kind), in code points, the end exclusive."""

import hashlib


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
