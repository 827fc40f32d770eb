"""Splitting text by a tokenizer's pattern, the same in tasks of several operators."""

import re

import regex

FAST_BELOW = 0x250  # Latin letters and marks; beyond, the general engine splits
_cache: dict[str, "Splitter"] = {}


class Splitter:
    """All matches of ``pattern`` in a text, in order.

    The pattern's character classes are spelled out for code points below
    ``FAST_BELOW``, which the plain ``re`` engine scans over twice as fast; a
    text with any other character goes through ``regex``. Results are equal.
    """

    def __init__(self, pattern: str):
        self.general = regex.compile(pattern).findall
        self.foreign = re.compile(f"[^\\x00-{chr(FAST_BELOW - 1)}]").search
        low = [chr(i) for i in range(FAST_BELOW)]
        members = {k: "".join(re.escape(c) for c in low if regex.match(k, c)) for k in (r"\p{L}", r"\p{N}", r"\s")}
        plain = pattern
        for name in (r"[^\s\p{L}\p{N}]", r"\p{L}", r"\p{N}", r"\S", r"\s"):
            inside = "".join(v for k, v in members.items() if k in name.replace(r"\S", r"\s"))
            plain = plain.replace(name, f"[{'^' if name[1] in '^S' else ''}{inside}]")
        self.fast = re.compile(plain).findall if r"\p" not in plain else self.general

    def __call__(self, text: str) -> list[str]:
        return self.general(text) if self.foreign(text) else self.fast(text)


def splitter(pattern: str) -> Splitter:
    """One per pattern and Python worker."""
    if pattern not in _cache:
        _cache[pattern] = Splitter(pattern)
    return _cache[pattern]
