"""Regexes written in Python's Unicode dialect, rendered for Spark's Java engine.

Python's ``\\s``, ``\\d`` and ``\\b`` are Unicode aware and combining marks are not
word characters there; Java's shorthands differ.  ``java`` spells the classes out,
so a pattern means the same thing on both sides.
"""

from __future__ import annotations

import re

# Inside (?U) the shorthand \\s is one property test; the information separators are white space to Python only.
SPACE = r"\s\x1C-\x1F"
WORD = r"\p{L}\p{N}_"
_EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_START = f"(?<![{WORD}])"  # what \\b means ahead of a letter or digit

_OUTSIDE = {"s": f"[{SPACE}]", "S": f"[^{SPACE}]", "d": r"\p{Nd}", "w": f"[{WORD}]", "b": _EDGE}
_INSIDE = {"s": SPACE, "d": r"\p{Nd}", "w": WORD}
_TOKEN = re.compile(r"\\(.)|(\[)|(\])", re.S)


def java(pattern: str, ignore_case: bool = False) -> str:
    """Render a Python-dialect pattern for Java, with ``.`` and ``$`` tied to ``\\n`` only."""
    in_class = False
    head = ""
    if pattern.startswith(r"\b"):
        # Every rule that opens with \\b goes on with a letter or digit; for digits, test the cheap part first.
        head = (r"(?=\p{Nd})" if pattern.startswith((r"\b(\d", r"\b\d")) else "") + _START
        pattern = pattern[2:]

    def swap(m: re.Match) -> str:
        nonlocal in_class
        if m.group(2):
            in_class = True
        elif m.group(3):
            in_class = False
        else:
            return (_INSIDE if in_class else _OUTSIDE).get(m.group(1), m.group(0))
        return m.group(0)

    return ("(?idU)" if ignore_case else "(?dU)") + head + _TOKEN.sub(swap, pattern)
