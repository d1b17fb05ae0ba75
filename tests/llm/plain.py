"""What the contracts say, in plain Python."""

from __future__ import annotations

import re

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str | None) -> list[str]:
    """Words as the contracts define them, by the pattern over code points."""
    return _WORD.findall((text or "").translate(_LOWER))
