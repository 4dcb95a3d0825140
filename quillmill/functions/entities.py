"""Character references, resolved by the standard HTML5 table (Spark has no built-in)."""

from __future__ import annotations

import html

FENCE = "```"


def decode_outside_fences(text: str) -> str:
    """Resolve references and no-break spaces everywhere but between paired fences."""
    pieces = text.split(FENCE)
    last = len(pieces) - 1
    return FENCE.join(
        piece if at % 2 and at < last else html.unescape(piece).replace("\u00a0", " ")
        for at, piece in enumerate(pieces)
    )
