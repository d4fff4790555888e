"""Places in a text where a token surely ends.

A position between a byte that is not ASCII white space and an ASCII white space ends a token of a tokenizer that drops
white space, whatever stands before or after.
"""

from __future__ import annotations

import re

CUT = re.compile(rb"[^ \t\n\r\x0b\x0c](?=[ \t\n\r\x0b\x0c])")
SPACES = b" \t\n\r\x0b\x0c"


def last_cut(chunk: bytes) -> int:
    """The last sure end of a token inside the chunk, or -1."""
    at = len(chunk)
    while at > 0:
        at = max(chunk.rfind(s, 0, at) for s in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
        if at > 0 and chunk[at - 1] not in SPACES:
            return at
    return -1

