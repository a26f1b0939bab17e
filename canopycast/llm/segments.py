"""Whole texts as segments: a run of white space with the run of other characters that follows it.

The pre-token pattern of byte-level BPE never matches across the start of a white-space run, nor from a word into the
punctuation behind it, so the tokens of a text are those of its segments, one after another, and a segment seen before
need not be encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# The characters of the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters, digits and punctuation of which no pre-token holds both; the apostrophe, which contractions begin with, is left out.
WORD = "0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f"
MARK = '!"#$%&()*,./:;?|-'
SEGMENT = re.compile(f"[{WHITE}]*[{WORD}]++(?=[{MARK}])|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


#: Longer segments are encoded each time they occur.
LONG = 64


class Segments(dict):
    """From segment to what ``encode`` makes of it; emptied when it holds ``limit`` segments, so memory is bounded."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 800_000):
        self.encode, self.limit = encode, limit

    def of(self, texts: list[str]) -> list[list]:
        """For each text the values of its segments."""
        split = [SEGMENT.findall(text) for text in texts]
        if len(self) > self.limit:
            self.clear()
        new = list({s for segments in split for s in segments if s not in self})
        self.update(zip(new, self.encode(new)))
        values = [list(map(self.__getitem__, segments)) for segments in split]
        for s in new:
            if len(s) > LONG:
                del self[s]
        return values
