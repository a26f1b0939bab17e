"""Token ids of whole texts by the tokenizers library, as little-endian bytes, with remembered segments."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cache

import numpy as np

from .segments import Segments

#: Segments that one call of the library takes.
CALL = 20_000


@cache
def encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """One per Python worker and vocabulary. Gives each text's ids as an array of unsigned 32-bit integers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(segments: list[str]) -> list[bytes]:
        found = []
        for at in range(0, len(segments), CALL):
            for x in tokenizer.encode_batch_fast(segments[at : at + CALL], add_special_tokens=False):
                found.append(np.array(x.ids, "<u4").tobytes())
        return found

    segments = Segments(encode)
    return lambda texts: [np.frombuffer(b"".join(x), "<u4") for x in segments.of(texts)]
