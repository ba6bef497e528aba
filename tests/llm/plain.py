"""Plain helpers of these tests."""

from __future__ import annotations

from functools import cache

import numpy as np

SF_DIR = "/root/testdata/sf0.001"


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(path: str, text: str) -> bytes:
    return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
