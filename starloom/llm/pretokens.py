"""Splitting of whole texts into the pieces that byte-level BPE encodes one by one."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the tokenizers understand it (the Unicode property); Java's \s is narrower.
_SPACE = r"\t-\r\x20\x85\xA0  -     　"
# Characters that Java does not know yet: such texts are split by the `regex` library, which is newer.
_UNKNOWN = r"\p{Cn}"


def java_pattern(pattern: str) -> str:
    """The pattern with white space spelled out, for Spark's own regular expressions."""
    return pattern.replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


def split_columns(text: Column, pattern: str) -> tuple[Column, Column]:
    """`pieces`, all matches of the pattern in order, and `whole`, the text itself where Python has to split it."""
    odd = text.rlike(_UNKNOWN)
    pieces = F.when(~odd, F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0)))
    return pieces.alias("pieces"), F.when(odd, text).alias("whole")


@cache
def _compiled(pattern: str):
    return regex.compile(pattern)


def coded(pieces: pa.Array, whole: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces of a batch, the code of each piece in order, and where each row's codes begin (one more at the end)."""
    if whole.null_count < len(whole):
        split = [_compiled(pattern).findall(w) if w is not None else p for p, w in zip(pieces.to_pylist(), whole.to_pylist(), strict=True)]
        pieces = pa.array(split, pa.list_(pa.string()))
    begins = np.concatenate(([0], np.cumsum(np.asarray(pieces.value_lengths().fill_null(0), dtype=np.int64))))
    encoded = pieces.flatten().dictionary_encode()
    return encoded.dictionary, np.asarray(encoded.indices, dtype=np.int32), begins


def gathered(values: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of every code one after another, and how many each code has; code c owns values[starts[c]:starts[c + 1]]."""
    many = np.diff(starts)[codes]
    ends = np.cumsum(many)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[codes] - (ends - many), many)
    return values[at], many
