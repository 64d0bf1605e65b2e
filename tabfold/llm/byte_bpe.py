"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut first, at places where a match of the splitting pattern
surely ends: before white space that follows something else.  No match of the
pattern holds white space after another character, and the pattern never looks
back, so the pieces are encoded on their own with the same ids as the whole.

Defined cases: a null text counts as the empty text, which has no ids; strings
of special tokens are ordinary text; repeated rows are encoded each; a table
without rows gives no rows; other columns are never read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfold.llm.common import ship_package, text_or_empty

PIECE = 1 << 16          # characters: longer texts are cut at safe places
_SAFE = re.compile(r"(?<=\S)(?=\s)")


@functools.lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per worker process."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters that end where a match surely ends."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of the whole text as unsigned 32-bit integers."""
    parts = [np.asarray(enc.encode_ordinary(p), dtype="<u4") for p in safe_pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_texts(docs: DataFrame, key: str, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (binary: little-endian unsigned 32-bit) of every row; no shuffle."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            yield pd.Series([encode(enc, t).tobytes() for t in texts], dtype=object)
    return docs.select(F.col(key), ids(text_or_empty(text)).alias("ids"))


def decode_ids(encoded: DataFrame, key: str, rank_file: str, pattern: str) -> DataFrame:
    """``key`` and ``bytes`` (raw: a part of a token sequence need not be valid UTF-8)."""
    ship_package(encoded.sparkSession)

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for col in batches:
            yield pd.Series([enc.decode_bytes(np.frombuffer(b, "<u4").tolist()) for b in col], dtype=object)
    return encoded.select(F.col(key), raw("ids").alias("bytes"))


def round_trip(docs: DataFrame, key: str, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return both digests per row.

    One Python pass: ids of a batch are decoded where they were made.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            rows = []
            for t in texts:
                ids = encode(enc, t)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col(key), digests(text_or_empty(text)).alias("d")).select(key, "d.*")
