"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters after which a long text is cut at the next safe place.
PIECE = 1 << 16

# No match of the pattern spans a place between other characters and the white space after them:
# white space can only begin a match or fill it. Digits after letters start a match as well, as do
# letters after digits. ASCII only, on which all Unicode tables agree.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` cut at safe places only; a piece is longer than ``size`` up to the next one."""
    start, length = 0, len(text)
    while length - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None or cut.start() >= length:
            break
        yield text[start : cut.start()]
        start = cut.start()
    if start < length:
        yield text[start:]


@functools.lru_cache(maxsize=2)
def encoding(ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@functools.lru_cache(maxsize=2)
def _decimals(ranks: str) -> list[bytes]:
    return [b"%d" % i for i in range(encoding(ranks).max_token_value + 1)]


def encode(text: str | None, ranks: str = RANKS) -> list[int]:
    """Ids of a whole text; strings that look like special tokens are ordinary text."""
    one = encoding(ranks).encode_ordinary
    if not text:
        return []
    return one(text) if len(text) <= PIECE else [i for piece in pieces(text) for i in one(piece)]


def decode(ids: list[int], ranks: str = RANKS) -> bytes:
    return encoding(ranks).decode_bytes(ids)


def with_ids(docs: DataFrame, text: str = "text", into: str = "ids", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the ids of each text; none for null and empty texts."""

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([encode(x, ranks) for x in batch], dtype=object)

    return docs.withColumn(into, of(F.col(text)))


def with_bytes(docs: DataFrame, ids: str = "ids", into: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the bytes that its ids stand for; they need not be whole characters."""

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([decode([] if x is None else list(x), ranks) for x in batch], dtype=object)

    return docs.withColumn(into, of(F.col(ids)))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, one row per row of ``docs``.

    Ids are encoded, decoded and hashed in the task that reads the text, so that only digests
    leave it. Null and empty texts have no ids; other columns are ignored.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decimals = _decimals(ranks)
        for batch in batches:
            rows = []
            for text in batch:
                ids = encode(text, ranks)
                written = hashlib.sha256(b" ".join([decimals[i] for i in ids])).hexdigest()
                rows.append((len(ids), written, hashlib.sha256(decode(ids, ranks)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).alias("doc_id"), of(F.col(text)).alias("d")).select("doc_id", "d.*")
