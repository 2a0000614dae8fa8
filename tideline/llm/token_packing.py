"""Best-fit packing of tokenised documents into sequences, by bin completion."""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import bin_completion
from tideline.llm.tables import Stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END_ID = 2048, 0
#: Words whose ids a task remembers, and the longest of them; both bound its memory.
WORDS, WORD_BYTES = 500_000, 64
#: Rows of one size that are numbered in one task, about.
BUCKET_ROWS = 10_000

_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
#: Letters and then ASCII marks, without the apostrophe that contractions have: each is a word of
#: the tokenizer's own.
_WORD_AND_MARKS = re.compile(f"([{_LETTERS}]*)([!-&(-/:-@\\[-`{{-~]*)".encode("latin-1"))


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it has
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


class WordIds:
    """Ids of whole texts, put together from those of their words.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of what
    lies between. What has been encoded is remembered, up to :data:`WORDS` entries.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        bytewise = self.tokenizer.pre_tokenizer[1].pre_tokenize_str
        self.bytewise = str.maketrans({c: bytewise(c)[0][0] for c in _LETTERS[26:]})
        self.known: dict[str, dict[bytes, bytes]] = {"latin-1": {}, "utf-8": {}}

    def __call__(self, text: str | None) -> bytes:
        """Ids as unsigned 32-bit little-endian numbers."""
        text = text or ""
        try:
            # Lower case first lets more words be alike; within Latin-1 it changes no ids.
            text.encode("latin-1")
            return self._join(text.lower().encode("latin-1").split(), "latin-1")
        except UnicodeEncodeError:
            return self._join(text.encode().split(), "utf-8")

    def _join(self, words: list[bytes], coding: str) -> bytes:
        known = self.known[coding]
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > WORDS:
                known.clear()
        own = self._learn({w for w in words if w not in known}, coding)
        return b"".join([own[w] if w in own else known[w] for w in words])

    def _learn(self, words: set[bytes], coding: str) -> dict[bytes, bytes]:
        """Ids of unknown words; long ones are not remembered."""
        known, merges, own, other = self.known[coding], self.tokenizer.model.tokenize, {}, []
        for word in words:
            split = _WORD_AND_MARKS.fullmatch(word) if coding == "latin-1" else None
            if not split:
                other.append(word)
                continue
            ids = b""
            for part in split.groups():
                found = known.get(part) if part else b""
                if found is None:
                    # Nothing is left to normalise or split, so the merges alone give the ids.
                    tokens = merges(part.decode(coding).translate(self.bytewise))
                    found = np.array([t.id for t in tokens], "<u4").tobytes()
                    if len(part) <= WORD_BYTES:
                        known[part] = found
                ids += found
            own[word] = ids
        encoded = self.tokenizer.encode_batch_fast([w.decode(coding) for w in other], add_special_tokens=False)
        own.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(other, encoded))
        known.update((w, x) for w, x in own.items() if len(w) <= WORD_BYTES)
        return own


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    """One for all tasks of a worker, which share what it remembers."""
    return WordIds(path)


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32``.

    A document's ids end with :data:`END_ID`; null and empty texts have that id alone. Only
    longer documents are cut, every ``capacity`` ids. ``with_ids`` adds the ids themselves.
    """
    fields = "piece:int,start:long,length:long,ids_crc32:long" + ",ids:array<int>" * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    @F.pandas_udf(f"array<struct<{fields}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids_of = _word_ids(tokenizer)
        for batch in batches:
            out = []
            for one in batch:
                data = ids_of(one) + end
                rows = []
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row = {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                    if with_ids:
                        row["ids"] = np.frombuffer(part, "<u4").astype(np.int32)
                    rows.append(row)
                out.append(rows)
            yield pd.Series(out, dtype=object)

    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(cut(F.col(text))).alias("p")).select("doc_id", "p.*")


def _slots(plan: list[bin_completion.Pattern]) -> dict[str, np.ndarray]:
    """For each size and filling: the first number of its items, its bins and its place there."""
    taken: dict[int, int] = {}
    rows, bin_ = [], 0
    for filling, bins in plan:
        offset = 0
        for size, each in filling:
            rows.append((size, taken.get(size, 0), bin_, offset, each))
            taken[size] = taken.get(size, 0) + bins * each
            offset += size * each
        bin_ += bins
    rows.sort()
    names = ("size", "first", "bin", "offset", "each")
    return dict(zip(names, np.array(rows or np.empty((0, 5)), np.int64).T))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", steps: int = 1_000_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each of them goes.

    Sequences have no gaps, and no more than ``capacity`` tokens. The driver gets the number of
    pieces of each length, at most ``capacity`` numbers, and sends back which fillings take
    them; pieces of one length are numbered in buckets, so that no task has all of a length that
    many share. ``pieces`` is read several times and should be a stored table; an empty one
    gives an empty one. Rows that are alike may change places.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    slots = _slots(bin_completion.complete(histogram, capacity, steps))
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    named = [F.col(f"`{c}`").cast("string") for c, kind in pieces.dtypes if not kind.startswith(("array", "map"))]
    key = F.xxhash64(*named)
    numbered = pieces.withColumn("_key", key).withColumn("_bucket", F.pmod("_key", F.lit(buckets)).cast("int"))
    order = Window.partitionBy(length, "_bucket").orderBy("_key")
    before = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        numbered.groupBy(length, "_bucket").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    ).drop("count")

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, number: pd.Series) -> pd.DataFrame:
        size, number = size.to_numpy(np.int64), number.to_numpy(np.int64)
        # Sizes are at most the capacity, so one number orders pairs of a size and a first item.
        wide = np.int64(1) << np.int64(45)
        at = np.searchsorted(slots["size"] * wide + slots["first"], size * wide + number, "right") - 1
        nth, each = number - slots["first"][at], slots["each"][at]
        return pd.DataFrame(
            {"sequence_id": slots["bin"][at] + nth // each, "offset": slots["offset"][at] + nth % each * size}
        )

    ranked = numbered.withColumn("_nth", F.row_number().over(order) - 1).join(sizes, [length, "_bucket"])
    return ranked.withColumn("_at", place(F.col(length), F.col("_nth") + F.col("_before"))).select(
        *pieces.columns, "_at.sequence_id", "_at.offset"
    )


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` with their places; see :func:`token_pieces` and :func:`pack`."""
    return pack(Stored(token_pieces(docs, doc_id, text, capacity), "pieces").df, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed ids of each sequence, at most its capacity.

    ``packed`` holds pieces with their ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
