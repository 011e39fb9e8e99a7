"""Token counts from distinct pre-tokens: pieces are counted once for each, ids are never built."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import table, text_chunks, texts

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
KNOWN_MAX = 200_000  # pre-tokens a worker remembers; beyond that it forgets all and starts anew

# A run of spaces with what follows, or a line break with what follows: no piece of the
# vocabulary goes on across the start of such a pre-token, so pieces can be counted apart.
_PRE_TOKEN = re.compile("▁+[^▁\n]*|\n[^▁\n]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text as the tokenizer sees it: marked spaces, one put in front."""
    return _PRE_TOKEN.findall("▁" + text.replace(" ", "▁")) if text else []


class PieceCounts:
    """Number of pieces of each pre-token."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, int] = {}

    def of(self, distinct: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_MAX:
            self.known = {}
        new = [p for p in distinct if p not in self.known]
        # the tokenizer puts one space in front by itself; after a line break that one is extra
        said = self.model.encode(
            [p if p[0] == "\n" else p[1:].replace("▁", " ") for p in new], num_threads=1
        )
        for p, ids in zip(new, said, strict=True):
            self.known[p] = len(ids) - 1 if p[0] == "\n" else len(ids) if p != "▁" else 1
        return np.fromiter((self.known[p] for p in distinct), np.int64, len(distinct))


_loaded: dict[str, PieceCounts] = {}  # by path, for the life of a Python worker


def count_texts(values: list[str], counts: PieceCounts) -> np.ndarray:
    """Tokens of each text: distinct pre-tokens counted once, joined to frequencies, summed."""
    split = [pre_tokens(v) for v in values]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    coded = pa.array([p for one in split for p in one], pa.string()).dictionary_encode()
    del split
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    if not distinct:
        return np.zeros(len(values), np.int64)
    pieces = counts.of(distinct)
    documents = np.repeat(np.arange(len(values)), sizes)
    pairs, frequency = np.unique(documents * len(distinct) + codes, return_counts=True)
    sums = np.zeros(len(values), np.int64)
    np.add.at(sums, pairs // len(distinct), frequency * pieces[pairs % len(distinct)])
    return sums


def token_counts(
    df: DataFrame,
    path: str,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row's whole text.

    A null or empty text has no bytes and no tokens. Repeated rows are each counted. Other columns
    are not looked at. Each task keeps a bounded table of the pre-tokens it has met, so that pieces
    are counted once for each, and nothing is shuffled.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = PieceCounts(path)
        for ids, values, part in text_chunks(batches):
            n = count_texts(values, _loaded[path])
            yield pa.RecordBatch.from_arrays(
                [ids, part.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"]
            )

    sized = texts(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path(MODEL))
