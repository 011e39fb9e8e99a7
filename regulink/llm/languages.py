"""Languages of documents as mixtures: EM over n-gram likelihoods, sets chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import row_chunks, table, text_chunks, texts

BUCKETS = 1 << 15  # hashed n-grams of three characters
SMOOTHING = 0.5
MAX_LANGUAGES = 1000
ROUNDS = 12  # EM steps for a mixture
PENALTY = 1.5  # n-grams of a text overlap, so each parameter costs three times half a log count
UNDETERMINED = "und"

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point of the first planes whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x32000)), bool, 0x32000)
    return _LETTER


def grams(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, n-gram bucket and count of each distinct n-gram of each text.

    Texts are lower-cased and runs of anything but letters become one space, also at the ends.
    An n-gram is three characters of which the middle one is a letter.
    """
    low = [f" {v.lower()} " for v in values]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[np.minimum(points, len(_letters()) - 1)]
    documents = np.repeat(np.arange(len(low), dtype=np.int64), sizes)
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # the first of a run of other characters stands for it
    kept[0] = True
    starts = np.cumsum(sizes) - sizes
    kept[starts] = True
    points = np.where(is_letter, points, 32)[kept].astype(np.uint64)
    documents, is_letter = documents[kept], is_letter[kept]
    if len(points) < 3:
        none = np.zeros(0, np.int64)
        return none, none, none
    with np.errstate(over="ignore"):
        mixed = (
            points[:-2] * np.uint64(0x9E3779B97F4A7C15)
            + points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
            + points[2:] * np.uint64(0x165667B19E3779F9)
        )
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    inner = is_letter[1:-1]
    pairs, counts = np.unique(documents[1:-1][inner] * BUCKETS + bucket[inner], return_counts=True)
    return pairs // BUCKETS, pairs % BUCKETS, counts


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    likelihood: np.ndarray  # [bucket, language]

    def chunk_chars(self) -> int:
        return max(20_000, 2_000_000 // max(4, len(self.names)))


def fit_languages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> LanguageModel:
    """N-gram likelihoods of every language that labels a row; rows without a label teach nothing.

    Counts are summed by (language, n-gram bucket) over all rows; the driver gets that table, whose
    size is bounded by the languages.
    """
    labelled = df.where(F.col(lang_col).isNotNull()).select(
        F.lit(0).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for _, values, part in text_chunks(batches):
            langs = part.column("lang").to_pylist()
            documents, bucket, n = grams(values)
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[documents]
            found = np.bincount(code * BUCKETS + bucket, n, len(names) * BUCKETS)
            for k, name in enumerate(names):
                own = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                own += found[k * BUCKETS : (k + 1) * BUCKETS].astype(np.int64)
        for name, own in sums.items():
            there = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(there), pa.string()), pa.array(there), pa.array(own[there])],
                ["lang", "bucket", "n"],
            )

    counted = labelled.mapInArrow(count, "lang string, bucket long, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MAX_LANGUAGES} can be told apart")
    table_of = np.full((BUCKETS, len(names)), SMOOTHING)
    if names:
        at = {x: k for k, x in enumerate(names)}
        column = np.array([at[x] for x in found.column("lang").to_pylist()])
        table_of[found.column("bucket").to_numpy(), column] += found.column("n").to_numpy()
    return LanguageModel(names, (table_of / table_of.sum(0)).astype(np.float32))


def _mixture(p, n, document, total, shares, rounds=ROUNDS):
    """EM for the shares of the languages in each document; shares that start at 0 stay there."""
    starts = np.flatnonzero(np.diff(document, prepend=-1))
    for _ in range(rounds):
        parts = p * shares[document]
        parts *= (n / parts.sum(1))[:, None]
        shares = np.add.reduceat(parts, starts, 0) / total[:, None]
    return shares


def _log_likelihood(p, n, document, shares):
    starts = np.flatnonzero(np.diff(document, prepend=-1))
    return np.add.reduceat(n * np.log((p * shares[document]).sum(1).astype(np.float64)), starts)


def infer(values: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray, list[list[str]]]:
    """The main language, its share and the chosen set of languages of each text.

    Sets grow along the shares of the full mixture: the best single language first, then the first
    two, and so on while the likelihood gains more than the penalty for one more share.
    """
    said, score = [UNDETERMINED] * len(values), np.zeros(len(values))
    chosen: list[list[str]] = [[] for _ in values]
    document, bucket, counts = grams(values)
    if not len(document) or not model.names:
        return said, score, chosen
    there, document = np.unique(document, return_inverse=True)
    p, n = model.likelihood[bucket], counts.astype(np.float32)
    total = np.bincount(document, n).astype(np.float32)
    width = len(model.names)
    full = _mixture(p, n, document, total, np.full((len(there), width), 1 / width, np.float32))
    order = np.argsort(-full, 1, kind="stable")
    best = np.zeros_like(full)
    best[np.arange(len(there)), order[:, 0]] = 1
    level = _log_likelihood(p, n, document, best)
    going = np.arange(len(there))
    for size in range(2, width + 1):
        mine = np.isin(document, going) if len(going) < len(there) else slice(None)
        own = np.searchsorted(going, document[mine])
        start = np.zeros((len(going), width), np.float32)
        rows = np.arange(len(going))[:, None]
        start[rows, order[going, :size]] = full[going][rows, order[going, :size]] + np.float32(1e-3)
        start /= start.sum(1, keepdims=True)
        shares = _mixture(p[mine], n[mine], own, total[going], start)
        reached = _log_likelihood(p[mine], n[mine], own, shares)
        gains = reached - level[going] > PENALTY * np.log(np.maximum(2, total[going]))
        best[going[gains]], level[going[gains]] = shares[gains], reached[gains]
        going = going[gains]
        if not len(going):
            break
    main = best.argmax(1)
    for k, d in enumerate(there.tolist()):
        said[d] = model.names[main[k]]
        chosen[d] = [model.names[j] for j in np.argsort(-best[k]) if best[k, j] > 0]
    score[there] = np.clip(best[np.arange(len(there)), main], 0, 1)
    return said, score, chosen


def identify(
    df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, langs`` of each row's whole text.

    ``score`` is the share of the main language, ``langs`` the chosen set, main language first. A
    null text or one without a letter is ``und`` with score 0 and no set. Equal shares fall to the
    first language by name. Repeated rows are each answered.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values, _ in text_chunks(batches, held.value.chunk_chars()):
            said, score, chosen = infer(values, held.value)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(said, pa.string()), pa.array(score), pa.array(chosen, pa.list_(pa.string()))],
                ["doc_id", "lang_pred", "score", "langs"],
            )

    return texts(df, id_col, text_col).mapInArrow(
        tell, "doc_id long, lang_pred string, score double, langs array<string>"
    )


def keep_identified(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of which some language is told; others go.

    A model that has learned no language says nothing against a text: all texts with a letter stay.
    """
    at = df.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, at, held.value.chunk_chars()):
            values = [t or "" for t in part.column(at).to_pylist()]
            if held.value.names:
                stays = [x != UNDETERMINED for x in infer(values, held.value)[0]]
            else:
                stays = np.isin(np.arange(len(values)), grams(values)[0]).tolist()
            yield part.filter(pa.array(stays, pa.bool_()))

    held = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(keep, df.schema)


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = fit_languages(documents.where(~is_held_out()))
    said = identify(documents, model)
    return said.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "langs")
