"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import row_chunks, table, text_chunks, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "handle", "dial")  # what the method adds to the base patterns
KINDS = BASE_KINDS + ADDED_KINDS
LABELERS = ("pattern", "gazetteer", "context", "shape", "variety")
CONTEXT_CHARS = 24
EM_ROUNDS, TRAIN_ROUNDS = 100, 400
KEEP = 0.5

# The base patterns, given with the task. Digits before a match cannot start one.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# What the method looks at beyond them.
_SECRET = re.compile(r"""(?<![^\s"'=:])(?!//)[A-Za-z0-9_+/-]{20,}+={0,2}+(?![^\s"',;.])""")
_HANDLE = re.compile(
    r"(?<!\w)[A-Za-z0-9._-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{1,63})+"
)
_DIAL = re.compile(r"(?<![\w+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")

# Gazetteers.
_ENDINGS = frozenset("com org net edu gov int info biz io de fr es uk eu it nl ch at us ca".split())
_WORDS = {
    "email": re.compile(r"mail|contact|correo|courriel|write to", re.I),
    "ip": re.compile(r"\bip\b|addr|server|host|client", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta|payment", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|m[oó]vil|anruf", re.I),
    "secret": re.compile(r"token|secret|api|key|passw|auth", re.I),
    "handle": re.compile(r"mail|contact|correo|courriel|write to", re.I),
    "dial": re.compile(r"tel|phone|call|fax|mobile|m[oó]vil|anruf", re.I),
}

Span = tuple[str, int, int]


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` so that long runs without one cost nothing."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by kind as listed, then start; failing matches are dropped."""
    spans = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [
        ("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))
    ]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [
            ("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15
        ]
    return spans


def added_candidates(text: str, base: list[Span]) -> list[Span]:
    """Spans of the added kinds that touch no base span."""
    found = [("secret", *m.span()) for m in _SECRET.finditer(text) if _is_key_like(m.group())]
    if "at" in text or "AT" in text:
        found += [("handle", *m.span()) for m in _HANDLE.finditer(text)] if "(" in text or "[" in text else []
    if _DIGIT.search(text):
        found += [("dial", *m.span()) for m in _DIAL.finditer(text)]
    return [c for c in found if not any(c[1] < e and s < c[2] for _, s, e in base)]


def _is_key_like(run: str) -> bool:
    """Whether a run with base64's own characters mixes digits and both cases, as paths and formulas
    rarely do; others are always looked at."""
    if not any(c in run for c in "+/="):
        return True
    return any(map(str.isdecimal, run)) and any(map(str.isupper, run)) and any(map(str.islower, run))


def votes(text: str, span: Span) -> tuple[int, ...]:
    """What each labeler says of a span: 1 personal, -1 not, 0 no opinion."""
    kind, start, end = span
    inside = text[start:end]
    before = text[max(0, start - CONTEXT_CHARS) : start]
    digits = _digits(inside)
    letters = sum(map(str.isalpha, inside))
    if kind == "email":
        pattern = 1
        gazetteer = 1 if inside.rpartition(".")[2].lower() in _ENDINGS else -1
        shape = 1 if 6 <= end - start <= 80 and not inside.startswith(".") else -1
    elif kind == "ip":
        pattern = 1
        gazetteer = -1 if inside.split(".")[0].lstrip("0") in ("", "127", "255") else 1
        shape = 1 if all(len(p) == len(p.lstrip("0")) or p == "0" for p in inside.split(".")) else -1
    elif kind == "card":
        pattern = 1
        gazetteer = 1 if digits[0] in "3456" else -1
        shape = 1 if len(digits) == 16 else 0
    elif kind == "phone":
        pattern = 1
        gazetteer = 1 if digits[0] != "0" else -1
        shape = 1 if 10 <= len(digits) <= 13 else 0
    elif kind == "secret":
        pattern = 1 if re.fullmatch(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:sk|pk|gh[a-z]|AKIA)[_-]?\w{16,})", inside) else -1
        gazetteer = 1 if re.search(r"""[=:]\s*["']?\Z""", before) else -1
        shape = 1 if len(digits) >= 4 and letters >= 4 else -1
    elif kind == "handle":
        pattern = 1
        gazetteer = 1 if re.split(r"[\s\])]", inside)[-1].lower() in _ENDINGS else -1
        shape = 1 if end - start <= 80 else -1
    else:
        pattern = 0
        gazetteer = 1 if digits[0] not in "01" and digits[3] not in "01" else -1
        shape = 1 if len({c for c in inside if c in " .-"}) == 1 or "(" in inside else 0
    context = 1 if _WORDS[kind].search(before) else 0
    edge = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()
    variety = -1 if edge or len(set(digits or inside)) < 3 else 1
    return pattern, gazetteer, context, shape, variety


def features(text: str, span: Span) -> tuple[int, ...]:
    """Small numbers that describe a span to the classifier, apart from the votes."""
    kind, start, end = span
    inside = text[start:end]
    before, after = text[max(0, start - CONTEXT_CHARS) : start], text[end : end + 1]
    share = sum(map(str.isdecimal, inside)) / max(1, end - start)
    return (
        min(3, (end - start) // 12),
        round(3 * share),
        int(_WORDS[kind].search(before) is not None),
        int(bool(re.search(r"""[=:]\s*["']?\Z""", before))),
        int(before[-1:].isalnum() or after.isalnum()),
        int(re.fullmatch("[0-9a-fA-F]*", inside) is not None),
        int(any(map(str.isupper, inside))),
    )


def _design(keys: list[tuple]) -> np.ndarray:
    """One row for each (kind, features): a constant, the kind, the features one-hot by kind."""
    columns: dict[tuple, int] = {}
    for k, kind in enumerate(KINDS):
        columns[(kind,)] = k
    rows = []
    for kind, found in keys:
        rows.append([(kind,), *((j, v) for j, v in enumerate(found))])
    sizes = (4, 4, 2, 2, 2, 2, 2)
    for j, size in enumerate(sizes):
        for v in range(size):
            columns[(j, v)] = len(columns)
    x = np.zeros((len(rows), len(columns)))
    for k, names in enumerate(rows):
        x[k, [columns[n] for n in names]] = 1
    return x


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities of the labelers by kind, and the weights of the span classifier."""

    prior: dict[str, float]
    reliability: dict[str, np.ndarray]  # by kind: [personal or not, labeler, vote -1 0 1]
    weights: np.ndarray

    def keeps(self, kind: str, found: tuple[int, ...], cache: dict) -> bool:
        key = (kind, found)
        if key not in cache:
            cache[key] = bool(1 / (1 + np.exp(-(_design([key]) @ self.weights)[0])) >= KEEP)
        return cache[key]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS):
    """EM for one kind: prior, vote probabilities of both classes, and each pattern's posterior.

    ``patterns`` holds votes (-1, 0, 1), one row a pattern. It starts from the majority vote, and
    one pseudo-count keeps every vote possible; so a labeler that never dissents stays usable.
    """
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
    posterior = 1 / (1 + np.exp(-patterns.sum(1).astype(float)))
    prior, probability = 0.5, np.full((2, patterns.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        votes_by_class = np.einsum("cp,plv->clv", weight, one_hot)
        # a yes from a labeler is never taken as a sign against, nor a no as one for
        start = np.array([[2.0, 1.0, 1.0], [1.0, 1.0, 2.0]])[:, None, :]
        probability = (votes_by_class + start) / (votes_by_class + start).sum(2, keepdims=True)
        said = np.einsum("plv,clv->cp", one_hot, np.log(probability))
        odds = said[1] - said[0] + np.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return prior, probability, posterior


def train(x: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = TRAIN_ROUNDS) -> np.ndarray:
    """Logistic regression on soft targets, with a weak pull to zero."""
    w = np.zeros(x.shape[1])
    share = counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        # Newton steps: the table of distinct rows is small
        slope = x.T @ (share * (p - target)) + 1e-4 * w
        bend = (x.T * (share * p * (1 - p))) @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanModel | None:
    """Fit the labelers' reliabilities and the classifier on the candidates of all rows.

    The driver gets counts by (kind, votes, features), of which there are a bounded number. Without
    any candidate there is no model.
    """

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for _, values, _ in text_chunks(batches):
            for text in values:
                base = base_spans(text)
                for span in [*base, *added_candidates(text, base)]:
                    counts[span[0], votes(text, span), features(text, span)] += 1
        if counts:
            kinds, said, found = zip(*counts, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds),
                    pa.array(list(map(list, said)), pa.list_(pa.int32())),
                    pa.array(list(map(list, found)), pa.list_(pa.int32())),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["kind", "votes", "features", "n"],
            )

    tallied = texts(df, id_col, text_col).mapInArrow(
        tally, "kind string, votes array<int>, features array<int>, n long"
    )
    rows = tallied.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return None
    rows = sorted((r["kind"], tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in rows)
    prior, reliability, target = {}, {}, np.zeros(len(rows))
    for kind in {r[0] for r in rows}:
        own = [k for k, r in enumerate(rows) if r[0] == kind]
        said = np.array([rows[k][1] for k in own])
        prior[kind], reliability[kind], target[own] = estimate(
            said, np.array([rows[k][3] for k in own], float)
        )
    x = _design([(r[0], r[2]) for r in rows])
    return SpanModel(prior, reliability, train(x, target, np.array([r[3] for r in rows], float)))


def all_spans(text: str, model: SpanModel | None, cache: dict) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the added ones that the classifier keeps; both in listed order."""
    base = base_spans(text)
    added = added_candidates(text, base) if model else []
    kept = [s for s in added if model.keeps(s[0], features(text, s), cache)]
    return base, base + sorted(kept, key=lambda s: (KINDS.index(s[0]), *s[1:]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(
    df: DataFrame, model: SpanModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts of base spans, their digest and all spans of each row's whole text.

    A null or empty text has no spans. Offsets are code points, ends exclusive. Spans of one kind
    never overlap; spans of different kinds may. Repeated rows are each looked at.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for ids, values, _ in text_chunks(batches):
            counts = {k: [] for k in BASE_KINDS}
            digests, spans = [], []
            for text in values:
                base, every = all_spans(text, model, cache)
                found = Counter(s[0] for s in base)
                for k in BASE_KINDS:
                    counts[k].append(found[k])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
            )

    longs = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return texts(df, id_col, text_col).mapInArrow(
        find, f"doc_id long, {longs}, base_sha256 string, spans string"
    )


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping ones by the first's."""
    out, end = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out += [text[end:s], f"[{kind.upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]]) if out else text


def mask_documents(df: DataFrame, model: SpanModel | None, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data in ``text_col`` masked; null texts stay null."""
    at = df.columns.index(text_col)

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in row_chunks(batches, at):
            masked = [
                t if t is None else mask(t, all_spans(t, model, cache)[1])
                for t in batch.column(at).to_pylist()
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(masked, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(replace, df.schema)


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return personal_data(documents, fit_spans(documents))
