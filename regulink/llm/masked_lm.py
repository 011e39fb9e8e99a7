"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import row_chunks, table, text_chunks, texts
from regulink.llm.wordhash import classes_of, words_of
from regulink.session import freeze, scratch_path

VOCABULARY = 2048  # most frequent tokens with an id of their own, at least
GROWTH = 16  # ids of their own for so many times the root of the number of different tokens
ALONE = 32  # most frequent tokens with a class of their own
SHARED = 32  # classes of all others, by a hash
WINDOW = 2  # tokens on either side
WIDTH = 16
ROUNDS = 1  # passes over all texts
STEPS = 16  # steps in a pass, each on the texts whose hash is dealt to it
BATCH, RATE = 8192, 0.3
BLOCK = 8192  # slopes that travel as one value
CHUNK_BYTES = 400_000  # of encoded texts

CLASSES = ALONE + SHARED
PAD = VOCABULARY + SHARED  # ids of further tokens follow
START_SPEED = np.float32(1e-2)
_BYTES = classes_of(b" \t\n\r\x0b\x0c", marks=True)


@dataclass(frozen=True)
class Vocabulary:
    """Ids by token hash (sorted), each id's class and log share of it, and its way through a tree.

    Each shared class is a binary tree over its tokens with an id and one leaf, with the class's id,
    for all others. ``first, node, turn`` hold the nodes from the root to each id, ``start`` the log
    odds of each node in the corpus, ``class_start`` the log share of each class. ``rest`` has the
    occurrences of a class's other tokens, and one for those the corpus lacks. ``counts`` (``token, n``, a distributed table, on the driver only)
    has the other tokens that occur more than once.
    """

    hashes: np.ndarray
    ids: np.ndarray
    class_of: np.ndarray
    log_share: np.ndarray
    first: np.ndarray
    node: np.ndarray
    turn: np.ndarray
    start: np.ndarray
    rest: np.ndarray
    class_start: np.ndarray
    counts: DataFrame | None = None

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        hashes = hashes.view(np.int64)
        rest = VOCABULARY + (hashes.view(np.uint64) % np.uint64(SHARED)).astype(np.int64)
        if not len(self.hashes):
            return rest
        shift, place, crowded = self._slots
        slot = (hashes.view(np.uint64) >> shift).astype(np.int64)
        at = place[slot]
        found = np.where(self.hashes[at] == hashes, self.ids[at], rest)
        again = np.flatnonzero(crowded[slot])
        at = np.minimum(np.searchsorted(self.hashes, hashes[again]), len(self.hashes) - 1)
        same = self.hashes[at] == hashes[again]
        found[again[same]] = self.ids[at[same]]
        return found

    @cached_property
    def _slots(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """By the first bits of a hash: how far to shift it for them, one token that has them, and
        whether more than one has."""
        bits = (16 * len(self.hashes)).bit_length()
        shift = np.uint64(64 - bits)
        slot = (self.hashes.view(np.uint64) >> shift).astype(np.int64)
        place = np.zeros(1 << bits, np.int32)
        place[slot] = np.arange(len(slot))
        return shift, place, np.bincount(slot, minlength=1 << bits) > 1

    def steps(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Node and turn of each step on the ways to ``ids``, which are in order of the length of
        their ways, longest first; the k-th step is that of as many of them as have one."""
        begin = self.first[ids]
        n = self.first[ids + 1] - begin
        for k in range(int(n[0]) if len(n) else 0):
            at = begin[: len(n) - np.searchsorted(n[::-1], k, "right")] + k
            yield self.node[at], self.turn[at]

    @cached_property
    def lengths(self) -> np.ndarray:
        """How many steps fewer than the longest way the way to each id has."""
        n = np.diff(self.first)
        return (n.max(initial=0) - n).astype(np.uint16)

    def sent(self) -> Vocabulary:
        """What tasks need."""
        return replace(self, counts=None)


def token_hashes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    words = words_of([v.lower().encode("utf-8", "replace") for v in values], _BYTES)
    return words.hashes, words.first


def count_tokens(df: DataFrame) -> DataFrame:
    """``token, n``: occurrences of every token (by its hash) in all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, _ in text_chunks(batches, 2_000_000):
            found, n = np.unique(token_hashes(values)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(n)], ["token", "n"]
            )

    counted = df.mapInArrow(count, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _trees(leaves: list[tuple[list[int], list[float]]], n_ids: int):
    """Ways to all ids and log odds of nodes: one Huffman tree for each list of ids and counts."""
    steps: list[list[tuple[int, float]]] = [[] for _ in range(n_ids)]
    start: list[float] = []
    for ids, n in leaves:
        heap = [(x, k, i, None) for k, (i, x) in enumerate(zip(ids, n, strict=True))]
        heapq.heapify(heap)
        order = len(heap)
        while len(heap) > 1:
            one, two = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (one[0] + two[0], order, len(start), (one, two)))
            start.append(float(np.log(one[0] / two[0])))
            order += 1
        going = [(heap[0], [])] if heap else []
        while going:
            (_, _, own, below), way = going.pop()
            if below is None:
                steps[own] = way
            else:
                going += [(below[0], [*way, (own, 1.0)]), (below[1], [*way, (own, -1.0)])]
    first = np.concatenate([[0], np.cumsum([len(w) for w in steps], dtype=np.int64)])
    flat = [x for way in steps for x in way]
    node, turn = np.array([x[0] for x in flat], np.int64), np.array([x[1] for x in flat], np.float32)
    return first, node, turn, np.array(start, np.float32)


def _most_frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent tokens and their counts; equally frequent ones by hash.

    Counts are first laid in steps, so that only little more than ``most`` rows are sorted.
    """
    step = F.floor(F.log2("n") * 8)
    cut, total = 0, 0
    for r in sorted(counted.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        cut, total = r["s"], total + r["count"]
        if total >= most:
            break
    top = counted.where(step >= cut).orderBy(F.desc("n"), "token").limit(most).toArrow()
    return top.column("token").to_numpy(), top.column("n").to_numpy().astype(float)


def build_vocabulary(df: DataFrame) -> Vocabulary:
    """The most frequent tokens of all texts, more of them the more different ones there are;
    equally frequent ones in order of their hash.

    The driver gets the vocabulary and, by class, the count and the number of the other tokens.
    Counts of the others stay a distributed table.
    """
    counted = freeze(count_tokens(df), "tokens")
    # SHARED is a power of two, so remainders of signed and of unsigned hashes agree
    rest_class = F.pmod(F.col("token"), F.lit(SHARED)).alias("k")
    all_of = counted.groupBy(rest_class).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    most = max(VOCABULARY, int(GROWTH * sum(r["types"] for r in all_of) ** 0.5))
    tokens, n = _most_frequent(counted, most)
    own = np.arange(len(tokens)) + (np.arange(len(tokens)) >= VOCABULARY) * (SHARED + 1)
    of_top = (tokens.view(np.uint64) % np.uint64(SHARED)).astype(np.int64)
    kind = np.where(np.arange(len(tokens)) < ALONE, np.arange(len(tokens)), ALONE + of_top)
    rest = np.ones(SHARED)
    for r in all_of:
        rest[r["k"]] += r["n"]
    rest -= np.bincount(of_top, n, SHARED)
    whole = rest + np.bincount(of_top[ALONE:], n[ALONE:], SHARED)
    n_ids = PAD + 1 + max(0, len(tokens) - VOCABULARY)
    log_share, class_of = np.zeros(n_ids), np.zeros(n_ids, np.int64)
    log_share[own[ALONE:]] = np.log(n[ALONE:] / whole[of_top[ALONE:]])
    log_share[VOCABULARY:PAD] = -np.log(whole)
    class_of[own], class_of[VOCABULARY:PAD] = kind, ALONE + np.arange(SHARED)
    leaves = [([VOCABULARY + k], [rest[k]]) for k in range(SHARED)]
    for i, k, x in zip(own[ALONE:].tolist(), of_top[ALONE:].tolist(), n[ALONE:].tolist(), strict=True):
        leaves[k][0].append(i)
        leaves[k][1].append(x)
    of_class = np.full(CLASSES, 0.5)
    of_class[: len(tokens[:ALONE])], of_class[ALONE:] = n[:ALONE], whole
    class_start = np.log(of_class / of_class.sum()).astype(np.float32)
    order = np.argsort(tokens)
    few = counted.where("n > 1")
    if len(n):  # what is more frequent has an id
        few = few.where(F.col("n") <= int(n[-1]))
    return Vocabulary(tokens[order], own[order], class_of, log_share, *_trees(leaves, n_ids), rest, class_start, few)


def new_weights(
    seed: int = 11, ids: int = PAD + 1, start: np.ndarray | None = None, class_start: np.ndarray | None = None
) -> list[np.ndarray]:
    """Embeddings by place in the window, a hidden bias, output weights and biases of classes, and
    of nodes; biases begin at the corpus's odds."""
    dealt = np.random.default_rng(seed)
    start = np.zeros(0, np.float32) if start is None else start
    return [
        dealt.normal(0, 0.1, (2 * WINDOW, ids, WIDTH)).astype(np.float32),
        np.zeros(WIDTH, np.float32),
        dealt.normal(0, 0.1, (WIDTH, CLASSES)).astype(np.float32),
        np.zeros(CLASSES, np.float32) if class_start is None else class_start.copy(),
        np.zeros((len(start), WIDTH), np.float32),
        start.copy(),
    ]


def _laid_out(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one row with padding around each, and the place of each token in it."""
    sizes = np.diff(first)
    room = np.full(len(ids) + 2 * WINDOW * len(sizes), PAD)
    at = np.arange(len(ids)) + np.repeat(2 * WINDOW * np.arange(len(sizes)) + WINDOW, sizes)
    room[at] = ids
    return room, at


def _near(room: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([room[at + d] for d in range(-WINDOW, WINDOW + 1) if d])


def windows(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ids of the neighbours of each token, padded where the text ends."""
    return _near(*_laid_out(ids, first))


def _hidden(weights: list[np.ndarray], near: np.ndarray) -> np.ndarray:
    total = weights[0][0].take(near[0], 0)
    for p in range(1, 2 * WINDOW):
        total += weights[0][p].take(near[p], 0)
    total += weights[1]
    return np.tanh(total, out=total)


def class_log_probabilities(weights: list[np.ndarray], near: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Log probability of each token's class given its neighbours."""
    return _class_logs(weights, _hidden(weights, near), goal)


def _logits(weights: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """Logits of classes, shifted where their powers could be too large; hidden values are within 1."""
    logits = h @ weights[2]
    logits += weights[3]
    if np.abs(weights[2]).sum(0).max() + np.abs(weights[3]).max() > 60:
        logits -= logits.max(1, keepdims=True)
    return logits


def _class_logs(weights: list[np.ndarray], h: np.ndarray, goal: np.ndarray) -> np.ndarray:
    logits = _logits(weights, h)
    chosen = logits[np.arange(len(goal)), goal]
    return chosen - np.log(np.exp(logits, out=logits).sum(1))


def token_log_probabilities(
    weights: list[np.ndarray], near: np.ndarray, ids: np.ndarray, vocabulary: Vocabulary
) -> np.ndarray:
    """Log probability of each id given its neighbours: of its class, then of each turn to it."""
    h = _hidden(weights, near)
    logs = _class_logs(weights, h, vocabulary.class_of[ids])
    order = np.argsort(vocabulary.lengths[ids], kind="stable")
    met, lost = h.take(order, 0), np.zeros(len(ids))
    for node, turn in vocabulary.steps(ids[order]):
        n = len(node)
        odds = turn * (np.einsum("ij,ij->i", met[:n], weights[4].take(node, 0)) + weights[5][node])
        lost[:n] += np.maximum(-odds, 0) + np.log1p(np.exp(-np.abs(odds)))
    out = logs.astype(np.float64)
    out[order] -= lost
    return out


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the number among them of each key."""
    held = np.zeros(keys.max() + 1, bool)
    held[keys] = True
    found = np.flatnonzero(held)
    number = np.zeros(len(held), np.int64)
    number[found] = np.arange(len(found))
    return found, number[keys]


def _sums(number: np.ndarray, groups: int, columns: np.ndarray) -> np.ndarray:
    """Sums of each column by group, a row for each group."""
    return np.array([np.bincount(number, c, groups) for c in columns]).T


def add_slopes(
    total: list[np.ndarray],
    weights: list[np.ndarray],
    near: np.ndarray,
    goal: np.ndarray,
    ids: np.ndarray | None = None,
    vocabulary: Vocabulary | None = None,
) -> None:
    """Add the slopes of minus the log probability of all given tokens to ``total``.

    With ``ids`` those of the turns to each token are added to those of its class.
    """
    h = _hidden(weights, near)
    p = _logits(weights, h)
    whole = np.exp(p, out=p).sum(1)
    p[np.arange(len(goal)), goal] -= whole
    share = 1 / whole
    total[2] += (h * share[:, None]).T @ p
    total[3] += share @ p
    back = p @ weights[2].T
    back *= share[:, None]
    if ids is not None:
        order = np.argsort(vocabulary.lengths[ids], kind="stable")
        met, turned = h.take(order, 0), np.zeros(back.shape)
        nodes, slopes, parts = [], [], []
        for node, turn in vocabulary.steps(ids[order]):
            n, way = len(node), weights[4].take(node, 0)
            odds = turn * (np.einsum("ij,ij->i", met[:n], way) + weights[5][node])
            slope = -turn / (1 + np.exp(np.minimum(odds, 60)))
            way *= slope[:, None]
            turned[:n] += way
            nodes.append(node)
            slopes.append(slope)
            parts.append(np.multiply(met[:n], slope[:, None], out=way))
        if nodes:
            back[order] += turned
            at, number = _groups(np.concatenate(nodes))
            total[4][at] += _sums(number, len(at), np.array(np.concatenate(parts).T, np.float64, order="C"))
            total[5][at] += np.bincount(number, np.concatenate(slopes), len(at))
    back *= 1 - h * h
    columns = np.array(back.T, np.float64, order="C")
    total[1] += columns.sum(1)
    at, number = _groups(near.ravel())
    for place, own in enumerate(number.reshape(near.shape)):
        total[0][place, at] += _sums(own, len(at), columns)


def step(weights: list[np.ndarray], speed: list[np.ndarray], total: list[np.ndarray]) -> None:
    """One step against the slopes, in place; step sizes shrink by element as slopes add up."""
    for w, v, slope in zip(weights, speed, total, strict=True):
        v += slope**2
        w -= RATE * np.divide(slope, np.sqrt(v), out=np.zeros_like(v), where=v > 0)


def _ids(values: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    hashes, first = token_hashes(values)
    return vocabulary.encode(hashes), first


def _encoded(df: DataFrame, words: Broadcast) -> DataFrame:
    """``ids, step``: each text's ids as 32-bit numbers, written once in a folder for each step.

    The step is a hash of id and text, so it does not depend on where a row lies.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, part in text_chunks(batches):
            ids, first = _ids(values, words.value)
            ends, held = pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(ids.astype(np.int32))
            column = pa.Array.from_buffers(pa.binary(), len(values), [None, ends, held])
            yield pa.RecordBatch.from_arrays([column, part.column("step")], ["ids", "step"])

    dealt = df.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(STEPS)).alias("step"))
    path = scratch_path(df.sparkSession, "encoded")
    dealt.mapInArrow(encode, "ids binary, step long").write.partitionBy("step").parquet(path)
    return df.sparkSession.read.schema("ids binary, step long").parquet(path)


def summed_slopes(encoded: DataFrame, weights: list[np.ndarray], words: Broadcast) -> list[np.ndarray] | None:
    """Slopes of all tokens of ``encoded``, none if there are none.

    Each task adds up its own; they travel in blocks and are added up by block, one value at a time.
    The driver gets one value for each block, as many as the network has.
    """
    held = encoded.sparkSession.sparkContext.broadcast(weights)

    def pass_over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vocabulary = held.value, words.value
        total = [np.zeros(w.shape) for w in own]
        for part in row_chunks(batches, 0, CHUNK_BYTES):
            column = part.column(0)
            first = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy() // 4, dtype=np.int64)])
            ids = np.frombuffer(b"".join(column.to_pylist()), np.int32)
            room, at = _laid_out(ids, first)
            for begin in range(0, len(ids), BATCH):
                some = ids[begin : begin + BATCH]
                near = _near(room, at[begin : begin + BATCH])
                add_slopes(total, own, near, vocabulary.class_of[some], some, vocabulary)
        flat = np.concatenate([t.ravel() for t in total])
        flat = np.concatenate([flat, np.zeros(-len(flat) % BLOCK)]).reshape(-1, BLOCK)
        used = np.flatnonzero(flat.any(1))
        if len(used):
            yield _blocks(used, flat[used])

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(values.as_buffer(), np.float32)
                sums[block] = sums.get(block, 0.0) + one.astype(np.float64)
        if sums:
            yield _blocks(np.array(list(sums)), np.array(list(sums.values())))

    kinds = "block long, slopes binary"
    found = encoded.select("ids").mapInArrow(pass_over, kinds).repartition("block").mapInArrow(add_up, kinds).toArrow()
    held.destroy()
    if not found.num_rows:
        return None
    sizes = np.cumsum([0] + [w.size for w in weights])
    flat = np.zeros(-(-sizes[-1] // BLOCK) * BLOCK)
    for block, values in zip(found.column(0).to_pylist(), found.column(1), strict=True):
        flat[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(values.as_buffer(), np.float32)
    return [flat[a:b].reshape(w.shape) for a, b, w in zip(sizes, sizes[1:], weights)]


def _blocks(numbers: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    held = [r.tobytes() for r in rows.astype(np.float32)]
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(held, pa.binary())], ["block", "slopes"])


def train(df: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Train on every token of every text.

    A round takes ``STEPS`` steps, each against the slopes of all tokens of its texts, summed over
    all tasks; every text belongs to one step. So the weights are the same, up to rounding, however
    rows lie in partitions. An empty table gives the untrained weights.
    """
    weights = new_weights(ids=len(vocabulary.class_of), start=vocabulary.start, class_start=vocabulary.class_start)
    speed = [np.full(w.shape, START_SPEED, np.float64) for w in weights]
    words = df.sparkSession.sparkContext.broadcast(vocabulary.sent())
    encoded = _encoded(df, words)
    for k in range(rounds * STEPS):
        total = summed_slopes(encoded.where(F.col("step") == k % STEPS), weights, words)
        if total is not None:
            step(weights, speed, total)
    return weights


def score_texts(values: list[str], weights: list[np.ndarray], vocabulary: Vocabulary):
    """Tokens and summed conditional log probability of each text; tokens without an id are taken as
    occurring once."""
    return _score_ids(*_ids(values, vocabulary), weights, vocabulary)


def _score_ids(ids: np.ndarray, first: np.ndarray, weights: list[np.ndarray], vocabulary: Vocabulary):
    sums = np.zeros(len(ids) + 1)
    room, at = _laid_out(ids, first)
    once = np.zeros(len(vocabulary.class_of))
    once[VOCABULARY:PAD] = -np.log(vocabulary.rest)
    for begin in range(0, len(ids), BATCH):
        rows = slice(begin, begin + BATCH)
        logs = token_log_probabilities(weights, _near(room, at[rows]), ids[rows], vocabulary)
        sums[begin + 1 : begin + 1 + len(logs)] = logs
    sums[1:] += once[ids]
    sums = np.cumsum(sums)
    return np.diff(first), sums[first[1:]] - sums[first[:-1]]


def score(
    df: DataFrame, weights: list[np.ndarray], vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` of each row's whole text.

    A token without an id has its own share, by its count in the corpus, of what its class has for
    such tokens; each meets its count by a join. The most frequent ones have ids, so none is hot.
    A null text, or one without tokens, has no tokens and log probability 0; its mean is null.
    Repeated rows are each scored; equal texts score alike up to rounding.
    """
    held = df.sparkSession.sparkContext.broadcast((weights, vocabulary.sent()))

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row for each text, whose token is only its number, and one for each token without an id
        own, words = held.value
        row = TaskContext.get().partitionId() << 40
        for doc_ids, values, _ in text_chunks(batches):
            hashes, first = token_hashes(values)
            ids = words.encode(hashes)
            n, log_prob = _score_ids(ids, first, own, words)
            numbers = row + np.arange(len(n))
            row += len(n)
            other = np.flatnonzero((ids >= VOCABULARY) & (ids < PAD))
            far, none = numbers[np.searchsorted(first, other, "right") - 1], pa.nulls(len(other), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([numbers, far])),
                    pa.array(np.concatenate([numbers, hashes[other].view(np.int64)])),
                    pa.concat_arrays([doc_ids.cast(pa.int64()), none]),
                    pa.concat_arrays([pa.array(n.astype(np.int64)), none]),
                    pa.concat_arrays([pa.array(log_prob), none.cast(pa.float64())]),
                ],
                ["row", "token", "doc_id", "n_tokens", "log_prob"],
            )

    scored = texts(df, id_col, text_col).mapInArrow(
        give, "row long, token long, doc_id long, n_tokens long, log_prob double"
    )
    counted = scored.join(vocabulary.counts, "token", "left")
    own_count = F.when(F.col("n_tokens").isNull(), F.coalesce(F.ln("n"), F.lit(0.0)))
    summed = counted.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("log_prob", own_count)).alias("log_prob"),
    )
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return summed.drop("row").withColumn("mean_log_prob", mean)


def op3_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(table(spark, folder, "documents"))
    vocabulary = build_vocabulary(documents)
    return score(documents, train(documents, vocabulary), vocabulary)
