"""Pseudo-likelihood: slopes against differences, whole distributions, order beats disorder."""

import random

import numpy as np

from regulink.llm import masked_lm as lm


def documents(spark, n=300):
    dealt = random.Random(3)
    chain = {k: [dealt.randrange(40) for _ in range(2)] for k in range(40)}
    texts = []
    for _ in range(n):
        at, words = dealt.randrange(40), []
        for _ in range(60):
            words.append(f"w{at}")
            at = dealt.choice(chain[at])
        texts.append(" ".join(words))
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_step_follows_the_slope(monkeypatch):
    dealt = np.random.default_rng(1)
    weights = [w.astype(np.float64) for w in lm.new_weights()]
    near, goal = dealt.integers(0, lm.PAD + 1, (4, 50)), dealt.integers(0, lm.CLASSES, 50)
    loss = lambda ws: -lm.class_log_probabilities(ws, near, goal).sum()
    after, speed = [w.copy() for w in weights], [np.zeros_like(w) for w in weights]
    monkeypatch.setattr(lm, "RATE", 1.0)
    total = [np.zeros_like(w) for w in weights]
    lm.add_slopes(total, weights, near, goal)
    lm.step(after, speed, total)
    for k, at in ((0, (1, near[1, 0], 3)), (1, (2,)), (2, (3, goal[0])), (3, (goal[0],))):
        moved = [w.copy() for w in weights]
        moved[k][at] += 1e-5
        slope = (loss(moved) - loss(weights)) / 1e-5
        assert abs(abs(slope) - np.sqrt(speed[k][at])) < 1e-2 * max(1, abs(slope))
        assert np.sign(weights[k][at] - after[k][at]) == np.sign(slope)


def test_class_shares_add_up(spark):
    df = documents(spark, 20)
    words = lm.build_vocabulary(df)
    tokens = np.unique(lm.token_hashes([r["text"] for r in df.collect()])[0])
    ids = words.encode(tokens)
    total = np.bincount(words.class_of[ids], np.exp(words.log_share[ids]), lm.CLASSES)
    assert (total <= 1 + 1e-9).all() and (total[total > 0] > 0.5).all()  # one count is held back for others


def test_windows_stop_at_ends_of_texts():
    near = lm.windows(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    p = lm.PAD
    assert near.T.tolist() == [[p, p, 6, 7], [p, 5, 7, p], [5, 6, p, p], [p, p, p, p]]


def test_order_scores_above_disorder(spark):
    df = documents(spark)
    words = lm.build_vocabulary(df)
    weights = lm.train(df, words, rounds=2)
    kept = [r["text"] for r in df.limit(50).collect()]
    dealt = random.Random(4)
    mixed = [" ".join(dealt.sample(t.split(), 60)) for t in kept]
    n, ordered = lm.score_texts(kept, weights, words)
    _, disordered = lm.score_texts(mixed, weights, words)
    assert (n == 60).all() and (ordered > disordered).mean() > 0.95


def test_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, " !", "x")], "doc_id long, text string, n_tokens string")
    words = lm.build_vocabulary(lm.texts(df))
    got = lm.score(df, lm.train(lm.texts(df), words), words).collect()
    assert [r["n_tokens"] for r in got] == [2, 2, 0, 1]
    assert got[0]["log_prob"] == got[1]["log_prob"] < 0 and got[2]["log_prob"] == 0 and got[2]["mean_log_prob"] is None
    none = df.limit(0)
    words = lm.build_vocabulary(lm.texts(none))
    assert lm.score(none, lm.train(lm.texts(none), words), words).count() == 0


def test_tokens_beyond_the_vocabulary_have_their_own_share(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROWTH", 0)
    # 3,000 tokens of three occurrences fill the vocabulary up, so that "twice" and "once" have no id
    words = " ".join(f"w{k}" for k in range(3000))
    same = [k for k in (f"x{i}" for i in range(400)) if int(lm.token_hashes([k])[0][0]) % lm.SHARED == 5][:3]
    twice, once, unseen = same
    df = spark.createDataFrame([(1, words), (2, words), (3, words), (4, f"{twice} {twice} {once}")], "doc_id long, text string")
    vocabulary = lm.build_vocabulary(df)
    weights = lm.train(df, vocabulary)
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(same)] + [(3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["log_prob"] for r in lm.score(asked, weights, vocabulary).collect()}
    assert got[3] == 0 and abs(got[0] - got[1] - np.log(2)) < 1e-6 and abs(got[1] - got[2]) < 1e-6
    # all tokens there are, and one that is not for each class, share the whole probability
    tokens = [r["token"] for r in lm.count_tokens(df).collect()]
    n = {r["token"]: r["n"] for r in vocabulary.counts.collect()}
    ids = vocabulary.encode(np.array(tokens))
    near = np.full((2 * lm.WINDOW, len(ids)), lm.PAD)
    log = lm.token_log_probabilities(weights, near, ids, vocabulary)
    rare = (ids >= lm.VOCABULARY) & (ids < lm.PAD)
    log[rare] += np.log([n.get(t, 1) for t in np.array(tokens)[rare]]) - np.log(vocabulary.rest[ids[rare] - lm.VOCABULARY])
    assert rare.sum() > 900 and 0.9 < np.exp(log).sum() < 1 + 1e-4


def test_vocabulary_grows_and_every_token_of_it_is_predicted(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{k} w{k}" for k in range(30_000)))], "doc_id long, text string")
    words = lm.build_vocabulary(df)
    assert len(words.hashes) == int(lm.GROWTH * 30_000**0.5) > lm.VOCABULARY
    assert len(np.unique(words.ids)) == len(words.ids) and (words.ids < len(words.class_of)).all()
    assert (np.diff(words.first)[words.ids[words.class_of[words.ids] >= lm.ALONE]] > 0).all()


def test_context_tells_tokens_of_one_class_apart(spark):
    one, two = [k for k in (f"x{i}" for i in range(400)) if int(lm.token_hashes([k])[0][0]) % lm.SHARED == 5][:2]
    common = " ".join(f"c{k}" for k in range(lm.ALONE)) + " "
    texts = [common * 12 + f"a a {one} a a . " * 5 + f"b b {two} b b " * 5] * 60
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = lm.build_vocabulary(df)
    weights = lm.train(df, words, rounds=2)
    ids = words.encode(lm.token_hashes([f"a b {one} {two}"])[0])
    assert words.class_of[ids[2]] == words.class_of[ids[3]]
    near = np.array([[ids[0]] * 2, [ids[0]] * 2, [ids[0]] * 2, [ids[0]] * 2])
    fits, not_ = lm.token_log_probabilities(weights, near, ids[2:], words)
    assert fits > not_ + 0.5


def test_weights_and_scores_do_not_depend_on_partitions(spark):
    df = documents(spark)
    words = lm.build_vocabulary(df)
    one, seven = (lm.train(df.repartition(n), words) for n in (1, 7))
    assert max(np.abs(a - b).max() for a, b in zip(one, seven, strict=True)) < 1e-4
    scored = [{r["doc_id"]: r["log_prob"] for r in lm.score(df.repartition(n), w, words).collect()} for n, w in ((1, one), (7, seven))]
    assert all(abs(x - scored[1][k]) < 1e-5 * abs(x) for k, x in scored[0].items())


def test_slopes_of_turns_follow_differences(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{k} w{k % 7}" for k in range(400)))], "doc_id long, text string")
    words = lm.build_vocabulary(df)
    dealt = np.random.default_rng(2)
    weights = [w.astype(np.float64) for w in lm.new_weights(ids=len(words.class_of), start=words.start, class_start=words.class_start)]
    weights[4] += dealt.normal(0, 0.3, weights[4].shape)
    ids, first = lm.token_hashes([df.first()["text"]])
    ids = words.encode(ids)
    near = lm.windows(ids, first)
    total = [np.zeros_like(w) for w in weights]
    lm.add_slopes(total, weights, near, words.class_of[ids], ids, words)
    loss = lambda ws: -lm.token_log_probabilities(ws, near, ids, words).sum()
    for k, at in ((0, (2, ids[5], 1)), (1, (4,)), (2, (3, 40)), (3, (40,)), (4, (3, 2)), (5, (3,))):
        moved = [w.copy() for w in weights]
        moved[k][at] += 1e-5
        assert abs((loss(moved) - loss(weights)) / 1e-5 - total[k][at]) < 1e-2 * max(1, abs(total[k][at]))


def test_score_equals_a_plain_loop(spark):
    df = documents(spark, 12)
    words = lm.build_vocabulary(df)
    weights = lm.train(df, words)
    got = {r["doc_id"]: r["log_prob"] for r in lm.score(df, weights, words).collect()}
    for doc_id, text in df.collect():
        ids = words.encode(lm.token_hashes([text])[0]).tolist()
        total = 0.0
        for i, own in enumerate(ids):
            x = weights[1].astype(float)
            for p, d in enumerate((-2, -1, 1, 2)):
                x = x + weights[0][p, ids[i + d] if 0 <= i + d < len(ids) else lm.PAD]
            h = np.tanh(x)
            logits = h @ weights[2] + weights[3]
            total += logits[words.class_of[own]] - np.log(np.exp(logits).sum())
            for s in range(words.first[own], words.first[own + 1]):
                odds = h @ weights[4][words.node[s]] + weights[5][words.node[s]]
                total -= np.log(1 + np.exp(-words.turn[s] * odds))
        assert abs(total - got[doc_id]) < 1e-3 * abs(total)


def test_ids_of_hashes_that_begin_alike():
    """Tokens whose hashes share their first bits, and others that share those with a token."""
    dealt = np.random.default_rng(5)
    hashes = dealt.integers(-(1 << 63), 1 << 63, 300)
    hashes = np.unique(np.concatenate([hashes, hashes[:50] ^ 1, hashes[:20] ^ 6, [0, -1, 1 << 62]]))
    none = np.zeros(1)
    held = lm.Vocabulary(hashes, np.arange(len(hashes)) + 7, *[none] * 8)
    asked = np.concatenate([hashes, hashes ^ 3, dealt.integers(-(1 << 63), 1 << 63, 1000)])
    id_of = dict(zip(hashes.tolist(), held.ids.tolist(), strict=True))
    want = [id_of.get(v, lm.VOCABULARY + v % lm.SHARED) for v in asked.tolist()]
    assert held.encode(asked.view(np.uint64)).tolist() == want
