"""Token counts against the tokenizer itself."""

import random

import public_tokenizers
import sentencepiece

from regulink.llm import token_counts as tc

PATH = public_tokenizers.path(tc.MODEL)
SAMPLES = ["", " ", "  ", "a  b", "a\nb", "\n\n", "a\r\nb", "<s> x </s>", "<unk>", "▁x", "ﬁ ①", "中 文", "\x00", "é" * 5000]


def texts():
    dealt = random.Random(3)
    letters = list("ab ▁\n\t\r<>/s. é①🙂ﬁ\u3000\u00a0\u200b\x00中é")
    return SAMPLES + ["".join(dealt.choice(letters) for _ in range(dealt.randrange(20))) for _ in range(3000)]


def test_counts_equal_the_tokenizer():
    own = tc.count_texts(texts(), tc.PieceCounts(PATH))
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert own.tolist() == [len(ids) for ids in model.encode(texts())]


def test_rows(spark):
    given = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "ab " * 5000, "x"), (3, "é", "x")]
    df = spark.createDataFrame(given, "doc_id long, text string, n_tokens string")
    rows = {(r["doc_id"], r["n_bytes"]): r for r in tc.token_counts(df, PATH).collect()}
    assert tc.token_counts(df, PATH).count() == 5
    assert rows[1, 0]["n_tokens"] == 0 and rows[2, 0]["n_tokens"] == 0
    assert rows[None, 15000]["over_limit"] and not rows[3, 2]["over_limit"]


def test_empty_table(spark):
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
