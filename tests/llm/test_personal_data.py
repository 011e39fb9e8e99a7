"""Personal data: base spans against plain patterns, EM on votes with known truth, masking."""

import hashlib
import random
import re

import numpy as np

from regulink.llm import personal_data as pd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and pd.luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((kind, *m.span()))
    return found


def test_base_spans_are_those_of_the_patterns():
    dealt = random.Random(2)
    letters = "0123456789..@@--  ++ab().%٣é"
    texts = ["".join(dealt.choice(letters) for _ in range(dealt.randrange(40))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 (017) 555-7713", "256.1.1.1 001.2.3.4"]
    for t in texts:
        assert pd.base_spans(t) == plain(t), t


def test_long_runs_take_no_time():
    for t in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "+1" * 150_000, "a@" * 100_000):
        assert pd.base_spans(t) == []
    assert len(pd.base_spans("1." * 150_000)) == 37_500


def test_em_finds_the_reliable_labelers():
    dealt = np.random.default_rng(1)
    truth = dealt.random(5000) < 0.4
    right = np.array([0.95, 0.9, 0.6, 0.9, 0.55])
    said = np.where(dealt.random((5000, 5)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    said[dealt.random((5000, 5)) < 0.2] = 0
    patterns, counts = np.unique(said, axis=0, return_counts=True)
    prior, probability, posterior = pd.estimate(patterns, counts.astype(float))
    assert abs(prior - 0.4) < 0.05
    assert (np.abs(probability[1, :, 2] / (1 - probability[1, :, 1]) - right) < 0.06).all()


TEXTS = [
    (1, 'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y'),
    (2, "write to a.b@c-d.example.com or 10.0.0.1, card 4111 1111 1111 1111, +1 (017) 555-7713"),
    (3, None), (4, ""), (4, ""), (None, "clean text of nobody"), (5, "ordinaryverylongwordwithoutdigits here"),
]


def test_rows(spark):
    df = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id long, text string, spans string")
    found = pd.personal_data(df, pd.fit_spans(df)).collect()
    assert len(found) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in found}
    two = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(TEXTS[1][1]))
    assert by_id[2]["spans"] == two and by_id[2]["base_sha256"] == hashlib.sha256(two.encode()).hexdigest()
    assert [by_id[2][f"n_{k}"] for k in pd.BASE_KINDS] == [1, 1, 1, 1]
    assert by_id[1]["spans"] == "secret:11:51" and by_id[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(by_id[k]["spans"] == "" for k in (3, 4, 5, None))
    masked = {r["doc_id"]: r["text"] for r in pd.mask_documents(df, pd.fit_spans(df)).collect()}
    assert masked[1] == 'x token = "[SECRET]" y' and masked[3] is None and masked[5] == TEXTS[-1][1]
    assert masked[2] == "write to [EMAIL] or [IP], card [CARD], [PHONE]"


def test_keys_of_any_length_are_looked_at():
    """Long ones, and base64 with all its characters; paths and links are not."""
    hexed = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for key in (hexed, hexed * 4, hexed * 5000, "pk_" + "a1B2" * 40, "aB3+/xY9" * 20, "aB3+/xY9" * 3 + "=="):
        text = f"the api key = {key}, as said"
        assert pd.added_candidates(text, []) == [("secret", 14, 14 + len(key))]
    for text in ("see /usr/local/lib/python/site-packages now", "http://a-very-long-host-name-of-ours/", "x" * 19, "+".join("abc" for _ in range(30))):
        assert pd.added_candidates(text, []) == []
    for text in ("a=" * 100_000, "A1b+" * 100_000 + "!", "/" * 300_000, "=" * 300_000):
        assert pd.added_candidates(text, []) == []


def test_nothing_to_find(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pd.fit_spans(df) is None
    assert pd.personal_data(df, None).count() == 0
