"""Decontamination against a plain computation of templates, and re-parameterised items."""

import random
import re

from pyspark.sql import functions as F

from regulink.llm import decontamination as dc

ITEM = "In total Anna walks 3 miles and then runs 4.5 km to meet Bob before noon each day of the week"


def found(spark, docs, items):
    d = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, hash string")
    i = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, pos string")
    return {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(d, i).collect()}


def test_other_numbers_names_and_units_are_caught(spark):
    docs = [
        (1, "Before. " + ITEM + " after"),
        (2, ITEM.replace("Anna", "Carl").replace("Bob", "Dora").replace("3", "1,700").replace("4.5", "12")),
        (3, ITEM.replace("miles", "yards")),
        (4, ITEM.replace("Anna", "Carl").replace("Bob", "Carl")),  # one name for two
        (5, "nothing of it here at all, only words"),
        (6, None), (7, ""), (None, ITEM), (8, "A, " * 400),
    ]
    got = found(spark, docs, [(1, ITEM), (1, ITEM), (2, None), (3, "too short"), (None, ITEM)])
    assert set(got) == {(1, 1), (2, 1), (3, 1)}
    assert got[2, 1]["n_slots"] == 6 and got[1, 1]["n_matched"] == got[1, 1]["n_windows"]


def plain_tokens(text):
    text = re.sub(r"(?<=[^\W\d_])( )(?=[A-Z][a-z])|(?<=[,;])( )(?=[A-Z][a-z])", " ", text or "").lower()
    return [t for t in re.split(r"[^a-z0-9]+", text) if t]


def plain(docs, items):
    shape = lambda ts: ["#name" if t[0] == "" else t for t in ts]
    out = set()
    for d, text in docs:
        raw = plain_tokens(text)
        seen = shape(raw)
        for i, item in items:
            own_raw = plain_tokens(item)
            own = shape(own_raw)
            places = [p for p in range(len(own) - 4) if sum(t != "#name" for t in own[p : p + 5]) >= 2]
            lines = {}
            for p in places:
                for q in range(len(seen) - 4):
                    if own[p : p + 5] == seen[q : q + 5]:
                        lines.setdefault(q - p, set()).add(p)
            good, longest = set(), 0
            for line, ps in lines.items():
                slots = {(own_raw[j], raw[j + line]) for p in ps for j in (p, p + 4) if own[j] == "#name"}
                if len({a for a, _ in slots}) == len({b for _, b in slots}) == len(slots):
                    good |= ps
                    longest = max(longest, len(ps))
            if places and (len(good) >= 0.8 * len(places) or longest >= 13):
                out.add((d, i))
    return out


def test_against_plain_computation(spark):
    dealt = random.Random(7)
    words = ["the", "of", "one", "two", "red", "Rome", "Mary", "blue", "end.", "so,"]
    make = lambda n: " ".join(dealt.choice(words) for _ in range(n))
    items = [(k, make(dealt.choice([6, 12, 30]))) for k in range(15)]
    docs = []
    for k in range(120):
        text = make(40).split()
        if k % 2:
            part = dealt.choice(items)[1].split()
            for _ in range(dealt.randrange(3)):
                part[dealt.randrange(len(part))] = dealt.choice(words)
            text[20:20] = part[: dealt.choice([5, 100, 100])]
        docs.append((k, " ".join(text)))
    assert set(found(spark, docs, items)) == plain(docs, items)


def test_large_benchmark_meets_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_MAX_WINDOWS", -1)
    assert set(found(spark, [(1, ITEM)], [(1, ITEM)])) == {(1, 1)}


def test_drop_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM), (2, "clean"), (None, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r["text"] for r in dc.drop_contaminated(docs, items).collect()) == sorted(["clean", ITEM])
    assert dc.contaminated(docs.limit(0), items).count() == 0
    assert dc.contaminated(docs, items.limit(0)).count() == 0


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    plan = dc.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


COACHES = "The coach party leaves at 3 with 3 coaches and 40 pupils then stops after 50 miles so how many seats stay free in each coach once everybody is seated"


def test_a_changed_number_costs_only_its_windows(spark):
    docs = [
        (1, COACHES.replace("with 3", "with 4")),  # one value of the item, two of the document
        (2, COACHES.replace("40", "50")),  # two values of the item, one of the document
        (3, COACHES.lower()), (4, ITEM.lower()), (5, ITEM.upper()), (6, ITEM.title()),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, COACHES), (2, ITEM)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(d, i, any_case=True).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2)}
    assert got[2, 1]["n_matched"] == got[2, 1]["n_windows"] == got[3, 1]["n_matched"]
    assert got[1, 1]["n_windows"] - 5 == got[1, 1]["n_matched"]
    assert got[4, 2]["n_matched"] == got[4, 2]["n_windows"]
