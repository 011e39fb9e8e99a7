"""Coordinate conversion against a plain Python version."""

import importlib
import random

from conftest import rows

from regulink.operators import liftover
from regulink.schemas import CHAIN_BLOCKS
from regulink.sources import parse_chain

LINKS = "chrom string, start long, end long, gene_id string"
ALLOWED = {*map(str, range(1, 23)), "X", "Y", "MT"}


def lift_one(chrom, start, end, blocks, maxdiff):
    def targets(position):
        hits = []
        for chain_id, score, src, a, b, tgt, size, strand, to in blocks:
            if src == chrom and a <= position < b and tgt.replace("chr", "") in ALLOWED:
                place = to + position - a
                place = size - 1 - place if strand == "-" else place
                hits.append((-score, chain_id, tgt.replace("chr", ""), place))
        return [(t, p) for _, _, t, p in sorted(hits)]

    starts, ends = targets(start - 1), targets(end - 1)
    if not starts or not ends:
        return None
    new_chrom, new_start = starts[0][0], starts[0][1] + 1
    same = [p + 1 for t, p in ends if t == new_chrom]
    if not same:
        return None
    low, high = min(new_start, same[0]), max(new_start, same[0])
    return None if abs(abs(start - end) - (high - low)) > maxdiff else (new_chrom, low, high)


def random_case(seed):
    rng = random.Random(seed)
    blocks = []
    for chain_id in range(40):
        at, to = rng.randrange(0, 60_000), rng.randrange(0, 60_000)
        src, tgt = rng.choice(["1", "2"]), rng.choice(["chr1", "chr2", "chrX", "chrUn", "3"])
        strand, score = rng.choice("+-"), rng.choice([10, 20, 30])
        for _ in range(3):
            size = rng.choice([1, 500, 16_384, 40_000])
            blocks.append((chain_id, score, src, at, at + size, tgt, 500_000, strand, to))
            at += size + rng.choice([0, 3, 50])
            to += size + rng.choice([0, 7])
    links = [("1", 5, 5, "same")] * 30
    for i in range(400):
        start = rng.randrange(1, 200_000)
        links.append((rng.choice(["1", "2", "9"]), start, start + rng.choice([0, 1, 200, 9000]), f"g{i}"))
    return links, blocks


def expected(links, blocks, maxdiff):
    lifted = [(lift_one(c, s, e, blocks, maxdiff), g) for c, s, e, g in links]
    return sorted(((*new, g) for new, g in lifted if new), key=repr)


def test_liftover_equals_plain_python(spark):
    links, blocks = random_case(1)
    lifted = liftover(spark.createDataFrame(links, LINKS), spark.createDataFrame(blocks, CHAIN_BLOCKS), 100)
    want = expected(links, blocks, 100)
    assert want and rows(lifted) == want


def test_liftover_is_the_same_when_too_large(spark, nothing_small):
    links, blocks = random_case(2)
    lifted = liftover(spark.createDataFrame(links, LINKS), spark.createDataFrame(blocks, CHAIN_BLOCKS), 10)
    assert rows(lifted) == expected(links, blocks, 10)


def test_identity_chain(spark):
    blocks = spark.createDataFrame([(1, 1, "1", 0, 10**6, "chr1", 10**6, "+", 0)], CHAIN_BLOCKS)
    links = [("1", 1, 50, "a"), ("1", 999_000, 1_000_000, "b"), ("1", 999_000, 1_000_001, "off")]
    assert rows(liftover(spark.createDataFrame(links, LINKS), blocks)) == sorted(links[:2], key=repr)


def test_minus_strand_swaps_ends(spark):
    blocks = spark.createDataFrame([(1, 1, "1", 0, 1000, "chr2", 5000, "-", 100)], CHAIN_BLOCKS)
    links = spark.createDataFrame([("1", 11, 21, "a")], LINKS)
    # positions 10 and 20 are 110 and 120 from the far end: 5000 - 1 - 110 + 1, 5000 - 1 - 120 + 1
    assert rows(liftover(links, blocks)) == [("2", 4880, 4890, "a")]


def test_parse_chain(spark):
    text = (
        "##comment\nchain 4900 1 1000 + 100 230 chr1 900 - 50 185 7\n"
        "50 10\t5\n30 0 10\n40\n"
    )
    other = "chain 10 2 1000 + 0 5 chr9 900 + 0 5 8\n5"
    df = spark.createDataFrame([(text,), (other,), ("\n",)], "value string")
    assert rows(parse_chain(df)) == sorted(
        [
            (7, 4900, "1", 100, 150, "chr1", 900, "-", 50),
            (7, 4900, "1", 160, 190, "chr1", 900, "-", 105),
            (7, 4900, "1", 190, 230, "chr1", 900, "-", 145),
            (8, 10, "2", 0, 5, "chr9", 900, "+", 0),
        ],
        key=repr,
    )


def test_work_does_not_grow_with_overlap(spark):
    """Ten thousand chains over one bin: nodes, not pairs of segments and chains."""
    module = importlib.import_module("regulink.operators.liftover")

    rng = random.Random(5)
    blocks = []
    for chain_id in range(10_000):
        a, b = sorted(rng.sample(range(16_384), 2))
        blocks.append((chain_id, rng.randrange(5000), "1", a, b, rng.choice(["chr1", "chr2"]), 10**6, rng.choice("+-"), 50 + a))
    df = spark.createDataFrame(blocks, CHAIN_BLOCKS)
    pieces = module._pieces(module.usable_blocks(df))
    assert pieces.select(module.F.size(module._nodes()).alias("n")).agg({"n": "max"}).first()[0] <= 2 * module.BIN_BITS
    segments = module.lift_segments(module.usable_blocks(df)).collect()
    assert len(segments) <= 4 * len(blocks)
    for place in rng.sample(range(16_384), 60):
        for within in ("1", "2", module.ANY_CHROMOSOME):
            over = [(-s, i, t[3:], o - a if d == "+" else 10**6 - 1 - (o - a)) for i, s, _, a, b, t, _, d, o in blocks if a <= place < b and within in (t[3:], "*")]
            held = [s for s in segments if s["seg_start"] <= place < s["seg_end"] and within == s["within"]]
            assert [(s["preference"]["minus_score"], s["preference"]["chain_id"], s["new_chrom"], s["offset"]) for s in held] == ([min(over)] if over else [])


def test_nodes_make_up_the_piece(spark):
    module = importlib.import_module("regulink.operators.liftover")

    size = 1 << module.BIN_BITS
    rng = random.Random(1)
    ends = [(0, size), (0, 1), (size - 1, size), (1, size - 1), *(tuple(sorted(rng.sample(range(size + 1), 2))) for _ in range(60))]
    df = spark.createDataFrame(ends, "_from int, _to int").select("_from", "_to", module._nodes().alias("nodes"))
    for a, b, nodes in df.collect():
        held = sorted(p for n in nodes for p in range(n["node"] << n["level"], (n["node"] + 1) << n["level"]))
        assert held == list(range(a, b))


def test_nodes_are_never_broadcast(spark):
    """A few chains in the text are millions of nodes, which Spark's estimate of the text does not show."""
    module = importlib.import_module("regulink.operators.liftover")

    text = "chain 10 1 2000000000 + 0 1900000000 chr1 2000000000 + 5 1900000005 7\n1900000000"
    blocks = parse_chain(spark.range(1).select(module.F.lit(text).alias("value")))
    plan = module.lift_segments(module.usable_blocks(blocks))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_ends_are_found_together_within_a_region(spark, nothing_small, monkeypatch):
    module = importlib.import_module("regulink.operators.liftover")
    width = 1 << (module.BIN_BITS + module.REGION_BITS)  # of a region
    one_bin = 1 << module.BIN_BITS
    blocks = spark.createDataFrame(
        [
            (1, 5, "1", 0, 3 * width, "chr2", 10 * width, "+", 50),
            (2, 9, "1", 100, 200, "chr3", 10 * width, "-", 0),  # better at its places, on another chromosome
            (3, 9, "1", width - 50, width + 50, "chr2", 10 * width, "-", 7),
        ],
        CHAIN_BLOCKS,
    )
    near = [
        ("1", 10, 20, "a"), ("1", 10, 150, "b"), ("1", 110, 120, "c"), ("chr1", width - 5, width + 5, "d"),
        ("1", width - 5, width + one_bin, "e"), ("1", width + 1, width + 2, "f"), ("1", 20, 10, "g"),
        ("1", None, 5, "h"), (None, 1, 5, "i"), ("7", 1, 5, "j"), ("1", 10, 20, "a"),
    ]
    far = [("1", 5, 2 * width, "k"), ("1", width + 9, width - 900, "l"), ("1", 5, width + one_bin + 1, "m")]
    frames = [spark.createDataFrame(some, LINKS) for some in (near, near + far)]
    expected = [rows(liftover(df, blocks, 10**9, small=True)) for df in frames]
    assert [len(e) for e in expected] == [8, 11]
    assert rows(liftover(frames[1], blocks, 10**9)) == expected[1]

    def no_join(*args, **options):
        raise AssertionError("a row is shuffled for each of its ends")

    monkeypatch.setattr(module, "lookup_join", no_join)
    assert rows(liftover(frames[0], blocks, 10**9)) == expected[0]


def test_many_rows_of_one_region_are_spread(spark, nothing_small):
    blocks = spark.createDataFrame([(1, 5, "1", 0, 10**6, "chr2", 10**7, "+", 50)], CHAIN_BLOCKS)
    df = spark.range(3000).selectExpr("'1' AS chrom", "100 AS start", "100 + id % 3 AS end", "'a' AS gene_id")
    assert rows(liftover(df, blocks).groupBy("end").count()) == [(150, 1000), (151, 1000), (152, 1000)]
