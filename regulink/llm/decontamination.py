"""Benchmark decontamination by templates: windows with typed placeholders, joined by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import table, texts, without_ids

WINDOW = 5  # tokens
SHARE = 0.8  # of an item's windows
RUN = 13  # windows in line that are enough for long items
LITERALS = 2  # tokens of a window that are no placeholders, at least
BROADCAST_MAX_WINDOWS = 500_000

# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yard yards mile miles mg g kg t ton tons oz lb lbs pound pounds "
    "ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents usd eur gbp mph kmh kph degree degrees"
).split()

_MARK = "\ue000"  # stands before a token that is a name
_NUMBER, _UNIT, _NAME = "#number", "#unit", "#name"


def _marked(text: Column) -> Column:
    """Lower-case text in which names carry a mark, numbers are whole and units stand apart.

    A name is a capitalised word that a letter, comma or semicolon and a space precede, so words
    that begin a sentence are none.
    """
    clean = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, "")).otherwise(text)
    named = F.lower(F.regexp_replace(clean, r" (?<=[\p{L},;] )(?=\p{Lu}\p{Ll})", " " + _MARK))
    whole = F.regexp_replace(named, r"([0-9])[.,](?=[0-9])", "$1p")
    apart = F.regexp_replace(whole, r"([0-9])(?=[\p{L}&&[^p]]|p(?![0-9]))", "$1 ")
    return F.when(named.rlike("[0-9]"), apart).otherwise(named)


def _split(marked: str) -> Column:
    """Tokens of a marked text: runs of letters and digits, names with their mark."""
    return F.array_remove(F.split(marked, "[^\\p{L}\\p{N}" + _MARK + "]+"), "")


def _is_number(token: Column) -> Column:
    return token.between("0", "9z")  # tokens start with a letter, a digit or the mark


def canonical(raw: str, names: bool = True) -> Column:
    """The tokens of column ``raw`` with placeholders for numbers, names and units after numbers;
    without ``names`` these are words like others."""
    before = lambda i: F.get(F.col(raw), i - 1)
    return F.transform(
        F.col(raw),
        lambda t, i: F.when(t.startswith(_MARK), _NAME if names else F.substring(t, 2, 1 << 30))
        .when(_is_number(t), _NUMBER)
        .when(t.isin(UNITS) & _is_number(before(i)), _UNIT)
        .otherwise(t),
    )


def _shaped(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """``key`` with the tokens as written, as template, and as template in which names are words
    (null where the text has no names)."""
    marked = df.select(key, _marked(F.col(text_col)).alias("_marked"))
    split = marked.select(
        key, F.col("_marked").rlike(f"[0-9{_MARK}]").alias("_slots"), _split("_marked").alias("_raw")
    )
    shape = F.when(F.col("_slots"), canonical("_raw")).otherwise(F.col("_raw"))
    plain = F.when(F.exists("_raw", lambda t: t.startswith(_MARK)), canonical("_raw", names=False))
    return split.select(key, "_raw", shape.alias("_shape"), F.when(F.col("_slots"), plain).alias("_plain"))


def windows(df: DataFrame, key: str, text_col: str, any_case: bool = False) -> DataFrame:
    """``key, again, pos, _0 .. , hash, first, last``: every window's template, its hash, and its first and
    last token as written.

    With ``any_case`` a text with names is laid twice: with placeholders for them, and with lower-case
    words (``again`` 1), as a copy in other case has them. The template is laid beside itself, each time one token further on,
    so that a row has a window.
    """
    shaped = _shaped(df, key, text_col)
    both = F.filter(F.array("_shape", "_plain"), lambda x: x.isNotNull()) if any_case else F.array("_shape")
    laid = shaped.select(key, "_raw", F.posexplode(both).alias("again", "_laid"))
    beyond = lambda name, k: F.slice(name, k + 1, 1 << 30)
    beside = F.arrays_zip(
        F.sequence(F.lit(0), F.size("_raw") - 1).alias("pos"),
        *[beyond("_laid", k).alias(f"_{k}") for k in range(WINDOW)],
        F.col("_raw").alias("first"),
        beyond("_raw", WINDOW - 1).alias("last"),
    )
    rows = laid.select(key, "again", F.inline(beside)).where("last is not null")  # whole windows only
    return rows.withColumn("hash", F.xxhash64(*[f"_{k}" for k in range(WINDOW)]))


def template_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", any_case: bool = False
) -> DataFrame:
    """Windows of benchmark items with enough literal tokens, and how many of them the item has.

    Items of fewer tokens than a window, or of nearly only placeholders, have none. Repeated rows of
    an item count once.
    """
    given = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    given = given.where("item_id is not null and text is not null").distinct()
    slot = lambda k: F.col(f"_{k}").startswith("#")
    literal = F.lit(0)
    for k in range(WINDOW):
        literal = literal + (~slot(k)).cast("int")
    found = (
        windows(given, "item_id", "text", any_case)
        .where(literal >= LITERALS)
        .select(
            "item_id", "again", F.col("pos").alias("item_pos"), "hash", F.col("first").alias("item_first"),
            F.col("last").alias("item_last"), slot(0).alias("slot_first"), slot(WINDOW - 1).alias("slot_last"),
        )
        .distinct()
    )
    places = found.where("again = 0").select("item_id", "item_pos").distinct()
    sizes = places.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_windows"))
    return found.join(places, ["item_id", "item_pos"], "left_semi").drop("again").distinct().join(sizes, "item_id")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    any_case: bool = False,
) -> DataFrame:
    """``doc_id, item_id, n_windows, n_matched, longest, n_slots`` of each document that has an item.

    Windows of both meet by the hash of their template. Matches in one line (same distance between the two positions) have to fill
    slots consistently: a value of the item stands for one value of the document, that at most of
    its places (the smallest of equally many); windows that hold another one are dropped. Different
    numbers or units may become equal; a line in which two names do is dropped, and so is one in
    which a name stands for two, unless ``any_case``: then windows with names also meet by their
    lower-case words, and names are bound as numbers are. A document has an item
    when consistent lines cover ``SHARE`` of the item's windows, or one has ``RUN`` windows.
    ``n_slots`` is the number of different filled slots. Null texts and ids, and texts of fewer
    tokens than a window, match nothing; rows that repeat an id are one document.
    """
    template = template_windows(items, item_id_col, item_text_col, any_case)
    if template.count() <= BROADCAST_MAX_WINDOWS:
        template = F.broadcast(template)
    given = texts(docs, id_col, text_col).where("doc_id is not null")
    rows = windows(given, "doc_id", "text", any_case).select("doc_id", "pos", "hash", "first", "last")
    hits = rows.join(template, "hash")
    hits = hits.withColumn("line", F.col("pos") - F.col("item_pos"))
    pair = lambda at, known, seen, slot: F.when(
        F.col(slot), F.struct(at.alias("at"), F.col(known).alias("known"), F.col(seen).alias("seen"))
    )
    lines = hits.groupBy("doc_id", "item_id", "line").agg(
        F.max("n_windows").alias("n_windows"),
        F.collect_set("item_pos").alias("positions"),
        F.array_union(
            F.collect_set(pair(F.col("item_pos"), "item_first", "first", "slot_first")),
            F.collect_set(pair(F.col("item_pos") + WINDOW - 1, "item_last", "last", "slot_last")),
        ).alias("slots"),
    )
    values = lambda name, side: F.size(F.array_distinct(F.transform(name, lambda s: s[side])))
    bound = F.transform("slots", lambda s: F.struct(s["known"].alias("known"), s["seen"].alias("seen")))
    lines = lines.withColumn("bound", F.array_distinct(bound))
    times = lambda b: F.size(F.filter("slots", lambda s: (s["known"] == b["known"]) & (s["seen"] == b["seen"])))
    rivals = lambda b: F.filter("bound", lambda c: (c["known"] == b["known"]) & (c["seen"] != b["seen"]))
    ahead = lambda c, b: (times(c) > times(b)) | ((times(c) == times(b)) & (c["seen"] < b["seen"]))
    most = F.filter("bound", lambda b: ~F.exists(rivals(b), lambda c: ahead(c, b)))
    agree = values("bound", "known") == F.size("bound")
    lines = lines.withColumn("most", F.when(agree, F.col("bound")).otherwise(most))
    wrong = F.filter("slots", lambda s: ~F.exists("most", lambda b: (b["known"] == s["known"]) & (b["seen"] == s["seen"])))
    lines = lines.withColumn("wrong", F.when(agree, F.array().cast("array<int>")).otherwise(F.transform(wrong, lambda s: s["at"])))
    free = F.filter("positions", lambda p: ~F.exists("wrong", lambda w: w.between(p, p + WINDOW - 1)))
    lines = lines.withColumn("positions", F.when(agree, F.col("positions")).otherwise(free))
    lines = lines.withColumn("names", F.filter("most" if any_case else "bound", lambda b: b["known"].startswith(_MARK)))
    one_to_one = (values("names", "known") == F.size("names")) & (values("names", "seen") == F.size("names"))
    found = (
        lines.where(one_to_one & (F.size("positions") > 0))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("n_windows").alias("n_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_set("positions")))).cast("long").alias("n_matched"),
            F.max(F.size("positions")).cast("long").alias("longest"),
            F.max(F.size("most")).cast("long").alias("n_slots"),
        )
    )
    return found.where((F.col("n_matched") >= SHARE * F.col("n_windows")) | (F.col("longest") >= RUN))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of documents that have no item, in any case of its letters."""
    found = contaminated(docs, items, id_col, text_col, any_case=True).select("doc_id").distinct()
    return without_ids(docs, found, id_col)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), any_case=True)
