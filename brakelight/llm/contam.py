"""Benchmark decontamination: a prefix-filtered join of item windows against whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, scratch_table, text_or_empty, words

#: positions of documents are tested against a bit table of this many slots before any row is made of them
SLOTS = 1 << 18


def _shingle(w: Column, i: Column) -> Column:
    """Hash of the two words from 0-based position i (of one word where only one is left)."""
    return F.xxhash64(F.get(w, i), F.get(w, i + 1))


def _slots(hashes: DataFrame) -> DataFrame:
    """One row: an array of SLOTS booleans, true where a hash of the column ``h`` falls."""
    marked = hashes.select(F.pmod("h", F.lit(SLOTS)).alias("slot")).distinct().withColumn("on", F.lit(True))
    every = hashes.sparkSession.range(SLOTS).withColumnRenamed("id", "slot")
    full = every.join(marked, "slot", "left").select("slot", F.coalesce("on", F.lit(False)).alias("on"))
    return full.groupBy().agg(F.array_sort(F.collect_list(F.struct("slot", "on"))).alias("x")).select(
        F.transform("x", lambda x: x["on"]).alias("slots"))


def item_windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, words of a window): ``width`` consecutive words, or all words of a shorter item."""
    w = items.select(F.col(id_col).alias("item"), words(ascii_lower(text_or_empty(text_col))).alias("w"))
    w = w.filter(F.size("w") > 0)
    at = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))).alias("i"))
    return at.select("item", F.slice("w", F.col("i"), F.lit(width)).alias("win")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 13, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_hit, items (sorted item ids as strings), contaminated.

    Words are runs of ASCII digits, letters (A-Z lowered) and non-ASCII characters. A document word is hit when
    it lies inside an occurrence of a window of an item; a document is contaminated when n_hit > 0 and
    ``share`` * n_hit >= n_words.

    The join is prefix filtered: the shingles (pairs of consecutive words) of each window are ordered by how often
    they occur in all documents, and since a window must be contained whole, a prefix of one shingle is enough: its
    rarest. Document positions that hold such a shingle are joined with its windows; the offset of the shingle in
    the window gives the only possible start, which must lie in the document with room for the whole window; then
    all words are compared. A document's repeated words never leave its row: positions are filtered against a
    fixed-size bit table first, and each surviving one carries only the words around it.

    Null text has no words and is not contaminated; windows shared by items count for each of them; items without
    words never count; items without id count for the hits and are not listed; repeated rows are judged separately; an empty table on either side gives
    no hits; further columns are ignored.
    """
    spark = docs.sparkSession
    win = item_windows(items, width, item_id_col, item_text_col)
    win = scratch_table(win, "contam-windows")
    texts = win.select("win").distinct()
    shingles = texts.select("win", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("win") - 2))).alias("off"))
    shingles = shingles.select("win", "off", F.when(F.size("win") == 1, F.xxhash64(F.get("win", F.lit(0)), F.lit(1)))
                               .otherwise(_shingle(F.col("win"), F.col("off"))).alias("h"))
    shingles = scratch_table(shingles, "contam-shingles")
    single = not shingles.filter(F.size("win") == 1).isEmpty()

    body = docs.select(F.col(id_col).alias("id"), words(ascii_lower(text_or_empty(text_col))).alias("w"))
    body = body.withColumn("row", F.monotonically_increasing_id())

    def hits(hashes: DataFrame, around: bool) -> DataFrame:
        """Rows of documents, one per position whose shingle falls in a slot; with ``around`` one more per document,
        without position."""
        # places: -1 for the document, then its pairs of words, then, if windows of one word need them, its words
        pairs, n = F.size("w") - 1, F.size("w")
        last = F.greatest(F.lit(-1), pairs + n - 1 if single else pairs - 1)
        first = -1 if around else 0
        at = body.select("*", F.explode(F.sequence(F.lit(-1), last)).alias("at")).filter(F.col("at") >= first)
        at = at.withColumn("p", F.when(F.col("at") < pairs, F.col("at")).otherwise(F.col("at") - pairs) if single else F.col("at"))
        h = _shingle(F.col("w"), F.col("p"))
        if single:
            h = F.when(F.col("at") < pairs, h).otherwise(F.xxhash64(F.get("w", "p"), F.lit(1)))
        at = at.withColumn("h", F.when(F.col("at") >= 0, h))
        on = F.get(_slots(hashes).scalar(), F.pmod("h", F.lit(SLOTS)).cast("int"))  # one row of SLOTS booleans
        at = at.filter((F.col("at") < 0) | on)
        if not around:
            return at.select("h")
        here = F.col("at") >= 0
        return at.select("row", "id", F.size("w").cast("long").alias("n_words"), F.when(here, F.col("p")).alias("p"), "h", F.when(
            here, F.slice("w", F.greatest(F.col("p") - width + 1, F.lit(0)) + 1, F.lit(2 * width))).alias("ctx"))

    counts = hits(shingles.select("h"), False).groupBy("h").count()
    by_rarity = Window.partitionBy("win").orderBy(F.coalesce("count", F.lit(0)), "h", "off")
    prefix = (shingles.join(counts, "h", "left").withColumn("r", F.row_number().over(by_rarity)).filter("r = 1")
              .select("win", "off", "h"))
    prefix = scratch_table(prefix, "contam-prefix")

    near = hits(prefix.select("h"), True)
    # documents without a candidate keep one row; a key of its own spreads such rows over the join
    near = near.withColumn("k", F.coalesce("h", F.xxhash64("row")))
    cand = near.join(prefix.withColumnRenamed("h", "k"), "k", "left")
    start = F.col("p") - F.col("off")
    base = F.greatest(F.col("p") - width + 1, F.lit(0))
    fits = (F.col("h").isNotNull() & (start >= 0) & (start + F.size("win") <= F.col("n_words")))
    same = F.when(fits, F.slice("ctx", F.greatest(start - base, F.lit(0)) + 1, F.size("win")) == F.col("win"))
    judged = cand.select("row", "id", "n_words", F.when(same, F.struct(
        start.alias("s"), (start + F.size("win")).alias("e"))).alias("span"),
        F.when(same, F.col("win")).alias("win"))
    spans = judged.groupBy("row", "id", "n_words").agg(F.array_sort(F.collect_set("span")).alias("spans"),
                                                       F.collect_set("win").alias("wins"))
    spans = scratch_table(spans, "contam-spans")
    # union of the sorted spans
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
                              F.greatest(a["end"], x["e"]).alias("end")), lambda a: a["n"])
    found = (spans.filter(F.size("wins") > 0).select("row", F.explode("wins").alias("win"))
             .join(win.filter(F.col("item").isNotNull()).select("item", "win"), "win")
             .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    out = spans.join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_words", covered.cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
