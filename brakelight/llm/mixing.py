"""Mixing sources to target weights: exact block quotas, split over shards by a multivariate-hypergeometric tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ordered_prefix, scratch_table

SIZE_PATTERN = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   max_epochs: int = 2) -> DataFrame:
    """(rank, source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights``, repeating. ``share`` times the total size is shared by
    weight; no target exceeds ``max_epochs`` times its source, and the excess is shared again by weight until
    none is above. The final level is the largest of the levels that arise when the sources with the smallest
    ratio of bound to weight are held at their bound one after the other. These windows run over the table
    of sources, which has one row per source.
    """
    # byte order of UTF-8 is code-point order
    by_name = Window.orderBy(F.col("source").isNull(), F.encode(F.coalesce(F.col("source"), F.lit("")), "UTF-8"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     F.pmod(F.col("rank"), F.lit(len(weights))).cast("int") + 1)
    ranked = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
              .withColumn("w", w.cast("long")).withColumn("bound", F.col("source_size") * max_epochs))
    whole = Window.partitionBy()
    held = Window.orderBy(F.col("bound") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(held), F.lit(0)))
             / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(held), F.lit(0))))
    levels = ranked.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("bound").cast("double"), F.greatest(F.col("level"), F.lit(0.0)) * F.col("w"))
    return levels.select("rank", "source", "source_size", target.alias("target"))


def split_quotas(quotas: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each source in the shards before, blocks of each source in this shard).

    The tree halves the shards; a node's blocks go to its left half by a multivariate-hypergeometric draw whose
    size is the left half's share of blocks. Every node draws from its own seeded generator, so any task that
    walks to a shard sees the same draws: quotas are met exactly and shards are disjoint.
    """
    lo, hi = 0, shards
    start, have = np.zeros(len(quotas), np.int64), quotas.astype(np.int64).copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        # exact for any total: one hypergeometric draw per source
        left, rest, need = np.zeros_like(have), total, take
        for i, n in enumerate(have):
            rest -= int(n)
            if need <= 0:
                break
            x = int(_hypergeometric(rng, int(n), rest, need)) if n else 0
            left[i], need = x, need - x
        if shard < mid:
            have, hi = left, mid
        else:
            start, have, lo = start + left, have - left, mid
    return start, have


def _hypergeometric(rng, good: int, bad: int, sample: int) -> int:
    if bad == 0:
        return min(good, sample)
    if good + bad < 1_000_000_000:
        return rng.hypergeometric(good, bad, sample)
    # beyond the library's range: halve the sample, both halves within bounds
    mean = sample * good / (good + bad)
    sd = (mean * bad / (good + bad) * (good + bad - sample) / (good + bad)) ** 0.5
    return int(min(good, sample, max(0, sample - bad, round(rng.normal(mean, sd)))))


def mix(docs: DataFrame, seed: int = 0, block_words: int = 4096, shard_words: int = 1 << 20,
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", permute_by: str | None = None) -> DataFrame:
    """The draws of a mix: id, row, size, source, source_size, target, epoch, shard, position, words.

    Each source's documents are permuted by a seeded hash; its blocks are runs of ``block_words`` words of that
    stream, and a document belongs to the block in which it begins. A source's quota is all its blocks once per
    whole epoch of its target, and the first blocks of its permuted stream for the rest; the last drawn block is
    cut so that the source's words meet the rounded target exactly (one document per source may be taken in part).
    ``split_quotas`` deals the quotas out to shards of about ``shard_words`` words; a shard takes its counts
    from the next unused blocks of each source, and ``position`` is a local shuffle within the shard.

    One row per document and draw; a document that is not drawn comes once, with shard null and words 0. ``row``
    identifies the input row, so repeated rows are mixed separately. Null or blank text has size 0 and is never
    drawn; null sources form a source of their own; an empty table gives no rows. Reruns agree, given
    ``permute_by`` (default: the id column), the column whose hash permutes the documents, is the same in them.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(SIZE_PATTERN)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size"),
                       F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(permute_by or id_col).cast("string"))).alias("u"))
    stream = ordered_prefix(rows, ["source", "u", "id", "size"], "source", "size", "before", "mix-stream")
    per_source = stream.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = (source_targets(per_source, weights, share, max_epochs)
               .withColumn("want", F.round("target").cast("long"))
               .withColumn("epochs", F.when(F.col("source_size") > 0,
                                            F.floor(F.col("want") / F.col("source_size"))).otherwise(F.lit(0)))
               .withColumn("rest", F.col("want") - F.col("epochs") * F.col("source_size"))
               .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
               .withColumn("quota", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block_words)))
    targets = scratch_table(targets.coalesce(1), "mix-targets")

    # every shard walks the tree with the list of quotas (one number per source)
    quotas = targets.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("q"),
                                   F.sum("want").alias("words"))
    shards = quotas.select(
        F.transform("q", lambda x: x["quota"].cast("long")).alias("q"),
        F.greatest(F.lit(1), F.ceil(F.col("words") / shard_words)).cast("long").alias("shards"))
    every = shards.select("q", "shards", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    schema = T.StructType().add("shard", "long").add("rank", "integer").add("first", "long").add("count", "long")

    def walk(batches):
        for b in batches:
            for q, n, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                first, count = split_quotas(np.asarray(q, np.int64), s, n, seed)
                use = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(use), s, np.int64)), pa.array(use.astype(np.int32)),
                     pa.array(first[use]), pa.array(count[use])], names=schema.names)

    dealt = every.repartition("shard").mapInArrow(walk, schema)
    drawn = dealt.select("shard", "rank", F.explode(
        F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("n"))
    keyed = F.broadcast(targets) if targets.count() <= 10_000 else targets
    drawn = (drawn.join(keyed.select("rank", "blocks"), "rank")
             .select("rank", "shard", F.floor(F.col("n") / F.col("blocks")).cast("int").alias("epoch"),
                     F.pmod("n", "blocks").alias("block")))

    named = stream.join(keyed.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    with_block = named.withColumn("block", F.floor(F.col("before") / block_words))
    alive = with_block.filter("size > 0")
    joined = alive.join(drawn, ["rank", "block"], "left")
    taken = (F.when(F.col("shard").isNull(), F.lit(0))
             .when(F.col("epoch") < F.col("epochs"), F.col("size"))
             .otherwise(F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))))
    keep = ["id", "source", "size", "before", "source_size", "target", "shard", "epoch"]
    draws = (joined.withColumn("words", taken.cast("long"))
             .select(*keep, "words")
             .unionByName(with_block.filter("size = 0").select(
                 "id", "source", "size", "before", "source_size", "target", F.lit(None).cast("long").alias("shard"),
                 F.lit(None).cast("int").alias("epoch"), F.lit(0).cast("long").alias("words"))))
    return draws


def placed(draws: DataFrame, seed: int = 0) -> DataFrame:
    """The drawn rows with ``position``: a shuffle within each shard (a shard holds a bounded number of words)."""
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.col("shard"), F.col("epoch"),
                                                           F.col("source"), F.col("before")), "epoch", "before", "id")
    return draws.filter("words > 0").withColumn("position", F.row_number().over(local) - 1)


def taken_per_document(draws: DataFrame) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, taken (words over all its draws)."""
    cols = ["id", "size", "source", "source_size", "target"]
    some = (draws.filter("size > 0").groupBy("source", "before", "id", "size", "source_size", "target")
            .agg(F.sum("words").alias("taken")))
    return some.select(*cols, "taken").unionByName(
        draws.filter("size = 0").select(*cols, F.lit(0).cast("long").alias("taken")))
