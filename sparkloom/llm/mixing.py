"""Mixing sources to target weights: hash-random order, range-sorted prefix sums, exact cuts.

1. Each row gets its size in words and a key, the hash of its id. The narrow rows (no texts) are written with a
   number of their own, so what follows does not change when a task is run again.
2. Each source gets its share of the budget by weight, but no more than `most_epochs` times its own size; the
   excess is shared out again by weight among the others until no target is above its bound. Integers decide.
3. Rows are range partitioned by source and key, which splits a hot source, and summed up inside each range; the
   sums of the ranges before give every row its place in its source (distributed prefix sums).
4. A source is taken whole as often as its target allows, and once more up to the exact word in the order of the
   keys: the row across the cut gives its first words.

DataFrame functions only: no Python worker takes part.

Defined results: a null text and a text without words have size 0 and give nothing; a null source is a source of
its own, the last one; null and repeated ids are rows like all others (rows of one source, id, size and text are
alike, and which of them the cut meets makes no difference); no rows give no rows. Other columns are kept aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import ASCII_SPACE
from sparkloom.operators.positions import global_row_number
from sparkloom.scratch import freeze

_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
_AFTER_WORD = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
_SOURCE = ["__none", "__source"]


@dataclass(frozen=True)
class MixParams:
    most_epochs: int = 3
    percent: int = 100  # size of the mix in percent of all sizes
    seed: int = 13
    rows_per_range: int = 4_000_000


def n_words(text: str | Column) -> Column:
    """Number of runs of anything but ASCII white space. Each run becomes a letter and the letters are counted, so
    that no list of a text's words is held."""
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.length(F.regexp_replace(trimmed, _WORD, "x")).cast("bigint")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its word number `words`."""
    return F.array_join(F.slice(F.split(text, _AFTER_WORD), 1, words.cast("int")), "")


def cycling_weight(*weights: int) -> Column:
    """Weights by the number of the source, which starts at 1: the given ones, repeating."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]),
                        (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))


def source_targets(sized: DataFrame, weight: Column, params: MixParams) -> DataFrame:
    """(__none, __source, rows, source_size, weight, budget, target): a row per source; `target` = `budget` but
    for the part of a word.

    Each round shares what the bounded sources leave by weight among the others; only sums over all sources reach
    the driver. The bounded sources grow in number from round to round.
    """
    spark = sized.sparkSession
    by_source = sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    numbered = global_row_number(by_source, _SOURCE, "number").withColumn(
        "source", F.when(~F.col("__none"), F.col("__source")))
    sources = freeze(spark, numbered.select(
        *_SOURCE, "rows", "source_size", weight.cast("bigint").alias("weight"),
        (F.col("source_size") * params.most_epochs).alias("most")), "sources")
    size, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if size is None:
        weights, size = 0, 0
    whole, left, free = size * params.percent // 100, size * params.percent // 100, weights
    while free > 0:
        bounded = F.col("most") <= F.expr(f"({left}L * weight) div {free}L")
        most, heavy = sources.filter(bounded).agg(F.coalesce(F.sum("most"), F.lit(0)),
                                                  F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (whole - most, weights - heavy) == (left, free):
            break
        left, free = whole - most, weights - heavy
    if free <= 0:
        return sources.withColumns({"budget": F.col("most"), "target": F.col("most").cast("double")}).drop("most")
    share = F.expr(f"({left}L * weight) div {free}L")
    exact = (F.lit(left) * F.col("weight")).cast("double") / F.lit(float(free))
    bounded = F.col("most") <= share
    return sources.withColumns({"budget": F.when(bounded, F.col("most")).otherwise(share),
                                "target": F.when(bounded, F.col("most").cast("double")).otherwise(exact)}).drop("most")


def mix_plan(docs: DataFrame, weight: Column | None = None, params: MixParams = MixParams(), id_column: str = "doc_id",
             text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(id, source, text_hash, size, source_size, target, epochs, cut, taken) of every row of `docs`: taken whole
    `epochs` times and its first `cut` words once more; `taken` words in all.

    `weight` is a column of whole numbers over `source` and `number`, the place of the source by code points, null
    last; without it the weights are 1, 2, 3, repeating.
    """
    spark, source = docs.sparkSession, F.col(source_column)
    key = F.unhex(F.md5(F.concat_ws(":", F.lit(str(params.seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("")))))
    sized = freeze(spark, docs.select(
        F.col(id_column).alias("__id"), source.isNull().alias("__none"), F.coalesce(source, F.lit("")).alias("__source"),
        n_words(text_column).alias("size"), key.alias("__key"), F.xxhash64(text_column).alias("text_hash"),
        F.monotonically_increasing_id().alias("__row")), "sized")
    targets = freeze(spark, source_targets(sized, cycling_weight(1, 2, 3) if weight is None else weight, params), "targets")
    # Equal keys (rows of one id) are told apart by the number, so that ranges can split them too.
    order = ["__key", "size", "text_hash", "__row"]
    rows = targets.agg(F.sum("rows")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // params.rows_per_range))
    ranged = freeze(spark, sized.repartitionByRange(ranges, *_SOURCE, *order)
                    .withColumn("__range", F.spark_partition_id()), "ranged")
    # A row per source and range that holds some of it: no more than ranges and sources together.
    per_range = ranged.groupBy(*_SOURCE, "__range").agg(F.sum("size").alias("__sum"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_range.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
               .join(targets, _SOURCE))
    inside = Window.partitionBy(*_SOURCE, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, [*_SOURCE, "__range"])
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("bigint")
    left = F.expr("budget - __epochs * source_size - __before - __inside")
    cut = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), left))
    return placed.withColumn("__epochs", epochs).withColumn("cut", cut).select(
        F.col("__id").alias(id_column), F.when(~F.col("__none"), F.col("__source")).alias(source_column), "text_hash",
        "size", "source_size", "target", F.col("__epochs").alias("epochs"), "cut",
        (F.col("__epochs") * F.col("size") + F.col("cut")).alias("taken"))


def mixed_texts(docs: DataFrame, plan: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source") -> DataFrame:
    """The mix itself: a row (id, source, epoch, text) for each time a row of `docs` is taken, epochs from 0 on,
    the text of a cut row up to its last word taken. Rows with no words taken do not appear."""
    texts = docs.select(F.col(id_column).alias("__id"), F.col(source_column).alias("__source"),
                        F.xxhash64(text_column).alias("__hash"), F.col(text_column).alias("__text")).dropDuplicates(
        ["__id", "__source", "__hash"])
    wanted = plan.filter("taken > 0").withColumn("epoch", F.explode(F.sequence(
        F.lit(0), (F.col("epochs") + F.when(F.col("cut") > 0, 1).otherwise(0)).cast("int") - 1)))
    same = (F.col(id_column).eqNullSafe(F.col("__id")) & F.col(source_column).eqNullSafe(F.col("__source"))
            & (F.col("text_hash") == F.col("__hash")))
    whole = F.col("epoch") < F.col("epochs")
    text = F.when(whole | (F.col("cut") == F.col("size")), F.col("__text")).otherwise(
        first_words(F.col("__text"), F.col("cut")))
    return wanted.join(texts, same).select(id_column, source_column, "epoch", text.alias(text_column))
