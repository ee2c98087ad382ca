"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts and benchmark items are cut into words (runs of letters and digits, lower case). Fixed masks lay over
every place and ignore some positions, so a hash survives a substituted word there. Hashes of items and texts
are joined; each hit names a text, an item and a diagonal (the item's first word's place
in the text). Along the diagonal the words are compared one by one, and the pair counts as an overlap
when some window of `window` words of the item (the whole item if shorter) agrees in at least `percent`
percent of its places. Insertions move the diagonal, and each side is judged on its own. With the default
window and percentage no overlap is missed: wherever the words that differ are, some mask fits between them
(a test tries all placements).

Defined results: null and empty texts and items, and items with fewer than `SPAN` words, match nothing: so few
words cannot tell a leak from chance. Rows without an id cannot be reported. Items with the same words are
compared once and reported each; repeated rows give one row. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import broadcast_counted
from sparkloom.scratch import freeze

#: Places that a mask looks at; those between may hold any word. A mask lies wherever its own last place is a word.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
#: Least words of an item.
SPAN = 8


def words(text: Column) -> Column:
    """Words of a text; an empty string may stand at either end and matches nothing but its like."""
    return F.split(F.lower(text), "[^\\p{L}\\p{N}]+")


def seeds(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """`keep`, the place and the hash of every mask at every place of the token array where it fits."""
    shortest = min(mask[-1] for mask in MASKS) + 1
    places = df.filter(F.size(tokens) >= shortest).select(
        *keep, tokens, F.explode(F.sequence(F.lit(0), F.size(tokens) - shortest)).alias("place"))

    def at(offset: int) -> Column:
        return F.get(F.col(tokens), F.col("place") + offset)

    hashes = F.array(*[F.when(F.col("place") + mask[-1] < F.size(tokens), F.xxhash64(F.lit(k), *[at(o) for o in mask]))
                       for k, mask in enumerate(MASKS)])
    return places.select(*keep, "place", F.explode(hashes).alias("seed")).filter("seed is not null")


def overlaps(docs: DataFrame, items: DataFrame, window: int = 20, percent: int = 80, doc_id: str = "doc_id",
             item_id: str = "item_id", text_column: str = "text", item_text: str = "text",
             broadcast_rows: int = 500_000) -> DataFrame:
    """(doc_id, item_id, n_agree, n_compared, doc_place): text and item pairs that overlap, best window each."""
    spark = docs.sparkSession
    asked = (items.select(F.col(item_id).alias("__item"), words(F.col(item_text)).alias("__words"))
             .filter("__item is not null and size(__words) >= 1"))
    asked = asked.withColumn("__words", F.filter("__words", lambda w: w != "")).distinct()
    least = asked.groupBy("__words").agg(F.min("__item").alias("__same"))
    same = freeze(spark, asked.join(least, "__words").select("__item", "__same", "__words"), "items")
    distinct = same.filter((F.col("__item") == F.col("__same")) & (F.size("__words") >= SPAN)).select(
        "__same", "__words").distinct()
    asked_seeds = freeze(spark, seeds(distinct, "__words", "__same").withColumnRenamed("place", "__asked"), "item-seeds")
    text = docs.select(F.col(doc_id).alias("__doc"), words(F.col(text_column)).alias("__tokens")).filter(
        "__doc is not null")
    # Few benchmark seeds are copied to every task; beyond the bound the join shuffles both sides.
    hits = (seeds(text, "__tokens", "__doc").join(broadcast_counted(asked_seeds, broadcast_rows), "seed")
            .select("__doc", "__same", (F.col("place") - F.col("__asked")).alias("__from")).distinct())
    hits = freeze(spark, hits, "hits")
    candidates = hits.join(broadcast_counted(distinct, broadcast_rows), "__same")
    found = text.join(broadcast_counted(hits.select("__doc").distinct(), broadcast_rows), "__doc", "left_semi")
    rows = freeze(spark, found, "hit-texts").join(candidates, "__doc")
    agree = F.expr("transform(__words, (w, k) -> if(__from + k >= 0 and get(__tokens, __from + k) = w, 1, 0))")
    rows = rows.select("__doc", "__same", "__from", agree.alias("__agree"))
    rows = rows.withColumn("__n", F.least(F.lit(window), F.size("__agree")))
    sums = F.expr("transform(sequence(0, size(__agree) - __n), "
                  "s -> named_struct('n', aggregate(slice(__agree, s + 1, __n), 0, (a, x) -> a + x), 'at', -s))")
    best = rows.withColumn("__best", F.array_max(sums)).select(
        "__doc", "__same", F.col("__best.n").alias("n_agree"), F.col("__n").alias("n_compared"),
        (F.col("__from") - F.col("__best.at")).alias("doc_place"))
    best = best.filter(100 * F.col("n_agree") >= percent * F.col("n_compared"))
    best = best.groupBy("__doc", "__same").agg(F.max(F.struct("n_agree", "n_compared", (-F.col("doc_place")).alias(
        "before"))).alias("b"))
    return best.join(same.select("__item", "__same"), "__same").select(
        F.col("__doc").alias(doc_id), F.col("__item").alias(item_id), "b.n_agree", "b.n_compared",
        (-F.col("b.before")).alias("doc_place"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 20, percent: int = 80, doc_id: str = "doc_id",
                      broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of `docs` that overlap with no item, all columns; rows without an id stay."""
    bad = overlaps(docs, items, window, percent, doc_id).select(F.col(doc_id).alias("__bad")).distinct()
    bad = broadcast_counted(freeze(docs.sparkSession, bad, "contaminated"), broadcast_rows)
    return docs.join(bad, F.col(doc_id) == F.col("__bad"), "left_anti")
