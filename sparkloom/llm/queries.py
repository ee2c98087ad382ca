"""The registered queries over whole tables, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import (centroids, code_compression, decontam, embed_dedup, langid, minhash, mixing, packing, pii, quality,
                           substring_dedup, token_counts, toxicity)
from sparkloom.llm.common import fold
from sparkloom.llm.oracles import ORACLES  # noqa: F401
from sparkloom.operators.joins import join_aggregate
from sparkloom.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, str(sf_dir).rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def scored(spark, sf_dir, train, score, label: str, parts: int, held: int, threshold: float) -> DataFrame:
    """Fit on the folds that are not held out, score all of `documents`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), learn_from=fold("__id", parts) != held, label=label)
    return score(docs, model).select("doc_id", (fold("doc_id", parts) == held).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op1_quality(spark, sf_dir):
    return scored(spark, sf_dir, quality.train_quality, quality.score_quality, "quality", 3, 1, 0.5)


@query
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train_langid(docs, learn_from=fold("doc_id", 4) != 2)
    return (langid.identify(docs, model)
            .select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted"))


@query
def op3_token_counts(spark, sf_dir):
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op4_repeats(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_toxicity(spark, sf_dir):
    return scored(spark, sf_dir, toxicity.train_toxicity, toxicity.score_toxicity, "toxic", 4, 2, 0.3)


@query
def op6_embeddings(spark, sf_dir):
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train_pii(docs))
    counts = [pii.n_spans("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("base"), 256).alias("base_sha256"),
                        pii.spans_text("spans").alias("spans"))


@query
def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.MinHashParams(words=3, percent=85))


@query
def op9_decontamination(spark, sf_dir):
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_vector_codes(spark, sf_dir):
    coded, books = code_compression.compress(table(spark, sf_dir, "embeddings"))
    numbers = ",".join(str(x) for x in books.ravel())
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, F.lit("0")))), "")
    rows = coded.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label")
    summed = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_aggregate(rows, summed, ["label"]).select(
        "vec_id", "code", "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))


@query
def op12_centroids(spark, sf_dir):
    found = centroids.with_inertia(centroids.cluster(table(spark, sf_dir, "embeddings")))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        digest.alias("centroid_sha256"))


@query
def op13_mixing(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")
