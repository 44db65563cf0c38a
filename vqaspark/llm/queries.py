"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vqaspark.llm import align, hard_negatives, huffman, licenses, lm_score, mixing, near_dup, neighbours, resync, tokens, url_filters
from vqaspark.llm import quality_classifier as qc
from vqaspark.llm import quality_rules as qr
from vqaspark.llm.registry import register
from vqaspark.sources.tables import read_table


@register("op2_bpe_tree")
def op2(spark, sf_dir):
    return tokens.digests(read_table(spark, sf_dir, "documents"))


@register("op4_huffman_ids")
def op4(spark, sf_dir):
    path = huffman.store_documents(read_table(spark, sf_dir, "documents"))
    return huffman.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op5_quality_classifier")
def op5(spark, sf_dir):
    return qc.quality_classifier(read_table(spark, sf_dir, "documents"))


@register("op7_quality_rules")
def op7(spark, sf_dir):
    return qr.quality_rules(read_table(spark, sf_dir, "documents"))


@register("op8_mix_sources")
def op8(spark, sf_dir):
    return mixing.mix_counts(read_table(spark, sf_dir, "documents"))


@register("op10_minhash_bayes")
def op10(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), k=2)


@register("op9_license_scan")
def op9(spark, sf_dir):
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


@register("op6_url_filters", url_filters.ORACLE)
def op6(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return url_filters.filter_urls(url_filters.captures_of(pages), url_filters.derived_list(pages))


@register("op3_nn_descent")
def op3(spark, sf_dir):
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@register("op1_lm_context_mixing")
def op1(spark, sf_dir):
    return lm_score.lm_scores(read_table(spark, sf_dir, "documents"))


@register("op12_overlap_resync")
def op12(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return resync.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@register("op13_lemp_negatives")
def op13(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.hard_negatives(rows, lambda i: i % 100 == 0)


@register("op11_token_alignment")
def op11(spark, sf_dir):
    return align.align_documents(read_table(spark, sf_dir, "documents"), keep_groups=False, keep=["doc_id"])
