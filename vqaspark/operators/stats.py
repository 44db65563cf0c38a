"""Dataset statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vqaspark.functions.text import word_count


def split_stats(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A1: rows per split plus a ``total`` row (one rollup, one shuffle of
    partial counts)."""
    return (df.rollup(split_col)
              .agg(F.count(F.lit(1)).alias("num_samples"),
                   F.grouping(split_col).alias("_g"))
              .select(F.when(F.col("_g") == 1, F.lit("total"))
                       .otherwise(F.col(split_col)).alias(split_col),
                      "num_samples"))


def split_image_stats(df: DataFrame, split_col: str = "split", image_col: str = "image_id",
                      approx: bool = False) -> DataFrame:
    """Samples and unique images per split (exact or HLL++)."""
    distinct = (F.approx_count_distinct(image_col) if approx
                else F.count_distinct(image_col))
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("num_samples"),
                                     distinct.alias("unique_images"))


def length_profile(df: DataFrame, cols=("question", "answer"), group_by=None) -> DataFrame:
    """min/max/avg and median of character and word lengths."""
    aggs = []
    for c in cols:
        chars = F.char_length(c)
        words = word_count(c)
        aggs += [F.min(chars).cast("bigint").alias(f"{c}_chars_min"),
                 F.max(chars).cast("bigint").alias(f"{c}_chars_max"),
                 F.round(F.avg(chars), 6).alias(f"{c}_chars_avg"),
                 F.min(words).cast("bigint").alias(f"{c}_words_min"),
                 F.max(words).cast("bigint").alias(f"{c}_words_max"),
                 F.round(F.avg(words), 6).alias(f"{c}_words_avg"),
                 F.percentile(words, 0.5).alias(f"{c}_words_median")]
    g = df.groupBy() if group_by is None else df.groupBy(group_by)
    return g.agg(*aggs)


# ---------------------------------------------------------- mergeable sketches

HLL_BITS = 12       # relative standard error about 1.04 / sqrt(2^12) = 1.6 %
KLL_SIZE = 800      # rank error about 0.3 % (99 % of the time)


def split_sketches(df: DataFrame, split_col: str = "split", image_col: str = "image_id", length_cols=("question", "answer"),
                   hll_bits: int = HLL_BITS, kll_size: int = KLL_SIZE) -> DataFrame:
    """A12/A13 as sketches to store with a run: per split, ``num_samples``,
    ``images`` (HyperLogLog of the image ids) and for each text column
    ``<col>_words`` (KLL of its word counts) and ``<col>_words_max``.  A few KB
    a split, however many rows; tables of several runs are merged by
    ``merge_sketches``, and the rows need not be read again."""
    aggs = [F.count(F.lit(1)).alias("num_samples"), F.hll_sketch_agg(image_col, hll_bits).alias("images")]
    for c in length_cols:
        words = word_count(c).cast("bigint")
        aggs += [F.kll_sketch_agg_bigint(words, kll_size).alias(f"{c}_words"), F.max(words).alias(f"{c}_words_max")]
    return df.groupBy(split_col).agg(*aggs)


def merge_sketches(sketches: DataFrame, split_col: str = "split", length_cols=("question", "answer"),
                   quantiles=(0.5, 0.9)) -> DataFrame:
    """Sketch rows of any number of runs to one row per split: exact
    ``num_samples`` and maxima, ``unique_images`` and the word-count quantiles
    ``<col>_words_p50`` ... within the sketches' errors.  Runs may share
    images: they count once.  Splits without texts have null quantiles."""
    aggs = [F.sum("num_samples").alias("num_samples"), F.hll_sketch_estimate(F.hll_union_agg("images")).alias("unique_images")]
    for c in length_cols:
        aggs += [F.kll_merge_agg_bigint(f"{c}_words").alias(f"_{c}"), F.max(f"{c}_words_max").alias(f"{c}_words_max")]
    merged = sketches.groupBy(split_col).agg(*aggs)
    out = [split_col, "num_samples", "unique_images"]
    for c in length_cols:
        known = F.kll_sketch_get_n_bigint(f"_{c}") > 0
        out += [F.when(known, F.kll_sketch_get_quantile_bigint(f"_{c}", F.lit(q))).alias(f"{c}_words_p{round(q * 100)}") for q in quantiles]
        out.append(f"{c}_words_max")
    return merged.select(*out)
