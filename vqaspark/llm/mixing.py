"""Mixing sources to target weights (operator 8).

Every source's words are packed, in id order, into fixed-length blocks.  Each
output shard draws how many slots it gives to every source: shard counts are
multinomial, conditioned on the source's exact total (a slot of the source
picks its shard by a hash of the slot number, uniformly).  The n-th slot of a
source takes block ``permutation(n)`` of the source, a pseudorandom permutation
of its blocks (a Feistel network with cycle walking), newly keyed
for each pass over the source.  Slots meet blocks by an equi-join on (source,
block).  The last slot of a source is cut to the words that are left, so every
source gives exactly its target, rounded.  ``mix_blocks`` writes the mix as
packed blocks by (shard, slot) with the table of the shards' draws;
``mix_documents`` and ``mix_counts`` are views of the same plan.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vqaspark.llm.base import Words, parts, small, text_slices, write_scratch

WEIGHTS = (5.0, 2.0, 1.0)    # of the sources in code point order, repeating
SHARE = 1.5                  # words of the mix over words of the input
MOST = 2.0                   # a source gives at most so many times its words
BLOCK_WORDS = 1024
SHARD_WORDS = 1 << 20        # words of an output shard, about
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc, source, size): number of words; null texts have none."""
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) by water-filling, in closed form.

    A source is capped when its weighted part of what is left exceeds
    ``most * size``; caps bind in the order of size / weight, so running sums
    over that order give the final level.  A row per source: the windows run
    over sources, not documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w)
    by = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("all_w", F.sum("weight").over(whole)).withColumn("budget", F.lit(share) * F.sum("source_size").over(whole))
           .withColumn("capped_w", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("capped", F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))))
    # Level if exactly the sources before this one are capped, and whether this one holds at it.
    per = per.withColumn("level", (F.col("budget") - F.col("capped")) / (F.col("all_w") - F.col("capped_w")))
    free = F.col("level") * F.col("weight") <= F.lit(most) * F.col("source_size")
    per = per.withColumn("final", F.min(F.when(free, F.struct("capped_w", "level"))).over(whole)["level"])
    target = F.least(F.lit(most) * F.col("source_size"), F.coalesce(F.col("final") * F.col("weight"), F.lit(most) * F.col("source_size")))
    return per.select("source", "source_size", target.alias("target"))


def _hash(*cols) -> Column:
    return F.xxhash64(*cols)


def _halves(size: Column) -> tuple[Column, Column]:
    """Sizes of the low and the high half of the network."""
    bits = F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(2)).cast("double"))), F.lit(2)).cast("int")
    return F.pow(F.lit(2.0), F.floor(bits / 2)).cast("long"), F.pow(F.lit(2.0), bits - F.floor(bits / 2)).cast("long")


def _walk(n: Column, size: Column, step) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), step(n), lambda acc, _: F.when(acc >= size, step(acc)).otherwise(acc))


def permuted(n: Column, size: Column, source: Column, turn: Column, seed: int) -> Column:
    """Image of ``n`` under a pseudorandom permutation of 0 .. size - 1.

    A Feistel network over two unequal halves permutes 0 .. 2^b - 1 with the
    smallest 2^b >= size; values outside are sent through it again until they
    fall inside (each try succeeds with probability over 1/2; 64 are made)."""
    low, high = _halves(size)

    def rounds(x):
        left, right = F.floor(x / low).cast("long"), F.pmod(x, low)
        for r in range(2):
            left = F.pmod(left + F.pmod(_hash(right, source, turn, F.lit(seed), F.lit(2 * r)), high), high)
            right = F.pmod(right + F.pmod(_hash(left, source, turn, F.lit(seed), F.lit(2 * r + 1)), low), low)
        return left * low + right

    return _walk(n, size, rounds)


def place_of(block: Column, size: Column, source: Column, turn: Column, seed: int) -> Column:
    """The ``n`` whose ``permuted`` image is ``block``: the network backwards."""
    low, high = _halves(size)

    def back(x):
        left, right = F.floor(x / low).cast("long"), F.pmod(x, low)
        for r in (1, 0):
            right = F.pmod(right - F.pmod(_hash(left, source, turn, F.lit(seed), F.lit(2 * r + 1)), low), low)
            left = F.pmod(left - F.pmod(_hash(right, source, turn, F.lit(seed), F.lit(2 * r)), high), high)
        return left * low + right

    return _walk(block, size, back)


def _in_order(rows: DataFrame) -> DataFrame:
    """Append ``offset``: words of the same source before the document, in id
    order (ties: smaller first).  Rows are sorted over all partitions, so a
    source may lie in many; a (partition, source) total carries the rest."""
    spark = rows.sparkSession
    ranged = write_scratch(
        rows.repartitionByRange(parts(spark, 0, 1), F.col("source").asc_nulls_last(), "doc", "size")
        .withColumn("part", F.spark_partition_id()), "op8-ranged")
    before = Window.partitionBy("part", "source").orderBy("doc", "size").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part", "source").agg(F.sum("size").alias("t"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("part", "source", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("of_part"))
    inside = ranged.withColumn("in_part", F.coalesce(F.sum("size").over(before), F.lit(0)))
    same = (inside["part"] == first["part"]) & inside["source"].eqNullSafe(first["source"])
    return inside.join(first, same).select("doc", inside["source"], "size", (F.col("in_part") + F.col("of_part")).alias("offset"))


def slots(per_source: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 42) -> DataFrame:
    """(source, shard, slot, turn, block, take): the draws of every source.

    ``take`` words of the block are used: all, but for the last slot of the
    source."""
    t = F.least(F.round("target").cast("long"), F.lit(MOST).cast("long") * F.col("source_size"))
    shards = F.greatest(F.ceil(F.sum(t).over(Window.partitionBy()) / F.lit(shard_words)), F.lit(1)).cast("long")
    s = (per_source.where("source_size > 0").withColumn("t", t).withColumn("shards", shards)
         .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")).where("t > 0"))
    key = F.coalesce("source", F.lit("\0null"))
    last_turn = F.floor((F.col("t") - 1) / F.col("source_size")).cast("long")
    s = s.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), last_turn)))
    s = s.withColumn("words", F.least(F.col("t") - F.col("turn") * F.col("source_size"), F.col("source_size")))
    # All blocks are full but the source's last one; before slot n lie n blocks, less what the
    # short one misses if it was drawn before.
    s = s.withColumn("sn", place_of(F.col("blocks") - 1, F.col("blocks"), key, F.col("turn"), seed))
    # Slot numbers in runs, so that a large source is spread over tasks before it is unrolled.
    run = 4096
    s = s.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / F.lit(run)).cast("long"))))
    s = s.repartition(parts(per_source.sparkSession, 0, 1), "source", "turn", "run")
    s = s.withColumn("nth", F.explode(F.sequence(F.col("run") * run, F.least(F.col("blocks"), (F.col("run") + 1) * run) - 1)))
    s = s.withColumn("block", permuted(F.col("nth"), F.col("blocks"), key, F.col("turn"), seed))
    short = F.col("source_size") - (F.col("blocks") - 1) * F.lit(block_words)
    size = F.when(F.col("nth") == F.col("sn"), short).otherwise(F.lit(block_words))
    begun = F.col("nth") * F.lit(block_words) - F.when(F.col("sn") < F.col("nth"), F.lit(block_words) - short).otherwise(F.lit(0))
    take = F.least(size, F.col("words") - begun)
    slot = F.col("turn") * F.col("blocks") + F.col("nth")
    return (s.withColumn("take", take).where("take > 0")
            .select("source", F.pmod(_hash(key, slot, F.lit(seed + 1)), F.col("shards")).alias("shard"),
                    slot.alias("slot"), "turn", "block", "take"))


def shard_counts(drawn: DataFrame) -> DataFrame:
    """(shard, source, slots, words): what every output shard drew of every
    source.  The slots of a source over all shards are its blocks in the mix,
    the words its target."""
    return drawn.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("slots"), F.sum("take").alias("words"))


def plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, seed: int, shard_words: int = SHARD_WORDS):
    """(documents with their words' places, sources, draws, word ranges drawn).
    ``k`` numbers the rows of one id and size by (source, place)."""
    sizes = write_scratch(sized(docs, id_col, text_col, source_col), "op8-sizes")
    per = write_scratch(targets(sizes).coalesce(1), "op8-targets")
    placed = write_scratch(_in_order(sizes), "op8-placed")
    lo = F.floor(F.col("offset") / F.lit(block_words)).cast("long")
    hi = F.floor((F.col("offset") + F.col("size") - 1) / F.lit(block_words)).cast("long")
    nth = F.row_number().over(Window.partitionBy("doc", "size").orderBy(F.col("source").asc_nulls_last(), "offset"))
    pieces = (placed.where("size > 0").withColumn("k", nth).withColumn("block", F.explode(F.sequence(lo, hi)))
              .withColumn("from_block", F.greatest(F.col("offset"), F.col("block") * block_words) - F.col("block") * block_words)
              .withColumn("to_block", F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block_words)
                          - F.col("block") * block_words))
    drawn = slots(per, block_words, shard_words, seed)
    same = pieces["source"].eqNullSafe(drawn["source"]) & (pieces["block"] == drawn["block"])
    got = (pieces.join(drawn, same).withColumn("n", F.least("to_block", "take") - F.col("from_block")).where("n > 0")
           .select("doc", pieces["source"], "size", "k", "offset", "shard", "slot", "turn",
                   (pieces["block"] * block_words + F.col("from_block") - F.col("offset")).alias("word"), "n"))
    return placed, per, drawn, got


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               block_words: int = BLOCK_WORDS, seed: int = 42) -> DataFrame:
    """One row per input row: id, ``size``, ``source_size`` and ``target`` of
    its source, and ``taken``, the words that the mix takes from it.

    Null texts and texts without words have size 0 and give nothing; a null
    source is a source of its own, after all others; an empty table gives an
    empty result.  Rows that repeat an id with the same source and size share
    their words evenly in order; other columns are not read."""
    placed, per, _, got = plan(docs, id_col, text_col, source_col, block_words, seed)
    taken = got.groupBy("doc", "source", "size", "offset").agg(F.sum("n").alias("taken"))
    key = ["doc", "source", "size", "offset"]
    a, b = placed.alias("a"), taken.alias("b")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]
    out = a.join(b, on[0] & on[1] & on[2] & on[3], "left").select(
        *[F.col(f"a.{c}").alias(c) for c in key], F.coalesce("taken", F.lit(0)).alias("taken"))
    out = out.join(small(per).withColumnRenamed("source", "s"), out["source"].eqNullSafe(F.col("s")))  # a row per source
    return out.select(F.col("doc").alias(id_col), F.col("size"), F.col("source_size"), F.col("target"), F.col("taken"))


def _meet(rows: DataFrame, cuts: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows with the cuts of their place among rows of the same id and size."""
    size = F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long")
    named = rows.withColumn("__id", F.col(id_col).cast("long")).withColumn("__n", size).where("__n > 0")
    order = [F.col(source_col).cast("string").asc_nulls_last(), text_col]
    named = named.withColumn("__k", F.row_number().over(Window.partitionBy("__id", "__n").orderBy(*order)))
    c = cuts.select(*[F.col(x).alias(f"__{x}_of") if x in ("doc", "size", "k") else F.col(x) for x in cuts.columns])
    return named.join(c, F.col("__id").eqNullSafe(F.col("__doc_of")) & (F.col("__n") == F.col("__size_of")) & (F.col("__k") == F.col("__k_of")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  size_col: str | None = "n_chars", block_words: int = BLOCK_WORDS, seed: int = 42) -> DataFrame:
    """The mix as rows like the input's: for each document and pass over its
    source, a row with the words taken from it (in text order, separated as in
    the text where they are neighbours, else by a line break).  A document
    taken whole keeps its text untouched; ``size_col``, if there, is set to
    the new number of characters.  Rows of one id and size are told apart
    by the order of their sources and texts: each gives the words of its own place."""
    names = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)])
    at = {c: f"__c{names.index(c)}" for c in (id_col, text_col, source_col)}
    _, _, _, got = plan(renamed, at[id_col], at[text_col], at[source_col], block_words, seed)
    cuts = got.groupBy("doc", "size", "k", "turn").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("cuts"))
    met = _meet(renamed, cuts, at[id_col], at[text_col], at[source_col])
    out = _cut_words(met.select(*renamed.columns, "cuts"), at[text_col])
    if size_col in names:
        c = f"__c{names.index(size_col)}"
        out = out.withColumn(c, F.length(at[text_col]).cast(out.schema[c].dataType))
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)])


def mix_blocks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Write the mix as packed blocks and return (blocks, counts) as stored.

    ``blocks``, under ``path``/blocks, has a row per slot: ``shard``, ``source``,
    ``slot``, ``n_words``, ``docs`` (ids in block order) and ``text`` (their
    words; a line break between documents).  Files are ranges of (shard, place),
    where ``place`` is a hash of the slot, so a reader finds the sources mixed.
    ``counts``, under ``path``/counts, is ``shard_counts``.  Rows of one id
    and size lie in the order of their sources and texts; texts without words
    and an empty table give no block; null ids stay null in ``docs``."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"), F.col(source_col).cast("string").alias("src"))
    _, _, drawn, got = plan(slim, "doc", "t", "src", block_words, seed, shard_words)
    cuts = got.groupBy("doc", "size", "k", "offset").agg(F.collect_list(F.struct("word", "n", "shard", "slot")).alias("cuts"))
    met = _meet(slim, cuts, "doc", "t", "src").select("doc", F.col("src").alias("source"), "offset", "t", "cuts")
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc", "t", "n")))     # at most block_words words
    blocks = (_cut_pieces(met).groupBy("shard", "source", "slot").agg(inside.alias("p"))
              .select("shard", "source", "slot", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_words"),
                      F.col("p.doc").alias("docs"), F.array_join("p.t", "\n").alias("text")))
    place = _hash("source", "slot", F.lit(seed + 2))
    spark = docs.sparkSession
    blocks.withColumn("place", place).repartitionByRange(parts(spark, 0, 1), "shard", "place").sortWithinPartitions(
        "shard", "place", "source", "slot").drop("place").write.parquet(os.path.join(path, "blocks"))
    shard_counts(drawn).write.parquet(os.path.join(path, "counts"))
    return spark.read.parquet(os.path.join(path, "blocks")), spark.read.parquet(os.path.join(path, "counts"))


def _cut_words(rows: DataFrame, text_col: str) -> DataFrame:
    """Rows whose text is cut to the word ranges of their ``cuts``, which go."""
    ti, ci = rows.columns.index(text_col), rows.columns.index("cuts")
    keep = [i for i in range(len(rows.columns)) if i != ci]
    schema = T.StructType([rows.schema.fields[i] for i in keep])

    def cut(batches):
        for b in batches:
            for lo, part in text_slices(b.column(ti)):
                w = Words(part)
                raw = w.buf.tobytes()
                texts = []
                for i, ranges in enumerate(b.column(ci).slice(lo, len(part)).to_pylist()):
                    texts.append(_extract(raw, w, i, ranges))
                cols = [pa.array(texts, pa.string()) if j == ti else b.column(j).slice(lo, len(part)) for j in keep]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.mapInArrow(cut, schema)


def _cut_pieces(rows: DataFrame) -> DataFrame:
    """A row per word range: a text is read once, however many blocks it fills."""
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("source", T.StringType()), T.StructField("slot", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("t", T.StringType()),
                           T.StructField("n", T.LongType())])

    def cut(batches):
        for b in batches:
            for lo, part in text_slices(b.column("t")):
                w = Words(part)
                raw = w.buf.tobytes()
                docs, sources, offsets, cuts = (b.column(c).slice(lo, len(part)).to_pylist() for c in ("doc", "source", "offset", "cuts"))
                found = [(r["shard"], sources[i], r["slot"], offsets[i], docs[i], _extract(raw, w, i, [r], whole=False), r["n"])
                         for i, ranges in enumerate(cuts) for r in ranges]
                yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], t) for j, t in enumerate(
                    (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()))], names=schema.names)

    return rows.mapInArrow(cut, schema)


def _extract(raw: bytes, w: Words, i: int, ranges: list[dict], whole: bool = True) -> str:
    a, z = int(w.first[i]), int(w.first[i + 1])
    spans = []
    for r in ranges:
        lo, hi = a + r["word"], min(a + r["word"] + r["n"], z)
        if spans and spans[-1][1] == lo:
            spans[-1][1] = hi
        elif lo < hi:
            spans.append([lo, hi])
    if whole and spans == [[a, z]]:
        return raw[int(w.offsets[i]):int(w.offsets[i + 1])].decode("utf-8")
    return "\n".join(raw[int(w.starts[lo]):int(w.ends[hi - 1])].decode("utf-8") for lo, hi in spans)
