"""A tokenizer as a stage: ids and character offsets of texts (M6).

A tokenizer is a factory; ``factory()`` is called once per Python worker and
returns a callable that maps a list of texts to a list of ``(ids, starts,
ends)``, offsets in characters.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FileTokenizer:
    """A tokenizer file (``.json``) of the public tokenizers library."""

    def __init__(self, path: str):
        self.path = path
        self.cache_key = f"file-tokenizer:{path}"

    def __call__(self):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(self.path)
        tok.no_truncation()
        tok.no_padding()

        def encode(texts):
            out = []
            for e in tok.encode_batch(texts, add_special_tokens=False):
                at = e.offsets
                out.append((e.ids, [a for a, _ in at], [b for _, b in at]))
            return out
        return encode

    def __repr__(self):
        return self.cache_key


def tokenize(df: DataFrame, text_col: str, tokenizer_factory: Callable, out: str = "tokens", prefix_col: str | None = None,
             texts_at_once: int = 256) -> DataFrame:
    """Add ``out``: struct of ``ids``, ``starts``, ``ends`` and ``n_prefix``,
    the tokens that begin before character ``prefix_col`` (0 without one).
    Null texts have no tokens.  Other columns, of any type, pass as they are."""
    from vqaspark.operators.predict import _factory_key, _load
    key = _factory_key(tokenizer_factory)
    kept = [c for c in df.columns if c != out]
    field = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.IntegerType())),
                          T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("n_prefix", T.IntegerType())])
    prefix = F.coalesce(F.col(f"`{prefix_col}`").cast("int"), F.lit(0)) if prefix_col else F.lit(0)
    # The caller's columns travel as one struct: no name can clash.
    slim = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"), prefix.alias("prefix"))
    schema = T.StructType([slim.schema["row"], T.StructField("tok", field)])
    tok_type = pa.struct([("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("n_prefix", pa.int32())])

    def run(batches):
        encode = _load(tokenizer_factory, key)
        for b in batches:
            for lo in range(0, b.num_rows, texts_at_once):
                part = b.slice(lo, texts_at_once)
                found = encode([t or "" for t in part.column(1).to_pylist()])
                rows = [{"ids": list(ids), "starts": list(starts), "ends": list(ends), "n_prefix": sum(s < p for s in starts)}
                        for (ids, starts, ends), p in zip(found, part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, tok_type)], names=["row", "tok"])

    done = slim.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], F.col("tok").alias(out))
