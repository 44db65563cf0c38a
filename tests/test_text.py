"""Literal cases for the string expressions."""

from vqaspark.functions import text as T
from vqaspark.functions.hashing import hash_bucket, shuffle_key


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_matches_python_strip_lower(spark):
    cases = ["  Hai Con Mèo  ", " NBSP　", "\x1cSEP\x1f", "\tTab\n", "", None, "ÉCOLE"]
    rows = spark.createDataFrame([(c,) for c in cases], "s string").select(
        "s", T.normalize_answer("s").alias("n")).collect()
    for r in rows:
        expect = None if r["s"] is None else r["s"].strip().lower()
        assert r["n"] == expect, (r["s"], r["n"])


def test_preview_cuts_at_100(spark):
    long = "x" * 150
    assert one(spark, T.preview("s"), long) == "x" * 100 + "..."
    assert one(spark, T.preview("s"), "short") == "short"
    assert one(spark, T.preview("s"), "y" * 100) == "y" * 100


def test_clean_text_keeps_diacritics(spark):
    out = one(spark, T.clean_text("s", lowercase=True, remove_special=True), "Tiếng Việt, có dấu!?")
    assert out == "tiếng việt có dấu"


def test_ascii_tokens_cut_at_diacritics(spark):
    assert one(spark, T.ascii_tokens("s"), "hai chú mèo") == ["hai", "ch", "m", "o"]
    assert one(spark, T.unicode_tokens("s"), "Hai chú mèo") == ["hai", "chú", "mèo"]


def test_word_count_and_split(spark):
    assert one(spark, T.word_count("s"), "  a  b　c ") == 3
    assert one(spark, T.split_words("s"), "a\tb\nc") == ["a", "b", "c"]


def test_shuffle_key_and_bucket_are_row_local(spark):
    df = spark.range(0, 200).withColumnRenamed("id", "id")
    a = {r["id"]: (r["k"], r["b"]) for r in df.select("id", shuffle_key("id").alias("k"),
                                                      hash_bucket("id").alias("b")).collect()}
    b = {r["id"]: (r["k"], r["b"]) for r in df.repartition(7).select(
        "id", shuffle_key("id").alias("k"), hash_bucket("id").alias("b")).collect()}
    assert a == b
    import hashlib
    assert a[5][0] == hashlib.md5(b"42:5").hexdigest()
    assert a[5][1] == int(hashlib.md5(b"42:5").hexdigest()[:8], 16) % 100


def test_nfc_nfd_left_as_is(spark):
    import unicodedata

    from vqaspark.operators.metrics.exact import exact_match
    nfc = unicodedata.normalize("NFC", "mèo")
    nfd = unicodedata.normalize("NFD", "mèo")
    assert nfc != nfd
    df = spark.createDataFrame([(nfc, nfd), (nfc, nfc)], "prediction string, reference string")
    # like str.strip().lower(): no Unicode normalisation, so the two forms differ
    assert exact_match(df).first()["exact_match"] == 0.5
