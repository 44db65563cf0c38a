import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                       T.StructField("kept", T.StringType()), T.StructField("d", T.StringType()),
                       T.StructField("ids", T.StringType())])


def prose(seed: int, words: int) -> str:
    """Invented text without repeats, in sentences and lines."""
    import random
    r = random.Random(seed)
    syl = "ba ke li mo nu ra se ti vo za the an er on re in".split()
    out = ["".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(out[i:i + 12]).capitalize() + "." for i in range(0, words, 12))


def edge_rows():
    a = prose(1, 120)
    rows = [(1, a), (2, a), (3, a.replace("ba", "BA", 1)), (4, " ".join(a.split()[:115]) + " other words here now"),
            (5, None), (6, ""), (7, " \n\t "), (8, "One"), (9, "one"), (10, "One two"), (11, prose(2, 30_000)),
            (12, "x" * 70_000), (13, "MIT License. Apache license\nGeneral Public License, mit license"),
            (14, "é İ ſ <|endoftext|> 日本 ́ \x85 \x00 it's 'S"), (15, "Der " * 300), (16, prose(3, 90)),
            (16, prose(4, 90)), (17, prose(5, 90)), (17, prose(5, 90)), (None, prose(6, 80)), (None, None),
            (-18, prose(7, 100)), (2 ** 53 + 1, prose(8, 100)), (19, "%%% *** " * 80 + prose(9, 20))]
    return [(i, t, "en", [None, "a", "b", "c"][n % 4] if n else "a", len(t or ""), "clash", "clash", "clash", "clash")
            for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1] or "") for r in edge_rows()]
