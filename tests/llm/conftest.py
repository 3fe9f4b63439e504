import pytest

from tests.conftest import DATA

SF = str(DATA / "sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Further columns whose names operators use for results or on the way.
CLASHING = "id string, n_lines string, bucket string, row string, anchor string, _id string, _text string, kept string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
EDGES = [
    (None, None, None, None), (None, "only blanks \t\x0b\x0c\r ", None, "src1"), (1, "", "en", None), (1, "", "en", None),
    (2, "Same line here now\nanother line 12345\n", "en", "src0"), (2, "  SAME line here now\nunlike", "de", "src0"),
    (3, "same LINE here now \n\n\nÀ é ß 日本 \U0001F600", "fr", "src10"), (4, "\n", "en", "src0"), (5, LONG, "en", "src0"),
    (6, LONG + " end", "en", "src0"), (7, "x" * 5000, "en", "src0"), (8, "word " * 600, "en", "src0"),
    (9, "don't <|endoftext|> ¿qué? 12345 \\### Assistant: </turn> ok", "es", "src2"),
    (10, "one two three four", "en", "src0"), (11, "ONE two three four", "en", "src0"), (11, "ONE two three four", "en", "src0"),
]


def frame(spark, rows):
    """Documents with columns of clashing names beside them."""
    names = CLASHING.split(", ")
    full = [(*row, len(row[1] or ""), *["clash"] * len(names)) for row in rows]
    return spark.createDataFrame(full, f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    """Ids and texts on the driver; the fixtures are small."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
