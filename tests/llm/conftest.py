import pytest

SMALL = "/root/testdata/sf0.001"
WIDE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of the smallest documents table as dictionaries."""
    return [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.fixture
def as_table(spark, tmp_path):
    """Write ``(doc_id, text)`` pairs, or longer tuples, as a documents table and give its folder."""

    def write(rows, schema=WIDE):
        names = [x.split()[0] for x in schema.split(", ")]
        full = [tuple(r) + (None,) * (len(names) - len(r)) for r in rows]
        spark.createDataFrame(full, schema).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


#: Texts which every operator must take: null, empty, blank, no spaces, long, odd characters, copies.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a"),
    (5, "x" * 30000),
    (6, "word " * 3000),
    (7, "Café naïve café   straße ÀÉ   wide \U0001f600\U0001f600 it's WE'LL 'S 12345 --- <|endoftext|> a<|endoftext|>b"),
    (8, "same text here for both of them"),
    (9, "same text here for both of them"),
    (10, "é \n  x  y\r\n\r\n z \x1c\x85 q　 \n"),
    (11, "don't  can't   I'm    they'd've\n\n\n  indented\n\ttab"),
    (12, "▁ literal ▁▁ marks <0x0A> <s> </s> ▁x"),
    (None, "a row without an id"),
    (8, "same text here for both of them"),
]
