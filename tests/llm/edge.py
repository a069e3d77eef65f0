"""Inputs that every operator must take: nulls, empty and very long texts, repeated rows, no rows,
and columns whose names the operators use themselves."""

SF = "/root/testdata/sf0.001"
LONG = ("lorem word, " * 30_000).strip()
DOCS = [(1, "Plain words of a text, that is short."), (2, None), (3, ""), (4, LONG), (5, "Plain words of a text, that is short."),
        (5, "Plain words of a text, that is short."), (None, "a text without an id"), (None, None), (6, " \n\t "), (7, "é\0x 日本")]
DDL = ("doc_id long, text string, lang string, n_words long, kept boolean, set_id long, score double, "
       "ids array<int>, own string, node int, length long, rank int, n_chars long")


def edge_docs(spark, rows=DOCS):
    return spark.createDataFrame(
        [(i, t, "en", 7, False, 1, 0.5, [1], "x", 2, 3, 4, None if t is None else len(t)) for i, t in rows], DDL)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def by_id(df):
    """Rows as tuples without their order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
