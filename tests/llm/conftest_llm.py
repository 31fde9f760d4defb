DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside themselves.
CLASH = "doc_id bigint, text string, block string, spans string, bucket string, words string, rank string, at string, set_id string, weights string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)


def clashing(spark, rows):
    """The same rows with further columns, all null."""
    return spark.createDataFrame([(i, t, *[None] * 8) for i, t in rows], CLASH)


#: Nulls, empty and blank texts, repeated rows, one very long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three four five six seven"), (4, "one two three four five six seven"), (None, "a b"), (9, "lo ng " * 30_000)]
