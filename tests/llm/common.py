"""Small tables with everything that may go wrong in them."""

DOCS = "doc_id long, text string, lang string, _row string, _k1 string, gone int, words string"


def documents(spark, texts, ids=None):
    """Documents with further columns whose names an operator might use itself."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, text, None, "r", "k", 1, "w") for i, text in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    """Nulls, empty and very long texts, ties and repeated rows."""
    texts = [None, "", "one", "same line\nother", "same line\nother", "x " * 60_000, "é\n\n\t \nÉ", " \n ", None, "one"]
    return documents(spark, texts, [1, 2, 3, 4, 4, None, 6, 7, None, 8])


def empty(spark):
    return spark.createDataFrame([], DOCS)
