"""Small tables for the operators' tests."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Documents from ``(id, text)``."""
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC)


def same_rows(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))
