"""Small tables for the training-data operators."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    rows = []
    for i, t in enumerate(texts):
        rows.append((i if ids is None else ids[i], t, "en", None if sources is None else sources[i],
                     None if t is None else len(t)))
    return spark.createDataFrame(rows, DOC)


def clashing(df):
    """Extra columns whose names the operators also use inside."""
    from pyspark.sql import functions as F
    for c in ("h", "d", "fp", "bucket", "shard", "slot", "copies", "words", "node", "key", "path", "size", "n"):
        df = df.withColumn(c, F.lit("x"))
    return df


ODD = [None, "", " \n\t", "one", "one", "a b c d e f g", "a b c d e f g", "é ß ñ 漢字 " * 5, "long word " * 30_000]
