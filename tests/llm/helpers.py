"""Inputs shared by the tests of the text and vector operators."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, first=0):
    """Documents with ids from ``first`` and the given texts (None allowed)."""
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The frame with extra columns named like working columns of the operators."""
    for c in ("row", "uid", "length", "score", "fp", "id", "n", "label", "key", "lm", "value"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


def texts_of(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


ODD_TEXTS = [None, "", " ", "\n\n  x", "a", "1", "<|endoftext|>", "a <|endoftext|>b  c",
             "É ÿß×÷ 中文 नमस्ते ́ \x00\x1f\x85  z", "it's  we'll 're'd", "..!?  ...",
             "word " * 3000, "x" * 5000, "\t\r\n", "ΑΣ ς 1²½ 🙂🙂"]
