import pytest

from samples import ODD

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(*texts, lang="en", extra=True):
        rows = []
        for k, t in enumerate(texts):
            doc_id, text = t if isinstance(t, tuple) else (k, t)
            rows.append((doc_id, text, lang, "src", None if text is None else len(text)))
        df = spark.createDataFrame(rows, DOCUMENT)
        if extra:
            from pyspark.sql import functions as F
            df = df.withColumns({"digest": F.lit("x"), "kept": F.lit(1), "n_words": F.lit("y"), "sid": F.lit(2.5),
                                 "key": F.lit(None).cast("string"), "entropy": F.lit(7), "gone_id": F.lit(-1)})
        return df

    return make


@pytest.fixture
def odd(documents):
    return documents(*ODD)


@pytest.fixture
def nothing(odd):
    return odd.where("false")
