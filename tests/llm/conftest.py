from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with nulls, empty, one-word and long texts, copies, near copies, shared passages, repeated rows."""
    rnd = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t ", "one", "Two Words", "ünï cödé 漢字 🙂 text", "a" * 5000, "ab " * 700,
                               "x\n" * 80, "word " * 60]
    passage = " ".join(_words(rnd, 60))
    while len(texts) < n:
        w = _words(rnd, rnd.choice([3, 13, 14, 60, 150, 400]))
        kind = rnd.randrange(5)
        if kind == 0 and len(texts) > 12:
            t = rnd.choice(texts[10:])
        elif kind == 1 and len(texts) > 12:
            t = rnd.choice(texts[10:]) or ""
            w = t.split(" ")
            for _ in range(rnd.choice([1, 1, 4])):
                w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind == 2:
            at = rnd.randrange(len(w))
            t = " ".join([*w[:at], passage, *w[at:]])
        else:
            t = " ".join(w)
            t = t.replace(" w1", "\nw1")
        texts.append(t)
    ids = list(range(n))
    rnd.shuffle(ids)
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", "s4", None]), len(t) if t else None)
            for i, t in zip(ids, texts)]
    rows.append(rows[-1])  # a repeated row
    rows.append((rows[-3][0], "another text of a repeated id", "en", "s1", 29))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_root):
    path = f"{tmp_root}/llm-docs.parquet"
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def unique_docs(spark, rows, tmp_root):
    """The same without rows that repeat a doc_id, with two more columns of clashing names."""
    from pyspark.sql import functions as F
    first = {r[0]: r for r in reversed(rows)}
    path = f"{tmp_root}/llm-unique-docs.parquet"
    (spark.createDataFrame(list(first.values()), SCHEMA).withColumn("th", F.lit("x")).withColumn("size", F.lit("y"))
     .withColumn("row", F.lit(1)).repartition(3).write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(spark, unique_docs, tmp_root):
    """A folder of tables as the queries read them."""
    base = f"{tmp_root}/llm-sf"
    unique_docs.select("doc_id", "text", "lang", "source", "n_chars").write.mode("overwrite").parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int") \
        .write.mode("overwrite").parquet(f"{base}/labels.parquet")
    return base
