"""Small inputs with the cases every operator has to bear."""

from __future__ import annotations

LONG = "wort und satz. " * 20_000
ODD_TEXTS = [
    (1, "The cat is on the mat and it was in the house of the man."),
    (2, "The cat is on the mat and it was in the house of the man."),
    (2, "The cat is on the mat and it was in the house of the man."),
    (3, None),
    (4, ""),
    (None, "Une phrase sans numéro, mais avec des mots."),
    (None, None),
    (5, LONG),
    (6, "\0 \t\r\n  é ß 漢字 🙂 <|endoftext|>"),
    (7, "12345 !!! ..."),
]


def odd_documents(spark, parts=3):
    """Documents (in their order, if in one part) with nulls, empty, equal, long and strange texts, and columns whose names clash
    with results."""
    rows = [(i, t, "x", 1, "y", 0.5) for i, t in ODD_TEXTS]
    schema = "doc_id bigint, text string, lang string, size int, Shard string, score double"
    return spark.createDataFrame(rows, schema).repartition(parts) if parts > 1 else spark.createDataFrame(rows, schema).coalesce(1)


def no_documents(spark):
    return odd_documents(spark).where("false")
