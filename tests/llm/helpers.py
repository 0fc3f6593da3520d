"""Small tables for the training-data operators: the awkward rows every operator must take."""

from pyspark.sql import types as T

LONG = "long words without any end " * 40_000  # over a million characters

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 10),   # repeated row
    (3, None, "en", "b", 0),
    (4, "", None, None, 0),
    (5, " \t\n", "de", "b", 3),
    (None, "Ein Satz ohne Nummer steht hier ganz allein", "de", "b", 4),
    (None, None, None, None, None),
    (6, LONG, "en", "c", len(LONG)),
    (7, "12345 !!! ***", "fr", "c", 5),
    (8, "one", "en", "", 1),
    (9, "naïve Œuvre ÀÉÎ 漢字 🙂 \x00 end", "fr", "b", 9),
]
BASE = ("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
CLASHING = ["id", "fp", "component", "text_key", "size", "row", "copies", "slot", "shard", "bin", "cell", "hit",
            "kept_id", "table_slot", "item_id", "score", "length", "terms", "Hash", "n"]


def awkward(spark):
    """The awkward rows, with extra columns named like those the operators use inside."""
    schema = T.StructType([*T._parse_datatype_string(BASE).fields,
                           *[T.StructField(c, T.StringType()) for c in CLASHING]])
    return spark.createDataFrame([(*r, *[f"{c}!" for c in CLASHING]) for r in DOCS], schema)


def empty(spark):
    return spark.createDataFrame([], BASE)


def frame(spark, rows, schema="doc_id BIGINT, text STRING"):
    return spark.createDataFrame(rows, schema)
