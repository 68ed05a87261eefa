"""Rows that every corpus operator must take."""

LONG = "lorem ipsum dolor sit amet " * 12_000
PROSE = " ".join(f"word{i % 97}x{i % 89} and the other{i}" for i in range(60))

EDGE_ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE),            # copies, and a repeated row
    (3, None), (4, ""), (5, " \t\n"), (6, "one"),  # null, empty, blank, tiny
    (7, LONG), (None, PROSE + " tail"), (None, None),
    (8, PROSE.replace("word5x5", "changed")), (9, "é ß 日本 😀 \u0000 \u0085 end"),
]


def edge_docs(spark, clash=()):
    """Documents with the edge rows and extra columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE_ROWS, "doc_id bigint, text string")
    for name in clash:
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df.repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
