"""Rows every operator has to stand: nulls, empty and long texts, repeats, columns of their own."""

LONG = "The river of the old town and the sea. " * 4000

ROWS = [
    (1, "One text with a few words, and more of them."),
    (1, "One text with a few words, and more of them."),
    (2, None),
    (3, ""),
    (None, "A text without a number of its own."),
    (None, None),
    (4, " \t\n "),
    (5, LONG),
    (6, "123 456 !!! ***"),
    (7, "日本語のテキスト és ñ 😀"),
]

#: names that operators use inside, or give to results
CLASHING = "_winner _winner_hash _hash _later score ids length part rank fp hash root key component_id fingerprint row attempt held_out lang_pred".split()


def documents(spark, rows=ROWS):
    """Documents with columns of clashing names, all null."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.selectExpr("*", "cast(null as string) as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")
    return frame.selectExpr("*", *[f"cast(null as string) as {c}" for c in CLASHING])


def empty(spark):
    return documents(spark).where("false")
