"""Documents with nulls, empty and very long texts, ties, repeats and clashing columns."""

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
GOOD = "The quick brown fox jumps over the lazy dog near the river bank today."
ROWS = [
    (1, GOOD, "en", "a", 70),
    (1, GOOD, "en", "a", 70),  # a repeated row
    (2, GOOD, "en", "b", 70),  # a tie in all but the id
    (3, None, "de", "a", None),
    (4, "", None, None, 0),
    (5, " \t\n ", "fr", "c", 4),
    (None, "no id but a text with some words", "en", "a", 31),
    (6, LONG, "en", "c", len(LONG)),
    (7, "Grüße aus Köln 日本語 😀 </s> <|endoftext|> ▁ \x00 end", "de", None, 40),
    (8, "one", None, "d", 3),
]
CLASHES = (
    "n_tokens size taken fp component_id kept lang_pred score row_no spans token_ids clean copy_no source_size "
    "target held_out n_words quality least root text_ base word"
).split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows=ROWS, clashes=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        for name in CLASHES:
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df
