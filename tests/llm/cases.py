"""Rows that every operator has to bear."""

LONG = "long words repeat here. " * 4000
#: Nulls in every column, empty and very long texts, ties and repeated rows, and columns whose names clash with the operators' own.
ROWS = [
    (1, "", "en", "a", 0, "x"),
    (2, None, "en", None, None, None),
    (None, "a text without a number in its key, long enough.", None, "b", 5, "y"),
    (3, LONG, "en", "a", len(LONG), "x"),
    (4, "The same text in two rows of one key here.", "de", "a", 1, "x"),
    (4, "The same text in two rows of one key here.", "de", "a", 1, "x"),
    (5, "The same text in two rows of one key here.", "de", "b", 1, "x"),
    (6, "   \t\n  ", "fr", "c", 7, "z"),
    (7, "word", "fr", "c", 4, "z"),
    (8, "12345 !!! 678", None, "c", 4, "z"),
    (9, "Ünïcode ñandú 日本語 𝔘 emoji 😀 end.", "es", "c", 4, "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"

_P = " ".join(f"passage{i}" for i in range(60))
#: Rows that share a doc_id but not a text, rows without doc_id, and repeated rows, with lines and a passage that several have.
SHARED = [
    (1, "A line of several words stands here.\nand the first text goes on", "en", "a", 1, "x"),
    (2, "Completely other text that must stay untouched here now", "en", "a", 2, "x"),
    (2, "a line of several words stands here.\nthis one is another text", "en", "b", 3, "y"),
    (2, "a line of several words stands here.\nthis one is another text", "en", "b", 3, "y"),
    (3, f"Words before {_P} and words after", None, None, 4, "z"),
    (3, f"Other words {_P} then an end", "de", "c", 5, "z"),
    (None, "A line of several words stands here.\nwithout a number", "en", "a", 6, "x"),
    (None, "A line of several words stands here.\nwithout a number", "en", "a", 6, "x"),
    (None, "Only this row has these words in it, and no number", "fr", "d", 7, None),
    (5, None, None, None, None, None),
    (5, "", "en", "a", 0, "x"),
]


def frame(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
