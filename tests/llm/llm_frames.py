"""Small frames with the awkward cases: nulls, empty and long texts, ties, clashing column names."""

LONG = "lorem ipsum dolor sit amet " * 3000
PLAIN = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall tree "


def documents(spark, texts, extra=True):
    """Documents 0, 1, .. with these texts; further columns clash with names used inside."""
    rows = [(i, text, "en", "s", 0, "x", 1) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, n int"
    )
    return frame if extra else frame.drop("size", "n")


AWKWARD = [None, "", " \n\t ", "one", "one two", LONG, LONG, PLAIN, PLAIN, "ÄÖ ß 中文 😀 \x00 end"]
