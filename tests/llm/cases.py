"""Rows that every operator over documents must stand: nulls, empty and very long texts, repeats, ties, clashing columns."""

PROSE = "Anblewh sttible athawh thonre was is anly hend and oftionnt. "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, w string, id long, key long, words int, score double, label int, t long, component string"


def rows():
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    texts = [None, "", " \n\t ", "x", PROSE * 3, PROSE * 3, long, "😀 Ünïcödé 漢字 ß", "A" * 50_000, PROSE * 3 + "And more words stand behind it now."]
    some = [(i, t, "en" if i % 2 else None, None, None, 1, "w", 1, 1, 1, 0.5, 1, 1, "c") for i, t in enumerate(texts)]
    return [*some, some[4], (None, PROSE, None, None, None, None, None, None, None, None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
