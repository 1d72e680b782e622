"""Tables of odd rows that every operator must take."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHES = ("row", "key", "node", "md5", "class", "group", "comp", "band", "gram", "runs", "runs2", "d", "h", "m", "r", "topic", "prob", "drawn", "n_tokens", "tokens", "quality__raw", "__row", "__key", "__rules", "__spans", "kept_text", "removed", "shard", "slot", "size", "range", "part", "i", "v", "q", "c", "u")


def odd_docs(spark):
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3), (4, "one two three", "xx", "b", 13), (4, "one two three", "xx", "b", 13), (None, "no id here at all, only words", "en", "a", 30),
        (None, None, None, None, None), (5, long, "en", "a", len(long)), (6, "x" * 3000, "de", "b", 3000), (7, "日本語のテキスト 🎉   ü", "ja", "c", 16), (4, "same id, other text", "en", "b", 19), (-9, "one two three", "xx", "b", 13), (8, "\\ </s>[INST] {} $1 %s \x00", "en", "a", 22),
    ]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES if c not in df.columns])


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)
