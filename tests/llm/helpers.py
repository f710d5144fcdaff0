"""Small tables with every awkward case, and answers worked out plainly."""

import random
import zlib

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names the operators use themselves.
CLASHES = ("score", "size", "first", "same", "kept", "block", "label", "key", "seq", "kind", "taken", "n_words", "_m", "_s", "rule")


_SPELT = str.maketrans("0123456789", "abcdefghij")


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return ["w" + str(rng.randrange(vocabulary)).translate(_SPELT) for _ in range(n)]


def awkward_rows():
    """Null and empty texts, white space only, one word, ties, repeated rows, a very long text, null columns."""
    base = " ".join(words(120, 1))
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "a", len(base)),
        (2, base.upper(), "en", "a", len(base)),
        (3, " ".join(near), "en", "b", 10),
        (4, None, "en", "b", None),
        (5, "", None, "c", 0),
        (6, " \t\n ", "fr", None, 4),
        (7, "one", "fr", None, 3),
        (8, "12 34 !!", "fr", "c", 8),
        (9, "one", "de", "a", 3),
        (9, "one", "de", "a", 3),
        (10, " ".join(words(30_000, 2, 9_000)), "de", "a", None),
        (None, "no id at all", None, None, None),
        (None, "no id at all", None, None, None),
        (11, " ".join(words(40, 3)) + "\n" + " ".join(words(40, 3)), "en", "b", 1),
        (12, "Ünï cödé text   \U0001f600 end", "xx", "é", 9),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SHAPE)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SHAPE)


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
