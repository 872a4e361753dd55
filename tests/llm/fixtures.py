"""Small tables with the awkward cases every operator must take."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("n", T.StringType()), T.StructField("key", T.IntegerType()), T.StructField("kind", T.StringType())])

_rng = random.Random(11)
VOCABULARY = ["".join(_rng.choice("abcdefghij") for _ in range(_rng.randint(2, 7))) for _ in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def rows(seed=3):
    """Copies, near copies, shared passages, white space of all kinds, empty, null, long and repeated rows."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    words = base.split()
    near = list(words)
    near[50] = "changed"
    upper = base.upper().replace(" ", "\t", 3)
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, upper), (5, base + " " + prose(rng, 15)),
        (6, None), (7, ""), (8, " \t\n\x0b\f\r "), (9, "one two"), (10, "one two"), (11, "ONE  two"), (12, "two one"),
        (13, prose(rng, 40) + " " + passage + " " + prose(rng, 30)), (14, passage + "\n" + prose(rng, 70)),
        (15, prose(rng, 25) + "\n" + passage), (16, prose(rng, 49)), (17, prose(rng, 5000)),
        (18, "line again here\nline again here\nline again here\nother words stay"),
        (19, "a b c d e a b c d e f"), (20, "x " * 300), (21, "x " * 310), (22, "né ñandú 中文 🙂 \x1c\x85 a b c"),
        (None, base), (None, prose(rng, 80)), (1, base), (23, "$$ ## ** %% && || <> !! ??"), (24, "w" * 20000),
        (-5, " ".join(words[:100])),
    ]
    return [(i, t, "en", None if k % 7 == 0 else f"s{k % 3}", len(t) if t else None, "n", k, "kind")
            for k, (i, t) in enumerate(texts)]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCUMENTS).repartition(5)


def tokens(text):
    return [w.decode() for w in (text or "").encode().split()]


def shingles(text, k=5):
    w = [x.decode() for x in bytes((text or ""), "utf-8").translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
