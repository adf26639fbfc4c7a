"""Small tables with the awkward cases every operator must take: nulls, empty and long texts, repeats, clashing extra columns."""

from __future__ import annotations

import random

WORDS = "alder birch cedar dogwood elm fir gum hazel ivy juniper kauri larch maple nutmeg oak pine quince rowan spruce teak".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n))


def rows() -> list[tuple]:
    long = prose(1, 6000)
    texts = [prose(k, 20 + 7 * k) for k in range(20)]
    texts += [texts[3], texts[3], texts[4].replace("oak", "Oak"), texts[19] + " end", None, "", " \n\t ", "one", "\u00e9t\u00e9 \u4f60\u597d na\u00efve", long, long + " x",
              "same same same same same same same same same same same same", "a b c d e f g h i j\na b c d e f g h i j"]
    out = [(k, t, "en", f"src{k % 3}", len(t) if t else 0) for k, t in enumerate(texts)]
    return [*out, out[2], (None, texts[5], None, None, None), (None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), DOCS)


def clashing(spark):
    """The same with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    extra = ["n_words", "spans", "items", "raw", "row", "id", "body", "fp", "bucket", "host", "kept", "ids", "length", "task", "new_text", "stays", "digest", "a", "b"]
    return documents(spark).withColumns({c: F.lit("x") for c in extra})


def empty(spark):
    return spark.createDataFrame([], DOCS)


def benchmark(spark):
    long, short = rows()[29][1].split(), rows()[10][1].split()
    return spark.createDataFrame([(1, " ".join(long[50:75])), (2, " ".join(short[5:17]).upper()), (3, "one"), (4, None), (5, ""), (6, "never found anywhere"), (6, "one")],
                                 "item_id long, text string")
