"""Small corpora with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, label string, _word long"
WORDS = "the of and river stone quiet amber lantern meadow harbour winter copper violet Éclair straße niño".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", ".", ","]))
        out.append(rng.choice([" ", " ", " ", "\n", "  ", "\t"]))
    return "".join(out)


def rows():
    texts = [prose(i, 5 + 7 * i % 90) for i in range(40)]
    texts += [None, "", "", " \n\t ", "one", "One", "ONE", "a b", "É é", "é É", "x" * 5000, prose(77, 9000)]
    texts += [texts[3]] * 4 + [texts[5].upper()] * 2 + ["<|endoftext|> end", "a\x00b", "tab\tand  two   spaces \n\n lines\r\n"]
    out = [(i, t, "en", "s", 0, 0.5, "k", "l", 7) for i, t in enumerate(texts)]
    out += [out[3], out[3], (3, "another text of id three", None, None, None, None, None, None, None)]
    out += [(None, "no id", None, None, None, None, None, None, None)] * 2 + [(None, None, None, None, None, None, None, None, None)]
    return out


def documents(spark, parts: int = 3):
    return spark.createDataFrame(rows(), DOC).repartition(parts)


def no_documents(spark):
    return spark.createDataFrame([], DOC)


def text_of(row) -> str:
    return row[1] or ""
