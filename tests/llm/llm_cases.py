"""Small document tables with the awkward cases, and plain-Python helpers."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, shard string, h int, rank string, id string"
BLANK = "[\x20\x09-\x0d]"


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(s):
    return re.findall("[^\x20\x09-\x0d]+", s or "")


def rows(seed=0, n=40):
    """(doc_id, text, lang, source, and columns whose names clash with the operators' own)."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    passages = [" ".join(rng.choice(vocab) for _ in range(25)) for _ in range(4)]
    out = []
    for i in range(n):
        body = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.6:
            body.insert(rng.randint(0, len(body)), rng.choice(passages))
        if rng.random() < 0.7:
            body.append(rng.choice(["  Read MORE\t", "read more", "READ more  "]))
        out.append((i, "\n".join(body)))
    out += [(100, None), (101, ""), (102, " \n\t"), (103, out[3][1]), (104, out[3][1]), (104, out[3][1]), (105, "É ÀB É"),
            (None, out[5][1]), (None, "alone without an id " * 6), (None, None), (106, "x" * 3000), (107, "ab\n" * 400), (108, "!?")]
    return [(d, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), "clash", 1, "r", "i") for d, t in out]


def frame(spark, data, partitions=3):
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def key(row):
    return tuple((v is None, str(v)) for v in row)
