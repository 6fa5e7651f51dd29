"""Odd rows that every operator has to stand: nulls, empty, blank, very long, repeated, and columns named like results."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, shard string, ids string, kept string, target string, spans string, fingerprint string, n_shingles string, th string, rank string, part string, label string"
WORDS = "the of and to in a is that it for on with as was be at by this had not are but from or have an they which one you were all her she there".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 9)) * (r.random() < 0.05) for _ in range(n))


def rows():
    texts = [None, "", "  \t\n ", "word", "two words", "ẞ é 日本 😀 x", prose(1, 300), prose(1, 300), prose(2, 80), prose(3, 30000), "x" * 60000, "a\nb\n" * 400]
    out = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, "null id " + prose(4, 60), "en", "s1", 1), (None, None, None, None, None)]
    return [r + ("x",) * 13 for r in out]


def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(spark, tmp_path, docs) -> str:
    """A folder that a registered query can read ``documents`` from."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)
