import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from signals.llm import sentencepieces
from signals.llm.q_sentencepieces import MODEL, op6_sentencepiece
from tests.conftest import SF0001
from tests.llm import data

PATH = public_tokenizers.path(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    v = sentencepieces.read_vocabulary(PATH)
    return sentencepieces.Encoder(v), sentencepieces.Decoder(v)


def same(library, coder, text):
    ids = np.frombuffer(coder[0].encode(text), np.int32)
    assert ids.tolist() == library.encode(text), text[:100]
    assert coder[1].decode(ids) == library.decode(ids.tolist())


def test_random_texts(library, coder):
    r = random.Random(1)
    alphabet = "ab  e\n\t▁thin日é́😀\x00\r\xa0,.ﬁ12{}()=<s>/"
    for _ in range(5000):
        same(library, coder, "".join(r.choice(alphabet) for _ in range(r.randint(0, 30))))
    for n in range(1, 140):
        for end in ("", "a", "日", "\n", "the"):
            same(library, coder, " " * n + end)
            same(library, coder, "x" + " " * n + end + " y")
    for t in ("a" * 50000, "ab1" * 20000, "   " * 3000 + "x", "😀" * 5000):
        same(library, coder, t)


def test_decoding_of_any_ids(library, coder):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(131, 259)]) for _ in range(r.randint(0, 12))]
        assert coder[1].decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_query_equals_library(spark, library, tmp_path):
    for folder in (SF0001, data.write(spark, tmp_path, data.odd(spark))):
        docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
        want = []
        for d in docs:
            ids = library.encode(d["text"] or "")
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            want.append((str(d["doc_id"]), len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
        got = [(str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op6_sentencepiece(spark, folder).collect()]
        assert sorted(got) == sorted(want)


def test_empty_table_and_clashing_columns(spark):
    assert sentencepieces.decode(sentencepieces.encode(data.empty(spark), PATH), PATH).count() == 0
    coded = sentencepieces.encode(data.odd(spark), PATH)
    assert coded.schema["ids"].dataType.simpleString() == "array<int>"
    nulls = spark.createDataFrame([(1, None)], "id long, ids array<int>")
    assert sentencepieces.decode(nulls, PATH).first()["decoded"] == ""
