import hashlib

from signals.llm.hashing import Powers, word_hashes
from signals.llm.q_simhash import op3_simhash
from signals.llm.simhash import block_masks, fingerprint, within_radius
from tests.conftest import SF001
from tests.llm import data


def check(rows, docs):
    """``docs``: (doc_id, text) in descending id; equal neighbours of equal ids may come in any order."""
    by_id = {r["doc_id"]: r for r in rows}
    for (i, a), (j, b) in zip(docs, docs[1:] + docs[:1]):
        m = len(a) // 3
        edited = a[: len(a) - m] + b[:m]
        r = by_id[i]
        assert r["n_chars"] == len(a)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, e, n = (int(x, 16) for x in (r["fingerprint"], r["edited_fingerprint"], by_id[j]["fingerprint"]))
        assert abs(r["near_edited"] - (1 - (own ^ e).bit_count() / 64)) < 1e-12
        assert abs(r["near_next"] - (1 - (own ^ n).bit_count() / 64)) < 1e-12


def test_query_against_brute_force(spark):
    rows = op3_simhash(spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    check(rows, [(d["doc_id"], d["text"] or "") for d in sorted(docs, key=lambda d: -d["doc_id"])])
    text_of = {d["doc_id"]: d["text"] for d in docs}
    prints = {}
    for r in rows:
        assert prints.setdefault(text_of[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    numbers = [int(r["fingerprint"], 16) for r in rows]
    for r in rows:
        want = sum((int(r["fingerprint"], 16) ^ x).bit_count() <= 3 for x in numbers)
        assert r["n_near"] == (want if r["doc_id"] % 50 == 0 else None)


def test_odd_rows_and_empty_table(spark, tmp_path):
    rows = op3_simhash(spark, data.write(spark, tmp_path / "odd", data.odd(spark))).collect()
    assert len(rows) == len(data.rows())
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"0" * 16}
    assert op3_simhash(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0
    one = spark.createDataFrame([(7, "only one document")], "doc_id long, text string")
    check(op3_simhash(spark, data.write(spark, tmp_path / "one", one)).collect(), [(7, "only one document")])


def test_search_finds_all_within_the_radius(spark):
    base = fingerprint(data.prose(1, 200), Powers())
    masks = block_masks(3, 6)
    assert len(masks) == 20
    near = [base ^ sum(1 << b for b in bits) for bits in ((), (0,), (5, 40), (1, 30, 62), (1, 2, 3, 4))]
    prints = spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in near + near[1:2]], "fingerprint long")
    found = {r["fingerprint"]: r["n"] for r in within_radius(prints.limit(1), prints, 3, 6).collect()}
    assert sorted(found.values()) == [1, 1, 1, 2]


def test_word_hashes():
    powers = Powers()
    a = word_hashes("The cat\n sat, THE\x0bcat".encode(), powers)
    assert len(a) == 5 and a[0] == a[3] and a[1] == a[4] and len(set(a.tolist())) == 3
    assert len(word_hashes(b"", powers)) == len(word_hashes(b" \t\r\n", powers)) == 0
