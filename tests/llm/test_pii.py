import hashlib
import re

import numpy as np

from signals.llm import pii, tagger
from signals.llm.q_pii import op5_pii
from tests.conftest import SF001
from tests.llm import data

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
CASES = [
    "mail a.b+c@x-y.example.com, b@c and @d.e or x@@y.zz",
    "1.2.3.4.5.6.7.8 and 999.1.1.1 or 10.0.0.255. 00000000001.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111x",
    "+1 (555) 555-0100 +49 30 1234567 +1 + 2 +1 (269) 555-3296 4524132264652876",
    "a@b.c@d.e.f a@b..c @@ é@ü.de x@y.z-",
    "12 34-56  78",
    "",
]


def plain(text):
    spans = [(m.start(), m.end(), k) for k, p in PLAIN.items() for m in p.finditer(text) if pii.valid(k, m[0])]
    return sorted(spans, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def test_linear_patterns_equal_the_plain_ones():
    r = np.random.default_rng(3)
    alphabet = list("ab@@..--++0123456789  ()éX\n")
    cases = CASES + ["".join(r.choice(alphabet, int(r.integers(1, 60)))) for _ in range(4000)]
    for t in cases:
        assert pii.base_spans(t) == plain(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "@" * 50_000, "+1" * 50_000, "1.2." * 50_000, "a.b@" * 30_000, "+1" + "(" * 100_000):
        pii.base_spans(t)
        pii.matches(t)


def test_gradient():
    r = np.random.default_rng(0)
    p, ids = tagger.init(4, 5), r.integers(0, tagger.CHARS, (3, 7))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [7, 8, 0, 0, 5, 6, 6]])
    _, g = tagger.loss_and_gradient(p, ids, tags)
    for k in p:
        at = tuple(r.integers(0, s) for s in p[k].shape) if k != "E" else (ids[0, 0], 1)
        old, e = p[k][at], 1e-5
        p[k][at] = old + e
        up = tagger.loss_and_gradient(p, ids, tags)[0]
        p[k][at] = old - e
        down = tagger.loss_and_gradient(p, ids, tags)[0]
        p[k][at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 1e-5


def test_query_and_what_the_tagger_finds_alone(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    extra = [(10**6, "Is the of +1 (269) 555-3296 4524132264652876 and the. " * 2), (10**6 + 1, "Clean text of the year 2021, version 2.0, no 12345.")]
    folder = data.write(spark, tmp_path, docs.union(spark.createDataFrame(extra, docs.schema)))
    rows = {r["doc_id"]: r for r in op5_pii(spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for i, t in texts.items():
        want = plain(t)
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in want).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[2] == k for s in want) for k in PLAIN]
        assert {f"{k}:{a}:{b}" for a, b, k in want} <= set(rows[i]["spans"].split(",")) | {""}
    # the pattern takes phone and card for one long match and drops it; the tagger parts them
    assert {"phone:10:27", "card:28:44"} & set(rows[10**6]["spans"].split(","))
    assert rows[10**6 + 1]["spans"] == ""
    model = pii.fit(docs)
    hits = total = 0
    held = [t for t in texts.values() if pii.base_spans(t)]
    for t, found in zip(held, pii.tagger_spans(held, model)):
        want = set(pii.base_spans(t))
        hits, total = hits + len(want & set(found)), total + len(want)
    assert hits >= 0.9 * total > 0


def test_odd_rows_and_redaction(spark, tmp_path):
    docs = data.odd(spark)
    rows = op5_pii(spark, data.write(spark, tmp_path / "odd", docs)).collect()
    assert len(rows) == len(data.rows())
    assert op5_pii(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0
    assert pii.fit(data.empty(spark)) is None
    small = spark.createDataFrame([(1, "to a@b.com, +1 (555) 555-0100."), (2, None), (3, "none")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(small, None).collect()}
    assert got == {1: "to [EMAIL], [PHONE].", 2: None, 3: "none"}
    assert pii.masked("abcdef", [(0, 3, "ip"), (2, 5, "card")]) == "[IP]f"
