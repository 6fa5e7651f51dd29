import pandas as pd
import pytest
from pyspark.sql import functions as F

from signals.llm.q_sharding import op1_sharding
from signals.llm.sharding import shard
from tests.conftest import SF0001
from tests.llm import data


def even(p: pd.DataFrame, n_shards: int = 8) -> None:
    sizes = p.groupby("shard").size().reindex(range(n_shards), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for _, g in p.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


def test_query_is_even_and_keeps_groups_together(spark):
    p = op1_sharding(spark, SF0001).toPandas()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").toPandas()
    even(p)
    m = p.merge(docs, on="doc_id")
    assert len(m) == len(docs)
    assert (m["size"] == m["text"].map(lambda t: len(t.encode()) + 1)).all()
    assert m.groupby("text")["shard"].nunique().max() == 1  # no group here is larger than a quota


def test_odd_rows_and_empty_table(spark, tmp_path):
    p = op1_sharding(spark, data.write(spark, tmp_path / "odd", data.odd(spark))).toPandas()
    even(p)
    assert len(p) == len(data.rows())
    none = p[p["size"] == 1]
    assert (none["text_crc32"] == 0).all() and len(none) == 3
    assert op1_sharding(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0


def test_hot_group_is_drawn_together(spark):
    """A text with a third of all rows is drawn together as far as quotas go; small groups are whole but for a few."""
    docs = spark.range(2400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 800, F.lit(-1)).when(F.col("id") < 1600, F.floor(F.col("id") / 4)).otherwise(F.col("id")).alias("hub"),
    )
    p = shard(docs, ["hub"], n_shards=8, rounds=8).toPandas()
    even(p)
    groups = p[p["doc_id"] < 1600].groupby("hub")["shard"].nunique()
    assert groups[-1] <= 5  # three hold it at least; quotas are given out greedily
    assert (groups.drop(-1) > 1).sum() <= 8


@pytest.mark.parametrize("n_shards", [1, 3])
def test_other_shard_counts(spark, n_shards):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("hub"))
    even(shard(docs, ["hub"], n_shards=n_shards).toPandas(), n_shards)


def test_copies_stay_together_without_unlinked_rows(spark):
    """Every text has copies: only groups at the end of a shard may be cut."""
    for copies in (2, 10):
        docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.floor(F.col("id") / copies).alias("hub"))
        p = shard(docs, ["hub"]).toPandas()
        even(p)
        assert (p.groupby("hub")["shard"].nunique() > 1).sum() <= 16


def test_near_groups_gather_without_unlinked_rows(spark):
    """Groups of ten texts, each twice, linked by one hub: nothing is unlinked, and nearly all groups end in one shard."""
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.floor(F.col("id") / 2).alias("text"), F.floor(F.col("id") / 20).alias("line"))
    p = shard(docs, ["text", "line"]).toPandas()
    even(p)
    assert (p.groupby("text")["shard"].nunique() > 1).sum() <= 16
    assert (p.groupby("line")["shard"].nunique() > 1).mean() <= 0.08


def test_any_shared_line_links(spark, tmp_path):
    """Groups of five share one line, short or long, that is not the least of their lines; or are one line with an edit."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = []
    for i in range(800):
        g, own = i // 5, [f"own line {i} number {j} with forty characters and more" for j in range(6)]
        text = " ".join([f"The text {g} is here.", f"It goes on {g}.", f"Edit {i}."]) if g % 4 == 0 else "\n".join([*own, f"shared {g}" + " and long enough to pass any length test" * (g % 2)])
        rows.append((i, text))
    folder = data.write(spark, tmp_path / "lines", spark.createDataFrame(rows, "doc_id long, text string").select(
        *[F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    ))
    p = op1_sharding(spark, folder).toPandas()
    even(p)
    assert (p.groupby(p["doc_id"] // 5)["shard"].nunique() > 1).mean() <= 0.15


def test_columns_called_as_inner_ones(spark):
    names = ("key", "part", "label", "start", "small", "last", "hubs", "l_label")
    docs = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("key2"), *[F.concat(F.lit(n), "id").alias(n) for n in names])
    rows = shard(docs, ["key2"], n_shards=3).collect()
    assert len(rows) == 40 and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
    by_key = shard(docs.drop("key2"), ["key"], n_shards=3)
    assert by_key.columns == [*docs.drop("key2").columns, "shard", "slot"] and by_key.count() == 40
    assert len(shard(data.odd(spark), ["text"], n_shards=3).collect()) == len(data.rows())


def test_cuts_fewer_links_than_a_random_deal_and_none_where_none_is_needed(spark):
    """Sixty groups of ten in two shards: whole groups fit, so a deal without a cut exists; a random one cuts half of all links."""
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.col("id").alias("text"), (F.col("id") % 60).alias("line"))
    p = shard(docs, ["text", "line"], n_shards=2).toPandas()
    even(p, 2)

    def cut(shards):
        return sum(a != b for _, g in shards.groupby(p["line"]) for i, a in enumerate(g) for b in list(g)[i + 1 :])

    links = 60 * 45
    random_cut = cut(p["shard"].sample(frac=1, random_state=1).set_axis(p.index))
    assert 0.4 * links < random_cut and cut(p["shard"]) <= 0.05 * links
