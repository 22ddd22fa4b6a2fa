import duckdb
import pytest
from pyspark.sql import functions as F

from tilewright.llm import mixing as M

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def same_as_sql(df):
    docs = df.select("doc_id", "text", "source").toArrow()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", docs)
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({M.MIX_SQL})").fetchall()
    assert sorted(map(repr, map(tuple, M.mix(df).select(*COLUMNS).collect()))) == sorted(map(repr, expected))


def test_odd_rows(odd):
    same_as_sql(odd)


def test_caps_and_hot_source(spark):
    """A source with few words is capped at three times them; one source has most rows."""
    rows = [(i, "w " * (1 + i % 50), "b") for i in range(900)] + [(1000 + i, "w w w", "a") for i in range(5)] + [(2000 + i, "w " * 40, "c") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    same_as_sql(df)
    by = {r.source: r for r in M.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("n"), F.max(F.try_divide("taken", "size")).alias("most")).collect()}
    assert by["a"].target == 3 * by["a"].n == by["a"].taken
    for r in by.values():
        assert r.most <= 3
        assert abs(r.taken - r.target) <= 25
    assert sum(r.target for r in by.values()) == pytest.approx(sum(r.n for r in by.values()))


def test_reruns_agree(odd):
    one, two = (sorted(map(repr, M.mix(odd).collect())) for _ in range(2))
    assert one == two


def test_weights(spark):
    rows = [(i, "w " * 10, "a", 1.0 + i % 2 * 3) for i in range(2000)] + [(5000, "w " * 20000, "b", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, appeal double")
    by = {r.appeal: r.c for r in M.mix(df, weight="appeal").join(df.select("doc_id", "appeal"), "doc_id").where("source = 'a'").groupBy("appeal").agg(F.avg("copies").alias("c")).collect()}
    assert by[4.0] > 3 * by[1.0] > 0


def test_empty_and_wordless(empty, spark):
    assert M.mix(empty).count() == 0
    rows = M.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_long_documents_are_wanted_more(spark):
    """The registered defaults: inclusion probabilities differ within a source, and the SQL agrees."""
    rows = [(i, "w " * (20, 100, 400, 1500)[i % 4], "ab"[i % 3 == 0]) for i in range(1200)] + [(5000 + i, "w " * 30, "c") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    same_as_sql(df)
    by = {(r.source, r.size): r.c for r in M.mix(df).groupBy("source", "size").agg(F.avg("copies").alias("c")).collect()}
    assert by["a", 20] < by["a", 100] < by["a", 400] < by["a", 1500] < 3


def test_inclusion_frequencies(spark):
    """Over many seeds a document is drawn as often as it is wanted."""
    rows = [(i, "w " * 10, "a", float(1 + i % 3)) for i in range(60)] + [(100 + i, "w " * 10, "b", 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, appeal double").repartition(1).cache()
    sizes = df.select("doc_id", "source", F.lit(10).cast("long").alias("size"), "appeal")
    wanted = {(r.plan_source, r.plan_weight): r.wanted for r in M.wanted_copies(sizes, M.source_targets(sizes), 3).collect()}
    # a has a third of 1200 words as its target: 400 of 600
    assert [round(wanted["a", w] * 3, 6) for w in (1.0, 2.0, 3.0)] == [1.0, 2.0, 3.0] and round(wanted["b", 1.0], 6) == round(800 / 600, 6)
    seeds, drawn = 20, {}
    for seed in range(seeds):
        for r in M.mix(df, seed, weight="appeal").where("source = 'a'").select("doc_id", "copies").collect():
            drawn[1 + r.doc_id % 3] = drawn.get(1 + r.doc_id % 3, 0) + r.copies
    for w in (1, 2, 3):
        assert abs(drawn[w] / 20 / seeds - w / 3) < 0.1
