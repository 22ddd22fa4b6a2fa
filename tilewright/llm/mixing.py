"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Each source gets a target number of words. Within a source a document is wanted in proportion
to its weight, by default that of its length (longer documents are wanted more), never more
than max_copies times; the factor at which the wanted words add up to the target follows from
one row for each source and weight. The whole part of what is wanted is certain copies, the rest its
inclusion probability p in one more draw, which so differs from document to document. The
draw ranks a source's documents by the random odds u / (1 - u) divided by the inclusion odds
p / (1 - p) and takes them in that order until the words that the source still lacks are
reached; the last one is taken if that brings the source nearer to its target. u comes from
md5 of the seed and doc_id, so reruns agree.

No source is sorted as a whole: the ranks fall into cells, the cells' sums (one row per
source and cell) show the one cell in which a source's draw ends, and only that cell's
documents are ordered.

Edge cases: null text has size 0; a null source is a source, the last; a null doc_id is drawn
as the text 'null'; rows with the same source and doc_id tie and are taken or left together;
documents of size 0 take 0 words; an empty table or one without words gives targets of 0;
a weight that is null or not positive is never drawn beyond what caps force; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.common import SPACE, keep

#: Cells into which a source's ranks are dealt.
CELLS = 4096
#: Rows (one for each source and weight) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 16
#: Words from which a document weighs 2, 3 and 4.
LENGTHS = (64, 256, 1024)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def uniform(seed: int) -> Column:
    """A number in (0, 1) from the seed and doc_id, the same in any engine that has md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, cycle: int = 3, max_copies: int = 3) -> DataFrame:
    """source, source_size, target: weights 1..cycle by the order of the sources share all words.

    A target above max_copies times its source's size stops there and its excess is shared
    again by weight. That is the level at which the sum of min(cap, level * weight) is the
    total; with the sources in the order of cap / weight, one pass finds it. One row for each
    source enters the ordering.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumn("cap", max_copies * F.col("source_size")).select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(upto), F.lit(0)).alias("capped"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("open_weight"),
    )
    # the sources from the first one on whose cap is not below its share have the common level
    free = F.col("cap").cast("double") * F.col("open_weight") >= (F.col("total") - F.col("capped")).cast("double") * F.col("weight")
    level = F.min(F.when(F.col("free"), F.struct(F.col("capped"), F.col("open_weight")))).over(every)
    found = sources.withColumn("free", free).withColumn("level", level)
    share = (F.col("total") - F.col("level.capped")).cast("double") * F.col("weight") / F.col("level.open_weight")
    under = F.col("level").isNotNull() & (F.col("capped") >= F.col("level.capped")) & F.col("free")
    return found.select("source", "source_size", F.when(under, share).otherwise(F.col("cap").cast("double")).alias("target"))


def length_weight(size: Column) -> Column:
    """1 for short documents, up to 4 for long ones."""
    out = F.when(size < LENGTHS[0], 1.0)
    for n, least in enumerate(LENGTHS[1:], 2):
        out = out.when(size < least, float(n))
    return out.otherwise(float(len(LENGTHS) + 1))


def wanted_copies(sizes: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """plan_source, plan_weight, source_size, target, wanted: copies wanted of each document of a source and weight.

    wanted is max_copies for the greatest weights and a common factor times the weight for the
    others, so that the wanted words of a source add up to its target. One row for each source
    and weight enters the ordering.
    """
    classes = sizes.groupBy(F.col("source").alias("plan_source"), F.col("appeal").alias("plan_weight")).agg(F.sum("size").cast("double").alias("words"))
    joined = classes.join(targets, classes["plan_source"].eqNullSafe(targets["source"])).drop("source")
    own = Window.partitionBy("plan_source")
    falling = own.orderBy(F.desc("plan_weight"))
    upto = falling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = falling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    joined = joined.withColumns(
        {"capped": max_copies * F.coalesce(F.sum("words").over(upto), F.lit(0.0)), "weighed": F.sum(F.col("words") * F.col("plan_weight")).over(onwards)}
    )
    # the weights from the first one on that the common factor leaves below the bound have that factor
    free = (F.col("target") - F.col("capped")) * F.col("plan_weight") <= max_copies * F.col("weighed")
    level = F.max(F.when(free, F.struct("plan_weight", "capped", "weighed"))).over(own)
    found = joined.withColumn("level", level)
    shared = F.when(F.col("level.weighed") > 0, (F.col("target") - F.col("level.capped")) * F.col("plan_weight") / F.col("level.weighed")).otherwise(0.0)
    under = F.coalesce(F.col("plan_weight") <= F.col("level.plan_weight"), F.lit(False))
    wanted = F.when(F.col("source_size") > 0, F.when(under, shared).otherwise(F.lit(float(max_copies)))).otherwise(0.0)
    return found.select("plan_source", "plan_weight", "source_size", "target", F.least(F.lit(float(max_copies)), wanted).alias("wanted"))


def mix(docs: DataFrame, seed: int = 20, max_copies: int = 3, weight: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for each row of docs(doc_id, source, text).

    weight names a column of positive numbers, few of them distinct, in proportion to which the
    documents of a source are wanted; without it length_weight() counts.
    """
    size = word_count(F.col("text"))
    appeal = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else length_weight(size)
    sizes = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), appeal.alias("appeal"), uniform(seed).alias("u")), "sizes")
    plan = keep(wanted_copies(sizes, source_targets(sizes, max_copies=max_copies), max_copies), "plan")
    few = plan.count() <= BROADCAST_ROWS
    checked = F.broadcast if few else (lambda df: df)
    rows = sizes.join(checked(plan), sizes["source"].eqNullSafe(plan["plan_source"]) & (sizes["appeal"] == plan["plan_weight"])).drop("plan_source", "plan_weight")
    rows = rows.withColumn("certain", F.floor("wanted"))
    p = F.col("wanted") - F.col("certain")
    odds = F.when(p > 0, F.col("u") / (1 - F.col("u")) * (1 - p) / p)
    rows = rows.withColumn("odds", odds).withColumn("cell", F.floor(F.col("odds") / (1 + F.col("odds")) * CELLS).cast("int"))

    own = Window.partitionBy("source")
    cells = rows.groupBy("source", "cell").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("certain")).alias("certain_words"), F.max("target").alias("target")
    )
    upto = own.orderBy(F.col("cell").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("lacking", F.col("target") - F.sum("certain_words").over(own))
    drawn = F.when(F.col("cell").isNull(), 0).otherwise(F.col("words"))
    cells = cells.withColumn("before", F.coalesce(F.sum(drawn).over(upto), F.lit(0)))
    # the draw ends in the last cell that begins below what is lacking
    ends = cells.where("cell is not null and before < lacking").groupBy("source").agg(F.max(F.struct("cell", "before", "lacking")).alias("end"))
    ends = ends.withColumnRenamed("source", "end_source")
    # a row for each source at most
    rows = rows.join(checked(ends), rows["source"].eqNullSafe(ends["end_source"]), "left").drop("end_source")
    kept = ["doc_id", "source", "size", "source_size", "target", "certain"]
    surely = F.coalesce(F.col("cell") < F.col("end.cell"), F.lit(False)).cast("long").alias("more")
    at_end = F.coalesce(F.col("cell") == F.col("end.cell"), F.lit(False))
    outside = rows.where(~at_end).select(*kept, surely)
    so_far = own.orderBy(F.struct("odds", "doc_id")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("source", "odds", "doc_id")
    inside = rows.where(at_end).withColumn("words_to", F.col("end.before") + F.sum("size").over(so_far))
    inside = inside.withColumn("tied", F.sum("size").over(same))
    # a document is taken if its words bring the source nearer to what it lacks
    near = (F.col("words_to") - F.col("tied") / 2.0) <= F.col("end.lacking")
    inside = inside.select(*kept, near.cast("long").alias("more"))
    out = outside.unionByName(inside).withColumn("copies", F.col("certain") + F.col("more"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB's form of mix() with its defaults, over a whole ordering of each source.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('20:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
ordered AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum(3 * source_size) OVER w, 0) AS BIGINT) AS capped,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS BIGINT) AS open_weight
  FROM sources WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) * open_weight >= CAST(total - capped AS DOUBLE) * weight AS free FROM ordered),
level AS (SELECT capped AS lc, open_weight AS lw FROM marked WHERE free ORDER BY capped, open_weight LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN lc IS NOT NULL AND capped >= lc AND free THEN CAST(total - lc AS DOUBLE) * weight / lw ELSE CAST(3 * source_size AS DOUBLE) END AS target
  FROM marked LEFT JOIN level ON true),
weighed AS (SELECT *, CASE WHEN size < 64 THEN 1.0::DOUBLE WHEN size < 256 THEN 2.0::DOUBLE WHEN size < 1024 THEN 3.0::DOUBLE ELSE 4.0::DOUBLE END AS appeal FROM sizes),
classes AS (SELECT source, appeal, CAST(sum(size) AS DOUBLE) AS words FROM weighed GROUP BY source, appeal),
falling AS (
  SELECT c.source, c.appeal, t.source_size, t.target,
    3 * coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS capped,
    sum(words * appeal) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source WINDOW w AS (PARTITION BY c.source ORDER BY appeal DESC)),
levels AS (SELECT source, max(appeal) AS top, arg_max(capped, appeal) AS lc, arg_max(heavy, appeal) AS lh FROM falling WHERE (target - capped) * appeal <= 3 * heavy GROUP BY source),
plan AS (
  SELECT f.source, f.appeal, f.source_size, f.target, CASE WHEN f.source_size <= 0 THEN 0.0::DOUBLE WHEN f.appeal <= l.top
    THEN least(3.0::DOUBLE, CASE WHEN l.lh > 0 THEN (f.target - l.lc) * f.appeal / l.lh ELSE 0.0::DOUBLE END) ELSE 3.0::DOUBLE END AS wanted
  FROM falling f LEFT JOIN levels l ON f.source IS NOT DISTINCT FROM l.source),
wanted AS (
  SELECT s.*, source_size, target, wanted FROM weighed s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source AND s.appeal = p.appeal),
odds AS (
  SELECT *, CAST(floor(wanted) AS BIGINT) AS certain, wanted - floor(wanted) AS p,
    CASE WHEN wanted - floor(wanted) > 0 THEN u / (1 - u) * (1 - (wanted - floor(wanted))) / (wanted - floor(wanted)) END AS odds
  FROM wanted),
run AS (
  SELECT *, target - sum(size * certain) OVER (PARTITION BY source) AS lacking,
    sum(CASE WHEN odds IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY odds NULLS FIRST, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words_to,
    sum(size) OVER (PARTITION BY source, odds, doc_id) AS tied
  FROM odds)
SELECT doc_id, size, source_size, target,
  CAST(size * (certain + CASE WHEN odds IS NOT NULL AND lacking > 0 AND words_to - tied / 2.0::DOUBLE <= lacking THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
