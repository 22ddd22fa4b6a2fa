"""The registered queries of the llm operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm.common import documents
from tilewright.llm.exact_dedup import exact_dedup
from tilewright.llm.jaccard_join import jaccard_join
from tilewright.llm.language import identify
from tilewright.llm.mixing import MIX_SQL, mix
from tilewright.llm.packing import pack
from tilewright.llm.quality import classify
from tilewright.llm.sharding import shard
from tilewright.llm.simhash import simhash
from tilewright.llm.suffix_dedup import suffix_dedup
from tilewright.llm.toxicity import grade


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The file of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("n_bytes", "fingerprint")


OP2_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
r AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM r
"""


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


OP3_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM t),
sets AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n, md5(array_to_string(list_sort(g), chr(10))) AS sig FROM s),
x AS (SELECT doc_id, unnest(g) AS sh FROM s),
shared_with AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b, p.sig AS a_sig, q.sig AS b_sig FROM shared_with JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(id, root) AS (SELECT doc_id, doc_id FROM sets UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
partners AS (SELECT a, count(DISTINCT b_sig) FILTER (WHERE b_sig <> a_sig) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, s.n AS n_shingles, min(r.root) AS component_id, coalesce(any_value(p.n_links), 0) AS n_links
FROM sets s JOIN reach r ON r.id = s.doc_id LEFT JOIN partners p ON p.a = s.doc_id GROUP BY s.doc_id, s.n
"""


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_exact_dedup, op3_jaccard_join, op4_source_mix, op5_best_fit_pack, op6_simhash, op7_quality, op8_shard, op9_language_id, op10_suffix_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op3_jaccard_join": OP3_SQL, "op4_source_mix": MIX_SQL}
