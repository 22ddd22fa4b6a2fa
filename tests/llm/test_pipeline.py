"""The pipeline's stages against brute force, and its run over the smallest tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.conftest import prose
from tests.llm.test_exact_dedup import body
from tests.llm.test_jaccard_join import brute as near
from tilewright.llm.mixing import mix
from tilewright.llm.quality import classify

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run(spark, tmp_path):
    """Each stage on what the former one kept, by plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = {}
    for name, stage in C.STAGES[:-1]:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
        stages[name] = (before.collect(), docs.collect(), before)
    before, after, df = stages["quality"]
    kept = {r.doc_id for r in classify(df).where("kept").collect()}
    assert {r.doc_id for r in after} == kept and 0.7 * len(before) < len(after) < len(before)
    before, after, _ = stages["exact_copies"]
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(body(r.text), r)
    assert sorted(after) == sorted(first.values())
    before, after, _ = stages["near_copies"]
    alone = {i for i, _, c, _ in near([(r.doc_id, r.text) for r in before]) if i == c}
    assert sorted(after) == sorted(r for r in before if r.doc_id in alone)
    before, after, df = stages["source_mix"]
    copies = {r.doc_id: r.copies for r in mix(df).collect()}
    assert sorted(after) == sorted(r for r in before for _ in range(copies[r.doc_id]))
    pieces = C.run(spark, SF).collect()
    assert sum(p.piece == 0 for p in pieces) == len(after)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    from tokenizers import Tokenizer

    from tilewright.llm.queries import tokenizer_path

    t = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in after}
    for p in random.Random(1).sample(pieces, 20):
        ids = np.array([*t.encode(texts[p.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_odd_rows(spark, odd, empty, name):
    stage = dict(C.STAGES)[name]
    found = stage(spark, odd, SF)
    if name != "packing":
        assert found.schema == odd.schema
    rows = found.collect()
    if name == "exact_copies":
        bodies = [body(r.text) for r in odd.collect()]
        assert len(rows) == len(set(bodies)) == len({body(r.text) for r in rows})
        assert min(r.doc_id for r in rows if r.doc_id is not None) == 0
    if name == "near_copies":
        assert {r.doc_id for r in rows if r.text == prose(2, 120)} == {0}
    assert stage(spark, empty, SF).count() == 0


def test_repeated_ids_with_other_texts_stay(spark):
    rows = [(1, "a b c"), (1, "d e f"), (1, "a  b c"), (2, "d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    assert sorted(r.text.split()[0] for r in C.exact_copies(spark, df, SF).collect()) == ["a", "d"]
