import zlib

import numpy as np
from pyspark.sql import functions as F

from tilewright.llm import language as L


def test_gradient():
    """Backpropagation through time against differences."""
    rng = np.random.default_rng(0)
    model = L.ByteGRU(["a", "b", "c"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    windows = rng.integers(0, 256, (7, 4))
    windows[5:, 1] = 256  # padding
    label = np.array([0, 1, 2, 1])

    def loss():
        import builtins

        del builtins
        return model.gradients(windows, label)[0]

    _, g = model.gradients(windows, label)
    for name, v in model.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in v.shape)
            if name.startswith("x"):
                at = (int(windows.flat[rng.integers(0, windows.size)]), at[1])
                if at[0] == 256:
                    continue
            old = v[at]
            v[at] = old + 1e-2
            up = loss()
            v[at] = old - 1e-2
            down = loss()
            v[at] = old
            assert abs((up - down) / 2e-2 - g[name][at]) < 2e-4


def test_windows_don_t_depend_on_the_batch():
    model = L.ByteGRU(["a", "b"])
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 255, 256, 257, 1000)]
    together = model.predict(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    for t, p in zip(texts, together, strict=True):
        assert np.allclose(model.predict(t, np.array([0, len(t)]))[0], p, atol=1e-5)
        assert len(t) == 0 or abs(p.sum() - 1) < 1e-4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, empty):
    found = L.identify(odd).collect()
    assert len(found) == odd.count()
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {1, 2, 3, 14}
    assert {r.lang_pred for r in found} <= {"und", "en", "fr", "de"}
    assert L.identify(empty).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}


def test_language_of_copies_is_learned(spark):
    """A language that is one text in many copies is predicted."""
    other = [(i, f"the {i} small birds were singing in the garden before noon {i * 7}", "en") for i in range(3000)]
    docs = spark.createDataFrame(other + [(i, "żółty źrebak chodził przez łąkę i śnił o wiośnie", "pl") for i in range(3000, 6000)], "doc_id long, text string, lang string")
    rows = L.identify(docs, 200).collect()
    assert np.mean([r.lang_pred == ("en" if r.doc_id < 3000 else "pl") for r in rows]) > 0.98
