"""Registered queries cover all rows of their tables."""

import pytest

from tarnbeck.plans import registry


@pytest.mark.parametrize("name", ["x14_merged_chunks", "x11_hybrid"])
def test_no_row_is_left_out(spark, tmp_path, name):
    long = "word " * 2000 + "end."
    docs = spark.createDataFrame([(1, "a short text.", 13), (2, long, len(long)), (3, "one more text.", 14), (30, "the last text.", 14)], "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [float(i == j) for j in range(64)], 0) for i in (1, 2, 3, 30)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(1, "short text"), (30, "last text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = registry.queries()[name](spark, str(tmp_path))
    if name == "x14_merged_chunks":
        rows = found.collect()
        assert {r["id"] for r in rows} == {1, 2, 3, 30}
        assert "".join("".join(r["text"].split()) for r in rows if r["id"] == 2).endswith("end.")
    else:
        assert {r["qid"] for r in found.collect()} == {1, 30}
