"""The pipeline against what brute force says of its rows."""

import random

import corpus_pipeline
import pytest

from kinweave.llm.common import fresh_path


@pytest.fixture
def tables(spark):
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    leak, copy = say(40), say(100)
    rows = [(1, say(80)), (2, "too short"), (3, copy), (4, copy), (5, copy + " end"), (6, f"{say(50)} {leak}. yes"), (7, say(60) + " write to ann@example.org"), (8, None)]
    path = fresh_path(spark, "tables")
    spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, f"{leak}. Yes.")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, tables):
    docs, kept = spark.read.parquet(f"{tables}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    assert kept == [{1, 3, 4, 5, 6, 7}, {1, 3, 6, 7}, {1, 3, 7}, {1, 3, 7}]
    assert "ann@" not in docs.where("doc_id = 7").first().text
    out = corpus_pipeline.run(spark, tables).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in out} == {1, 3, 7} and all(r.n_bytes == len(texts[r.doc_id].encode()) and r.n_tokens == len(r.ids) for r in out)


def test_near_copies_of_five_word_shingles(spark):
    """A copy with two words changed: 0.81 in five-word shingles, 0.88 in three-word ones."""
    words = [f"w{k}" for k in range(100)]
    near = [f"edit{k}" if k in (30, 70) else w for k, w in enumerate(words)]
    far = [f"edit{k}" if k in (20, 40, 60) else w for k, w in enumerate(words)]  # 0.73
    d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, d, "").collect()} == {1, 3}
