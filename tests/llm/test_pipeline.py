"""The pipeline's stages on a table with awkward rows, and the registered queries."""

import corpus_pipeline
from cases import AWKWARD, frame, real_rows
from compare import compare, duck

from stockspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_keeps_the_columns_and_takes_effect(spark):
    rows = real_rows(120)
    copies = [(9000 + r[0], r[1], r[2], r[3], r[4]) for r in rows[:10]] + [(9500, "123 !!", "en", "s", 6), (9501, None, None, None, None)]
    docs = spark.createDataFrame(rows + copies + [(9600, "write to ann.b@c.example.org please and thank you very much", "en", "s", 50)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{_folder(spark)}/{name}")
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        assert docs.columns[:5] == COLUMNS
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "language":
            assert 9500 not in ids and 9501 not in ids
        if name == "near_duplicates":
            assert not ids & {9000 + r[0] for r in rows[:10]}
        if name == "personal_data":
            assert docs.where("text LIKE '%ann.b@%'").count() == 0 and docs.where("text LIKE '%<EMAIL>%'").count() > 0
    assert counts[0] == len(rows) + len(copies) - 1 and counts == sorted(counts, reverse=True)


def _folder(spark):
    from stockspark.session import scratch_path

    return scratch_path(spark, "pipeline-test")


def test_stages_take_awkward_rows(spark):
    docs = frame(spark, AWKWARD, clash=("topic", "row", "node"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := _folder(spark))
        docs = spark.read.parquet(path)


def test_sql(spark):
    for name, sql in SQL.items():
        assert compare(spark, duck(SF), SF, QUERIES[name], sql) == []
