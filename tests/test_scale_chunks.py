import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import gondola.session as session
from gondola.llm import language_model
from gondola.llm.language_model import Settings, scored, trained

ROWS = [(i, f"the cat sat on w{i % 9} and v{i % 7} by w{i * 3} " * (1 + i % 3)) for i in range(60)] + [(None, ""), (99, None)]


def figures(df):
    return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in df.collect())


def test_a_task_of_many_chunks_holds_a_few(spark, monkeypatch):
    """the rows of a table of chunks are megabytes each; one task wrote, and read, all of its chunks as one group of rows."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)
    made, cut = [], language_model.lineage_cut

    def kept(df):
        made.append((df.columns, cut(df), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        if "lens" in df.columns:
            files = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in made[-1][1].inputFiles()]
            groups.extend(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups))
        return made[-1][1]

    groups = []
    monkeypatch.setattr(language_model, "lineage_cut", kept)
    many = figures(scored(docs, settings=Settings(chunk_tokens=40)))
    assert sum(groups) > 15 and max(groups) <= session.FEW_ROWS
    # the table that chunks are read for to ask for words hands Python a few at a time, too
    assert [int(n) for columns, _, n in made if "keys" in columns] == [session.FEW_ROWS]
    assert spark.conf.get("parquet.block.row.count.limit", None) is None
    assert many == figures(scored(docs, settings=Settings()))


def test_hashed_words_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    """each sweep over the pairs holds a part of the words hashed, which was as large as words / shuffle partitions."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    few = {r["word"]: r["parent"] for r in trained(docs, Settings(hot_words=5))[1].words.collect()}
    monkeypatch.setattr(session, "TASK_ROWS", 4)
    found, cut = [], language_model.lineage_cut

    def watched(df):
        if "ts" in df.columns:
            found.append(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return cut(df)

    monkeypatch.setattr(language_model, "lineage_cut", watched)
    _, tables = trained(docs, Settings(hot_words=5))
    assert found == [-(-len(few) // 4)] * 4
    assert {r["word"]: r["parent"] for r in tables.words.collect()} == pytest.approx(few)
    assert tables.words.agg(F.sum("n")).first()[0] == sum(len(language_model.tokens(t or "")) for _, t in ROWS)
