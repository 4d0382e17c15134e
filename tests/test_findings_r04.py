"""What the review of round 4 found."""

import duckdb
from pyspark.sql.readwriter import DataFrameWriter

from tarnlake.llm import scratch
from tarnlake.plans import basics
from tarnlake.plans.registry import ORACLE_SQL
from tarnlake.streaming import ingest


def test_pieces_of_empty_and_null_notes_are_those_of_the_sql(spark, tmp_path):
    texts = [(1, ""), (2, None), (3, "a"), (4, "é" * 1800), (5, "x" * 1801), (6, "y" * 5401)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(ORACLE_SQL["fn_window_gen"]).fetchall())
    assert sorted(map(tuple, basics.fn_window_gen(spark, str(tmp_path)).collect())) == want
    assert (1, 0) in want and not any(n == 2 for n, _ in want)


def test_notes_are_ingested_in_bounded_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "NOTES_PER_BATCH", 40)
    texts = {str(i): f"line {i}\r\nünd\n" * (i % 3 + 1) for i in range(100)}
    for i, t in texts.items():
        (tmp_path / "in" / f"f{int(i) % 4}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"f{int(i) % 4}" / f"{i}.txt").write_bytes(t.encode())
    keys = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(k) for k in keys]
    for batch in ("b1", "b2"):
        ingest.ingest_notes(spark, f"file://{tmp_path}/in/*", f"file://{tmp_path}/out", f"file://{tmp_path}/state", batch)
    rows = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert {r["note_id"]: r["note_text"] for r in rows} == texts and len(rows) == 100 and {r["_batch_id"] for r in rows} == {"b1"}
    assert len([f for f in (tmp_path / "state" / "commits").iterdir() if f.name.isdigit()]) == 3
    assert [spark.conf.get(k) for k in keys] == before


def test_kept_tables_are_made_without_large_broadcasts(spark, monkeypatch):
    seen = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path: seen.append([spark.conf.get(k) for k in (scratch.SMALL, scratch.LISTED)]) or write(w, path))
    before = [spark.conf.get(k) for k in (scratch.SMALL, scratch.LISTED)]
    rows = spark.range(1000)
    assert scratch.keep(rows.join(rows, "id"), "rows").count() == 1000
    with monkeypatch.context() as m:
        m.setattr(scratch, "MOST_SMALL", -1)
        scratch.keep(rows, "rows")
    assert seen == [[str(1 << 20), "0"], ["-1", "0"]] and [spark.conf.get(k) for k in (scratch.SMALL, scratch.LISTED)] == before
