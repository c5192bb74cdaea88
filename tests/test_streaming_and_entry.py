import pytest
from pyspark.sql import functions as F

from clauseloom import session
from clauseloom.operators import responses as rp
from clauseloom.sources import contracts as ct
from clauseloom.sources import results as rs
from clauseloom.sources import snapshots as sn
from clauseloom.streaming import ingest, throughput
from verification import fixture as fx
from verification import evaluation  # noqa: F401 - registers its queries
from verification.registry import QUERIES

from conftest import values


def test_only_new_files_are_ingested(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    calls = []

    def to_results(batch):
        calls.append(1)
        shaped = batch.select(F.col("doc_id").cast("string").alias("contract_id"), "text", "doc_id")
        return rp.result_rows(fx.respond(ct.ready(shaped)), fx.FIELDS)

    def run():
        ingest.ingest_new_files(spark, folder, docs.schema, to_results, table, checkpoint)
        return rs.read_latest(spark, table, fx.FIELDS).count()

    docs.where("doc_id < 100").write.mode("append").parquet(folder)
    first = run()
    assert run() == first and len(calls) == 1
    docs.where("doc_id >= 100").write.mode("append").parquet(folder)
    assert run() == ct.ready(fx.contracts(spark, "/root/testdata/sf0.001")).count() and len(calls) == 2


def test_no_run_replaces_rows_of_another(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rs.append_batch(fx.results(spark, "/root/testdata/sf0.001"), table, "batch", 0)
    stored = rs.read_latest(spark, table, fx.FIELDS).count()

    def to_results(batch):
        shaped = batch.select(F.concat(F.lit("new"), F.col("doc_id")).alias("contract_id"), "text", "doc_id")
        return rp.result_rows(fx.respond(ct.ready(shaped)), fx.FIELDS)

    docs.where("doc_id < 10").write.parquet(folder)
    for run in ("one", "two"):  # the second has lost the checkpoint of the first
        ingest.ingest_new_files(spark, folder, docs.schema, to_results, table, str(tmp_path / run))
        docs.where("doc_id >= 10 and doc_id < 20").write.mode("overwrite").parquet(folder)
    new = ct.ready(fx.contracts(spark, "/root/testdata/sf0.001").where("doc_id < 20")).count()
    assert rs.read_latest(spark, table, fx.FIELDS).count() == stored + new
    with pytest.raises(ValueError, match="run id"):
        rs.append_batch(docs, table, "a/b", 0)


def test_last_write_wins_at_equal_times(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = rp.result_rows(fx.responses(spark, "/root/testdata/sf0.001").limit(1), fx.FIELDS).coalesce(1)
    both = rows.unionByName(rows.withColumn("tokens_used", F.lit(7).cast("long"))).coalesce(1)
    rs.append_batch(both, table, "one", 3)
    assert values(rs.read_latest(spark, table, fx.FIELDS), "tokens_used") == [(7,)]
    rs.append_batch(rows.withColumn("tokens_used", F.lit(8).cast("long")), table, "two", 0)
    assert values(rs.read_latest(spark, table, fx.FIELDS), "tokens_used") == [(8,)]


def test_contract_files_are_streamed(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "x.txt").write_text("a contract " * 20)
    (folder / "y.md").write_text("no contract")

    def to_results(batch):
        answers = batch.select("contract_id", "file_path", F.lit('{"opening_quote": "a", "has_flag": true}').alias("raw_response"),
                               F.length("text").alias("tokens_used"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("created_at"))
        return rp.result_rows(answers, fx.FIELDS)

    ingest.ingest_contract_files(spark, str(folder), to_results, table, str(tmp_path / "c"))
    (folder / "z.txt").write_text("b")
    ingest.ingest_contract_files(spark, str(folder), to_results, table, str(tmp_path / "c"))
    assert sorted(values(rs.read_latest(spark, table, fx.FIELDS), "contract_id", "tokens_used")) == [("x", 220), ("z", 1)]


def test_a_content_sent_again_is_taken_once(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    sn.create(spark, table, 4, fx.FIELDS)

    def to_results(batch):
        answers = batch.select("contract_id", "file_path", F.lit('{"opening_quote": "a"}').alias("raw_response"), F.length("text").alias("tokens_used"),
                               F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("created_at"))
        return rp.result_rows(answers, fx.FIELDS)

    def run():
        ingest.ingest_contract_files(spark, str(folder), to_results, table, str(tmp_path / "c"), once_within="30 days",
                                     store=lambda rows, path, run_id, batch: sn.merge(rows, path, run_id, batch, fx.FIELDS))
        return sorted(values(sn.read(spark, table, fx.FIELDS), "contract_id"))

    (folder / "x.txt").write_text("a contract")
    assert run() == [("x",)]
    (folder / "y.txt").write_text("a contract")  # another run of the stream: the state comes from the checkpoint
    (folder / "z.txt").write_text("another one")
    assert run() == [("x",), ("z",)]


def test_shared_folder_is_required_on_a_cluster():
    class Fake:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(dict)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake)


def test_stream_windows_agree_with_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    throughput.run_to_table(throughput.throughput(stream, F.col("ts")), str(tmp_path / "w"), str(tmp_path / "c"))
    done = dict(values(spark.read.parquet(str(tmp_path / "w")), "window_start", "n"))
    batch = dict(values(throughput.throughput_batch(events, F.col("ts")), "window_start", "n"))
    assert len(batch) - len(done) == 1 and all(batch[w] == n for w, n in done.items())


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


def test_flagship(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["contract_id", "context", "n_chunks"] and df.count() > 0


@pytest.mark.parametrize("name", ["clean_text", "chunk_pack", "retrieve_topk", "context", "extract_clauses", "status_class", "eval_report"])
def test_queries_agree_with_sql(name):
    from verification.compare import main

    assert main("/root/testdata/sf0.001", [name]) == 0


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_is_streamed_as_a_file_or_a_folder(spark, tmp_path, files):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 30")
    if files == 1:
        docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    else:
        docs.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["stream_ingest"](spark, str(tmp_path))
    assert found.count() == ct.ready(fx.contracts(spark, str(tmp_path))).count() > 0
