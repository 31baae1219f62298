import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuscle.operators.upsert import merged_view, upsert
from corpuscle.plans import answer
from corpuscle.plans.index import (
    TooManyFailures, build_index, chunk_records, export_chunks, export_csv_index, index_counters, index_rows, postings,
    record_shape_of_json,
)
from corpuscle.plans.ingest import docs_from_text, ingest
from corpuscle.session import discard_staged, stage
from corpuscle.sources.files import binary_files
from corpuscle.sources.records import sharded_index
from corpuscle.streaming.ingest import file_stream, ingest_stream
from corpuscle.workload import tables


def docs(spark, rows):
    return docs_from_text(spark.createDataFrame(rows, "uri string, text string"))


def test_docs_table_columns(spark):
    row = docs(spark, [("d/a.txt", "one\x00 \ntwo")]).first()
    assert (row.uri, row.text, row.language, row.title) == ("d/a.txt", "one two", "en", "one two")
    assert row.docId == hashlib.sha256(b"d/a.txt").hexdigest()
    assert row.contentHash == hashlib.sha256(b"one two").hexdigest()
    raw = spark.createDataFrame([("d/a.txt", "one\ntwo")], "uri string, text string")
    assert docs_from_text(raw, title_from_raw=True).first().title == "one"


def test_upsert_inserts_only_unknown_versions(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = docs(spark, [("a", "one"), ("b", "two")])
    second = docs(spark, [("a", "one"), ("b", "two changed"), ("c", "three"), ("c", "three ")])
    upsert(first, path)
    assert merged_view(spark.read.parquet(path), second).count() == 5
    for _ in range(2):
        upsert(second, path)
    rows = spark.read.parquet(path).orderBy("uri", "text").collect()
    assert [(r.uri, r.text) for r in rows] == [("a", "one"), ("b", "two"), ("b", "two changed"), ("c", "three"), ("c", "three")]


def test_upsert_null_keys_never_match(spark, tmp_path):
    path = str(tmp_path / "docs")
    row = spark.sql("select 'u' uri, cast(null as string) docId, 'h' contentHash")
    upsert(row, path)
    upsert(row, path)
    upsert(row, path)
    assert spark.read.parquet(path).count() == 3


def test_ingest_of_files_twice_and_as_a_stream(spark, tmp_path):
    raw = tmp_path / "raw" / "sub"
    raw.mkdir(parents=True)
    (raw / "a.txt").write_text("alpha\nbeta")
    (raw / "b.txt").write_bytes(b"caf\xe9")
    table, streamed = str(tmp_path / "docs"), str(tmp_path / "streamed")
    assert ingest(spark, str(tmp_path / "raw"), table) == 2
    assert ingest(spark, str(tmp_path / "raw"), table) == 2
    checkpoint = str(tmp_path / "checkpoint")
    ingest_stream(file_stream(spark, str(tmp_path / "raw")), streamed, checkpoint).awaitTermination()
    assert spark.read.parquet(streamed).exceptAll(spark.read.parquet(table)).count() == 0
    (raw / "c.txt").write_text("new")
    ingest_stream(file_stream(spark, str(tmp_path / "raw")), streamed, checkpoint).awaitTermination()
    assert spark.read.parquet(streamed).count() == 3


def test_index_holds_every_version_and_counts_failures(spark, tmp_path):
    table, path = str(tmp_path / "docs"), str(tmp_path / "index")
    upsert(docs(spark, [("a", "x " * 900), ("b", "short")]), table)
    upsert(docs(spark, [("b", "short again")]), table)
    build_index(spark, table, path, 3)
    index = sharded_index(spark, path)
    assert index.count() == 5
    assert index.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0

    def half_broken():
        def embed(texts):
            if any("short" in t for t in texts):
                raise RuntimeError("no")
            return [[1.0] for _ in texts]

        return embed

    counted = index_counters(index_rows(spark.read.parquet(table), 3, half_broken, batch=1).persist()).first()
    assert tuple(counted) == (5, 3, 3)


def test_chunk_records_filters_and_ids(spark):
    good, odd = "word " * 60, "→ " * 100
    files = spark.createDataFrame([("g.txt", good), ("s.txt", "short"), ("o.txt", odd), ("e.txt", " \n ")], "name string, text string")
    rows = chunk_records(files).collect()
    clean = good.strip()
    assert [(r.id, r.source, r.text) for r in rows] == [
        ("g.txt#" + hashlib.sha256(clean.encode()).hexdigest()[:12], "g.txt", clean)
    ]
    packed = spark.createDataFrame([("p.txt", "a" * 100 + "\n\n" + "b" * 100)], "name string, text string")
    assert [r.text for r in chunk_records(packed, by_paragraph=True).collect()] == ["a" * 100 + " " + "b" * 100]


def test_postings_and_record_shape(spark):
    chunks = spark.createDataFrame([("d", 0, "Été été b"), ("d", 1, "b")], "doc_id string, chunk_id long, text string")
    rows = postings(chunks).orderBy("token", "chunk_id").collect()
    assert [tuple(r) for r in rows] == [("b", "d", 0, 1), ("b", "d", 1, 1), ("été", "d", 0, 2)]
    lines = spark.createDataFrame(
        [('{"doc_id":"foo.pdf","chunk_id":0,"text":"Hello world.","vec":[0.1,0.2,0.3]}',),
         ('{"doc_id":"foo.pdf","chunk_id":1,"text":"bad\\u0001","vec":[]}',), ('{"doc_id":"x"}',)],
        "value string",
    )
    assert tuple(record_shape_of_json(lines).first()) == (3, 1, 2, 1)


def test_every_incoming_row_is_worked_out_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return text

    rows = spark.createDataFrame([(str(i), f"h{i}", "text") for i in range(20)], "docId string, contentHash string, text string")
    counting = F.udf(count, "string").asNondeterministic()
    upsert(rows.where("CAST(docId AS INT) < 12"), path)
    for _ in range(2):
        upsert(rows.withColumn("text", counting("text")), path)
    assert seen.value == 40 and spark.read.parquet(path).count() == 20


def failing_model():
    def failing():
        def embed(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [[1.0, float(len(t))] for t in texts]

        return embed

    return failing


def test_jobs_count_and_refuse_too_many_failures(spark, tmp_path):
    failing = failing_model()
    docs = spark.createDataFrame([(f"d{i}", f"u{i}", ("bad " if i % 4 == 0 else "good ") * 40) for i in range(20)], "docId string, uri string, text string")
    table, path = str(tmp_path / "docs"), str(tmp_path / "index")
    docs.write.parquet(table)
    with pytest.raises(TooManyFailures):
        build_index(spark, table, path, 2, failing, retries=0)
    with pytest.raises(FileNotFoundError):
        sharded_index(spark, path)
    assert build_index(spark, table, path, 2, failing, max_failed=0.25, retries=0, metric="cosine") == {"prepared": 20, "embedded": 15, "failed": 5}
    with pytest.raises(TooManyFailures):
        build_index(spark, table, path, 2, failing, retries=0)
    assert sharded_index(spark, path).count() == 15

    asked = spark.createDataFrame([(1, "good " * 30), (2, "good")], "question_id long, question string")
    exact = answer.retrieve(asked, sharded_index(spark, path), k=4, make_embedder=failing, metric="cosine")
    near = answer.retrieve_from(asked, path, k=4, make_embedder=failing)
    assert near.columns == exact.columns and sorted(near.collect()) == sorted(exact.collect())
    assert answer.retrieve_from(asked, path, k=4, make_embedder=failing, probes=1).count() > 0

    named = docs.selectExpr("uri AS name", "text", "uri AS doc")
    for export in (export_chunks, export_csv_index):
        with pytest.raises(TooManyFailures):
            export(named, str(tmp_path / f"x-{export.__name__}"), failing)
        assert export(named, str(tmp_path / export.__name__), failing, max_failed=0.5)["failed"] == 5


def test_staged_tables_can_be_discarded(spark):
    staged = stage(spark.range(3), "gone")
    assert staged.count() == 3 and discard_staged(spark) >= 1 and discard_staged(spark) == 0
    with pytest.raises(Exception):
        staged.collect()


def test_a_stream_lists_its_files_in_few_tasks_and_leaves_the_session_alone(spark, tmp_path):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    files = file_stream(spark, str(tmp_path))
    assert files.sparkSession.conf.get(name) == "32" and spark.conf.get(name) == before
    assert files.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_a_batch_of_small_files_is_read_in_a_task_for_each_core(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(1000):
        (raw / f"{i}.txt").write_text(f"text {i}")
    tasks = []
    files = file_stream(spark, str(raw)).select("path")
    files.writeStream.foreachBatch(lambda batch, _: tasks.append((batch.rdd.getNumPartitions(), batch.count()))).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert [n for _, n in tasks] == [1000] and tasks[0][0] <= spark.sparkContext.defaultParallelism


def test_files_of_pages_are_those_of_the_text_writer(spark, tmp_path):
    pages = [(1, "a\nb"), (9, None), (-3, "é"), (None, ""), (8, "x"), (8, "x")]
    frame = spark.createDataFrame(pages, "page_id long, html string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    found = binary_files(spark, tables.write_files(spark, str(tmp_path))).select("path", "content").collect()
    frame.select((F.col("page_id") % 8).alias("part"), F.coalesce("html", F.lit("")).alias("text")).write.option(
        "maxRecordsPerFile", 1).partitionBy("part").text(str(tmp_path / "text"))
    want = binary_files(spark, str(tmp_path / "text"), "*.txt").select("path", "content").collect()
    laid = lambda rows: sorted((r.path.split("/")[-2], bytes(r.content)) for r in rows)
    assert laid(found) == laid(want) and len(found) == len(pages) and all(r.path.endswith(".txt") for r in found)
    assert not list(Path(found[0].path.removeprefix("file:")).parent.parent.rglob("*.crc"))
