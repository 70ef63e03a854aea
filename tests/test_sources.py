"""Sources and sinks (A1–A7), including rejects for broken JSON (FIXTURES §2 row 22)."""
import os
import tempfile

from docnorm.sources import documents as D

from helpers import rows


def test_read_jsonl_with_rejects(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write('{"_id": "a"}\n\n{broken\n{"_id": "b", "x": 1, "x": 2}\n{"_id": "c"}\n\n')
    docs, rejects = D.read_documents(spark, d, with_rejects=True)
    assert sorted(r["_seq"] for r in docs.collect()) == [0, 3]
    assert sorted(r["_seq"] for r in rejects.collect()) == [1, 2]


def test_dense_seq_over_files(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    for i in range(3):
        with open(os.path.join(d, f"part-{i}.json"), "w") as fh:
            fh.write("".join(f'{{"f": {i}, "n": {j}}}\n' for j in range(5)))
    docs = D.read_documents(spark, d)
    seqs = sorted(r["_seq"] for r in docs.collect())
    assert seqs == list(range(15))


def test_sample_roundtrip(spark, docs):
    src = docs({"_id": "a", "t": "ñ"}, {"_id": "b"}, {"_id": "c"})
    out = os.path.join(tempfile.mkdtemp(prefix="sample-"), "s")
    assert D.export_sample(src, out, n=2) == 2
    back = D.load_sample(spark, out)
    assert back.count() == 2
    assert D.load_sample(spark, "/nonexistent/path") is None


def test_export_empty_sample_writes_nothing(spark, docs):
    src = docs({"_id": "a"}).limit(0)
    out = os.path.join(tempfile.mkdtemp(prefix="sample-"), "s")
    assert D.export_sample(src, out) == 0
    assert not os.path.exists(out)


def test_read_parquet_text_column_dense_seq(spark):
    d = tempfile.mkdtemp(prefix="pq-")
    for i in range(2):
        spark.createDataFrame([(f'{{"f": {i}, "n": {j}}}',) for j in range(4)], "json string") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(d, f"part{i}"))
    docs = D.read_documents(spark, os.path.join(d, "*"), fmt="parquet", text_col="json")
    got = sorted((r["_seq"], r["doc"].toJson()) for r in docs.collect())
    assert [s for s, _ in got] == list(range(8))
    # file order, then row order inside each file
    assert [j for _, j in got][:4] == [f'{{"f":0,"n":{j}}}' for j in range(4)]


def test_read_jsonl_glob_and_unit_suffixed_split_size(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    for i in range(2):
        with open(os.path.join(d, f"p{i}.json"), "w") as fh:
            fh.write("".join(f'{{"f": {i}, "n": {j}}}\n' for j in range(3)))
    assert D.estimated_splits(spark, os.path.join(d, "*.json")) >= 2
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        docs = D.read_documents(spark, os.path.join(d, "*.json"))
        assert sorted(r["_seq"] for r in docs.collect()) == list(range(6))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_byte_sizes():
    assert D._bytes("134217728") == 134217728
    assert D._bytes("128m") == D._bytes("128MB") == 128 * 1024 * 1024
    assert D._bytes("1g") == 1 << 30


def test_write_table_to_path_and_catalog(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="wt-"), "t")
    D.write_table(spark.range(3), "ignored", path=out)
    assert spark.read.parquet(out).count() == 3
    import uuid
    name = f"default.docnorm_write_probe_{uuid.uuid4().hex[:8]}"   # managed tables outlive a run's catalog
    D.write_table(spark.range(2), name)
    assert spark.table(name).count() == 2
