"""Builders of the nested collections: documents are built once, above the exchange, by compiled code."""
import json

from pyspark.sql import functions as F

from docnorm.sources import nest

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_built_above_the_exchange(spark):
    for name, build in nest._BUILDERS.items():
        text = plan(build(spark, SMALL, 4))
        top, _, below = text.partition("rangepartitioning")
        assert below, name
        assert top.count("to_json") + top.count("StructsToJson") and "map_filter" not in text, name


def test_orders_join_without_broadcast_of_growing_tables(spark):
    text = plan(nest.build_order_docs(spark, SMALL, 4))
    assert text.count("SortMergeJoin") == 2


def test_collections_are_stored_whole_and_the_session_is_left_as_it_was(spark):
    key = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(key, None)
    path = nest.docs(spark, SMALL, "staff").inputFiles()[0]
    assert spark.conf.get(key, None) == before
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getFileMetaData().getSchema().getColumns().size()
    finally:
        reader.close()
    assert columns == 3  # _seq, metadata and value of the document


def test_json_of_structs(spark):
    k = F.col("k")
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "k long").select("k", F.to_json(nest.obj(
        x=nest.choose((k == 0, nest.jnull()), (k == 1, nest.obj(a=k, b=F.when(k != 1, k))), default=F.lit('q"')),
        r=nest.row(id=k))).alias("j"))
    assert {r.k: json.loads(r.j) for r in df.collect()} == {
        0: {"x": None, "r": {"id": 0}}, 1: {"x": {"a": 1}, "r": {"id": 1}},
        2: {"x": 'q"', "r": {"id": 2}}, None: {"x": 'q"', "r": {"id": None}}}
    more = spark.range(1).select(
        nest.with_text(F.lit('{"a":1}'), b=F.lit("[2]"), c=F.lit(None).cast("string")).alias("some"),
        nest.with_text(F.lit("{}"), b=F.lit("[2]")).alias("none")).first()
    assert (more.some, more.none) == ('{"a":1,"b":[2]}', '{"b":[2]}')


def test_padded_keys(spark):
    df = spark.createDataFrame([(7,), (1234567,), (-5,), (None,)], "k long")
    assert [r[0] for r in df.select(nest.uid(F.col("k"))).collect()] == ["u000007", "u1234567", "u-00005", None]


def test_line_items_are_rendered_before_the_aggregate(spark):
    text = plan(nest.build_order_docs(spark, SMALL, 4))
    assert "collect_list(line#" in text  # an expression inside the aggregate would be interpreted


def test_line_item_texts(spark):
    import datetime
    df = spark.createDataFrame(
        [(7, 8, 1, datetime.datetime(2020, 1, 2), 'R"', 2.0), (None, None, 3, None, None, None)],
        "l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double")
    a, b = [{k: json.loads(v) for k, v in r.asDict().items()} for r in
            df.select(*[c.alias(k) for k, c in nest._line_items().items()]).collect()]
    assert a == {"movement": {"at": "2020-01-02 00:00:00", "id": 7, "to": 'R"', "qty": 2.0, "line": 1, "supp": 8},
                 "member": "u000007", "recipient": {"id": "u000007", "name": "P7"}, "document": {"id": "p7"},
                 "internal": {"id": "s8"}, "step": {"title": "T1", "description": 'R"'}}
    assert b == {"movement": None, "member": None, "recipient": {"id": None, "name": None}, "document": {"id": None},
                 "internal": {"id": None}, "step": {"title": "T3", "description": None}}


def test_text_beyond_ascii_is_cut_by_bytes(spark):
    assert spark.range(1).select(nest.with_text(F.lit('{"a":"ñ€😀"}'), b=F.lit("1"))).first()[0] == '{"a":"ñ€😀","b":1}'


def test_builds_leave_no_projection_to_the_interpreter_of_the_jvm(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with nest._building(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == before


def test_documents_hold_no_parsed_items(spark):
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        text = nest.build_document_docs(spark, SMALL, 4)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "participants" in text and "parseJson" not in text


def test_line_items_are_shuffled_as_plain_columns(spark):
    with nest._building(spark):
        text = plan(nest.build_order_docs(spark, SMALL, 4))
    rendered = text.index("collect_list(line#")
    below = text[rendered:].partition("hashpartitioning(l_orderkey")[2]
    assert below and "to_json" not in below and "StructsToJson" not in below
    assert "ObjectHashAggregate" not in text  # rows arrive sorted by order


def test_order_documents_hold_their_items_in_order(spark, tmp_path):
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    o = spark.read.parquet(f"{SMALL}/orders.parquet").limit(1)
    o = o.withColumn("o_orderkey", F.explode(F.array(F.lit(4), F.lit(4), F.lit(5), F.lit(None)).cast("array<bigint>")))
    o.write.parquet(str(tmp_path / "orders.parquet"))
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(1).withColumn(
        "l_linenumber", F.explode(F.array(F.lit(2), F.lit(None), F.lit(1)))).withColumn(
        "l_orderkey", F.explode(F.array(F.lit(4), F.lit(None)).cast("array<bigint>")))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    with nest._building(spark):
        rows = nest.build_order_docs(spark, str(tmp_path), 3).collect()
    lines = [(r._seq, [m.get("line") for m in json.loads(r.json)["movements"]] if '"movements"' in r.json else None)
             for r in rows]
    assert sorted(lines, key=str) == [(4, [None, 1, 2]), (4, [None, 1, 2]), (5, None), (None, None)]


def test_texts_of_line_items_stay_out_of_shuffles(spark):  # F2, F8
    with nest._building(spark):
        text = plan(nest.build_order_docs(spark, SMALL, 4))
    below = text.partition("rangepartitioning")[2]
    assert "collect_list(line#" in below and "to_json" not in below and "StructsToJson" not in below


def test_collections_at_rest_are_packed_and_shuffles_of_a_build_go(spark):  # F2, F5 to F8
    path = nest.docs(spark, SMALL, "orders").inputFiles()[0]
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        codecs = {c.getCodec().toString() for c in reader.getFooter().getBlocks().get(0).getColumns()}
    finally:
        reader.close()
    assert codecs == {"ZSTD"}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with nest._building(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
