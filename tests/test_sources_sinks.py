import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tablezones.errors import CorruptInputError, EmptyInputError, MissingInputError, UnsafeOverwriteError
from tablezones.sinks import jdbc_options, land_json_documents, land_json_lines, write_jdbc, write_parquet
from tablezones.sources import CORRUPT_COLUMN, read_json_documents, read_json_lines, read_parquet


def part_files(path):
    return sorted(f for f in glob.glob(os.path.join(path, "part-*")))


def test_land_documents_round_trip(spark, tmp_path):
    df = spark.range(0, 500, numPartitions=5).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("ä\n\""), F.col("id"))).alias("t")
    )
    out = str(tmp_path / "raw")
    land_json_documents(df.repartition(7), out)  # some partitions may be empty
    files = part_files(out)
    assert 1 <= len(files) <= 7
    for f in files:
        with open(f, encoding="utf-8") as fh:
            doc = json.load(fh)  # each file is one valid JSON array document
        assert isinstance(doc, list) and doc
    back = read_json_documents(spark, out, schema="id long, t string")
    assert sorted(tuple(r) for r in back.select("id", "t").collect()) == sorted(tuple(r) for r in df.collect())


def test_empty_frame_lands_no_document(spark, tmp_path):
    out = str(tmp_path / "raw")
    land_json_documents(spark.range(0).select("id"), out)
    with pytest.raises(EmptyInputError):
        read_json_documents(spark, out)


def test_multiline_reads_one_root_value_per_file(spark, tmp_path):
    # Two JSON lines read as documents: only the first root value is seen.
    path = tmp_path / "two.json"
    path.write_text('{"a": 1}\n{"a": 2}\n')
    assert read_json_documents(spark, str(path)).count() == 1
    assert read_json_lines(spark, str(path)).count() == 2


def test_json_lines_inference(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2.5), (2, None, 3.0)], "a long, b string, c double")
    out = str(tmp_path / "lines")
    land_json_lines(df, out)
    back = read_json_lines(spark, out)
    assert dict(back.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert back.count() == 2


def test_missing_path(spark, tmp_path):
    with pytest.raises(MissingInputError):
        read_parquet(spark, str(tmp_path / "nope"))
    with pytest.raises(MissingInputError):
        read_json_documents(spark, str(tmp_path / "nope"))
    with pytest.raises(MissingInputError):
        read_json_lines(spark, str(tmp_path / "nope"), schema="a int")


def test_corrupt_file_kept_or_failed(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "good.json").write_text('[{"a": 1}, {"a": 2}]')
    (d / "bad.json").write_text('[{"a": 3}, {"a": ')
    df = read_json_documents(spark, str(d), schema="a long")
    assert CORRUPT_COLUMN in df.columns
    rows = df.collect()
    assert len(rows) == 3 and sum(r[CORRUPT_COLUMN] is not None for r in rows) == 1
    with pytest.raises(Exception) as info:
        read_json_documents(spark, str(d), schema="a long", on_corrupt="fail").collect()
    assert "FAILFAST" in str(info.value) or "Malformed" in str(info.value) or "MALFORMED" in str(info.value)
    assert CorruptInputError  # typed error exists for callers that map it


def test_empty_input_raises(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    (d / "e.json").write_text("")
    with pytest.raises(EmptyInputError):
        read_json_documents(spark, str(d))


def test_write_parquet_reports_rows_in_same_pass(spark, tmp_path):
    out = str(tmp_path / "p")
    report = write_parquet(spark.range(123), out)
    assert report.written and report.rows == 123
    assert read_parquet(spark, out).count() == 123


def test_overwriting_its_own_input_is_safe(spark, tmp_path):
    src = str(tmp_path / "t")
    write_parquet(spark.range(10), src)
    df = read_parquet(spark, src).withColumn("x", F.col("id") + 1)
    with pytest.raises(UnsafeOverwriteError):
        write_parquet(df, src, inputs=[src])  # a named input is refused
    assert read_parquet(spark, src).count() == 10
    # Not named: the input is read to the end before it is replaced.
    assert write_parquet(df, src).rows == 10
    assert sorted(tuple(r) for r in read_parquet(spark, src).collect()) == [(i, i + 1) for i in range(10)]


@pytest.mark.parametrize("land, read", [(land_json_documents, read_json_documents), (land_json_lines, read_json_lines)])
def test_landing_never_destroys_its_input(spark, tmp_path, land, read):
    raw = str(tmp_path / "raw")
    assert land(spark.range(10), raw).rows == 10
    df = read(spark, raw, schema="id long").select((F.col("id") * 2).alias("id"))
    with pytest.raises(UnsafeOverwriteError):
        land(df, raw, inputs=[raw])
    broken = df.select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        land(broken, raw)
    assert read(spark, raw, schema="id long").count() == 10
    assert land(df, raw).rows == 10
    assert sorted(r.id for r in read(spark, raw, schema="id long").collect()) == list(range(0, 20, 2))


def test_land_documents_bounded_bytes(spark, tmp_path):
    out = str(tmp_path / "raw")
    df = spark.range(0, 60, numPartitions=2).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    land_json_documents(df, out, bytes_per_document=5000)
    assert all(os.path.getsize(f) < 6000 for f in part_files(out)) and len(part_files(out)) >= 12
    assert read_json_documents(spark, out, schema="id long, t string").count() == 60


def test_microseconds_survive_landing(spark, tmp_path):
    df = spark.sql("SELECT 1L AS id, timestamp_ntz'2024-05-06 07:08:09.123456' AS ts, double(0.1) + 0.2 AS v")
    for land, read in ((land_json_documents, read_json_documents), (land_json_lines, read_json_lines)):
        out = str(tmp_path / land.__name__)
        assert read(spark, out, schema=land(df, out).schema).select(df.columns).collect() == df.collect()


def test_a_cluster_session_must_name_a_shared_folder(spark):
    from types import SimpleNamespace

    from tablezones.errors import SharedFolderError
    from tablezones.session import checkpoint_root

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
        with pytest.raises(SharedFolderError):
            checkpoint_root(SimpleNamespace(sparkContext=sc))
    with pytest.raises(SharedFolderError):  # no context: a Connect session
        checkpoint_root(SimpleNamespace(conf=conf))


def test_replacing_a_folder_needs_a_file_system(spark):
    from types import SimpleNamespace

    from tablezones.sinks import replace_folder

    with pytest.raises(UnsafeOverwriteError):
        replace_folder(SimpleNamespace(_jvm=None), "hdfs://h/zone", lambda folder: False)


def test_gate_keeps_old_target(spark, tmp_path):
    out = str(tmp_path / "g")
    write_parquet(spark.range(5), out)
    report = write_parquet(spark.range(0), out, require_rows=True)
    assert not report.written
    assert read_parquet(spark, out).count() == 5


def test_jdbc_options():
    mysql = jdbc_options("jdbc:mysql://h:3306/db", "countries", user="u", password="p")
    assert mysql["driver"] == "com.mysql.cj.jdbc.Driver"
    assert mysql["batchsize"] == "1000" and mysql["isolationLevel"] == "NONE"
    assert "createTableOptions" in mysql and mysql["truncate"] == "false"
    other = jdbc_options("jdbc:postgresql://h/db", "t", truncate=True, num_partitions=4)
    assert "createTableOptions" not in other and "driver" not in other
    assert other["truncate"] == "true" and other["numPartitions"] == "4"


def test_jdbc_empty_frame_never_connects(spark):
    # An empty frame is gated before any connection is attempted.
    report = write_jdbc(spark.range(0), "jdbc:invalid://nowhere", "t")
    assert not report.written


def test_self_overwrite_by_named_inputs(spark, tmp_path):
    src = str(tmp_path / "zone" / "t")
    write_parquet(spark.range(10), src)
    df = read_parquet(spark, src)
    with pytest.raises(UnsafeOverwriteError):
        write_parquet(df, src, inputs=[src])
    with pytest.raises(UnsafeOverwriteError):  # parent of an input
        write_parquet(df, str(tmp_path / "zone"), inputs=[src])
    write_parquet(df, str(tmp_path / "zone" / "t2"), inputs=[src])
    assert read_parquet(spark, src).count() == 10


def test_jdbc_writer_wiring(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}

    def fake_save(self, *args, **kwargs):
        # Run the plan through the no-op sink (JVM side) instead of a database.
        seen["called"] = True
        self._df._jdf.write().format("noop").mode("overwrite").save()

    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    df = spark.createDataFrame([(1, ["a"], {"k": 1})], "id int, arr array<string>, m map<string,int>")
    report = write_jdbc(df, "jdbc:mysql://h:3306/db", "countries", user="u", password="p", num_partitions=2)
    assert seen.get("called") and report.written and report.rows == 1
    # complex columns were encoded before reaching the writer
    from tablezones.sinks import prepare_for_jdbc

    assert dict(prepare_for_jdbc(df).dtypes) == {"id": "int", "arr": "string", "m": "string"}


@pytest.mark.parametrize("per_doc", [1, 7, 1000])
def test_land_documents_bounded_size(spark, tmp_path, per_doc):
    df = spark.range(0, 200, numPartitions=3).select("id", F.lit("x").alias("t"))
    out = str(tmp_path / f"raw{per_doc}")
    land_json_documents(df, out, records_per_document=per_doc)
    total = 0
    for f in part_files(out):
        with open(f, encoding="utf-8") as fh:
            doc = json.load(fh)
        assert isinstance(doc, list) and 1 <= len(doc) <= per_doc
        total += len(doc)
    assert total == 200
    back = read_json_documents(spark, out, schema="id long, t string")
    assert sorted(r.id for r in back.collect()) == list(range(200))


def test_inference_rules_are_sparks(spark, tmp_path):
    # The reader adds nothing to JSON inference: sorted fields, widening, strings for dates.
    path = tmp_path / "doc.json"
    path.write_text(
        '[{"z": 1, "a": 1, "m": 1, "big": 99999999999999999999, "d": "2024-01-01", "e": [], "s": {"y": 1, "b": 2}},'
        ' {"z": 2, "a": 2.5, "m": "x", "big": 1, "d": "2024-01-02", "e": [], "s": null}]'
    )
    df = read_json_documents(spark, str(path))
    assert df.columns == ["a", "big", "d", "e", "m", "s", "z"]
    types = dict(df.dtypes)
    assert types["a"] == "double" and types["m"] == "string" and types["big"] == "decimal(20,0)"
    assert types["d"] == "string" and types["e"] == "array<string>" and types["s"] == "struct<b:bigint,y:bigint>"


def test_compressed_landing_round_trip(spark, tmp_path):
    df = spark.range(0, 300, numPartitions=3).select("id", F.concat(F.lit("v"), F.col("id")).alias("t"))
    docs, lines = str(tmp_path / "docs"), str(tmp_path / "lines")
    land_json_documents(df, docs, records_per_document=40, compression="gzip")
    land_json_lines(df, lines, compression="gzip")
    assert all(f.endswith(".gz") for f in part_files(docs))
    assert read_json_documents(spark, docs, schema="id long, t string").count() == 300
    assert read_json_lines(spark, lines, schema="id long, t string").count() == 300


def test_landing_reports_rows(spark, tmp_path):
    report = land_json_documents(spark.range(123, numPartitions=3), str(tmp_path / "raw"), records_per_document=50)
    assert report.written and report.rows == 123


def test_write_parquet_partitioned_with_options(spark, tmp_path):
    out = str(tmp_path / "p")
    df = spark.range(20).select("id", (F.col("id") % 2).alias("part"))
    report = write_parquet(df, out, partition_by=["part"], options={"compression": "zstd"})
    assert report.rows == 20
    assert sorted(d for d in os.listdir(out) if d.startswith("part=")) == ["part=0", "part=1"]
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(os.path.join(out, "part=0")))
    assert read_parquet(spark, out).count() == 20
