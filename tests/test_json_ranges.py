"""Array documents read by byte ranges: equal to whole documents at any range size, and resynchronised after damage."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tablezones.sources import read_json_documents
from tablezones.sources.json_ranges import json_records, read_json_ranges

SCHEMA = "id long, name string, tags array<string>, inner struct<a:long, b:array<struct<c:string>>>"


def record(rng, i):
    text = lambda: "".join(rng.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "\n", "é", "},{", '\\"', ":", " "]) for _ in range(rng.randint(0, 12)))
    return {"id": i, "name": text(), "tags": [text() for _ in range(rng.randint(0, 3))], "inner": {"a": i, "b": [{"c": text()} for _ in range(rng.randint(0, 3))]}}


LAYOUTS = {
    "landed": lambda rows: "[" + "\n,".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in rows) + "\n]",
    "indented": lambda rows: json.dumps(rows, ensure_ascii=False, indent=4) + "\n",
    "compact": lambda rows: json.dumps(rows, ensure_ascii=False, separators=(",", ":")),
}


def plain(df):
    return sorted((json.loads(r) for r, in df.select(F.to_json(F.struct("id", "name", "tags", "inner"), {"ignoreNullFields": "false"})).collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_ranges_equal_whole_documents(spark, tmp_path, layout, size):
    rng = random.Random(5)
    rows = [record(rng, i) for i in range(60)]
    rows[30]["name"] = "long } { " * 200  # over several ranges
    for k, part in enumerate((rows[:50], rows[50:59], rows[59:], [])):
        (tmp_path / f"{k}.json").write_text(LAYOUTS[layout](part), encoding="utf-8")
    (tmp_path / "one.json").write_text(json.dumps(record(rng, 99)))
    (tmp_path / "zero.json").write_text("")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = read_json_ranges(spark, str(tmp_path), SCHEMA)
        assert got.where("_corrupt_record IS NOT NULL").isEmpty()
        assert plain(got) == plain(read_json_documents(spark, str(tmp_path), schema=SCHEMA).where("id IS NOT NULL"))
        for r in json_records(spark, str(tmp_path)).collect():
            data = open(r.file.removeprefix("file:").replace("///", "/"), "rb").read()
            assert data[r.offset :].startswith(r.text.encode())
        if size < 100:
            assert json_records(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("layout", ["landed", "indented"])
@pytest.mark.parametrize("damage", ['"name": "open', '{"a": [', "}", "]]", '\\"', "nonsense"])
@pytest.mark.parametrize("size", [700, 1 << 20])
def test_a_broken_record_alone_is_malformed(spark, tmp_path, layout, damage, size):
    rng = random.Random(7)
    rows = [record(rng, i) for i in range(9)]
    for r in rows:
        r["name"] = f"name {r['id']}"
    text = LAYOUTS[layout](rows)
    at = text.index("name 4") + 3
    (tmp_path / "x.json").write_text(text[:at] + '", ' + damage + text[at + 4 :], encoding="utf-8")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = read_json_ranges(spark, str(tmp_path), SCHEMA)
        good = plain(got.where("_corrupt_record IS NULL"))
        bad = got.where("_corrupt_record IS NOT NULL").select("_offset", "_corrupt_record").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert [r for r in good if r["id"] != 4] == [r for r in rows if r["id"] != 4]
    bad.sort(key=lambda r: r._offset)
    assert len(bad) == 1 or size == 700 and 1 < len(bad) < 5  # rows of the one record where ranges end in it
    assert text[:at].encode()[bad[0]._offset :].startswith(bad[0]._corrupt_record[: at - text.rindex("{", 0, at)].encode()) and "nam" in bad[0]._corrupt_record


def test_structure_salvages_the_records_around_a_broken_one(spark, tmp_path):
    from tablezones.errors import CorruptInputError
    from tablezones.plans import structure
    from tablezones.sources import read_parquet

    raw, foundation = str(tmp_path / "raw"), str(tmp_path / "foundation")
    os.mkdir(raw)
    good = '[{"id":1,"name":"a"}\n,{"id":2,"name":"b"}\n]'
    broken = '[{"id":3,"name":"c"}\n,{"id":4,"name":"d"}\n,{"id":5,"name":\n,{"id":6,"name":"f"}\n]'
    for name, text in (("a.json", good), ("b.json", broken)):
        with open(f"{raw}/{name}", "w") as f:
            f.write(text)
    schema = "id long, name string"
    for _ in range(2):  # a rerun adds nothing to the quarantine
        with pytest.raises(CorruptInputError):
            structure(spark, raw, foundation, schema=schema)
        assert [r.text for r in read_parquet(spark, f"{foundation}_quarantine").collect()] == [broken]
    aside = str(tmp_path / "aside")
    for _ in range(2):
        report = structure(spark, raw, foundation, schema=schema, on_corrupt="salvage", quarantine_path=aside)
        assert report.metrics == {"rows": 5, "corrupt_rows": 1}
        assert sorted(map(tuple, read_parquet(spark, foundation).collect())) == [(i, n) for i, n in ((1, "a"), (2, "b"), (3, "c"), (4, "d"), (6, "f"))]
        (bad,) = read_parquet(spark, aside).collect()
        assert bad.offset == broken.index('{"id":5') and broken[bad.offset :].startswith(bad.text) and bad.file.endswith("b.json")
    with pytest.raises(ValueError):
        structure(spark, raw, foundation, on_corrupt="salvage")


def test_an_empty_landing_keeps_the_zone(spark, tmp_path):
    from tablezones.sinks import land_json_documents, land_json_lines
    from tablezones.sources import read_json_lines

    df = spark.range(10)
    for land, read in ((land_json_documents, read_json_documents), (land_json_lines, read_json_lines)):
        path = str(tmp_path / land.__name__)
        assert land(df, path).written
        report = land(df.where("id < 0"), path)
        assert not report.written and report.rows == 0
        assert read(spark, path, schema="id long").where("id IS NOT NULL").count() == 10
