import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tablezones.errors import CorruptInputError, EmptyInputError, MissingInputError
from tablezones.operators import complex_columns
from tablezones.plans import COUNTRIES, Zones, run_end_to_end, structure, transform, transform_countries
from tablezones.sources import CORRUPT_COLUMN, read_json_documents, read_parquet
from tablezones.streaming import run_incremental_transform

# An invented record: no English name, two time zones, no capital, a translation
# outside the allowed codes, a delimiter and an empty text within a list, and a
# field that no rule names.
FIXTURE = {
    "name": {
        "common": "Isla Verde",
        "official": "Commonwealth of Isla Verde",
        "nativeName": {"spa": {"common": "Isla Verde", "official": "Mancomunidad de Isla Verde"}},
    },
    "ccn3": "961",
    "cca3": "IVD",
    "latlng": [-12.5, 48.25],
    "independent": False,
    "status": "user-assigned",
    "translations": {
        "fra": {"official": "Communauté d'Île-Verte", "common": "Île-Verte"},
        "deu": {"official": "Gemeinwesen Grüninsel", "common": "Grüninsel"},
        "kor": {"official": "녹도 연방", "common": "녹도"},
    },
    "capital": [],
    "altSpellings": ["IV", "Green | Isle", ""],
    "languages": {"spa": "Spanish", "mlg": "Malagasy", "fra": "French"},
    "region": "Africa",
    "area": 1204.75,
    "maps": {"openStreetMaps": "https://osm.example/iv", "googleMaps": "https://maps.example/iv"},
    "timezones": ["UTC+03:00", "UTC+04:00"],
    "continents": ["Africa", "Oceania"],
    "flags": {"svg": "https://flags.example/iv.svg", "png": "https://flags.example/iv.png", "alt": "A green field"},
    "startOfWeek": "sunday",
    "population": 51200,
}

_FRA = '{"common":"Île-Verte","official":"Communauté d\'Île-Verte"}'
_DEU = '{"common":"Grüninsel","official":"Gemeinwesen Grüninsel"}'
_KOR = '{"common":"녹도","official":"녹도 연방"}'
# Worked out by hand from the rules; nested values are JSON with inferred (sorted) fields.
GOLDEN = [
    ("Dat_nuoc", "string", '{"common":"Isla Verde","nativeName":{"spa":{"common":"Isla Verde",'
     '"official":"Mancomunidad de Isla Verde"}},"official":"Commonwealth of Isla Verde"}'),
    ("ccn3", "string", "961"),
    ("cca3", "string", "IVD"),
    ("latlng", "string", "[-12.5,48.25]"),
    ("Doc_lap", "boolean", False),
    ("Trang_thai", "string", "user-assigned"),
    ("translations", "string", f'{{"deu":{_DEU},"fra":{_FRA},"kor":{_KOR}}}'),
    ("Thu_do", "string", ""),
    ("Ten_thay_the", "string", "IV|Green | Isle|"),
    ("languages", "string", '{"fra":"French","mlg":"Malagasy","spa":"Spanish"}'),
    ("Khu_vuc", "string", "Africa"),
    ("dien_tich", "double", 1204.75),
    ("ban_do", "string", '{"googleMaps":"https://maps.example/iv","openStreetMaps":"https://osm.example/iv"}'),
    ("Mui_gio", "string", '["UTC+03:00","UTC+04:00"]'),
    ("Luc_dia", "string", "Africa|Oceania"),
    ("Quoc_ky", "string", '{"alt":"A green field","png":"https://flags.example/iv.png","svg":"https://flags.example/iv.svg"}'),
    ("Ngay_bat_dau_tuan", "string", "sunday"),
    ("lat", "double", -12.5),
    ("lng", "double", 48.25),
    ("su_dung_tieng_anh", "boolean", False),
    ("translation_fra", "string", _FRA),
    ("translation_deu", "string", _DEU),
    ("Google_Maps", "string", "https://maps.example/iv"),
    ("timezone_1", "string", "UTC+03:00"),
    ("svg_flags", "string", "https://flags.example/iv.svg"),
    ("country_id", "string", str(uuid.uuid5(uuid.UUID(COUNTRIES.key_namespace), "Isla Verde - Commonwealth of Isla Verde"))),
]


@pytest.fixture()
def zones(tmp_path):
    z = Zones.under(str(tmp_path))
    os.makedirs(z.raw)
    with open(os.path.join(z.raw, "raw.json"), "w") as fh:
        json.dump([FIXTURE], fh, indent=4)
    return z


def test_golden_end_to_end(spark, zones):
    reports = run_end_to_end(spark, zones)
    assert reports["structure"].rows == 1 and reports["transform"].rows == 1
    assert reports["transform"].metrics["null_keys"] == 0
    out = read_parquet(spark, zones.trusted)
    assert out.columns == [g[0] for g in GOLDEN]
    assert out.dtypes == [(g[0], g[1]) for g in GOLDEN]
    row = out.first()
    for name, _, value in GOLDEN:
        assert row[name] == value, name


def test_as_shipped_output_without_key(spark, zones):
    structure(spark, zones.raw, zones.foundation)
    from dataclasses import replace

    transform(spark, zones.foundation, zones.trusted, replace(COUNTRIES, attach_key=False))
    assert read_parquet(spark, zones.trusted).columns == [g[0] for g in GOLDEN[:-1]]


def test_rerun_gives_same_table(spark, zones):
    run_end_to_end(spark, zones)
    first = sorted(map(tuple, read_parquet(spark, zones.trusted).collect()))
    run_end_to_end(spark, zones)
    assert sorted(map(tuple, read_parquet(spark, zones.trusted).collect())) == first


def test_schema_drift_gives_typed_nulls(spark):
    df = spark.createDataFrame(
        [({"vie": "Vietnamese"}, {"png": "p"}, {"other": "x"}, [], None)],
        "languages struct<vie:string>, flags struct<png:string>, maps struct<other:string>, "
        "latlng array<double>, capital array<string>",
    )
    out = transform_countries(df).first()
    assert out.su_dung_tieng_anh is False and out.svg_flags is None and out.Google_Maps is None
    assert out.lat is None and out.lng is None and out.Thu_do == ""
    assert out.country_id is None  # no name column: NULL key, not an error


def test_key_of_all_null_name_is_null(spark):
    df = spark.createDataFrame([({"common": None, "official": None},), (None,)], "name struct<common:string,official:string>")
    assert [r.country_id for r in transform_countries(df).collect()] == [None, None]


def test_transform_is_one_projection_without_shuffle(spark, zones):
    structure(spark, zones.raw, zones.foundation)
    df = transform_countries(read_parquet(spark, zones.foundation))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "EvalPython" not in plan
    assert complex_columns(df) == []


def test_failures_raise(spark, tmp_path):
    z = Zones.under(str(tmp_path))
    with pytest.raises(MissingInputError):
        run_end_to_end(spark, z)
    os.makedirs(z.raw)
    with open(os.path.join(z.raw, "raw.json"), "w") as fh:
        fh.write("[]")
    with pytest.raises(EmptyInputError):
        run_end_to_end(spark, z)


def test_incremental_stream_reads_new_files_only(spark, tmp_path, zones):
    structure(spark, zones.raw, zones.foundation)
    schema = read_parquet(spark, zones.foundation).schema
    ckpt = str(tmp_path / "ckpt")
    trusted = str(tmp_path / "stream_trusted")
    run_incremental_transform(spark, zones.raw, trusted, schema, checkpoint=ckpt)
    assert read_parquet(spark, trusted).count() == 1
    second = dict(FIXTURE, name={"common": "Japan", "official": "Japan"})
    with open(os.path.join(zones.raw, "raw2.json"), "w") as fh:
        json.dump([second], fh)
    progress = run_incremental_transform(spark, zones.raw, trusted, schema, checkpoint=ckpt)
    out = read_parquet(spark, trusted)
    assert out.count() == 2 and progress.get("numInputRows", 1) <= 1
    assert {r.Dat_nuoc for r in out.select("Dat_nuoc").collect()} == {
        GOLDEN[0][2],
        '{"common":"Japan","official":"Japan"}',
    }
    assert out.filter(F.col("country_id").isNull()).count() == 0


def test_map_typed_translations_emit_every_code(spark):
    df = spark.createDataFrame(
        [({"eng": {"common": "E"}, "fra": {"common": "F"}},), (None,)],
        "translations map<string,struct<common:string>>",
    )
    out = transform_countries(df)
    assert [c for c in out.columns if c.startswith("translation_")] == [
        f"translation_{k}" for k in ("eng", "fra", "spa", "deu", "ita", "por", "rus", "ara", "zho", "jpn")
    ]
    rows = out.collect()
    assert rows[0].translation_eng == '{"common":"E"}' and rows[0].translation_spa is None
    assert json.loads(rows[0].translations) == {"eng": {"common": "E"}, "fra": {"common": "F"}}
    assert rows[1].translations is None


def test_map_typed_languages_flag(spark):
    df = spark.createDataFrame([({"eng": "English"},), ({"vie": "V"},), (None,)], "languages map<string,string>")
    assert [r.su_dung_tieng_anh for r in transform_countries(df).collect()] == [True, False, False]


def test_edge_rows_keep_row_count(spark):
    schema = (
        "name struct<common:string,official:string>, latlng array<double>, capital array<string>, "
        "altSpellings array<string>, languages struct<eng:string>, maps struct<googleMaps:string>, "
        "timezones array<string>, flags struct<svg:string>, region string"
    )
    rows = [
        (None, None, None, None, None, None, None, None, None),
        ({"common": "Ñandú", "official": None}, [], [], [None, "x"], {"eng": None}, {"googleMaps": None}, [], {"svg": None}, "Á"),
        ({"common": "dup", "official": "dup"}, [1.0], ["a", None], ["b"], {"eng": "E"}, {"googleMaps": "g"}, [None], None, None),
        ({"common": "dup", "official": "dup"}, [1.0, 2.0, 3.0], ["a"], [], {"eng": "E"}, None, ["t"], {"svg": "s"}, "r"),
    ]
    df = spark.createDataFrame(rows, schema)
    out = transform_countries(df)
    got = out.collect()
    assert len(got) == 4 and complex_columns(out) == []
    assert (got[0].Dat_nuoc, got[0].Thu_do, got[0].Ten_thay_the, got[0].lat, got[0].country_id) == (None, "", "", None, None)
    assert got[1].Dat_nuoc == '{"common":"Ñandú"}' and got[1].Ten_thay_the == "x" and got[1].su_dung_tieng_anh is False
    assert got[1].country_id == str(__import__("uuid").uuid5(__import__("uuid").UUID(COUNTRIES.key_namespace), "Ñandú"))
    assert (got[2].lat, got[2].lng, got[2].Thu_do, got[2].timezone_1) == (1.0, None, "a", None)
    assert got[2].country_id == got[3].country_id  # duplicate names share a key, rows are not merged
    assert got[3].Mui_gio == '["t"]' and got[3].svg_flags == "s" and got[3].Google_Maps is None


def test_empty_table_transforms_to_empty(spark):
    df = spark.createDataFrame([], "name struct<common:string,official:string>, capital array<string>")
    out = transform_countries(df)
    assert out.count() == 0 and complex_columns(out) == []


def test_cli_arguments(monkeypatch, capsys):
    from tablezones import cli

    assert cli._arguments(["structure", "a", "b"]).on_corrupt == "fail"
    args = cli._arguments(["all", "r", "f", "t", "--url", "jdbc:x", "--table", "c", "--num-partitions", "4", "--num-files", "2"])
    assert (args.table, cli._jdbc_options(args)["num_partitions"], args.num_files) == ("c", 4, 2)
    args = cli._arguments(["save", "a", "t", "--host", "db", "--database", "geo"])
    assert cli._url(args) == "jdbc:mysql://db:3306/geo"
    for bad in (["save", "a", "t"], ["all", "r", "f", "t", "--url", "jdbc:x"], ["all", "r", "f", "t", "--table", "c"],
                ["structure", "a", "b", "--on-corrupt", "drop"]):
        with pytest.raises(SystemExit) as stop:
            cli._arguments(bad)
        assert stop.value.code == 2
    for name, value in zip(("host", "port", "database", "user"), ("h", "3307", "d", "u")):
        monkeypatch.setenv(cli.SETTINGS[name], value)
    monkeypatch.setenv(cli.PASSWORD_SETTING, "p")
    args = cli._arguments(["save", "a", "t"])
    assert cli._url(args) == "jdbc:mysql://h:3307/d"
    assert cli._jdbc_options(args) == {"user": "u", "password": "p", "num_partitions": None, "truncate": False}
    assert cli._arguments(["all", "r", "f", "t"]).table is None  # settings alone ask for no save


def test_cli_runs_structure_then_transform(zones):
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell")
    for args in (["structure", zones.raw, zones.foundation], ["transform", zones.foundation, zones.trusted]):
        done = subprocess.run([sys.executable, "-m", "tablezones.cli", *args], env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        assert json.loads(done.stdout.strip().splitlines()[-1])["rows"] == 1
    done = subprocess.run(
        [sys.executable, "-m", "tablezones.cli", "all", zones.raw, zones.foundation + "_all", zones.trusted + "_all"],
        env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    stages = [json.loads(line)["job"] for line in done.stdout.strip().splitlines() if line.startswith("{")]
    assert stages == ["structure", "transform"]
    run = lambda *args: subprocess.run([sys.executable, "-m", "tablezones.cli", *args], env=env, capture_output=True, text=True, timeout=300)
    lines = os.path.join(os.path.dirname(zones.raw), "lines.json")
    with open(lines, "w") as fh:
        fh.write("\n".join(json.dumps(dict(FIXTURE, ccn3=str(i))) for i in range(3)))
    done = run("land", lines, zones.raw + "_landed")
    assert done.returncode == 0 and json.loads(done.stdout.strip().splitlines()[-1])["rows"] == 3, done.stderr[-2000:]
    done = run("profile", zones.trusted, "--rows", "1")
    shown = [json.loads(line) for line in done.stdout.strip().splitlines() if line.startswith("{")]
    assert done.returncode == 0 and shown[0]["column_name"] == "Dat_nuoc" and shown[-1]["ccn3"] == "961"
    _write(zones.raw, "bad.json", BROKEN)
    assert run("structure", zones.raw, zones.foundation).returncode != 0
    assert run("structure", zones.raw, zones.foundation, "--on-corrupt", "quarantine").returncode == 0
    bad = subprocess.run(
        [sys.executable, "-m", "tablezones.cli", "transform", zones.raw + "/missing", zones.trusted + "2"],
        env=env, capture_output=True, text=True, timeout=300,
    )
    assert bad.returncode != 0 and "MissingInputError" in bad.stderr


def test_type_rules(spark):
    from tablezones.errors import ColumnTypeError

    ok = spark.createDataFrame([([1, None, 3], "a|b")], "capital array<int>, continents string")
    r = transform_countries(ok).first()
    assert (r.Thu_do, r.Luc_dia) == ("1|3", "a|b")
    all_null = transform_countries(spark.createDataFrame([(None,)], "latlng string")).first()
    assert (all_null.lat, all_null.lng) == (None, None)  # an all-NULL field infers as string
    with pytest.raises(Exception, match="non-array value"):
        transform_countries(spark.createDataFrame([("1,2",)], "latlng string")).collect()
    with pytest.raises(ColumnTypeError):
        transform_countries(spark.createDataFrame([(1.5,)], "latlng double"))
    with pytest.raises(ColumnTypeError):
        transform_countries(spark.createDataFrame([([{"a": 1}],)], "capital array<struct<a:int>>"))


BROKEN = '[{"name": {"common": "x"}}, {"name": {"common": "y"}}, {"name": '


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


@pytest.mark.parametrize("schema", [None, "name struct<common:string>"])
def test_corrupt_documents_fail_and_keep_the_foundation(spark, tmp_path, schema):
    z = Zones.under(str(tmp_path))
    _write(z.raw, "good.json", '[{"name": {"common": "a"}}, {"name": {"common": "b"}}]')
    structure(spark, z.raw, z.foundation, schema=schema)
    _write(z.raw, "bad.json", BROKEN)
    with pytest.raises(CorruptInputError, match="1 malformed"):
        structure(spark, z.raw, z.foundation, schema=schema)
    assert read_parquet(spark, z.foundation).count() == 2
    aside = read_parquet(spark, z.foundation + "_quarantine").collect()
    assert len(aside) == 1 and aside[0].file.endswith("bad.json") and aside[0].text == BROKEN
    # on request the job goes on without them: no NULL rows, and they are reported
    report = structure(spark, z.raw, z.foundation, schema=schema, on_corrupt="quarantine")
    assert (report.rows, report.metrics["corrupt_rows"]) == (2, 1)
    found = read_parquet(spark, z.foundation)
    assert CORRUPT_COLUMN not in found.columns and found.where("name IS NULL").count() == 0


def test_only_corrupt_documents(spark, tmp_path):
    z = Zones.under(str(tmp_path))
    _write(z.raw, "bad.json", '{"a": ')
    with pytest.raises(CorruptInputError):
        structure(spark, z.raw, z.foundation, on_corrupt="quarantine")
    assert read_parquet(spark, z.foundation + "_quarantine").first().text == '{"a": '
    with pytest.raises(ValueError):
        structure(spark, z.raw, z.foundation, on_corrupt="drop")


def test_a_failing_write_keeps_the_previous_zone(spark, zones):
    run_end_to_end(spark, zones)
    from tablezones.sinks import write_parquet

    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x"))
    for zone in (zones.foundation, zones.trusted):
        with pytest.raises(Exception, match="lost"):
            write_parquet(bad, zone)
        assert read_parquet(spark, zone).count() == 1
    left = os.listdir(os.path.dirname(zones.trusted))
    assert sorted(left) == ["foundation", "raw", "trusted"]  # no half-written folder stays


def test_every_field_reaches_the_foundation(spark, tmp_path):
    """A field of its own in each of 60 documents; a declared schema that names one field only."""
    z = Zones.under(str(tmp_path))
    for i in range(60):
        _write(z.raw, f"{i}.json", json.dumps([{"id": i, f"own{i}": i}]))
    structure(spark, z.raw, z.foundation)
    assert len(read_parquet(spark, z.foundation).columns) == 61
    structure(spark, z.raw, z.foundation, schema="id long")
    assert len(read_parquet(spark, z.foundation).columns) == 61


def test_declared_schema_keeps_undeclared_fields(spark, zones):
    from tablezones.plans import FEED_SCHEMA

    _write(zones.raw, "more.json", json.dumps([dict(FIXTURE, name={"common": "c", "official": "o", "short": "s"})]))
    structure(spark, zones.raw, zones.foundation, schema=FEED_SCHEMA)
    rows = read_parquet(spark, zones.foundation).orderBy("name.common").collect()
    assert [r.population for r in rows] == [51200, 51200]
    assert [r.name.short for r in rows] == [None, "s"] and rows[0].name.nativeName["spa"].common == "Isla Verde"


def test_incremental_stream_archives_processed_files(spark, tmp_path, zones):
    structure(spark, zones.raw, zones.foundation)
    schema = read_parquet(spark, zones.foundation).schema
    archive = str(tmp_path / "archive")
    trusted = str(tmp_path / "stream_trusted_archive")
    kw = dict(checkpoint=str(tmp_path / "ck2"), archive_dir=archive)
    run_incremental_transform(spark, zones.raw, trusted, schema, **kw)
    with open(os.path.join(zones.raw, "raw2.json"), "w") as fh:
        json.dump([dict(FIXTURE, name={"common": "Japan", "official": "Japan"})], fh)
    run_incremental_transform(spark, zones.raw, trusted, schema, **kw)
    assert read_parquet(spark, trusted).count() == 2
    # Files of a batch are archived once a later batch commits.
    archived = [f for _, _, fs in os.walk(archive) for f in fs]
    assert "raw.json" in archived and os.listdir(zones.raw) == ["raw2.json"]


def test_explicit_feed_schema_gives_stable_columns(spark, zones):
    from tablezones.plans import FEED_SCHEMA

    reports = run_end_to_end(spark, zones, schema=FEED_SCHEMA)
    assert reports["structure"].rows == 1
    out = read_parquet(spark, zones.trusted)
    codes = ("eng", "fra", "spa", "deu", "ita", "por", "rus", "ara", "zho", "jpn")
    assert [c for c in out.columns if c.startswith("translation_")] == [f"translation_{c}" for c in codes]
    row = out.first()
    golden = {name: value for name, _, value in GOLDEN}
    for name in ("Ten_thay_the", "Thu_do", "lat", "lng", "su_dung_tieng_anh", "Google_Maps",
                 "svg_flags", "timezone_1", "translation_fra", "Quoc_ky", "ban_do", "country_id"):
        assert row[name] == golden[name], name
    for name in ("languages", "translations", "Dat_nuoc"):
        assert json.loads(row[name]) == json.loads(golden[name])
    assert row.translation_eng is None


def test_feed_rules_for_another_feed(spark):
    from tablezones.plans import FeedRules, Field, Flag, Item, Variants, transform_feed

    rules = FeedRules(
        allow_list=("sku", "title", "tags", "dims", "attrs", "labels"),
        joined=("tags",),
        join_separator=",",
        derived=(
            Item("width", "dims", 0, cast="double"),
            Flag("has_color", "attrs", "color"),
            Field("brand", "attrs", "brand"),
            Variants("labels", ("en", "de"), "label_"),
        ),
        renames={"title": "name"},
        key_source="title",
        key_column="product_id",
    )
    df = spark.createDataFrame(
        [("A1", "Lamp", ["x", "y"], ["12.5", "3"], {"color": "red"}, {"en": "lamp"})],
        "sku string, title string, tags array<string>, dims array<string>, attrs map<string,string>, "
        "labels struct<en:string,fr:string>",
    )
    out = transform_feed(df, rules)
    assert out.columns == ["sku", "name", "tags", "dims", "attrs", "labels", "width", "has_color", "brand",
                           "label_en", "product_id"]
    r = out.first()
    assert (r.tags, r.width, r.has_color, r.brand, r.label_en) == ("x,y", 12.5, True, None, "lamp")
    assert r.product_id == str(__import__("uuid").uuid5(__import__("uuid").UUID(rules.key_namespace), "Lamp"))


def test_incremental_stream_quarantines_corrupt_documents(spark, tmp_path, zones):
    schema = read_json_documents(spark, zones.raw).schema
    _write(zones.raw, "broken.json", BROKEN)
    trusted = str(tmp_path / "stream_trusted_corrupt")
    result = run_incremental_transform(spark, zones.raw, trusted, schema, checkpoint=str(tmp_path / "ck3"))
    assert result["rows"] == 1 and result["corrupt_rows"] == 1
    out = read_parquet(spark, trusted)
    assert out.count() == 1 and CORRUPT_COLUMN not in out.columns and out.first().country_id is not None
    assert read_parquet(spark, trusted + "_quarantine").first().text == BROKEN


def test_incremental_stream_second_run_adds_the_new_files(spark, tmp_path):
    z = Zones.under(str(tmp_path))
    record = lambda i: {"name": {"common": f"c{i}", "official": "o"}}
    _write(z.raw, "first.json", json.dumps([record(i) for i in range(100)]))
    schema = read_json_documents(spark, z.raw).schema
    run = lambda: run_incremental_transform(spark, z.raw, z.trusted, schema, str(tmp_path / "ck"))
    assert run()["rows"] == 100
    _write(z.raw, "second.json", json.dumps([record(i) for i in range(100, 150)]))
    assert run()["rows"] == 50 and read_parquet(spark, z.trusted).count() == 150
    assert run()["rows"] == 0 and read_parquet(spark, z.trusted).count() == 150
    with pytest.raises(TypeError):
        run_incremental_transform(spark, z.raw, z.trusted, schema)  # a checkpoint is never invented


def test_incremental_stream_totals_do_not_depend_on_the_progress_buffer(spark, tmp_path, zones):
    schema = read_json_documents(spark, zones.raw).schema
    for i in range(11):
        _write(zones.raw, f"more{i}.json", json.dumps([dict(FIXTURE, cca3=str(i))]))
    _write(zones.raw, "broken.json", BROKEN)
    saved = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        result = run_incremental_transform(
            spark, zones.raw, str(tmp_path / "many"), schema, str(tmp_path / "ck5"), max_files_per_trigger=1
        )
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", saved)
    assert (result["rows"], result["corrupt_rows"]) == (12, 1)


def test_empty_input_keeps_previous_zones(spark, zones, tmp_path):
    from tablezones.errors import EmptyInputError

    run_end_to_end(spark, zones)
    empty_raw = str(tmp_path / "empty_raw")
    os.makedirs(empty_raw)
    with open(os.path.join(empty_raw, "e.json"), "w") as fh:
        fh.write("[]")
    with pytest.raises(EmptyInputError):
        structure(spark, empty_raw, zones.foundation, schema=read_parquet(spark, zones.foundation).schema)
    assert read_parquet(spark, zones.foundation).count() == 1
    assert read_parquet(spark, zones.trusted).count() == 1


def test_structure_rebalances_few_large_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "one.json", "w") as fh:
        json.dump([dict(FIXTURE, ccn3=str(i)) for i in range(200)], fh)
    out = str(tmp_path / "foundation")
    report = structure(spark, str(raw), out, num_files=4)
    assert report.rows == 200
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 4
    assert read_parquet(spark, out).select("ccn3").distinct().count() == 200


def test_save_stage_wiring_without_a_database(spark, zones, monkeypatch):
    """The save stage up to the JDBC writer: complex columns encoded, rows
    counted in the same pass, empty input gated. The JDBC ``save`` call is
    replaced by the no-op sink because no database may be started here."""
    from pyspark.sql.readwriter import DataFrameWriter

    from tablezones.plans import save

    calls = []

    def fake_save(self, *args, **kwargs):
        calls.append(self._df.dtypes)
        self._df._jdf.write().format("noop").mode("overwrite").save()

    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    reports = run_end_to_end(spark, zones, jdbc={"url": "jdbc:mysql://db:3306/x", "table": "countries"})
    assert reports["save"].written and reports["save"].rows == 1
    assert calls and all(t in ("string", "boolean", "double") for _, t in calls[-1])
    # an empty trusted table never reaches the writer
    empty = str(zones.trusted) + "_empty"
    read_parquet(spark, zones.trusted).limit(0).write.parquet(empty)
    before = len(calls)
    assert not save(spark, empty, "jdbc:mysql://db:3306/x", "countries").written
    assert len(calls) == before


def test_incremental_stream_counts_across_micro_batches(spark, tmp_path, zones):
    structure(spark, zones.raw, zones.foundation)
    schema = read_parquet(spark, zones.foundation).schema
    for i in range(2):
        with open(os.path.join(zones.raw, f"more{i}.json"), "w") as fh:
            json.dump([dict(FIXTURE, name={"common": f"C{i}", "official": f"O{i}"})], fh)
    trusted = str(tmp_path / "stream_batches")
    result = run_incremental_transform(
        spark, zones.raw, trusted, schema, checkpoint=str(tmp_path / "ck4"), max_files_per_trigger=1
    )
    assert result["rows"] == 3 and result["corrupt_rows"] == 0
    out = read_parquet(spark, trusted)
    assert out.count() == 3 and out.select("country_id").distinct().count() == 3


def test_incremental_stream_misses_no_file_that_lands_or_is_archived_meanwhile(spark, tmp_path, zones, monkeypatch):
    """A bad and a good file land after the raw zone was read, then the raw files are archived one by one."""
    from tablezones.streaming import incremental

    schema = read_json_documents(spark, zones.raw).schema
    trusted, archive = str(tmp_path / "stream_race"), str(tmp_path / "archive")
    record = lambda name: json.dumps([dict(FIXTURE, name={"common": name, "official": "o"})])
    run = lambda: run_incremental_transform(spark, zones.raw, trusted, schema, str(tmp_path / "ck"), max_files_per_trigger=1, archive_dir=archive)
    follow = incremental.start_quarantine

    def landing(*args, **kw):
        _write(zones.raw, "late_bad.json", BROKEN)
        _write(zones.raw, "late_good.json", record("late"))
        query = follow(*args, **kw)
        query.awaitTermination()
        _write(zones.raw, "later_bad.json", BROKEN)
        return query

    monkeypatch.setattr(incremental, "start_quarantine", landing)
    totals = [run()]
    monkeypatch.setattr(incremental, "start_quarantine", follow)
    for i in range(2):
        _write(zones.raw, f"next{i}.json", record(f"next{i}"))
        totals.append(run())
    assert sum(t["rows"] for t in totals) == 4 and sum(t["corrupt_rows"] for t in totals) == 2
    aside = read_parquet(spark, trusted + "_quarantine")
    assert sorted(os.path.basename(r.file) for r in aside.collect()) == ["late_bad.json", "later_bad.json"]
    assert aside.columns == ["file", "modified", "offset", "text", "parsed"]
    archived = {f for _, _, fs in os.walk(archive) for f in fs}
    assert {"raw.json", "late_bad.json", "late_good.json", "later_bad.json"} <= archived


def test_incremental_stream_completes_a_run_that_stopped_half_way(spark, tmp_path, zones, monkeypatch):
    from tablezones.streaming import incremental

    schema = read_json_documents(spark, zones.raw).schema
    _write(zones.raw, "broken.json", BROKEN)
    trusted = str(tmp_path / "stream_stopped")
    run = lambda: run_incremental_transform(spark, zones.raw, trusted, schema, str(tmp_path / "ck"))

    def fails(*args, **kw):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "start_incremental_transform", fails)
        with pytest.raises(RuntimeError, match="stopped"):
            run()
    result = run()
    assert result["rows"] == 1 and result["corrupt_rows"] == 0  # quarantined by the run that stopped
    assert read_parquet(spark, trusted + "_quarantine").count() == 1 and run()["rows"] == 0


def test_incremental_stream_on_an_empty_zone_and_on_an_old_checkpoint(spark, tmp_path):
    z = Zones.under(str(tmp_path))
    os.makedirs(z.raw)
    schema = "name struct<common:string,official:string>, _document string"
    from pyspark.sql.types import StructType

    run = lambda: run_incremental_transform(spark, z.raw, z.trusted, StructType.fromDDL(schema), str(tmp_path / "ck"))
    assert run() == {"rows": 0, "corrupt_rows": 0} or run()["rows"] == 0
    _write(z.raw, "a.json", json.dumps([{"name": {"common": "c", "official": "o"}, "_document": "a field of that name"}]))
    assert run()["rows"] == 1
    os.makedirs(tmp_path / "ck" / "transform")
    with pytest.raises(ValueError, match="fresh checkpoint"):
        run()
