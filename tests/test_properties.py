"""Property tests: flattening preserves rows and matches a pure-Python model."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tablezones.operators import complex_columns, flatten_complex
from tablezones.plans import transform_countries

SCHEMA = "id long, s struct<a:string,b:long>, arr array<string>, m map<string,long>, txt string"

text = st.one_of(st.none(), st.text(max_size=12))
small = st.one_of(st.none(), st.integers(min_value=-(2**40), max_value=2**40))
row = st.tuples(
    st.one_of(st.none(), st.fixed_dictionaries({"a": text, "b": small})),
    st.one_of(st.none(), st.lists(text, max_size=4)),
    st.one_of(st.none(), st.dictionaries(st.text(min_size=1, max_size=5), small, max_size=3)),
    text,
)


def model_struct(s):
    # to_json drops NULL struct fields
    return None if s is None else {k: v for k, v in s.items() if v is not None}


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=0, max_size=40))
def test_flatten_matches_model(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    out = flatten_complex(df)
    assert complex_columns(out) == []
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(data)
    for i, s, arr, m, txt in data:
        r = got[i]
        assert (json.loads(r.s) if r.s is not None else None) == model_struct(s)
        assert (json.loads(r.arr) if r.arr is not None else None) == arr
        assert (json.loads(r.m) if r.m is not None else None) == m
        assert r.txt == txt


FEED = (
    "name struct<common:string,official:string>, capital array<string>, altSpellings array<string>, "
    "latlng array<double>, languages struct<eng:string>"
)
feed_row = st.tuples(
    st.one_of(st.none(), st.fixed_dictionaries({"common": text, "official": text})),
    st.one_of(st.none(), st.lists(text, max_size=3)),
    st.one_of(st.none(), st.lists(text, max_size=3)),
    st.one_of(st.none(), st.lists(st.floats(allow_nan=False, width=32), max_size=3)),
    st.one_of(st.none(), st.fixed_dictionaries({"eng": text})),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(feed_row, min_size=0, max_size=30))
def test_transform_preserves_rows_and_joins_like_concat_ws(spark, rows):
    df = spark.createDataFrame(rows, FEED)
    out = transform_countries(df).collect()
    assert len(out) == len(rows)
    by_capital = sorted(r.Thu_do for r in out)
    assert by_capital == sorted("|".join(x for x in (c or []) if x is not None) for _, c, _, _, _ in rows)
    assert sorted(r.su_dung_tieng_anh for r in out) == sorted(
        bool(lang and lang["eng"] is not None) for *_, lang in rows
    )


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=30)), st.lists(text, max_size=3)), min_size=1, max_size=40),
    st.integers(min_value=1, max_value=7),
)
def test_landing_round_trips_any_text(spark, tmp_path_factory, rows, per_doc):
    from tablezones.sinks import land_json_documents
    from tablezones.sources import read_json_documents

    data = [(i, t, arr) for i, (t, arr) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, t string, arr array<string>").repartition(3)
    path = str(tmp_path_factory.mktemp("land"))
    report = land_json_documents(df, path + "/raw", records_per_document=per_doc)
    assert report.rows == len(data)
    back = read_json_documents(spark, path + "/raw", schema="id long, t string, arr array<string>", on_corrupt="fail")
    got = sorted((r.id, r.t, r.arr) for r in back.collect())
    assert got == sorted(data)


@settings(max_examples=15, deadline=None)
@given(st.permutations(["a", "b", "c", "d"]), st.integers(min_value=0, max_value=4))
def test_rename_is_a_simultaneous_permutation(spark, perm, k):
    from tablezones.operators import rename_columns

    names = ["a", "b", "c", "d"]
    mapping = dict(list(zip(names, perm))[:k])  # rename the first k columns
    result = [mapping.get(c, c) for c in names]
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    if len(set(result)) < len(result):
        import pytest

        from tablezones.errors import RenameCollisionError

        with pytest.raises(RenameCollisionError):
            rename_columns(df, mapping)
        return
    out = rename_columns(df, mapping)
    assert out.columns == result
    assert tuple(out.first()) == (1, 2, 3, 4)
