"""DuckDB SQL oracles, one per query key in :mod:`tablezones.registry`.

Run by the checker against the same Parquet tables registered as views. JSON
text rules: Spark drops NULL struct fields, DuckDB prints them, so oracles
build such objects by CASE; a NULL array joins to '' in Spark, hence the
``coalesce``.
"""

from __future__ import annotations

# The nested test bed, rebuilt from the flat tables.
_E = (
    "WITH pr AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS alt FROM orders GROUP BY 1), "
    "e AS (SELECT c_custkey AS id, c_name AS common, c_mktsegment AS official, n_nationkey AS nk, n_regionkey AS rk, "
    "n_name, r_name, c_acctbal, CASE WHEN n_nationkey % 7 <> 3 THEN alt END AS alt FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "LEFT JOIN pr ON o_custkey = c_custkey)"
)

_HASH = (
    "h AS (SELECT id, sha1(unhex('9a5963f85a5c4b8caa461068af074546') || encode(common || ' - ' || official)) AS h FROM e)"
)
_UUID = (
    "substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||"
    "substr('89ab',(strpos('0123456789abcdef',substr(h,17,1))-1)%4+1,1)||substr(h,18,3)||'-'||substr(h,21,12)"
)

# Every column of the test bed, nested ones as JSON text.
_LATLNG = "CASE WHEN nk % 5 <> 0 THEN to_json([nk::DOUBLE, rk::DOUBLE])::VARCHAR ELSE '[]' END"
_CAPITAL = "CASE WHEN nk % 5 <> 0 THEN to_json([n_name])::VARCHAR ELSE '[]' END"
_LANGUAGES = "CASE WHEN nk % 2 = 0 THEN to_json({'eng': n_name, 'fra': r_name}) ELSE to_json({'fra': r_name}) END::VARCHAR"
_DEU = "to_json({'common': n_name, 'official': r_name})::VARCHAR"
_FRA = "to_json({'common': r_name, 'official': n_name})::VARCHAR"
_TRANSLATIONS = (
    "to_json({'deu': {'common': n_name, 'official': r_name}, 'fra': {'common': r_name, 'official': n_name}})::VARCHAR"
)
_MAPS = "to_json({'googleMaps': 'https://m/' || id})::VARCHAR"
_FLAGS = "to_json({'png': 'https://f/' || nk || '.png'})::VARCHAR"
_FLAT = (
    "id, to_json({'common': common, 'official': official})::VARCHAR AS name, lpad(nk::VARCHAR,3,'0') AS ccn3, "
    f"{_LATLNG} AS latlng, c_acctbal > 0 AS independent, {_CAPITAL} AS capital, to_json(alt)::VARCHAR AS \"altSpellings\", "
    f"{_LANGUAGES} AS languages, {_TRANSLATIONS} AS translations, {_MAPS} AS maps, {_FLAGS} AS flags, "
    "to_json(['UTC', official])::VARCHAR AS timezones, to_json([r_name])::VARCHAR AS continents, r_name AS region"
)
_ATTRS = "to_json({'seg': official, 'reg': r_name})::VARCHAR AS attrs"
_FLAT_SQL = f"{_E} SELECT {_FLAT} FROM e"

_TRUSTED = (
    "id, to_json({'common': common, 'official': official})::VARCHAR AS \"Dat_nuoc\", "
    f"lpad(nk::VARCHAR,3,'0') AS ccn3, {_LATLNG} AS latlng, c_acctbal > 0 AS \"Doc_lap\", {_TRANSLATIONS} AS translations, "
    "CASE WHEN nk % 5 <> 0 THEN n_name ELSE '' END AS \"Thu_do\", "
    "coalesce(array_to_string(alt,'|'),'') AS \"Ten_thay_the\", "
    f"{_LANGUAGES} AS languages, r_name AS \"Khu_vuc\", {_MAPS} AS ban_do, to_json(['UTC', official])::VARCHAR AS \"Mui_gio\", "
    f"r_name AS \"Luc_dia\", {_FLAGS} AS \"Quoc_ky\", "
    "CASE WHEN nk % 5 <> 0 THEN nk::DOUBLE END AS lat, CASE WHEN nk % 5 <> 0 THEN rk::DOUBLE END AS lng, "
    f"nk % 2 = 0 AS su_dung_tieng_anh, {_FRA} AS translation_fra, {_DEU} AS translation_deu, "
    "'https://m/' || id AS \"Google_Maps\", 'UTC' AS timezone_1, NULL::VARCHAR AS svg_flags"
)

_KEY = f"{_E}, {_HASH} SELECT id, {_UUID} AS country_id FROM h"
_TRUSTED_SQL = f"{_E}, {_HASH} SELECT {_TRUSTED}, {_UUID} AS country_id FROM e JOIN h USING (id)"

# Name, whether nested, and SQL value of every column of the test bed, for the profile.
_PROFILED = (
    ("id", False, "id"), ("name", True, "1"), ("ccn3", False, "nk"), ("latlng", True, "1"), ("independent", False, "c_acctbal"),
    ("capital", True, "1"), ("altSpellings", True, "alt"), ("languages", True, "1"), ("translations", True, "1"), ("maps", True, "1"),
    ("flags", True, "1"), ("timezones", True, "1"), ("continents", True, "1"), ("region", False, "r_name"), ("attrs", True, "1"),
)

ORACLES: dict[str, str] = {
    "src_parquet_scan": "SELECT * FROM customer",
    "src_json_lines": "SELECT * FROM events",
    "src_json_multiline": _FLAT_SQL,
    "src_json_ranges": _FLAT_SQL,
    "src_missing_path": "SELECT * FROM supplier",
    "snk_parquet_overwrite": "SELECT * FROM orders",
    "snk_jdbc_overwrite": f"{_E} SELECT {_FLAT}, {_ATTRS} FROM e",
    "gate_nonempty": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "prj_select_present": "SELECT p_partkey, p_name, p_size FROM part",
    "prj_with_columns": (
        "SELECT * REPLACE (upper(l_returnflag) AS l_returnflag), l_linenumber * 2 AS twice FROM lineitem"
    ),
    "prj_rename_map": 'SELECT r_regionkey AS ma_khu_vuc, r_name AS "Khu_vuc" FROM region',
    "prj_struct_field": f"{_E} SELECT id, common AS name_common, official AS name_official FROM e",
    "prj_array_item": (
        f"{_E} SELECT id, CASE WHEN nk % 5 <> 0 THEN n_name END AS capital_1, 'UTC' AS timezone_1 FROM e"
    ),
    "prj_cast_double": (
        "SELECT * REPLACE (o_custkey::DOUBLE AS o_custkey, o_orderkey::DOUBLE AS o_orderkey) FROM orders"
    ),
    "prj_field_or_null": f"{_E} SELECT id, 'https://m/' || id AS \"Google_Maps\", NULL::VARCHAR AS svg_flags FROM e",
    "pred_is_not_null": f"{_E} SELECT id, nk % 2 = 0 AS su_dung_tieng_anh FROM e",
    "str_concat_ws": f"{_E} SELECT id, common || ' - ' || official AS name1 FROM e",
    "str_array_join": (
        f"{_E} SELECT id, coalesce(array_to_string(alt,'|'),'') AS \"altSpellings\", "
        "CASE WHEN nk % 5 <> 0 THEN n_name ELSE '' END AS capital FROM e"
    ),
    "json_encode_struct": (
        f"{_E} SELECT id, CASE WHEN nk % 2 = 0 THEN to_json({{'eng': n_name, 'fra': r_name}}) "
        "ELSE to_json({'fra': r_name}) END::VARCHAR AS languages FROM e"
    ),
    "json_encode_array": (
        f"{_E} SELECT id, to_json(alt)::VARCHAR AS alt, CASE WHEN nk % 5 <> 0 THEN "
        "to_json([nk::DOUBLE, rk::DOUBLE])::VARCHAR ELSE '[]' END AS latlng FROM e"
    ),
    "json_encode_map": f"{_E} SELECT id, to_json({{'seg': official, 'reg': r_name}})::VARCHAR AS attrs FROM e",
    "flatten_complex": f"{_E} SELECT {_FLAT}, {_ATTRS} FROM e",
    "json_extract_variants": (
        f"{_E} SELECT id, to_json({{'common': r_name, 'official': n_name}})::VARCHAR AS translation_fra, "
        "to_json({'common': n_name, 'official': r_name})::VARCHAR AS translation_deu, "
        "to_json({'deu': {'common': n_name, 'official': r_name}, 'fra': {'common': r_name, 'official': n_name}})"
        "::VARCHAR AS translations FROM e"
    ),
    "key_uuid5_native": _KEY,
    "key_uuid5_udf": _KEY,
    "join_attach_key": _KEY,
    "agg_count": "SELECT count(*) AS n_rows FROM lineitem",
    "agg_map_sum": "SELECT sum(l_linenumber * 2)::BIGINT AS total FROM lineitem",
    "lim_preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "profile_columns": (
        _E + " UNION ALL ".join(
            f" SELECT '{name}' AS column_name, {str(nested).lower()} AS is_complex, count(*) AS n_rows, "
            f"count(*) FILTER (({value}) IS NULL) AS n_nulls FROM e"
            for name, nested, value in _PROFILED
        )
    ),
    "profile_sketches": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, "
        "true AS distinct_ok, true AS ranks_ok, true AS top_ok FROM lineitem"
        for c in ("l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    ),
    "pipe_structure": _FLAT_SQL,
    "pipe_transform": _TRUSTED_SQL,
    "pipe_save": _TRUSTED_SQL,
    "pipe_end_to_end": _TRUSTED_SQL,
    "pipe_transform_stream": _TRUSTED_SQL,
    "pipe_changes": (
        "WITH b AS (SELECT o_orderkey AS k, 'O' AS status FROM orders WHERE o_orderstatus <> 'P'), "
        "a AS (SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW') "
        "SELECT coalesce(a.k, b.k) AS o_orderkey, CASE WHEN b.k IS NULL THEN 'inserted' WHEN a.k IS NULL THEN 'deleted' "
        "ELSE 'changed' END AS change, (b.k IS NOT NULL)::BIGINT AS n_old, (a.k IS NOT NULL)::BIGINT AS n_new, 1::INTEGER AS version "
        "FROM b FULL JOIN a ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.status <> b.status"
    ),
}
