"""Constants the output must reproduce exactly, kept in one place.

They define the countries table (column names, key namespace, translation
codes, separators) and the serving-table writer settings. Everything else in
the package is derived from the data's schema.
"""

# Namespace of the UUIDv5 row keys.
KEY_NAMESPACE = "9a5963f8-5a5c-4b8c-aa46-1068af074546"

# The key is built from these fields of the `name` struct, joined by this separator.
KEY_SOURCE_COLUMN = "name"
KEY_SOURCE_FIELDS = ("common", "official")
KEY_SEPARATOR = " - "
KEY_COLUMN = "country_id"

# The feed columns kept, in output order.
ALLOW_LIST = (
    "name", "ccn3", "cca3", "latlng", "independent", "status", "translations",
    "capital", "altSpellings", "languages", "region", "area", "maps", "timezones",
    "continents", "flags", "startOfWeek",
)

# Array columns joined into one string, and the separator.
PIPE_JOINED = ("capital", "altSpellings", "continents")
JOIN_SEPARATOR = "|"

# Translation codes given their own column, in this order, and the column prefix.
TRANSLATION_CODES = ("eng", "fra", "spa", "deu", "ita", "por", "rus", "ara", "zho", "jpn")
TRANSLATION_PREFIX = "translation_"

# Derived columns (output name: source column, nested key or position).
LAT = ("lat", "latlng", 0)
LNG = ("lng", "latlng", 1)
ENGLISH_FLAG = ("su_dung_tieng_anh", "languages", "eng")
GOOGLE_MAPS = ("Google_Maps", "maps", "googleMaps")
FIRST_TIMEZONE = ("timezone_1", "timezones", 0)
SVG_FLAG = ("svg_flags", "flags", "svg")

# Output names of the renamed feed columns.
RENAMES = {
    "name": "Dat_nuoc",
    "independent": "Doc_lap",
    "status": "Trang_thai",
    "capital": "Thu_do",
    "altSpellings": "Ten_thay_the",
    "region": "Khu_vuc",
    "area": "dien_tich",
    "maps": "ban_do",
    "timezones": "Mui_gio",
    "continents": "Luc_dia",
    "flags": "Quoc_ky",
    "startOfWeek": "Ngay_bat_dau_tuan",
}

# Serving-table writer settings.
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"
MYSQL_TABLE_OPTIONS = "ENGINE=InnoDB DEFAULT CHARSET=utf8mb4 COLLATE=utf8mb4_unicode_ci"
JDBC_BATCH_SIZE = 1000
JDBC_ISOLATION_LEVEL = "NONE"
