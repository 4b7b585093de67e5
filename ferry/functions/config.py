"""Connector configs and option maps as Column expressions.

A registry row carries ``type`` and a JSON ``config``; everything here turns
them into typed fields, validation errors and container-style option lists
without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Connector type names, the config field each needs, the
# option key each config field becomes, and the validation messages.
FILE_EXTRACTOR = "file_extractor"
WEB_SCRAPER = "web_scraper"
JSON_LOADER = "json_loader"
TABLE_READER = "table_reader"
TABLE_LOADER = "table_loader"
CONFIG_FIELDS = {FILE_EXTRACTOR: "url", WEB_SCRAPER: "url", JSON_LOADER: "path"}
OPTION_KEYS = {"url": "URL", "path": "PATH"}
REQUIRED_MESSAGES = {
    FILE_EXTRACTOR: "url is required",
    WEB_SCRAPER: "URL is required",
    JSON_LOADER: "path is required",
}
MISSING_OPTION_MESSAGES = {
    "URL": "URL environment variable not set",
    "PATH": "PATH environment variable not set",
}
UNKNOWN_TYPE_PREFIX = "unknown config type: "
BAD_JSON_MESSAGE = "invalid config JSON"


def config_fields() -> list[str]:
    """The config fields of all known types: ``url``, ``path``, then those of
    types registered later."""
    return list(dict.fromkeys(["url", "path", *CONFIG_FIELDS.values()]))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def queue_name(source_type, connection_id) -> Column:
    """Queue of a connection = source type + '_' + connection id."""
    return F.concat(_c(source_type), F.lit("_"), _c(connection_id))


def output_file(path, connection_id) -> Column:
    """The loader's file name, path + connection id + '.json'."""
    return F.concat(_c(path), _c(connection_id), F.lit(".json"))


def parse_config(type_col, config_col) -> Column:
    """C8 + C9: struct<url, path, …, error> for a (type, config JSON) pair.

    Only the field of the row's own type is kept. ``error`` is null for a
    usable config, else the reason: unknown type, bad JSON, or the required
    field missing or empty.
    """
    t, cfg = _c(type_col), _c(config_col)
    fields = config_fields()
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "_corrupt"]])
    parsed = F.from_json(cfg, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    own = [F.when(t.isin(*[k for k, v in CONFIG_FIELDS.items() if v == f]), parsed[f]).alias(f) for f in fields]
    required = F.lit(None).cast("string")
    for typ, field in CONFIG_FIELDS.items():
        value = parsed[field]
        required = F.when((t == F.lit(typ)) & (F.coalesce(value, F.lit("")) == ""),
                          F.lit(REQUIRED_MESSAGES.get(typ, f"{field} is required"))).otherwise(required)
    bad_json = cfg.isNull() | parsed.isNull() | parsed["_corrupt"].isNotNull()
    error = (F.when(~t.isin(*CONFIG_FIELDS) | t.isNull(),
                    F.concat(F.lit(UNKNOWN_TYPE_PREFIX), F.coalesce(t, F.lit(""))))
             .when(bad_json, F.lit(BAD_JSON_MESSAGE))
             .otherwise(required))
    return F.struct(*own, error.alias("error"))


def config_to_options(type_col, parsed_config) -> Column:
    """Typed config -> option map (``URL`` or ``PATH``)."""
    t, p = _c(type_col), _c(parsed_config)
    empty = F.create_map().cast("map<string,string>")
    return (F.when(t.isin(FILE_EXTRACTOR, WEB_SCRAPER), F.create_map(F.lit("URL"), p["url"]))
            .when(t == F.lit(JSON_LOADER), F.create_map(F.lit("PATH"), p["path"]))
            .otherwise(empty))


def merge_options(*maps) -> Column:
    """C11: later maps win on equal keys (session mapKeyDedupPolicy=LAST_WIN)."""
    return F.map_concat(*[_c(m) for m in maps])


def options_list(m) -> Column:
    """``KEY=value`` strings, keys upper-cased, sorted (Go's order is
    random, so sorting is the only stable form)."""
    return F.array_sort(F.transform(F.map_entries(_c(m)),
                                    lambda e: F.concat(F.upper(e["key"]), F.lit("="), e["value"])))


def options_to_config(type_col, m) -> Column:
    """Option map -> struct<url, path, error> for the row's type."""
    t, mm = _c(type_col), _c(m)
    url, path = F.element_at(mm, "URL"), F.element_at(mm, "PATH")
    error = (F.when(t.isin(FILE_EXTRACTOR, WEB_SCRAPER) & (F.coalesce(url, F.lit("")) == ""),
                    F.lit(MISSING_OPTION_MESSAGES["URL"]))
             .when((t == F.lit(JSON_LOADER)) & (F.coalesce(path, F.lit("")) == ""),
                   F.lit(MISSING_OPTION_MESSAGES["PATH"]))
             .when(~t.isin(*CONFIG_FIELDS) | t.isNull(),
                   F.concat(F.lit(UNKNOWN_TYPE_PREFIX), F.coalesce(t, F.lit("")))))
    return F.struct(F.when(t.isin(FILE_EXTRACTOR, WEB_SCRAPER), url).alias("url"),
                    F.when(t == F.lit(JSON_LOADER), path).alias("path"),
                    error.alias("error"))


def first_id(arr) -> Column:
    """C14: first id of a relation list; null (not an error) when empty."""
    return F.get(_c(arr), 0)
