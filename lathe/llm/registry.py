"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query names and their modules; the module has query(spark, sf_dir) and, where SQL can express it, ORACLE_SQL.
MODULES = {
    "op1_sentencepiece": "sentencepieces",
    "op7_simhash": "simhash",
    "op8_token_shards": "tokenbin",
    "op4_piecewise": "piecewise",
    "op5_licenses": "licenses",
    "op6_quality": "quality",
    "op9_url_rules": "urlrules",
    "op10_decontamination": "decontaminate",
    "op2_line_dedup": "linededup",
    "op3_warc_audit": "warcaudit",
}


def _module(name: str):
    return importlib.import_module(f"lathe.llm.{MODULES[name]}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {x: _module(x).query for x in MODULES}


def oracle_sql() -> dict[str, str]:
    return {x: sql for x in MODULES if (sql := getattr(_module(x), "ORACLE_SQL", None))}
