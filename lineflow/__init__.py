"""lineflow: schema-on-write time-series rows on Spark DataFrames."""

from lineflow.operators.batch import by_bytes, by_interval, by_rows
from lineflow.operators.decode import decode_binary, decode_text
from lineflow.operators.encode import encode
from lineflow.operators.schema import annotate, columns, merge, tables
from lineflow.plans.query import project, query, result_set
from lineflow.plans.spec import Field, RowSpec, SpecError
from lineflow.sources.config import ConfigError, Options, from_config, from_env
from lineflow.sources.sink import register, save

__all__ = [
    "ConfigError", "Field", "Options", "RowSpec", "SpecError", "annotate", "by_bytes", "by_interval", "by_rows", "columns",
    "decode_binary", "decode_text", "encode", "from_config", "from_env", "merge", "project", "query", "register",
    "result_set", "save", "tables",
]
