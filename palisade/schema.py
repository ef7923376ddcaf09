"""The 43-column connection layout and the numeric / categorical column split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: column order of a connection record -----------------------
CONNECTION_COLUMNS = """
duration protocol_type service flag src_bytes dst_bytes land wrong_fragment urgent hot
num_failed_logins logged_in num_compromised root_shell su_attempted num_root
num_file_creations num_shells num_access_files num_outbound_cmds is_host_login
is_guest_login count srv_count serror_rate srv_serror_rate rerror_rate srv_rerror_rate
same_srv_rate diff_srv_rate srv_diff_host_rate dst_host_count dst_host_srv_count
dst_host_same_srv_rate dst_host_diff_srv_rate dst_host_same_src_port_rate
dst_host_srv_diff_host_rate dst_host_serror_rate dst_host_srv_serror_rate
dst_host_rerror_rate dst_host_srv_rerror_rate label difficulty
""".split()
TEXT_COLUMNS = {"protocol_type", "service", "flag", "label"}
SMALL_INT_COLUMNS = {
    "land", "logged_in", "root_shell", "su_attempted", "is_host_login", "is_guest_login", "difficulty",
}
# -----------------------------------------------------------------------------


def _type_of(name: str) -> T.DataType:
    if name in TEXT_COLUMNS:
        return T.StringType()
    if name in SMALL_INT_COLUMNS:
        return T.IntegerType()
    return T.DoubleType() if name.endswith("_rate") else T.LongType()


CONNECTION_SCHEMA = T.StructType([T.StructField(c, _type_of(c)) for c in CONNECTION_COLUMNS])


def connection_schema(n_columns: int) -> T.StructType:
    """Schema of a headerless record: 43 = everything, 42 = no difficulty, 41 = features only."""
    if n_columns not in (41, 42, 43):
        raise ValueError(f"a connection record has 41, 42 or 43 fields, not {n_columns}")
    return T.StructType(CONNECTION_SCHEMA.fields[:n_columns])


def quoted(name: str) -> str:
    """Column names made from data values may hold dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    kinds = (T.StringType, T.CharType, T.VarcharType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def column_kinds(df: DataFrame) -> DataFrame:
    """One row per numeric or categorical column: (column, kind)."""
    rows = [(c, "numeric") for c in numeric_columns(df)] + [(c, "categorical") for c in categorical_columns(df)]
    return df.sparkSession.createDataFrame(rows, "column string, kind string")
