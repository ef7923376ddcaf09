"""Cleaning, encoding, scaling, features, splits and balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.config import FeatureSettings, PreprocessSettings
from palisade.functions.cells import with_binary_label
from palisade.functions.draws import portable_draw
from palisade.operators import cleaning, encoding, features, sampling
from palisade.operators.multiclass import LabelCodes
from palisade.operators.preprocess import Preprocessor
from palisade.plans import views
from palisade.plans.queries.registry import WITH_BIN, WITH_CONN, WITH_DOCS, query
from palisade.schema import quoted


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_binary_label(views.conn(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(quoted(c), digits) for c, t in df.dtypes if t == "double"})


# --- imputation ----------------------------------------------------------------

_MODE = "(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
_FLAG_FILL = f"coalesce(flag, {_MODE.format(c='flag', t='conn')}) AS flag"
_IMPUTED = {
    "mean": "(SELECT avg(dst_bytes) FROM conn)",
    "median": "(SELECT quantile_cont(dst_bytes, 0.5) FROM conn)",
    "most_frequent": _MODE.format(c="dst_bytes", t="conn"),
}


def _imputation(strategy: str) -> None:
    sql = f"""{WITH_CONN} SELECT row_id, {_FLAG_FILL}, round(coalesce(dst_bytes, {_IMPUTED[strategy]}), 6) AS dst_bytes
    FROM conn"""

    @query(f"impute_{strategy}", sql)
    def impute(spark, sf_dir):
        conn = views.conn(spark, sf_dir).select("row_id", "flag", "dst_bytes")
        fills = cleaning.fill_values(conn, ["dst_bytes"], ["flag"], strategy)
        return rounded(cleaning.impute(conn, fills))


for _strategy in _IMPUTED:
    _imputation(_strategy)


# --- duplicates and outliers ---------------------------------------------------

_FEATURES = """duration protocol_type service flag land dst_bytes serror_rate rerror_rate same_srv_rate
num_outbound_cmds""".split()
_NUMBERS = [c for c in _FEATURES if c not in ("protocol_type", "service", "flag")]
_CLEAN = f"""{WITH_BIN}, clean AS (SELECT row_id, label, * EXCLUDE (row_id, label, src_bytes, flag, dst_bytes),
  {_FLAG_FILL}, coalesce(dst_bytes, (SELECT avg(dst_bytes) FROM conn)) AS dst_bytes FROM bin),
raw AS (SELECT * EXCLUDE (src_bytes) FROM bin),
firsts AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(_FEATURES)} ORDER BY row_id) AS copy FROM clean),
survivors AS (SELECT * EXCLUDE (copy) FROM firsts WHERE copy = 1)"""


def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled view without the column that makes every row unique."""
    return labelled(spark, sf_dir).drop("src_bytes")


@query(
    "first_of_duplicates",
    f"{_CLEAN} SELECT raw.row_id, raw.label, {', '.join(f'raw.{c}' for c in _FEATURES)} "
    "FROM raw JOIN survivors s ON raw.row_id = s.row_id",
)
def first_of_duplicates(spark, sf_dir):
    df = _narrow(spark, sf_dir)
    fills = cleaning.fill_values(df, ["dst_bytes"], ["flag"], "mean")
    return cleaning.first_of_each(df, _FEATURES, "row_id", "label", fills)


_BOUNDED = ["src_bytes", "dst_bytes", "rerror_rate", "num_outbound_cmds"]


def _iqr(c: str, share: str = "1.5") -> tuple[str, str]:
    q1, q3 = (f"quantile_cont(CAST({c} AS DOUBLE), {q})" for q in ("0.25", "0.75"))
    return f"{q1} - {share} * ({q3} - {q1})", f"{q3} + {share} * ({q3} - {q1})"


def _bounds_table(bounds: dict[str, tuple[float, float]], spark: SparkSession) -> DataFrame:
    rows = [(c, float(low), float(high)) for c, (low, high) in bounds.items()]
    return rounded(spark.createDataFrame(rows, "feature string, low double, high double"))


@query(
    "iqr_bounds",
    f"{WITH_CONN} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round({_iqr(c)[0]}, 6) AS low, round({_iqr(c)[1]}, 6) AS high FROM conn"
        for c in _BOUNDED
    ),
)
def iqr_bounds(spark, sf_dir):
    return _bounds_table(cleaning.outlier_bounds(views.conn(spark, sf_dir), _BOUNDED, "iqr"), spark)


@query(
    "zscore_bounds",
    f"{WITH_CONN} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg({c}) - 3 * stddev_pop({c}), 6) AS low,
        round(avg({c}) + 3 * stddev_pop({c}), 6) AS high FROM conn HAVING stddev_pop({c}) > 0"""
        for c in _BOUNDED
    ),
)
def zscore_bounds(spark, sf_dir):
    return _bounds_table(cleaning.outlier_bounds(views.conn(spark, sf_dir), _BOUNDED, "zscore"), spark)


_TIGHT = ["src_bytes", "dst_bytes"]
_TIGHT_IQR = ", ".join(
    f"{_iqr(c, '0.25')[0]} AS {c}_low, {_iqr(c, '0.25')[1]} AS {c}_high" for c in _TIGHT
)


@query(
    "rows_inside_iqr",
    f"""{WITH_CONN}, bounds AS (SELECT {_TIGHT_IQR} FROM conn)
    SELECT conn.* FROM conn, bounds
    WHERE NOT (coalesce(src_bytes < src_bytes_low OR src_bytes > src_bytes_high, FALSE)
            OR coalesce(dst_bytes < dst_bytes_low OR dst_bytes > dst_bytes_high, FALSE))""",
)
def rows_inside_iqr(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    return cleaning.drop_outliers(conn, cleaning.outlier_bounds(conn, _TIGHT, "iqr", 0.25))


@query(
    "rows_inside_zscore",
    """WITH bounds AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
    SELECT o_orderkey, o_totalprice FROM orders, bounds WHERE o_totalprice BETWEEN m - 3 * s AND m + 3 * s""",
)
def rows_inside_zscore(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return cleaning.drop_outliers(orders, cleaning.outlier_bounds(orders, ["o_totalprice"], "zscore"))


# --- encoding and scaling ------------------------------------------------------

_LEVELS = {
    "protocol_type": ["icmp", "tcp", "udp"],
    "service": ["ftp", "http", "private", "smtp"],
    "flag": ["REJ", "S0", "SF"],
}
_INDICATORS = ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs
)


@query("one_hot", f"{WITH_CONN} SELECT row_id, {_INDICATORS} FROM conn")
def one_hot(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    levels = encoding.categories(conn, list(_LEVELS), limit=10_000)
    return conn.select("row_id", *encoding.indicators(levels))


@query(
    "category_codes",
    f"""{WITH_CONN} SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INT) AS code
    FROM (SELECT DISTINCT 'service' AS "column", service AS value FROM conn UNION ALL
          SELECT DISTINCT 'flag', flag FROM conn WHERE flag IS NOT NULL)""",
)
def category_codes(spark, sf_dir):
    return encoding.code_table(views.conn(spark, sf_dir), ["service", "flag"])


@query(
    "category_encoded",
    f"""{WITH_CONN}, codes AS (SELECT flag AS value, dense_rank() OVER (ORDER BY flag) - 1 AS code
      FROM (SELECT DISTINCT flag FROM conn WHERE flag IS NOT NULL))
    SELECT row_id, CAST(code AS INT) AS flag_code FROM conn LEFT JOIN codes ON conn.flag = codes.value""",
)
def category_encoded(spark, sf_dir):
    conn = views.conn(spark, sf_dir).select("row_id", "flag")
    codes = encoding.code_table(conn, ["flag"])
    return encoding.encode_with(conn, codes, "flag", "flag_code").select("row_id", "flag_code")


_SCALED = ["src_bytes", "serror_rate", "num_outbound_cmds"]
_SPANS = {
    "standard": ("avg({c})", "stddev_pop({c})"),
    "minmax": ("min({c})", "max({c}) - min({c})"),
    "robust": (
        "quantile_cont(CAST({c} AS DOUBLE), 0.5)",
        "quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25)",
    ),
}


def _spans_sql(method: str, table: str, columns: list[str]) -> str:
    centre, spread = _SPANS[method]
    parts = ", ".join(
        f"{centre.format(c=c)} AS {c}_centre, coalesce(nullif({spread.format(c=c)}, 0), 1) AS {c}_spread" for c in columns
    )
    return f"SELECT {parts} FROM {table}"


def _scaled_sql(columns: list[str]) -> str:
    # Adding zero turns a rounded minus zero into zero.
    return ", ".join(f"round(({c} - {c}_centre) / {c}_spread, 6) + 0 AS {c}" for c in columns)


def _scaling_query(method: str) -> None:
    sql = f"""{WITH_CONN}, spans AS ({_spans_sql(method, 'conn', _SCALED)})
    SELECT row_id, {_scaled_sql(_SCALED)} FROM conn, spans"""

    @query(f"scale_{method}", sql)
    def scale(spark, sf_dir):
        conn = views.conn(spark, sf_dir).select("row_id", *_SCALED)
        spans = encoding.scaling(conn, _SCALED, method)
        return _no_minus_zero(conn.select("row_id", *[encoding.scaled(c, *spans[c]) for c in _SCALED]))


def _no_minus_zero(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(quoted(c), 6) + F.lit(0.0) for c, t in df.dtypes if t == "double"})


for _method in _SPANS:
    _scaling_query(_method)


# --- the preprocessing stage ---------------------------------------------------

_SPANNED = f"{_CLEAN}, spans AS ({_spans_sql('standard', 'survivors', _NUMBERS)})"


@query("preprocessed_training_rows", f"{_SPANNED} SELECT row_id, label, {_scaled_sql(_NUMBERS)}, {_INDICATORS} FROM survivors, spans")
def preprocessed_training_rows(spark, sf_dir):
    model, rows = Preprocessor(PreprocessSettings()).fit_rows(_narrow(spark, sf_dir))
    return _no_minus_zero(model.transform(rows))


@query("preprocessed_rows", f"{_SPANNED} SELECT row_id, label, {_scaled_sql(_NUMBERS)}, {_INDICATORS} FROM clean, spans")
def preprocessed_rows(spark, sf_dir):
    df = _narrow(spark, sf_dir)
    return _no_minus_zero(Preprocessor(PreprocessSettings()).fit(df).transform(df))


# --- feature scores and filters ------------------------------------------------


def _f_sql(table: str, label: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(CASE WHEN min(lo) = max(hi) OR sum(n * v) = 0 THEN 0
          ELSE (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) END, 4) AS score
        FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, min({c}) AS lo, max({c}) AS hi,
                (SELECT avg({c}) FROM {table}) AS g FROM {table} GROUP BY {label})"""
        for c in columns
    )


_SCORED = _NUMBERS
_FINITE = f"""{WITH_BIN}, finite AS (SELECT row_id, label, duration, land, coalesce(dst_bytes, 0.0) AS dst_bytes, src_bytes,
  serror_rate, rerror_rate, same_srv_rate, num_outbound_cmds FROM bin)"""


@query("f_scores", f"{_FINITE} {_f_sql('finite', 'label', _SCORED)}")
def f_scores(spark, sf_dir):
    return rounded(features.ranked_importance(labelled(spark, sf_dir), _SCORED, "label"), 4)


@query(
    "f_scores_many_classes",
    f"{WITH_CONN}, finite AS (SELECT * REPLACE (coalesce(dst_bytes, 0.0) AS dst_bytes) FROM conn) "
    + _f_sql("finite", "label", _SCORED),
)
def f_scores_many_classes(spark, sf_dir):
    return rounded(features.ranked_importance(views.conn(spark, sf_dir), _SCORED, "label"), 4)


@query("document_f_scores", f"{WITH_DOCS} {_f_sql('docs', 'toxic', ['n_chars', 'quality'])}")
def document_f_scores(spark, sf_dir):
    return rounded(features.ranked_importance(views.labelled_documents(spark, sf_dir), ["n_chars", "quality"], "toxic"), 4)


def _information_sql(c: str) -> str:
    shares = ", ".join(f"0.{i}" for i in range(1, 10))
    return f"""SELECT '{c}' AS feature, round(greatest(sum(n / t * ln(n * t / (b * k))), 0), 6) AS score FROM (
      SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bin) AS b, sum(n) OVER (PARTITION BY label) AS k FROM (
        SELECT bin, label, CAST(count(*) AS DOUBLE) AS n FROM (
          SELECT label, (SELECT count(*) FROM (
              SELECT DISTINCT unnest(quantile_disc(CAST({c} AS DOUBLE), [{shares}])) AS border FROM finite)
            WHERE f.{c} > border) AS bin
          FROM finite f)
        GROUP BY bin, label))"""


@query("information_scores", f"{_FINITE} " + " UNION ALL ".join(_information_sql(c) for c in _SCORED))
def information_scores(spark, sf_dir):
    return rounded(features.ranked_importance(labelled(spark, sf_dir), _SCORED, "label", "mutual_info"))


_ALL_NUMBERS = "duration land src_bytes dst_bytes serror_rate rerror_rate same_srv_rate num_outbound_cmds".split()
_VARIANCES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}) AS variance FROM finite" for c in _ALL_NUMBERS
)


@query("varying_features", f"{_FINITE} SELECT feature FROM ({_VARIANCES}) WHERE variance > 0")
def varying_features(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _ALL_NUMBERS)
    kept = features.varying_features(clean, _ALL_NUMBERS)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query(
    "features_reaching_variance",
    f"{_FINITE} SELECT feature, round(variance, 4) AS variance FROM ({_VARIANCES}) WHERE variance >= 0.01",
)
def features_reaching_variance(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _ALL_NUMBERS)
    return rounded(features.reaching_variance(clean, _ALL_NUMBERS, 0.01), 4)


_VARYING = _ALL_NUMBERS[:-1]
_PAIRS = " UNION ALL ".join(
    f"SELECT '{b}' AS feature, abs(corr({a}, {b})) AS r FROM finite"
    for j, b in enumerate(_VARYING)
    for a in _VARYING[:j]
)


@query(
    "uncorrelated_features",
    f"""{_FINITE} SELECT feature FROM (VALUES {', '.join(f"('{c}')" for c in _VARYING)}) AS f(feature)
    WHERE feature NOT IN (SELECT feature FROM ({_PAIRS}) WHERE r > 0.95)""",
)
def uncorrelated_features(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _ALL_NUMBERS)
    kept = features.uncorrelated_features(clean, _VARYING)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


_LEAD = _ALL_NUMBERS[:5]
_PRODUCTS = ", ".join(
    f"CAST({a} AS DOUBLE) * {b} AS {a}_x_{b}" for i, a in enumerate(_LEAD) for b in _LEAD[i + 1 :]
)
_SQUARES = ", ".join(f"CAST({c} AS DOUBLE) * {c} AS {c}_pow_2" for c in _LEAD)


@query("interaction_features", f"{_FINITE} SELECT row_id, {_PRODUCTS} FROM finite")
def interaction_features(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _ALL_NUMBERS)
    products, _ = features.derived_names(_ALL_NUMBERS, True, False)
    return features.with_derived(clean, products, []).select("row_id", *[p[2] for p in products])


@query("squared_features", f"{_FINITE} SELECT row_id, {_SQUARES} FROM finite")
def squared_features(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _ALL_NUMBERS)
    _, squares = features.derived_names(_ALL_NUMBERS, False, True)
    return features.with_derived(clean, [], squares).select("row_id", *[s[1] for s in squares])


_POSITIONS = ", ".join(f"('{c}', {i})" for i, c in enumerate(_SCORED))


@query(
    "best_features",
    f"""{_FINITE}, ranked AS (SELECT feature, position, row_number() OVER (ORDER BY score DESC, position DESC) AS place
      FROM ({_f_sql('finite', 'label', _SCORED)}) JOIN (VALUES {_POSITIONS}) AS p(feature, position) USING (feature))
    SELECT feature, CAST(row_number() OVER (ORDER BY position) - 1 AS INT) AS position FROM ranked WHERE place <= 3""",
)
def best_features(spark, sf_dir):
    clean = features.finite_table(labelled(spark, sf_dir), _SCORED)
    kept = features.best_features(clean, _SCORED, "label", 3)
    return spark.createDataFrame([(c, i) for i, c in enumerate(kept)], "feature string, position int")


# The correlation filter drops same_srv_rate and the variance filter num_outbound_cmds.
_STAGE = ["duration", "land", "src_bytes", "dst_bytes", "serror_rate", "rerror_rate"]
_STAGE_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _STAGE)


@query("feature_stage", f"{_FINITE} SELECT row_id, label, {_STAGE_SQL}, {_PRODUCTS}, {_SQUARES} FROM finite")
def feature_stage(spark, sf_dir):
    df = labelled(spark, sf_dir).drop("protocol_type", "service", "flag")
    return features.FeatureEngineer(FeatureSettings(interactions=True, squares=True)).fit(df).transform(df)


_REPLAYED = [c for c in _NUMBERS if c not in ("same_srv_rate", "num_outbound_cmds")]


@query("prepared_features", f"{_SPANNED} SELECT row_id, label, {_scaled_sql(_REPLAYED)}, {_INDICATORS} FROM clean, spans")
def prepared_features(spark, sf_dir):
    df = _narrow(spark, sf_dir)
    preprocess, rows = Preprocessor(PreprocessSettings()).fit_rows(df)
    engineer = features.FeatureEngineer(FeatureSettings()).fit(preprocess.transform(rows))
    return _no_minus_zero(engineer.transform(preprocess.transform(df)))


# --- splits and balancing ------------------------------------------------------

_DRAWN = f"""{WITH_BIN}, drawn AS (SELECT row_id, label,
  CAST('0x' || substr(md5('42:' || row_id), 1, 15) AS BIGINT) AS draw FROM bin)"""


def _split_sql(stratified: bool) -> str:
    label = "label" if stratified else "0"
    return f"""{_DRAWN}, counts AS (SELECT {label} AS c, count(*) AS n, (SELECT count(*) FROM drawn) AS total
      FROM drawn GROUP BY 1),
    shares AS (SELECT c, total, total - CAST(ceil(CAST(0.2 AS DOUBLE) * total - CAST(1e-9 AS DOUBLE)) AS BIGINT) AS train,
      CAST(n * train AS DOUBLE) / total AS share FROM counts),
    sizes AS (SELECT c, CAST(floor(share) AS BIGINT)
      + CASE WHEN row_number() OVER (ORDER BY floor(share) - share, c) <= train - sum(CAST(floor(share) AS BIGINT)) OVER ()
        THEN 1 ELSE 0 END AS size FROM shares)
    SELECT row_id, label, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY draw, row_id) <= size
      THEN 'train' ELSE 'holdout' END AS part
    FROM drawn JOIN sizes ON {label} = sizes.c"""


def _split(spark: SparkSession, sf_dir: str, label: str | None) -> DataFrame:
    df = labelled(spark, sf_dir).select("row_id", "label")
    marked = sampling.holdout_parts(df, row_id="row_id", label=label, draw=portable_draw(42, F.col("row_id")))
    return marked.withColumn("part", F.when(F.col("part") == 0, "train").otherwise("holdout"))


@query("stratified_split", _split_sql(True))
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir, "label")


@query("plain_split", _split_sql(False))
def plain_split(spark, sf_dir):
    return _split(spark, sf_dir, None)


@query(
    "three_way_split",
    f"""{WITH_BIN} SELECT count(*) AS n, count(DISTINCT row_id) AS ids, 0.64::DOUBLE AS train_share,
      0.16::DOUBLE AS validation_share, 0.2::DOUBLE AS test_share FROM bin""",
)
def three_way_split(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "label")
    marked = sampling.three_way_parts(df, row_id="row_id", label="label")
    n = F.count(F.lit(1))
    shares = {"train_share": 0, "validation_share": 1, "test_share": 2}
    return marked.agg(
        n.alias("n"),
        F.countDistinct("row_id").alias("ids"),
        *[F.round(F.count_if(F.col("part") == i) / n, 3).alias(name) for name, i in shares.items()],
    )


def _sizes_sql(name: str, of: str, source: str, output: str) -> str:
    """Largest-remainder sizes of four fifths of the rows that ``source`` counts per class c."""
    return f"""{name}_total AS (SELECT sum({of}) AS total, sum({of}) - CAST(ceil(CAST(0.2 AS DOUBLE) * sum({of}) - CAST(1e-9 AS DOUBLE)) AS BIGINT) AS train FROM {source}),
    {name} AS (SELECT s.*, CAST({of} * train // total AS BIGINT)
      + CASE WHEN row_number() OVER (ORDER BY {of} * train % total DESC, c) <= train - sum({of} * train // total) OVER () THEN 1 ELSE 0 END AS {output}
      FROM {source} s, {name}_total)"""


_BY_PART = """WITH drawn AS (SELECT row_id, c, CAST('0x' || substr(md5('42:' || row_id), 1, 15) AS BIGINT) AS draw FROM (
  SELECT ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber AS row_id, l_partkey AS c FROM lineitem)),
  counts AS (SELECT c, CAST(count(*) AS HUGEINT) AS n FROM drawn GROUP BY c), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY draw, row_id) AS place FROM drawn)"""


def _parts_of_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_id = F.expr(views.ROW_ID).alias("row_id")
    return views.table(spark, sf_dir, "lineitem").select(row_id, F.col("l_partkey").alias("part_key"))


@query(
    "split_of_many_classes",
    f"""{_BY_PART}, {_sizes_sql('sizes', 'n', 'counts', 'train_rows')}
    SELECT row_id, c AS part_key, CASE WHEN place <= train_rows THEN 0 ELSE 1 END AS part FROM placed JOIN sizes USING (c)""",
)
def split_of_many_classes(spark, sf_dir):
    df = _parts_of_lineitem(spark, sf_dir)
    return sampling.holdout_parts(df, row_id="row_id", label="part_key", draw=portable_draw(42, F.col("row_id")))


@query(
    "three_way_rows",
    f"""{_BY_PART}, {_sizes_sql('seen_sizes', 'n', 'counts', 'seen')}, again AS (SELECT c, CAST(seen AS HUGEINT) AS seen FROM seen_sizes),
    {_sizes_sql('sizes', 'seen', 'again', 'train_rows')}
    SELECT row_id, c AS part_key, CASE WHEN place <= train_rows THEN 0 WHEN place <= seen THEN 1 ELSE 2 END AS part FROM placed JOIN sizes USING (c)""",
)
def three_way_rows(spark, sf_dir):
    df = _parts_of_lineitem(spark, sf_dir)
    return sampling.three_way_parts(df, row_id="row_id", label="part_key", draw=portable_draw(42, F.col("row_id")))


@query(
    "undersampled_rows",
    f"""{WITH_CONN}, drawn AS (SELECT row_id, label, row_number() OVER (PARTITION BY label
      ORDER BY CAST('0x' || substr(md5('42:' || row_id), 1, 15) AS BIGINT), row_id) AS place FROM conn)
    SELECT row_id, label FROM drawn
    WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM conn GROUP BY label))""",
)
def undersampled_rows(spark, sf_dir):
    df = views.conn(spark, sf_dir).select("row_id", "label")
    return sampling.undersample(df, row_id="row_id", label="label", draw=portable_draw(42, F.col("row_id")))


@query(
    "oversampled_counts",
    f"""{WITH_CONN}, counts AS (SELECT label, count(*) AS n FROM conn GROUP BY label)
    SELECT label, (SELECT max(n) FROM counts) AS n, TRUE AS from_the_class FROM counts""",
)
def oversampled_counts(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    sampled = sampling.oversample(conn.select("row_id", "label"), row_id="row_id", label="label", times="times")
    own = conn.select(F.col("row_id").alias("id"), F.col("label").alias("own"))
    return (
        sampled.join(own, F.col("row_id") == F.col("id"))
        .groupBy("label")
        .agg(F.sum("times").alias("n"), F.bool_and(F.col("label") == F.col("own")).alias("from_the_class"))
    )


@query(
    "balanced_class_weights",
    f"""{WITH_CONN} SELECT label AS class, round((SELECT count(*) FROM conn) / CAST(count(*) AS DOUBLE)
      / (SELECT count(DISTINCT label) FROM conn), 9) AS weight FROM conn GROUP BY label""",
)
def balanced_class_weights(spark, sf_dir):
    return rounded(sampling.class_weights(views.conn(spark, sf_dir), "label"), 9)


@query("uniform_class_weights", f"{WITH_CONN} SELECT DISTINCT label AS class, CAST(1 AS DOUBLE) AS weight FROM conn")
def uniform_class_weights(spark, sf_dir):
    return sampling.class_weights(views.conn(spark, sf_dir), "label", "uniform")


@query(
    "weighted_rows",
    f"""{WITH_BIN}, counts AS (SELECT label, count(*) AS n FROM bin GROUP BY label)
    SELECT row_id, label, round((SELECT count(*) FROM bin) / (2.0 * n), 9) AS weight
    FROM bin JOIN counts USING (label)""",
)
def weighted_rows(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "label")
    return rounded(sampling.with_class_weight(df, "label"), 9)


# --- class names ---------------------------------------------------------------

_CODES = f"""{WITH_CONN}, codes AS (SELECT label AS value, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS code
  FROM (SELECT DISTINCT label FROM conn))"""


@query("label_mapping", f"{_CODES} SELECT value, code FROM codes")
def label_mapping(spark, sf_dir):
    return LabelCodes("label").fit(views.conn(spark, sf_dir)).mapping


@query("labels_encoded", f"{_CODES} SELECT row_id, label, code FROM conn JOIN codes ON label = value")
def labels_encoded(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    return LabelCodes("label").fit(conn).encode(conn, "code").select("row_id", "label", "code")


@query("labels_decoded", f"{_CODES} SELECT row_id, value AS decoded FROM conn JOIN codes ON code = row_id % 6")
def labels_decoded(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    coded = conn.select("row_id", (F.col("row_id") % 6).cast("int").alias("code"))
    return LabelCodes("label").fit(conn).decode(coded, "code", "decoded").select("row_id", "decoded")
