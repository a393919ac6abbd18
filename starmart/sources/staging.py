"""Raw submissions derived from the driver's TPC-H-like test tables.

One submission per ``lineitem`` row. The order year is the edition, the part is
the book, the customer is the author and the supplier the publisher; nation and
region name the countries. The mapping is fixed so that an independent SQL
engine can derive the very same rows (see ``starmart.oracle``).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.dense_ids import with_dense_id
from starmart.operators.lookup import DEFAULT_BROADCAST_ROWS, broadcast_if_within, stored_bytes, stored_rows
from starmart.operators.spread import scan_splits, spread
from starmart.sources.schemas import RAW_COLUMNS, ROW_KEY

# nation has 25 rows and region 5 in every TPC-H scale; checked before broadcasting.
_GEO_MAX_ROWS = 10_000

# Fixed values of the test mapping.
_GENDER_BY_SEGMENT = (
    ("AUTOMOBILE", "Feminino"),
    ("BUILDING", "Masculino"),
    ("FURNITURE", "Masculino"),
    ("HOUSEHOLD", "Prefiro não informar"),
)
_AGE_BY_PRIORITY = (
    ("1-URGENT", "de 20 a 30 anos"),
    ("2-HIGH", "de 30 a 40 anos"),
    ("3-MEDIUM", "de 40 a 50 anos"),
    ("5-LOW", "de 60 a 70 anos"),
)
_FLAG_MIN_DISCOUNT = (
    ("indicador_semifinalista", 0.045),
    ("indicador_finalista", 0.075),
    ("indicador_vencedor", 0.095),
)
SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
ROW_KEY_FIELDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sized(spark: SparkSession, sf_dir: str, name: str, side: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a side derived from table ``name`` without adding rows, if that table is small."""
    path = f"{sf_dir}/{name}.parquet"
    return broadcast_if_within(side, stored_rows(spark, path), stored_bytes(spark, path), max_rows)


def _lookup_case(c, pairs):
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def _geo(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """nation joined to its region: (<prefix>_nationkey, <prefix>_nation, <prefix>_region)."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _sized(spark, sf_dir, "region", _table(spark, sf_dir, "region").select("r_regionkey", "r_name"), _GEO_MAX_ROWS)
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_nation"),
        F.col("r_name").alias(f"{prefix}_region"),
    )
    # An inner join to a unique key adds no rows: nation's count bounds it.
    return _sized(spark, sf_dir, "nation", geo, _GEO_MAX_ROWS)


def staging_submissions(
    spark: SparkSession, sf_dir: str, broadcast_rows: int = DEFAULT_BROADCAST_ROWS, workdir: str | None = None
) -> DataFrame:
    """Raw-shaped submissions (16 text columns + year) with a ``row_key``: a struct of
    the fields that order the lines, or with ``workdir`` (a shared folder for the numbered
    lines) their number from 0. Lines are numbered while they are narrow.

    Joins whose side has a checked row count within ``broadcast_rows`` run
    map-side on the line stream; larger sides stay shuffle joins.
    """
    # Of the discount and the two flags just the number of flags hit goes on: one byte a line.
    hit = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    hits = [F.when(hit & (F.col("l_discount") >= least), 1).otherwise(0) for _, least in _FLAG_MIN_DISCOUNT]
    lineitem = _table(spark, sf_dir, "lineitem").select(*ROW_KEY_FIELDS, reduce(add, hits).cast("byte").alias("hits"))
    row_key = F.struct(*[F.col(c) for c in ROW_KEY_FIELDS])
    if workdir:
        keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "hits"]
        lineitem = with_dense_id(lineitem, list(ROW_KEY_FIELDS), "line_number", workdir=workdir, keep=keep)
        row_key = F.col("line_number") - 1
    lineitem = spread(lineitem, scan_splits(lineitem))

    def sized(name: str, side: DataFrame) -> DataFrame:
        return _sized(spark, sf_dir, name, side, broadcast_rows)

    orders = sized(
        "orders", _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    )
    # Small geography tables join the customer and supplier tables, not the line stream.
    customer = sized(
        "customer",
        _table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        .join(_geo(spark, sf_dir, "cn"), F.col("c_nationkey") == F.col("cn_nationkey"), "inner"),
    )
    supplier = sized(
        "supplier",
        _table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_name", "s_nationkey")
        .join(_geo(spark, sf_dir, "sn"), F.col("s_nationkey") == F.col("sn_nationkey"), "inner"),
    )
    part = sized("part", _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"))

    rows = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    )

    line = F.col("l_linenumber")
    suppkey = F.col("l_suppkey")
    flags = []
    for least_hits, (name, _) in enumerate(_FLAG_MIN_DISCOUNT, 1):  # by ascending discount
        flags.append(
            F.when(F.col("hits") >= least_hits, F.when(line == 1, F.lit("SIM ")).otherwise(F.lit("Sim")))
            .when(line == 7, F.lit(None).cast("string"))
            .otherwise(F.lit("Não"))
            .alias(name)
        )
    no_country = F.col("c_nationkey") == 0

    out = rows.select(
        row_key.alias(ROW_KEY),
        F.year("o_orderdate").cast("int").alias("ano"),
        F.col("p_name").alias("titulo_livro"),
        F.col("p_type").alias("genero_livro"),
        F.col("sn_nation").alias("pais_primeira_edicao"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit(None).cast("string"))
        .when(line % 3 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name"))
        .alias("nome_autor"),
        _lookup_case(F.col("c_mktsegment"), _GENDER_BY_SEGMENT).alias("genero_autor"),
        _lookup_case(F.col("o_orderpriority"), _AGE_BY_PRIORITY).alias("faixa_etaria_autor"),
        F.col("cn_region").alias("nacionaldade_autor"),
        F.when(no_country, F.lit(None).cast("string")).otherwise(F.col("cn_nation")).alias("nome_pais_autor"),
        F.when(no_country, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
        .alias("sigla_pais_iso2"),
        F.when(suppkey % 10 != 0, F.col("s_name"))
        .when(line % 2 == 0, F.lit(" Autopublicação"))
        .otherwise(F.lit("AUTOPUBLICAÇÃO "))
        .alias("nome_editora"),
        F.when(suppkey % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("sn_region")).alias("sede_editora"),
        F.when(suppkey % 2 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://"), F.lower(F.col("s_name"))))
        .alias("site_editora"),
        *flags,
    )
    return out.select(ROW_KEY, *RAW_COLUMNS)
