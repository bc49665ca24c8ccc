"""Driver queries for typed columns and derived expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from wareflow.operators.derive import apply_spec, bind_types
from wareflow.operators.partition import with_prt_path
from wareflow.plans.registry import query, table
from wareflow.session import scratch_path
from wareflow.sinks.files import write_feature_json
from wareflow.sources.text import read_feature_json

# Discount and tax are used by expressions and hidden from the output.
LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "_l_discount", "_l_tax",
                    "'l_returnflag", "'l_linestatus", "'l_shipdate"]
FLAG_EXPRS = [(":net", ":l_extendedprice * (1 - :l_discount)"),
              (":bulky", ":l_quantity >= 40"),
              (":watch", "(:bulky && :net > 50000) || :l_tax > 0.07")]

DERIVE_FLAGS_SQL = """
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey,
       CAST(l_suppkey AS DOUBLE) AS l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
       l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate,
       l_extendedprice * (1 - l_discount) AS net, l_quantity >= 40 AS bulky,
       (l_quantity >= 40 AND l_extendedprice * (1 - l_discount) > 50000) OR l_tax > 0.07 AS watch
FROM lineitem
"""


def derive_flags_df(spark, sf_dir):
    return apply_spec(table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS, FLAG_EXPRS)


@query("derive_flags", DERIVE_FLAGS_SQL)
def derive_flags(spark, sf_dir):
    """Typed lineitem, three sequential columns, discount and tax hidden."""
    return derive_flags_df(spark, sf_dir)


@query("derive_shadow", """
SELECT o_orderkey, o_orderstatus, p2 AS o_totalprice, o_orderpriority, p2 > 300000 AS big
FROM (SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_orderstatus,
             CAST(o_totalprice AS DOUBLE) * 2 AS p2, o_orderpriority FROM orders)
""")
def derive_shadow(spark, sf_dir):
    """A reassigned column is what later expressions see."""
    cols = ["o_orderkey", "'o_orderstatus", "o_totalprice", "'o_orderpriority"]
    exprs = [(":o_totalprice", ":o_totalprice * 2"),
             (":big", ":o_totalprice > 300000")]
    return apply_spec(table(spark, sf_dir, "orders"), cols, exprs)


@pandas_udf(T.IntegerType())
def size_band(size: pd.Series) -> pd.Series:
    """User function for expressions: size bands of ten (1-10 -> 0, ...)."""
    return ((size - 1) // 10).astype("int32")


@query("derive_udf", """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_brand,
       CAST(p_size AS DOUBLE) AS p_size, CAST(p_retailprice AS DOUBLE) AS p_retailprice,
       CAST((p_size - 1) // 10 AS INTEGER) AS size_band,
       ((p_size - 1) // 10 >= 3 AND p_retailprice > 1500) AS premium
FROM part
""")
def derive_udf(spark, sf_dir):
    """A registered (vectorised) function used inside an expression."""
    spark.udf.register("wf_size_band", size_band)
    cols = ["p_partkey", "'p_brand", "p_size", "p_retailprice"]
    exprs = [(":size_band", "wf_size_band(:p_size)"),
             (":premium", ":size_band >= 3 && :p_retailprice > 1500")]
    return apply_spec(table(spark, sf_dir, "part"), cols, exprs)


@query("typed_columns", """
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name,
       CAST(c_nationkey AS DOUBLE) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
       c_mktsegment, TRY_CAST(c_mktsegment AS DOUBLE) AS c_segment_num
FROM customer
""")
def typed_columns(spark, sf_dir):
    """All-text customer rows bound to declared types (bad numbers -> NULL)."""
    cust = table(spark, sf_dir, "customer")
    as_text = cust.select(*[F.col(c).cast("string") for c in cust.columns],
                          F.col("c_mktsegment").alias("c_segment_num"))
    cols = ["c_custkey", "'c_name", "c_nationkey", "c_acctbal", "'c_mktsegment",
            "c_segment_num"]
    return bind_types(as_text, cols, on_bad_number="null")


ROUNDTRIP_COLUMNS = ["'prt_path", "l_orderkey", "l_linenumber", "l_quantity",
                     "_l_extendedprice", "_l_discount", "_l_tax", "'l_returnflag"]


@query("feature_json_roundtrip", """
SELECT 'ship_year=' || strftime(l_shipdate, '%Y') AS prt_path,
       CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(l_quantity AS DOUBLE) AS l_quantity, l_returnflag,
       l_extendedprice * (1 - l_discount) AS net, l_quantity >= 40 AS bulky,
       (l_quantity >= 40 AND l_extendedprice * (1 - l_discount) > 50000) OR l_tax > 0.07 AS watch,
       strftime(l_shipdate, '%Y') AS ship_year
FROM lineitem
""")
def feature_json_roundtrip(spark, sf_dir):
    """Derived rows written as JSON lines routed by prt_path, read back."""
    li = with_prt_path(table(spark, sf_dir, "lineitem"),
                       [("ship_year", F.date_format("l_shipdate", "yyyy"))])
    derived = apply_spec(li, ROUNDTRIP_COLUMNS, FLAG_EXPRS)
    path = scratch_path(spark, "feature_json")
    write_feature_json(derived, path, ["ship_year"])
    schema = derived.schema.add("ship_year", "string")
    return read_feature_json(spark, path, schema)
