"""The driver's star-schema tables reshaped into the 33-column raw ledger.

This is the test input of the library: it stands in for a raw file. Missing values, padding,
accounting negatives and unreadable cells are injected by rule so that every operator has
something to find, and some rows repeat. Money is built from whole cents, so no floating-point text enters a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payments_lake.functions import nullify_tokens, row_hash
from payments_lake.schema import RAW_COLUMNS, ROW_HASH, ROW_ID

TABLES = ["lineitem", "orders", "customer", "part", "supplier", "nation", "region"]

_PAID = (
    "cast(round(l_extendedprice * 100) as bigint)"
    " * (case when l_returnflag = 'R' and l_linenumber = 1 then -1 else 1 end)"
    " * (case when l_linenumber = 6 and l_quantity = 50 then 0"
    " when l_linenumber = 2 and l_quantity = 50 then 100000"
    " when l_linenumber = 2 and l_quantity > 40 then 1000"
    " when l_linenumber = 2 and l_quantity > 30 then 100 else 1 end)"
)
_PENDING = (
    "case when l_linestatus = 'O' and l_quantity < 10 and n_nationkey < 20"
    " then cast(round(l_extendedprice * 10) as bigint) else cast(0 as bigint) end"
    " * (case when l_quantity = 3 then -1 when l_quantity = 4 then 10000000 else 1 end)"
)
_ENCUMBRANCE = (
    "case when l_returnflag = 'N' then null"
    " else cast(round(l_extendedprice * l_discount * 100) as bigint)"
    " * (case when l_quantity = 5 then -1 when l_quantity = 6 then 10000000 else 1 end) end"
)
_RETAINAGE = (
    "case when l_linenumber = 7 then cast(round(l_extendedprice) as bigint)"
    " * (case when l_quantity = 8 then -1 when l_quantity = 9 then 100000000 else 1 end)"
    " else cast(0 as bigint) end"
)
CENTS = {"paid_c": _PAID, "pend_c": _PENDING, "enc_c": _ENCUMBRANCE, "ret_c": _RETAINAGE}


# How often a row stands in the file; only the row id tells copies apart.
COPIES = (
    "case when l_linenumber = 5 and l_quantity = 17 then 3"
    " when l_linenumber = 5 and l_quantity = 18 then 2 else 1 end"
)


def _money(cents: str) -> str:
    return (
        f"case when {cents} is null then null else concat("
        f"case when {cents} < 0 then '(' else '' end, '$', "
        f"cast(cast(floor(abs({cents}) / 100000) as bigint) as string), ',', "
        f"lpad(cast(cast(floor(abs({cents}) / 100) as bigint) % 1000 as string), 3, '0'), '.', "
        f"lpad(cast(abs({cents}) % 100 as string), 2, '0'), "
        f"case when {cents} < 0 then ')' else '' end) end"
    )


def _day(moment: str) -> str:
    return f"replace(substr(cast({moment} as string), 1, 10), '-', '/')"


_NO_DEPARTMENT = "l_linenumber = 7 and l_tax = 0.08"
_NO_PROGRAM = "l_linenumber = 2 and l_discount = 0.1"
_NO_CATEGORY = "l_linenumber = 1 and l_tax = 0.0 and l_discount = 0.0"

# One SQL expression per raw column, readable by Spark and by the oracle engine.
EXPRESSIONS = dict(
    zip(
        RAW_COLUMNS,
        [
            "case when l_linenumber = 6 and l_quantity = 11 then 'FY02'"
            " when l_linenumber = 6 and l_quantity = 12 then ' 1997.0 '"
            " when l_linenumber = 6 and l_quantity = 13 then '19980'"
            " when l_linenumber = 6 and l_quantity = 14 then null else"
            " cast(year(o_orderdate) + case when month(o_orderdate) >= 7 then 1 else 0 end"
            " as string) end",
            "case when n_nationkey % 5 = 0 then 'YES' else 'NO' end",
            "cast(r_regionkey as string)",
            "r_name",
            f"case when {_NO_DEPARTMENT} then null"
            " else concat('D', lpad(cast(n_nationkey as string), 2, '0')) end",
            f"case when {_NO_DEPARTMENT} then null"
            " when l_linenumber = 5 and n_nationkey % 4 = 3 then lower(n_name) else n_name end",
            f"case when {_NO_PROGRAM} then null else substr(p_type, 1, 3) end",
            f"case when {_NO_PROGRAM} then null else p_type end",
            "case when c_mktsegment < 'C' then 'NON_PERS_SVCS' else 'MTL_SUPP' end",
            "case when c_mktsegment < 'C' then 'Non-Personnel Services'"
            " else 'Materials & Supplies' end",
            "case when p_size <= 25 then 'TRAVEL' else 'TRAINING' end",
            "case when p_size <= 25 then 'Travel' else 'Training' end",
            "cast(500000 + p_size % 2 as string)",
            "p_name",
            "concat(o_orderstatus, '_FUND')",
            "case when o_orderstatus = 'F' then 'Enterprise Funds'"
            " when o_orderstatus = 'O' then 'General Fund' else 'Special Revenue' end",
            "concat(o_orderstatus, '_FUND~OP')",
            "concat(c_mktsegment, ' Fund')",
            f"case when {_NO_CATEGORY} then null else substr(o_orderpriority, 1, 1) end",
            f"case when {_NO_CATEGORY} then null"
            " when l_linenumber = 3 and l_discount = 0.05 then 'Other'"
            " when l_linenumber = 3 and l_discount = 0.06 then ' NA '"
            " when l_linenumber = 3 and l_discount = 0.07 then ' Unknown'"
            " else substr(o_orderpriority, 3) end",
            "case when l_linenumber = 4 then 'Direct Payments'"
            " when l_linenumber = 3 and l_tax = 0.01 then ' Direct Payments '"
            " else lpad(cast(l_orderkey as string), 10, '0') end",
            "case when l_linenumber = 5 then lower(s_name)"
            " when l_linenumber = 6 and l_quantity = 15 then null"
            " when l_linenumber = 3 then concat('  ', s_name, ' ') else s_name end",
            _money("paid_c"),
            "case when l_linenumber = 7 and l_quantity = 2 then 'pending'"
            f" else {_money('pend_c')} end",
            _money("enc_c"),
            _money("ret_c"),
            f"concat({_day('l_shipdate')},"
            " case when l_linestatus = 'F' then ' 02:32:12 PM' else ' 12:05:00 AM' end)",
            "case when l_linenumber = 4 and l_quantity = 14 then '1990/01/01 03:01:24 AM'"
            " when l_linenumber = 6 and l_quantity = 16 then 'N/A'"
            " when l_linenumber = 1 then '2002/01/02 03:01:24 AM'"
            " else '2002/01/01 03:01:24 AM' end",
            "case when l_linestatus = 'F' and l_linenumber <= 2 then 'X'"
            " when l_linestatus = 'F' and l_linenumber = 3 then ' x ' else null end",
            "case when l_returnflag = 'A' then concat(cast(1000000000 + l_partkey as string), '.0')"
            " else null end",
            "case when l_returnflag = 'A' then concat('Contract ', p_name) else null end",
            "case when l_returnflag = 'N' then null"
            " when l_linenumber = 7 and l_quantity = 1 then 'unknown'"
            f" else {_day('o_orderdate')} end",
            "case when l_returnflag = 'R' then 'Term Contract'"
            " when l_returnflag = 'A' then 'N/A' else null end",
        ],
        strict=True,
    )
)


def joined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its parents. Nothing is hinted: Spark broadcasts the parents whose size
    allows it and sorts or hashes the others, with skewed keys split at run time.

    Parts and orders, which grow with lineitem, come first, while its rows are narrow: what the
    smaller tables add to a row is long and would be shuffled along. Supplier, nation and region join
    one after the other, each by its own size: of a join Spark expects the product of both sizes,
    which would shuffle lineitem for a few suppliers.
    """
    t = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    order = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )


# Identity of a copy of a lineitem row, equal for identical rows only. Spelled without doubles, whose
# text differs between engines.
ROW_IDENTITY = (
    "md5(concat_ws('|', cast(l_orderkey as string), cast(l_linenumber as string),"
    " cast(l_partkey as string), cast(l_suppkey as string),"
    " cast(cast(round(l_quantity * 100) as bigint) as string),"
    " cast(cast(round(l_extendedprice * 100) as bigint) as string),"
    " cast(cast(round(l_discount * 100) as bigint) as string),"
    " cast(cast(round(l_tax * 100) as bigint) as string),"
    " l_returnflag, l_linestatus, cast(l_shipdate as string), cast(copy as string)))"
)


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells as a raw file would hold them: 33 text columns, and a row id.

    The tables have no file order, so the id is a hash of the lineitem row.
    """
    copies = F.sequence(F.lit(1), F.expr(COPIES))
    cents = joined_tables(spark, sf_dir).withColumn("copy", F.explode(copies)).select(
        "*", *[F.expr(sql).alias(name) for name, sql in CENTS.items()]
    )
    return cents.select(
        *[F.expr(sql).alias(name) for name, sql in EXPRESSIONS.items()],
        F.expr(ROW_IDENTITY).alias(ROW_ID),
    )


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge as landing would store it: missing cells are null, rows carry their hash."""
    return as_landed(bridge(spark, sf_dir))


def as_landed(cells: DataFrame, *more: Column) -> DataFrame:
    """Cells as landing would store them, next to ``more`` columns."""
    landed = cells.select(
        *[nullify_tokens(F.col(name)).alias(name) for name in RAW_COLUMNS], ROW_ID, *more
    )
    return landed.withColumn(ROW_HASH, row_hash(RAW_COLUMNS))
