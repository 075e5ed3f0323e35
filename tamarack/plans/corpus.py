"""Court-like documents rendered from orders, customers and nations: inputs whose answers are known.

Each rendering is a text built from an order's columns, so the expected fields follow from those columns
without reading the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` (order), ``cents``, ``d`` (date), ``cust`` and ``nat``, with the parts of texts made of them."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    rows = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey")).join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.selectExpr("o_orderkey as k", "cast(round(o_totalprice * 100) as bigint) as cents", "cast(o_orderdate as date) as d", "c_name as cust", "n_name as nat")
    # extraction costs far more than these rows weigh, so they are dealt to all cores whatever their size
    rows = rows.repartition(2 * spark.sparkContext.defaultParallelism, "k")
    day = lambda c: f"concat(month({c}), '/', day({c}), '/', year({c}))"
    money = lambda c: f"concat({c} div 100, '.', lpad({c} % 100, 2, '0'))"
    return rows.selectExpr(
        "*", f"{money('cents')} as amt", f"{money('(cents + 12345)')} as amt2",
        f"{day('d')} as m0", f"{day('date_add(d, 15)')} as m15", f"{day('date_add(d, 45)')} as m45",
        "date_format(d, 'MMMM d, yyyy') as t0", "date_format(date_add(d, 30), 'MMMM d, yyyy') as t30", "lpad(k % 1000000, 6, '0') as no",
    )


#: The same columns in DuckDB, with ISO dates.
BASE_SQL = """
with b0 as (
    select o_orderkey as k, cast(round(o_totalprice * 100) as bigint) as cents, cast(o_orderdate as date) as d, c_name as cust, n_name as nat
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
b as (
    select *, cents // 100 || '.' || lpad(cast(cents % 100 as varchar), 2, '0') as amt, (cents + 12345) // 100 || '.' || lpad(cast((cents + 12345) % 100 as varchar), 2, '0') as amt2,
        (2 * cents + 12345) // 100 || '.' || lpad(cast((2 * cents + 12345) % 100 as varchar), 2, '0') as total,
        strftime(d, '%-m/%-d/%Y') as m0, strftime(d, '%Y-%m-%d') as i0, strftime(d + interval 15 day, '%Y-%m-%d') as i15, strftime(d + interval 30 day, '%Y-%m-%d') as i30,
        strftime(d + interval 45 day, '%Y-%m-%d') as i45, strftime(d + interval 15 day, '%-m/%-d/%Y') as m15, strftime(d + interval 45 day, '%-m/%-d/%Y') as m45,
        strftime(d, '%B %-d, %Y') as t0, strftime(d + interval 30 day, '%B %-d, %Y') as t30, lpad(cast(k % 1000000 as varchar), 6, '0') as no
    from b0)
"""

#: A whole agreement, in one of four forms by order.
DOCUMENT = """concat(
    'IN THE FRANKLIN COUNTY MUNICIPAL COURT\\n\\n', nat, ' Properties LLC,\\nPlaintiff,\\n\\nv.\\n\\n', cust, ',\\nDefendant.\\n\\nAGREED ENTRY\\n\\n',
    case k % 4
        when 0 then concat('Defendant shall make these payments:\\n- $', amt, ' on or before ', m15, '\\n- $', amt2, ' on or before ', m45, ' by 5:00 PM\\nThis case is dismissed upon compliance.\\n')
        when 1 then concat('Defendant shall vacate the premises on or before ', t30, ' and return all keys.\\n')
        when 2 then concat('Defendant agrees to pay $', amt, ' by ', m15, '. Defendant shall vacate the premises on or before ', t30, '.\\n')
        else concat('<table><tr><td>1.</td><td>$ ', amt, '</td><td>', m15, '</td></tr><tr><td>2.</td><td>$', amt2, '</td><td>', m45, '</td></tr></table>\\nPayments follow the schedule above.\\n')
    end,
    '\\nIf Defendant breaches this agreement, Plaintiff is granted judgment and Defendant agrees to vacate the premises immediately.\\n')"""
FILENAME = "concat(year(d), '_CVG_', no, '_q7_', year(d), '_CVG_', no, '_-_', month(d), '_', day(d), '_', year(d), '_-_DAGREED_-_CV_Docket_cleaned.txt')"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(``filename``, ``text``) and the order's columns."""
    return base(spark, sf_dir).selectExpr("*", f"{FILENAME} as filename", f"{DOCUMENT} as text")
