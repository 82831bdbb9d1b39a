"""The retail tables as views over the driver tables, in SQL that Spark and DuckDB both run.

The raw tables hold no dirt, so nulls, orphans and bad values are put in by key modulo. Three tokens differ
between the engines: {F14:x} and {F8:x} format a timestamp as 14 or 8 digits, {ARR:a;b} makes an array.
"""

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "transactions": """
        select concat('T', lpad(cast(event_id as string), 8, '0')) as transaction_id,
          case when event_id%113=0 then null when event_id%101=0 then 'U99999999'
               else concat('U', lpad(cast(user_id as string), 8, '0')) end as user_id,
          case when event_id%107=0 then 'P99999999'
               else concat('P', lpad(cast((event_id*7)%np as string), 8, '0')) end as product_id,
          case when event_id%103=0 then 'M99999999'
               else concat('M', lpad(cast(event_id%ns as string), 8, '0')) end as merchant_id,
          case when event_id%97=0 then -value when event_id%199=0 then null
               when event_id%83=0 then value*20 else value end as amount,
          case when event_id%89=0 then {F8:ts} when event_id%211=0 then '2024023012000x'
               when event_id%223=0 then '20240230120000' else {F14:ts} end as timestamp,
          concat('CITY_', cast(event_id%25 as string)) as location,
          case when event_id%131=0 then null when event_type='view' then 'CARD' when event_type='click' then 'PAYPAL'
               when event_type='purchase' then 'BANK_TRANSFER' when event_type='signup' then 'CASH'
               else 'CRYPTO' end as payment_method,
          case when event_id%127=0 then null else p_type end as category
        from (select *, (select count(*) from part) as np, (select count(*) from supplier) as ns from events) e
        join part on p_partkey=(event_id*7)%np""",
    "transactions_long": """
        select concat('T', lpad(cast(o_orderkey as string), 8, '0')) as transaction_id,
          case when o_orderkey%113=0 then null
               else concat('U', lpad(cast(o_custkey as string), 8, '0')) end as user_id,
          concat('P', lpad(cast(o_orderkey%np as string), 8, '0')) as product_id,
          concat('M', lpad(cast(o_orderkey%ns as string), 8, '0')) as merchant_id,
          o_totalprice as amount, {F14:o_orderdate} as timestamp, 'CITY_0' as location,
          'CARD' as payment_method, o_orderpriority as category
        from (select *, (select count(*) from part) as np, (select count(*) from supplier) as ns from orders) o""",
    "users": """
        select concat('U', lpad(cast(c_custkey as string), 8, '0')) as user_id,
          case when c_custkey%37=36 then null else cast(10+(c_custkey*7)%95 as int) end as age,
          c_acctbal*10 as annual_income, n_name as city, c_mktsegment as customer_segment,
          case when c_custkey%41=40 then null else {ARR:c_mktsegment;n_name} end as preferred_categories,
          cast(20230101+c_custkey%28 as string) as registration_date
        from customer join nation on n_nationkey=c_nationkey""",
    "products": """
        select concat('P', lpad(cast(p_partkey as string), 8, '0')) as product_id,
          case when p_partkey%67=66 then null else p_name end as name, p_type as category,
          case when p_partkey%71=70 then cast(-1 as double) else p_retailprice end as price,
          concat('M', lpad(cast(p_partkey%ns as string), 8, '0')) as merchant_id,
          cast(p_size as double)/8 as rating, cast(p_size*10 as int) as stock
        from (select *, (select count(*) from supplier) as ns from part) p""",
    "merchants": """
        select concat('M', lpad(cast(s_suppkey as string), 8, '0')) as merchant_id, s_name as name,
          concat('CAT_', cast(s_suppkey%6 as string)) as category, r_name as region,
          case when s_suppkey%10=9 then cast(1.5 as double) else s_acctbal/10000 end as commission_rate,
          cast(20150101+s_suppkey%28 as string) as establishment_date
        from supplier join nation on n_nationkey=s_nationkey join region on r_regionkey=n_regionkey""",
}

# Columns of the driver tables in use; stating them saves reading a file footer per table and query.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_TOKENS = {
    "spark": {
        "F14": r"date_format(\1,'yyyyMMddHHmmss')",
        "F8": r"date_format(\1,'yyyyMMdd')",
        "ARR": r"array(\1,\2)",
    },
    "duckdb": {
        "F14": r"strftime(\1,'%Y%m%d%H%M%S')",
        "F8": r"strftime(\1,'%Y%m%d')",
        "ARR": r"list_value(\1,\2)",
    },
}


def view_sql(name: str, engine: str) -> str:
    tokens = _TOKENS[engine]
    sql = re.sub(r"\{F14:(\w+)\}", tokens["F14"], VIEWS[name])
    sql = re.sub(r"\{F8:(\w+)\}", tokens["F8"], sql)
    return re.sub(r"\{ARR:(\w+);(\w+)\}", tokens["ARR"], sql)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view over the Parquet tables in ``folder``."""
    sql = view_sql(name, "spark")
    tables = re.findall(r"\b(?:from|join)\s+(\w+)", sql)
    for table in set(tables):
        sql = re.sub(rf"\b(from|join)\s+{table}\b", rf"\1 {{{table}}}", sql)
    frames = {t: spark.read.schema(_COLUMNS[t]).parquet(f"{folder}/{t}.parquet") for t in set(tables)}
    return spark.sql(sql, **frames)


def views(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: view(spark, folder, name) for name in names}
