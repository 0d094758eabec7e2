"""Tables that stand for a lake's own: made from the given tables, alike in Spark and in ANSI SQL.

Each view is one SELECT; functions that the two engines name differently are
written as @name(argument).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_SPARK = {"stamp": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss\")", "day": "date_format({0}, 'yyyy-MM-dd')", "secs": "unix_seconds(cast({0} as timestamp))", "days": "datediff(cast({0} as date), date '2024-01-01')", "div": "({0} div {1})", "ts": "cast({0} as timestamp_ntz)"}
_DUCK = {"stamp": "strftime({0}, '%Y-%m-%dT%H:%M:%S')", "day": "strftime({0}, '%Y-%m-%d')", "secs": "cast(floor(epoch({0})) as bigint)", "days": "datediff('day', date '2024-01-01', cast({0} as date))", "div": "({0} // {1})", "ts": "cast({0} as timestamp)"}

#: name: (tables it reads, SELECT).
VIEWS = {
    "raw_lines": (["events"], """
        select event_id, case
            when event_id % 97 = 0 then '' when event_id % 89 = 1 then '   '
            when event_id % 83 = 2 then '[1,2]' when event_id % 79 = 3 then 'null'
            when event_id % 73 = 4 then '{"broken":' when event_id % 71 = 5 then '"text"'
            else concat('{"event_id":', cast(event_id as string), ',"timestamp":"', @stamp(ts), case when event_id % 3 = 0 then '.250Z' when event_id % 3 = 1 then '+02:00' else '' end,
                '","user_id":', case when event_id % 5 = 0 then concat('"', cast(user_id as string), '"') else cast(user_id as string) end,
                ',"event_type":"', event_type, '","cents":', cast(cast(round(value * 100) as bigint) as string), case when event_id % 4 = 0 then '.5' else '' end,
                ',"flag":', case when event_id % 7 = 0 then 'null' when event_id % 2 = 0 then 'true' else 'false' end,
                ',"tags":["x",', cast(event_id % 3 as string), '],"props":', props, '}') end as value
        from events"""),
    "files": (["events"], """
        select concat('t', cast(user_id % 5 as string)) as tenant, event_type as dataset, concat('day=', @day(ts)) as partition,
               concat('t', cast(user_id % 5 as string), '/', event_type, '/day=', @day(ts), '/', cast(user_id % 20 as string), '.parquet') as path,
               sum(length(props) + 20) as size, count(*) as n_rows, min(ts) as created, max(ts) as modified
        from events group by 1, 2, 3, 4"""),
    "jobs": (["orders"], """
        select o_orderkey as job_id, concat('t', cast(o_custkey % 30 as string)) as tenant, concat('d', cast(o_custkey % 7 as string)) as dataset,
               case o_orderstatus when 'O' then 'queue' when 'F' then 'dlq' else 'retry' end as state,
               case when o_orderkey % 11 = 0 then 0 when o_orderkey % 13 = 0 then null else 6 - cast(substring(o_orderpriority, 1, 1) as int) end as priority,
               o_orderdate as created, o_orderkey % 12 as attempts, case o_orderkey % 3 when 0 then 'upload' when 1 then 'convert' else '' end as kind,
               case when o_orderkey % 17 = 0 then 'string' else concat('t', cast(o_custkey % 40 as string)) end as asked_tenant
        from orders"""),
    "registry": (["region", "nation", "customer"], """
        select r_name as account, n_name as tenant, concat(c_mktsegment, '-', cast(c_custkey % 9 as string)) as dataset, count(*) as members,
               max(c_acctbal) > 9000 as testing
        from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey group by 1, 2, 3"""),
    "uploads": (["lineitem"], """
        select concat('d', cast(l_suppkey % 20 as string)) as destination, l_orderkey as order_key, l_linenumber as line, l_shipdate as happened,
               l_returnflag <> 'R' as success, cast(floor(l_quantity) as bigint) * 1000 as bytes, cast(l_linenumber as bigint) as attempts,
               cast(floor(l_extendedprice) as bigint) as millis, concat('error ', cast(l_partkey % 4 as string)) as error,
               case when l_linestatus = 'O' then 'upload' else null end as severity, l_returnflag as kind
        from lineitem"""),
    "fields": (["events"], """
        select distinct concat('f', @day(ts)) as file, cast(k as int) as pos,
               case cast(k as int) when 0 then 'event-id' when 1 then 'Event_Id_1' when 2 then concat('col_', cast(@days(ts) % 6 as string))
                                   else concat(event_type, case when @days(ts) % 10 > 6 then '-2' else '' end) end as name,
               case when cast(k as int) = 2 and event_id % 12 > 5 then 'double' when cast(k as int) > 0 and @days(ts) % 9 > 5 then 'string' else 'bigint' end as type
        from events cross join (select 0 as k union all select 1 union all select 2 union all select 3) as n"""),
}


def _filled(text: str, functions: dict[str, str]) -> str:
    for name, body in functions.items():
        mark = f"@{name}("
        while mark in text:
            start = text.index(mark)
            end = text.index(")", start)
            arguments = [a.strip() for a in text[start + len(mark) : end].split(",")]
            text = text[:start] + body.format(*arguments) + text[end + 1 :]
    return text


def spark_sql(text: str) -> str:
    return _filled(text, _SPARK)


def duck_sql(text: str) -> str:
    return _filled(text, _DUCK).replace("as string)", "as varchar)")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a given table by its name."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables, text = VIEWS[name]
    for t in tables:  # names of its own, so that nothing of the session's is hidden
        view(spark, sf_dir, t).createOrReplaceTempView(f"tarn_{t}")
    return spark.sql(re.sub(rf"\b(from|join) ({'|'.join(tables)})\b", r"\1 tarn_\2", spark_sql(text)))


def with_views(sql: str) -> str:
    """SQL for the other engine, with the views that it names in front."""
    used = [f"{n} as ({duck_sql(text)})" for n, (_, text) in VIEWS.items() if f" {n}" in sql]
    own = duck_sql(sql).strip()
    if not used:
        return own
    return f"with {', '.join(used)}" + (f", {own[5:]}" if own.startswith("with ") else f" {own}")
