"""Views that give the generated test tables the shape of a clone target.

The texts are plain SQL that Spark and DuckDB both run. ``{name}`` stands for a
base table or an earlier view. Surrogate ids of different kinds of org unit are
kept apart by their remainder, so they do not collide at any scale.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# The schemas are known, so that no file is opened to infer them.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "pages": "page_id long, url string, html string",
}

_EVENT_PROGRAM = (
    "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END"
)
_TRACKER_PROGRAM = "10 + CAST(substr(o_orderpriority, 1, 1) AS INT)"
_EVENT_STAGE = f"CAST({_EVENT_PROGRAM} * 10 + CASE WHEN value < 35 THEN 0 ELSE 1 END AS INT)"
_TRACKER_STAGE = (
    f"CAST(({_TRACKER_PROGRAM}) * 10 + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS INT)"
)
_BRAND = "CAST(substr(p_brand, 7) AS INT)"

VIEWS = {
    "organisationunit": """
        SELECT CAST(r_regionkey AS BIGINT) * 4 AS organisationunitid,
               concat('R', r_regionkey) AS uid, concat('/R', r_regionkey) AS path
        FROM {region}
        UNION ALL
        SELECT CAST(n_nationkey AS BIGINT) * 4 + 1, concat('N', n_nationkey),
               concat('/R', n_nationkey % 5, '/N', n_nationkey)
        FROM {nation}
        UNION ALL
        SELECT c_custkey * 4 + 2, concat('C', c_custkey),
               concat('/R', c_nationkey % 5, '/N', c_nationkey, '/C', c_custkey)
        FROM {customer}
        UNION ALL
        SELECT s_suppkey * 4 + 3, concat('S', s_suppkey),
               concat('/R', s_nationkey % 5, '/N', s_nationkey, '/S', s_suppkey)
        FROM {supplier}""",
    "dataset": f"SELECT DISTINCT {_BRAND} AS datasetid, p_brand AS uid FROM {{part}}",
    "dataelement": (
        "SELECT p_partkey AS dataelementid, concat('DE', p_partkey) AS uid FROM {part}"
    ),
    "datasetelement": f"""
        SELECT {_BRAND} AS datasetid, p_partkey AS dataelementid FROM {{part}}
        UNION ALL
        SELECT {_BRAND} % 25 + 1, p_partkey FROM {{part}} WHERE p_type = 'PROMO'""",
    "datavalue": """
        SELECT l_partkey AS dataelementid, l_suppkey * 4 + 3 AS sourceid,
               l_orderkey AS periodid, l_linenumber AS seq, l_quantity AS value
        FROM {lineitem}""",
    # One element has a third of all values or more; some values have none.
    "skewedvalue": """
        SELECT CASE WHEN l_linenumber <= 3 THEN 7
                    WHEN l_quantity >= 3 THEN l_partkey END AS dataelementid,
               l_suppkey * 4 + 3 AS sourceid,
               l_orderkey AS periodid, l_linenumber AS seq, l_quantity AS value
        FROM {lineitem}""",
    "datavalueaudit": """
        SELECT l_partkey AS dataelementid, l_suppkey * 4 + 3 AS sourceid,
               l_extendedprice AS value
        FROM {lineitem}""",
    "program": f"""
        SELECT DISTINCT {_EVENT_PROGRAM} AS programid, event_type AS uid FROM {{events}}
        UNION ALL
        SELECT DISTINCT {_TRACKER_PROGRAM}, concat('TP', substr(o_orderpriority, 1, 1))
        FROM {{orders}}""",
    "programstage": f"""
        SELECT DISTINCT {_EVENT_STAGE} AS programstageid, {_EVENT_PROGRAM} AS programid
        FROM {{events}}
        UNION ALL
        SELECT DISTINCT {_TRACKER_STAGE}, {_TRACKER_PROGRAM} FROM {{orders}}""",
    "programinstance": f"""
        SELECT o_orderkey AS programinstanceid, {_TRACKER_PROGRAM} AS programid,
               o_custkey AS trackedentityinstanceid
        FROM {{orders}}""",
    "programstageinstance": f"""
        SELECT event_id * 2 AS programstageinstanceid,
               {_EVENT_STAGE} AS programstageid,
               CAST(NULL AS BIGINT) AS programinstanceid,
               user_id * 4 + 2 AS organisationunitid,
               CASE WHEN value >= 5 THEN
                   concat('{{{{"de', user_id % 5, '":', user_id, ',"k":"v', event_id % 3, '"}}}}')
               END AS eventdatavalues
        FROM {{events}}
        UNION ALL
        SELECT o_orderkey * 2 + 1,
               {_TRACKER_STAGE},
               o_orderkey, o_custkey * 4 + 2,
               concat('{{{{"de', o_custkey % 5, '":', o_custkey, ',"k":null}}}}')
        FROM {{orders}}""",
    "programstageinstancecomments": """
        SELECT event_id * 2 AS programstageinstanceid, event_id * 20 AS commentid FROM {events}
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey * 20 + 10 FROM {orders}""",
    "trackedentitydatavalueaudit": """
        SELECT event_id * 2 AS programstageinstanceid, event_id * 20 + 1 AS auditid FROM {events}
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey * 20 + 11 FROM {orders}""",
    "trackedentityinstance": """
        SELECT c_custkey AS trackedentityinstanceid, c_custkey * 4 + 2 AS organisationunitid
        FROM {customer}""",
    "trackedentityattributevalue": """
        SELECT c_custkey AS trackedentityinstanceid, 1 AS attributeid, c_mktsegment AS value
        FROM {customer}
        UNION ALL
        SELECT c_custkey, 2, c_name FROM {customer}""",
    "trackedentityattributevalueaudit": """
        SELECT c_custkey AS trackedentityinstanceid, c_mktsegment AS value FROM {customer}""",
    "trackedentityprogramowner": """
        SELECT c_custkey AS trackedentityinstanceid, 11 + c_nationkey % 5 AS programid
        FROM {customer}""",
    "users": """
        SELECT concat('U', c_custkey) AS id, c_name AS username, c_acctbal < 0 AS disabled
        FROM {customer}""",
    "usergroupmembers": """
        SELECT c_mktsegment AS group_name, concat('U', c_custkey) AS user_id FROM {customer}
        UNION ALL
        SELECT concat('NATION_', c_nationkey), concat('U', c_custkey) FROM {customer}""",
    "userroles": """
        SELECT DISTINCT substr(o_orderpriority, 1, 1) AS id, o_orderpriority AS name
        FROM {orders}""",
    "userrolemembers": """
        SELECT DISTINCT concat('U', o_custkey) AS user_id, substr(o_orderpriority, 1, 1) AS role_id
        FROM {orders}""",
    "imported_users": """
        SELECT concat('U', r_regionkey - 2) AS id, r_name AS username,
               r_regionkey % 2 = 0 AS disabled
        FROM {region}""",
    "imported_elements": """
        SELECT concat('DE', n_nationkey - 12) AS id FROM {nation}""",
    "spatial_ref_sys": """
        SELECT n_nationkey AS srid, n_name AS auth_name FROM {nation}""",
    "sqlview": """
        SELECT p_partkey AS sqlviewid, concat(p_name, ' - ', p_brand) AS name,
               CASE WHEN p_type = 'PROMO' OR p_type = 'SMALL' THEN 'VIEW' ELSE 'QUERY' END AS type
        FROM {part}""",
    "metadata_target": """
        SELECT p_partkey AS id, p_name AS name, p_type AS type, p_size AS size FROM {part}""",
    "metadata_source": """
        SELECT p_partkey AS id, concat(p_name, ' v2') AS name,
               CASE WHEN p_size > 10 THEN p_type END AS type, p_size + 1 AS size
        FROM {part} WHERE p_type = 'LARGE' OR p_type = 'MEDIUM'
        UNION ALL
        SELECT -1 - s_suppkey, s_name, 'SUPPLIER', CAST(s_nationkey AS INT) FROM {supplier}
        UNION ALL
        SELECT CAST(NULL AS BIGINT), n_name, 'NATION', CAST(NULL AS INT) FROM {nation}""",
    "connection_log": """
        SELECT page_id,
               concat(replace(url, '://', concat('://user', page_id, ':pw', page_id, '@')),
                      ' -> ', url) AS line
        FROM {pages}""",
}

DATABASE = (
    "organisationunit",
    "dataset",
    "dataelement",
    "datasetelement",
    "datavalue",
    "datavalueaudit",
    "program",
    "programstage",
    "programinstance",
    "programstageinstance",
    "programstageinstancecomments",
    "trackedentitydatavalueaudit",
    "trackedentityinstance",
    "trackedentityattributevalue",
    "trackedentityattributevalueaudit",
    "trackedentityprogramowner",
)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


class Views(Mapping):
    """The views over the generated tables of one folder, each built when it is
    first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, names: Iterable[str] = DATABASE):
        self._spark = spark
        self._sf_dir = sf_dir
        self._names = tuple(names)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE_TABLES:
                frame = base_table(self._spark, self._sf_dir, name)
            else:
                text = VIEWS[name]
                frame = self._spark.sql(text, **{n: self[n] for n in references(text)})
            self._frames[name] = frame
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def references(text: str) -> list[str]:
    names = (*BASE_TABLES, *VIEWS)
    return [name for name in names if "{" + name + "}" in text]


def common_table_expressions(*wanted: str) -> str:
    """The wanted views, and those they need, as a WITH clause."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in needed:
            return
        for reference in references(VIEWS[name]):
            visit(reference)
        needed.append(name)

    for name in wanted:
        visit(name)
    parts = [
        f"{name} AS ({VIEWS[name].format(**{n: n for n in references(VIEWS[name])}).strip()})"
        for name in needed
    ]
    return "WITH " + ",\n".join(parts)
