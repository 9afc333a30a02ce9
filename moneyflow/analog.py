"""The domain's tables made from the star schema, so that every plan can be run and checked on any test data.

The definitions are plain SQL that both Spark and the oracle's engine understand; only these views are
shared. Everything after them is DataFrame plans on one side and independent SQL on the other.

lineitem, orders and customer are contributions: the customer gives, its market segment is the employer, the
supplier is the committee, the nation the candidate, its region decides the party.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CYCLE = 2024

VIEWS: dict[str, tuple[list[str], str]] = {
    "cm": (
        ["supplier", "nation", "region"],
        """SELECT concat('C', cast(s_suppkey AS string)) AS cmte_id, CASE WHEN s_suppkey % 5 = 0 THEN 'SHARED NAME' ELSE s_name END AS cmte_nm,
 CASE s_suppkey % 8 WHEN 0 THEN 'H' WHEN 1 THEN 'S' WHEN 2 THEN 'P' WHEN 3 THEN 'X' WHEN 4 THEN 'Y' WHEN 5 THEN 'O' WHEN 6 THEN 'Q' ELSE 'Z' END AS cmte_tp,
 CASE s_suppkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'U' ELSE 'A' END AS cmte_dsgn,
 CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'DEM' WHEN r_name IN ('ASIA', 'AFRICA') THEN 'REP' ELSE 'IND' END AS cmte_pty_affiliation,
 concat('N', cast(s_nationkey AS string)) AS cand_id, concat('ORG ', s_name) AS connected_org_nm
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 17 <> 0""",
    ),
    "cn": (
        ["nation", "region"],
        """SELECT concat('N', cast(n_nationkey AS string)) AS cand_id, n_name AS cand_name,
 CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'DEM' WHEN r_name IN ('ASIA', 'AFRICA') THEN 'REP' ELSE 'IND' END AS cand_pty_affiliation,
 CASE WHEN n_nationkey % 7 = 6 THEN '2022' ELSE '2024' END AS cand_election_yr,
 CASE n_nationkey % 5 WHEN 0 THEN 'WY' WHEN 1 THEN 'CA' WHEN 2 THEN ' ca' WHEN 3 THEN 'US' ELSE 'QQ' END AS cand_office_st,
 CASE n_nationkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'H' ELSE 'S' END AS cand_office,
 CASE n_nationkey % 6 WHEN 0 THEN '00' WHEN 1 THEN '7' WHEN 2 THEN '07.0' WHEN 3 THEN '99' WHEN 4 THEN '' ELSE '12' END AS cand_office_district,
 cast(n_nationkey AS bigint) AS _row_ord
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "ccl": (
        ["supplier"],
        """SELECT concat('N', cast(s_nationkey AS string)) AS cand_id, CASE WHEN s_suppkey % 5 = 0 THEN '2020' ELSE '2024' END AS cand_election_yr,
 CASE WHEN s_suppkey % 10 = 0 THEN '2020' ELSE '2024' END AS fec_election_yr, concat('C', cast(s_suppkey AS string)) AS cmte_id,
 CASE s_suppkey % 2 WHEN 0 THEN 'H' ELSE 'S' END AS cmte_tp, CASE s_suppkey % 3 WHEN 0 THEN 'P' ELSE 'A' END AS cmte_dsgn, cast(s_suppkey AS bigint) AS _row_ord
FROM supplier WHERE s_suppkey % 2 = 0""",
    ),
    "itcont": (
        ["lineitem", "orders", "customer", "nation"],
        """SELECT concat('C', cast(l_suppkey AS string)) AS cmte_id,
 CASE WHEN l_returnflag = 'R' THEN '22Y' WHEN o_orderpriority LIKE '1%' THEN '15E' WHEN o_orderpriority LIKE '2%' THEN '15' WHEN o_orderpriority LIKE '3%' THEN '10' WHEN o_orderpriority LIKE '4%' THEN '24T' ELSE '11' END AS transaction_tp,
 c_name AS name, n_name AS state, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN concat('  ', c_mktsegment) ELSE c_mktsegment END AS employer,
 o_orderpriority AS occupation, concat(lpad(cast(month(o_orderdate) AS string), 2, '0'), lpad(cast(day(o_orderdate) AS string), 2, '0'), cast(year(o_orderdate) AS string)) AS transaction_dt,
 CASE WHEN l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS transaction_amt, concat('N', cast(c_nationkey AS string)) AS other_id,
 CASE WHEN l_linestatus = 'O' THEN 'X' ELSE '' END AS memo_cd, cast(l_orderkey AS bigint) * 10 + l_linenumber AS sub_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "itoth": (
        ["lineitem"],
        """SELECT concat('C', cast(l_suppkey AS string)) AS cmte_id,
 CASE l_linenumber WHEN 1 THEN '24E' WHEN 2 THEN '24A' WHEN 3 THEN '24K' WHEN 4 THEN '24C' WHEN 5 THEN '24Z' ELSE '15J' END AS transaction_tp,
 concat('PAYEE ', cast(l_partkey % 50 AS string)) AS name, l_extendedprice AS transaction_amt,
 CASE l_partkey % 3 WHEN 0 THEN concat('N', cast(l_partkey % 25 AS string)) WHEN 1 THEN concat('C', cast(l_partkey % 100 + 1 AS string)) ELSE '' END AS other_id,
 CASE WHEN l_returnflag = 'R' THEN 'X' ELSE '' END AS memo_cd, cast(l_orderkey AS bigint) * 10 + l_linenumber AS sub_id
FROM lineitem""",
    ),
    "itpas2": (
        ["lineitem"],
        """SELECT concat('C', cast(l_suppkey AS string)) AS cmte_id, '24K' AS transaction_tp, l_extendedprice AS transaction_amt,
 concat('N', cast(l_partkey % 25 AS string)) AS cand_id, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE '' END AS memo_cd, cast(l_orderkey AS bigint) * 10 + l_linenumber AS sub_id
FROM lineitem WHERE l_linenumber = 3""",
    ),
    "curated": (
        [],
        """SELECT 'AUTOMOBILE' AS employer, 'TRUE' AS include, 'Auto & Co, Inc.' AS canonical_name, 'hardware' AS sector, 'car makers; autos' AS matched_searches, '' AS notes, cast(1 AS bigint) AS _row_ord
UNION ALL SELECT ' machinery', 'true', 'Machine Holdings LLC', 'hardware', 'machine', 'n', cast(2 AS bigint)
UNION ALL SELECT 'BUILDING', 'TRUE', 'Build Co', 'software', 'STEEL', '', cast(3 AS bigint)
UNION ALL SELECT 'Automobile', 'TRUE', 'Second Name', 'other', '', '', cast(4 AS bigint)
UNION ALL SELECT 'FURNITURE', 'TRUE', '', 'blank', 'BRASS9', '', cast(5 AS bigint)""",
    ),
    "filed": (
        ["orders", "customer"],
        """SELECT concat('F', cast(o_orderkey AS string)) AS filing_uuid, cast(year(o_orderdate) AS int) AS filing_year,
 CASE quarter(o_orderdate) WHEN 1 THEN 'first_quarter' WHEN 2 THEN 'mid_year' WHEN 3 THEN 'third_quarter' ELSE 'amendment' END AS filing_period,
 concat('Q', cast(quarter(o_orderdate) AS string)) AS filing_period_display, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS client_api_id,
 CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE c_name END AS client_name, o_custkey % 13 AS registrant_api_id, concat('REG ', cast(o_custkey % 13 AS string)) AS registrant_name,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS income, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS expenses,
 concat(cast(year(o_orderdate) AS string), '-', lpad(cast(month(o_orderdate) AS string), 2, '0')) AS dt_posted, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE cast(o_orderkey % 4 AS bigint) END AS n_activities,
 cast(o_orderkey % 3 AS bigint) AS n_foreign_entities, cast(o_orderkey % 2 AS bigint) AS n_affiliated_organizations,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 4 END AS lobbyist_api_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('Lobbyist ', cast(o_orderkey % 4 AS string)) END AS lobbyist_name,
 o_orderstatus = 'P' AS no_contributions
FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "activities": (
        ["lineitem"],
        """SELECT concat('F', cast(l_orderkey AS string)) AS filing_uuid, concat('F', cast(l_orderkey AS string), ':activity:', cast(l_linenumber % 5 AS string)) AS activity_id,
 concat('I', cast(l_partkey % 7 AS string)) AS general_issue_code, concat('Issue ', cast(l_partkey % 7 AS string)) AS general_issue_code_display,
 cast(l_suppkey AS bigint) AS lobbyist_api_id, concat('First ', cast(l_suppkey AS string)) AS lobbyist_first_name, concat('Last ', cast(l_suppkey % 5 AS string)) AS lobbyist_last_name,
 CASE WHEN l_returnflag = 'R' THEN 'Staff' END AS covered_position, l_linestatus = 'O' AS is_new,
 l_partkey % 9 AS government_entity_id, concat('Agency ', cast(l_partkey % 9 AS string)) AS government_entity_name, CASE WHEN l_linenumber < 3 THEN l_extendedprice END AS amount
FROM lineitem""",
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, sql = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        sql = " ".join(f"{{{t}}}" if w == t else w for w in sql.split(" ")) if t in sql.split(" ") else sql
    return spark.sql(sql, **frames)
