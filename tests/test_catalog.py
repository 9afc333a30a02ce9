"""Every registered query against its SQL, and a few plans."""

import pytest

from moneyflow.analog import CYCLE
from moneyflow.catalog import QUERIES, tables
from moneyflow.oracles import SQL
from moneyflow.plans import races, summaries
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, SQL[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_plans(spark):
    for name, query in QUERIES.items():
        assert "Python" not in plan(query(spark, SF)) and "Pandas" not in plan(query(spark, SF)), name


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["company_top_k"](spark, SF))


def test_ranking_takes_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["ranked_donors"](spark, SF))


def test_containment_is_an_equi_join(spark):
    assert "CartesianProduct" not in plan(QUERIES["entity_alias_match"](spark, SF))
    assert "NestedLoop" not in plan(QUERIES["entity_alias_match"](spark, SF))


def test_scan_is_pruned_and_filtered(spark):
    text = plan(QUERIES["uninvestigated_types"](spark, SF))
    assert "l_comment" not in text and "l_discount" not in text


def test_payloads_nest_everything(spark):
    t = tables(spark, SF)
    rows = summaries.company_payloads(t.giving, t.company_table, t.classes, CYCLE, 3).collect()
    assert rows and all(r.slug == r.summary.slug and r.weekly_series[0].week_end and len(r.top_donors) == 3 for r in rows)
    assert [x.rank for x in rows[0].top_committees] == list(range(1, len(rows[0].top_committees) + 1))


def test_orders_of_published_tables(spark):
    t = tables(spark, SF)
    got = [(r.entity_type, r.lean_measure_total, r.coverage_total, r.entity_name) for r in summaries.in_entity_order(QUERIES["entity_lean_union"](spark, SF)).collect()]
    low = float("-inf")
    key = lambda x: (summaries.ENTITY_ORDER.index(x[0]), -(low if x[1] is None else x[1]), -(low if x[2] is None else x[2]), x[3])
    assert got == sorted(got, key=key)
    rows = races.in_race_order(t.races).collect()
    key = lambda r: (not r.is_display_candidate, not r.is_major_party, -r.tech_itemized_receipts, -r.ie_support_total, -r.linked_principal_committee_count, r.cand_name)
    assert [key(r) for r in rows] == sorted(key(r) for r in rows)
    states = races.in_state_order(races.state_summary(t.races)).collect()
    assert [(-r.tech_itemized_receipts, -r.house_district_count, r.state_code) for r in states] == sorted((-r.tech_itemized_receipts, -r.house_district_count, r.state_code) for r in states)


def test_facts_are_scanned_once(spark):
    """What the summaries read is added up once; their own plans do not go back to the facts."""
    for name in ("donor_summary", "company_party_split", "weekly_totals"):
        text = plan(QUERIES[name](spark, SF))
        assert "lineitem.parquet" not in text and "giving-" in text, name


def test_invariants_of_published_figures(spark):
    for r in QUERIES["company_party_split"](spark, SF).collect():
        assert abs(r.net_total - (r.amt_dem + r.amt_rep + r.amt_mixed + r.amt_unknown)) < 0.01
        assert abs(r.amt_other - (r.amt_mixed + r.amt_unknown)) < 0.01
    weeks = sorted(QUERIES["weekly_totals"](spark, SF).collect(), key=lambda r: r.week_end)
    total = 0.0
    for r in weeks:
        total += r.net_total
        assert r.week_end.weekday() == 6 and abs(r.cumulative_net_total - total) < 0.05
    donors = {r.tech_canonical_name: r for r in QUERIES["company_donor_pivot2"](spark, SF).collect()}
    for r in QUERIES["company_party_split"](spark, SF).collect():
        assert abs(donors[r.tech_canonical_name].donor_amt_total - r.net_total) < 0.05
