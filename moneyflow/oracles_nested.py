"""SQL for the queries of ``catalog_nested``, straight from the driver's tables."""

from __future__ import annotations

from moneyflow import codes
from moneyflow.analog import CYCLE
from moneyflow.oracles import WEEK, core, ms, norm, slug, sql

NF = """SELECT o_orderkey AS k, concat('F', o_orderkey) AS filing_uuid, year(o_orderdate) AS filing_year, concat('Q', quarter(o_orderdate)) AS filing_period, o_orderstatus AS filing_type,
 strftime(o_orderdate, '%Y-%m-%d') AS dt_posted, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS income, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS expenses, o_custkey AS client,
 CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey + 7 END AS source_id, CASE WHEN o_orderkey % 5 = 0 THEN concat(c_name, ' Ltd') ELSE c_name END AS client_name, CASE WHEN o_orderkey % 4 <> 0 THEN c_mktsegment END AS about,
 cast(c_nationkey AS varchar) AS state, o_custkey % 13 AS reg FROM orders JOIN customer ON o_custkey = c_custkey"""
ACTS = """SELECT l.*, concat('F', l_orderkey) AS filing_uuid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i
 FROM lineitem l WHERE l_orderkey IN (SELECT k FROM nf)"""
PEOPLE = """SELECT concat(filing_uuid, ':activity:', i) AS activity_id, filing_uuid, i, j, l_orderkey AS k, (l_suppkey + j) % 40 AS id, CASE WHEN (l_suppkey + j) % 40 % 3 = 0 THEN '' ELSE concat('Last ', l_orderkey % 5) END AS last_name,
 CASE WHEN l_returnflag = 'R' THEN 'Staff' END AS covered_position, l_linestatus = 'O' AS is_new FROM acts, unnest(range(1, l_linenumber % 3 + 1)) u(j)"""
ITEMS = """SELECT concat('R', l_orderkey) AS filing_uuid, l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_extendedprice) AS i, concat('T', l_linenumber % 2) AS contribution_type,
 concat('Payee ', l_partkey % 50) AS payee_name, CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS amount FROM lineitem WHERE l_linenumber < 4 AND l_orderkey % 2 = 0 AND l_orderkey IN (SELECT o_orderkey FROM orders)"""
REPORTS = """SELECT o_orderkey AS k, concat('R', o_orderkey) AS filing_uuid, year(o_orderdate) AS filing_year, 'mid_year' AS filing_period, o_orderstatus = 'P' AS no_contributions, CASE WHEN o_orderkey % 4 = 0 THEN 'PAC A; PAC B' ELSE 'PAC C' END AS pacs,
 o_custkey % 13 AS reg, o_orderkey % 60 AS n FROM orders WHERE o_orderkey % 2 = 0"""
CLIENTS = """SELECT cast(client AS varchar) AS client_api_id, cast(max_by(source_id, k) FILTER (source_id IS NOT NULL) AS varchar) AS client_source_id, max_by(client_name, k) AS client_name, max_by(about, k) FILTER (about IS NOT NULL) AS general_description,
 max_by(state, k) AS state, cast(max_by(reg, k) AS varchar) AS registrant_api_id FROM nf GROUP BY client"""
REGS = "SELECT cast(reg AS varchar) AS registrant_api_id, CASE WHEN bool_or(f) THEN cast(reg + 100 AS varchar) END AS house_registrant_id, concat('REG ', reg) AS registrant_name, CASE WHEN bool_or(f) THEN 'DC' END AS state, CASE WHEN bool_or(f) THEN 'firm' END AS about, CASE WHEN bool_or(f) THEN 'US' END AS country FROM (SELECT reg, true AS f FROM nf UNION ALL SELECT reg, false FROM reports) GROUP BY reg"
SEEN = """SELECT p.id, concat('First ', p.id) AS first_name, nullif(p.last_name, '') AS last_name, f.reg, cast(0 AS hugeint) + p.k * 1000000 + p.i * 1000 + p.j AS o FROM people p JOIN nf f ON p.k = f.k
 UNION ALL SELECT n, concat('First ', n), CASE WHEN n % 4 <> 0 THEN concat('R ', n) END, reg, cast(1000000000000000000 AS hugeint) + k FROM reports"""
SPENT = f"count(DISTINCT filing_uuid) AS n_filings, {ms('income')} + {ms('expenses')} AS total_reported_spend, min(dt_posted) AS first_posted, max(dt_posted) AS last_posted"
ENTITIES = f"""SELECT *, {norm('entity_name')} AS entity_name_norm, {core(norm('entity_name'))} AS entity_name_core FROM (
 SELECT 'client' AS entity_type, client_api_id AS entity_id, client_name AS entity_name, general_description AS entity_description, state AS entity_state, 'US' AS entity_country, n_filings, n_counterparties, 'registrants' AS counterparty_label, total_reported_spend, first_posted, last_posted
 FROM clients LEFT JOIN (SELECT cast(client AS varchar) AS c, count(DISTINCT reg) AS n_counterparties, {SPENT} FROM nf GROUP BY client) ON c = client_api_id
 UNION ALL SELECT 'registrant', registrant_api_id, registrant_name, about, state, country, n_filings, n_counterparties, 'clients', total_reported_spend, first_posted, last_posted
 FROM regs LEFT JOIN (SELECT cast(reg AS varchar) AS c, count(DISTINCT client) AS n_counterparties, {SPENT} FROM nf GROUP BY reg) ON c = registrant_api_id)"""
ALIASES = f"""SELECT *, {core('an')} AS ac, length(replace(an, ' ', '')) >= 6 OR regexp_matches(an, '[0-9]') AS ok FROM (SELECT *, {norm('matched_alias')} AS an FROM
 (VALUES ('Customer 000000012', 'employer'), ('REG 1', 'canonical_name'), ('REG 2 LLC', 'employer'), ('nothing alike', 'canonical_name'), ('000000100 Ltd', 'employer'), ('Customer#000000100 Ltd', 'canonical_name')) a(matched_alias, alias_source))"""
OVERLAY = """SELECT * FROM (SELECT entity_type, entity_id, matched_alias, alias_source, CASE WHEN entity_name_norm = an THEN 100 WHEN ac <> '' AND entity_name_core = ac THEN 96 WHEN ok AND contains(entity_name_norm, an) THEN 86
 WHEN ok AND ac <> '' AND contains(entity_name_core, ac) THEN 82 END AS score FROM ents, aliases) WHERE score IS NOT NULL"""
PAGED = "SELECT concat('E', event_id - CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS filing_uuid, event_id, event_type, event_id // 500 + 1 AS page FROM events WHERE event_id < 3000"
STEPS = {"nf": NF, "acts": ACTS, "people": PEOPLE, "items": ITEMS, "reports": REPORTS, "clients": CLIENTS, "regs": REGS, "seen": SEEN, "ents": ENTITIES, "aliases": ALIASES, "overlay": OVERLAY, "paged6": PAGED}


def nested(body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in STEPS.items()) + "\n" + body


def text(*columns: str) -> str:
    """Columns of an analog view as bulk text."""
    return ", ".join(f"coalesce(cast({c} AS varchar), '') AS {c}" if not c.startswith("-") else f"'' AS {c[1:]}" for c in columns)


LABEL_X = "CASE WHEN c_custkey % 9 <> 0 THEN floor(c_acctbal) END"
TILES = "(VALUES " + ", ".join(f"('{k}', {x}, {y})" for k, (x, y) in codes.STATE_TILES.items()) + ") tiles(st, x, y)"
NAMES = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in codes.STATE_NAMES.items()) + ") names(st, name)"
GIVEN = "(SELECT 'itcont' AS source_file, cmte_id, transaction_tp, memo_cd, name, transaction_amt FROM itcont UNION ALL SELECT 'itoth', cmte_id, transaction_tp, memo_cd, name, transaction_amt FROM itoth)"


def place(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) AS place"


def build(known: dict[str, str]) -> dict[str, str]:
    lean, states = known["entity_lean_union"], known["state_rollup"]
    return {
        "flat_filings": nested("""SELECT filing_uuid, filing_year, filing_period, filing_type, dt_posted, income, expenses, client AS client_api_id, source_id AS client_source_id, client_name, reg AS registrant_api_id, reg + 100 AS registrant_house_id, concat('REG ', reg) AS registrant_name,
 cast(NULL AS varchar) AS posted_by_name, coalesce(n, 0) AS n_activities, k % 3 AS n_foreign_entities, k % 2 AS n_affiliated_organizations, cast(k % 50 = 0 AS bigint) AS n_conviction_disclosures FROM nf LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM acts GROUP BY 1) ON k = l_orderkey"""),
        "flat_activities": nested("SELECT concat(filing_uuid, ':activity:', i) AS activity_id, filing_uuid, i AS activity_index, concat('I', l_partkey % 7) AS general_issue_code, concat('Issue ', l_partkey % 7) AS general_issue_code_display, CASE WHEN l_linenumber % 2 = 0 THEN concat('On part ', l_partkey) END AS description, cast(NULL AS varchar) AS foreign_entity_issues, cast(l_linenumber % 3 AS bigint) AS n_lobbyists, cast(l_linenumber % 2 AS bigint) AS n_government_entities FROM acts"),
        "flat_lobbyists": nested("SELECT activity_id, filing_uuid, i AS activity_index, j AS activity_lobbyist_index, id AS lobbyist_api_id, concat('First ', id) AS lobbyist_first_name, last_name AS lobbyist_last_name, covered_position, is_new FROM people"),
        "flat_agencies": nested("SELECT concat(filing_uuid, ':activity:', i) AS activity_id, filing_uuid, i AS activity_index, cast(1 AS bigint) AS activity_government_entity_index, l_partkey % 9 + 1 AS government_entity_id, concat('Agency ', l_partkey % 9 + 1) AS government_entity_name FROM acts WHERE l_linenumber % 2 = 1"),
        "flat_foreign": nested("SELECT filing_uuid, j AS foreign_entity_index, concat('Foreign ', k, '-', j) AS name, CASE WHEN j = 1 THEN '12.5' END AS contribution, 'XX' AS country, cast(NULL AS varchar) AS city FROM nf, unnest(range(1, k % 3 + 1)) u(j)"),
        "flat_affiliated": nested("SELECT filing_uuid, cast(1 AS bigint) AS affiliated_organization_index, concat('Aff ', k) AS name, cast(1 AS bigint) AS extra FROM nf WHERE k % 2 = 1"),
        "flat_convictions": nested("SELECT filing_uuid, cast(1 AS bigint) AS conviction_disclosure_index, '2020-01-01' AS date FROM nf WHERE k % 50 = 0"),
        "flat_reports": nested("SELECT r.filing_uuid, cast(filing_year AS int) AS filing_year, filing_period, no_contributions, pacs, coalesce(c, 0) AS n_contribution_items, reg AS registrant_api_id, concat('REG ', reg) AS registrant_name, n AS lobbyist_api_id, concat('First ', n, CASE WHEN n % 4 <> 0 THEN concat(' R ', n) ELSE '' END) AS lobbyist_name FROM reports r LEFT JOIN (SELECT filing_uuid, count(*) AS c FROM items GROUP BY 1) t ON r.filing_uuid = t.filing_uuid"),
        "flat_report_items": nested("SELECT concat(filing_uuid, ':item:', i) AS contribution_item_id, filing_uuid, i AS item_index, contribution_type, payee_name, amount FROM items"),
        "dim_clients": nested("SELECT * FROM clients"),
        "dim_registrants": nested("SELECT registrant_api_id, house_registrant_id, registrant_name, state FROM regs"),
        "dim_lobbyists": nested("SELECT cast(id AS varchar) AS lobbyist_api_id, max_by(first_name, o) AS first_name, max_by(last_name, o) FILTER (last_name IS NOT NULL) AS last_name, cast(max_by(reg, o) AS varchar) AS registrant_api_id FROM seen GROUP BY id"),
        "lobbying_entities": nested("SELECT * FROM ents"),
        "lobbying_overlay": nested("SELECT entity_type, entity_id, max(score) AS best_match_score, first(matched_alias ORDER BY score DESC, matched_alias, alias_source) AS best_alias, count(*) AS n_candidate_matches, string_agg(matched_alias, ' | ' ORDER BY score DESC, matched_alias, alias_source) AS candidate_aliases, 'needs_review' AS review_status FROM overlay GROUP BY entity_type, entity_id"),
        "nested_presence": nested("SELECT 'client' AS path, 'object' AS kind, count(*) AS n_present FROM nf UNION ALL SELECT 'client.client_id', 'scalar', count(source_id) FROM nf UNION ALL SELECT 'income', 'scalar', count(*) FROM nf UNION ALL SELECT 'expenses', 'scalar', count(expenses) FROM nf UNION ALL SELECT 'lobbying_activities', 'array', count(DISTINCT l_orderkey) FROM acts UNION ALL SELECT 'registrant.name', 'scalar', count(*) FROM nf"),
        "flat_shapes": nested("SELECT 'filings' AS \"table\", count(*) AS n_rows, 34 AS n_columns FROM nf UNION ALL SELECT 'filing_activities', count(*), 9 FROM acts UNION ALL SELECT 'contributions', count(*), 30 FROM reports UNION ALL SELECT 'contribution_items', count(*), 10 FROM items UNION ALL SELECT 'clients', count(*), 16 FROM clients"),
        "nested_sample": nested("SELECT * FROM (SELECT 'types' AS list, filing_type AS entry, count(*) AS n FROM nf GROUP BY 2 ORDER BY n DESC, entry LIMIT 10) UNION ALL SELECT * FROM (SELECT 'issues' AS list, concat('I', l_partkey % 7) AS entry, count(*) AS n FROM acts GROUP BY 2 ORDER BY n DESC, entry LIMIT 10)"),
        "paged_filings": nested("SELECT filing_uuid, min(event_id) AS event_id, min_by(event_type, event_id) AS event_type FROM paged6 GROUP BY filing_uuid"),
        "supplemented_snapshot": nested("SELECT filing_uuid, max_by(event_id, p) AS event_id, max_by(event_type, p) AS event_type FROM (SELECT filing_uuid, event_id, event_type, -event_id - 1 AS p FROM paged6 UNION ALL SELECT concat('E', event_id - event_id % 80 + 1), event_id, 'repaired', event_id FROM events WHERE event_id % 40 = 7 AND event_id < 4000) GROUP BY filing_uuid"),
        "unseen_rows": nested("SELECT filing_uuid, event_id FROM paged6 WHERE page >= 3 AND filing_uuid NOT IN (SELECT filing_uuid FROM paged6 WHERE page < 4)"),
        "scan_committees": sql(f"SELECT {text('cmte_id', 'cmte_nm', '-tres_nm', 'cmte_tp', 'cmte_dsgn', 'cmte_pty_affiliation', 'connected_org_nm', 'cand_id')} FROM cm"),
        "scan_candidates": sql(f"SELECT {text('cand_id', 'cand_name', 'cand_pty_affiliation', 'cand_election_yr', 'cand_office_st', 'cand_office', 'cand_office_district', '-cand_zip')} FROM cn"),
        "scan_links": sql(f"SELECT {text('cand_id', 'cand_election_yr', 'fec_election_yr', 'cmte_id', 'cmte_tp', 'cmte_dsgn', '-linkage_id')} FROM ccl"),
        "scan_contributions": sql(f"SELECT {text('cmte_id', 'transaction_tp', 'name', 'state', 'employer', 'occupation', 'transaction_dt', 'other_id', 'memo_cd', '-memo_text', 'sub_id')}, transaction_amt FROM itcont"),
        "scan_spending": sql(f"SELECT {text('cmte_id', 'transaction_tp', 'name', 'other_id', 'memo_cd', 'sub_id')}, transaction_amt FROM itoth"),
        "scan_to_candidates": sql(f"SELECT {text('cmte_id', 'transaction_tp', 'cand_id', 'memo_cd', 'sub_id', '-city')}, transaction_amt FROM itpas2"),
        "bulk_cycles": sql(f"SELECT {CYCLE} AS cycle, count(*) AS n_rows, {ms('transaction_amt')} AS total FROM itpas2"),
        "bronze_order": sql(f"SELECT {CYCLE} AS cycle, count(*) AS n_rows, count(*) AS n_places FROM ccl"),
        "curated_list": sql("SELECT employer, include, canonical_name, sector, notes, matched_searches FROM curated WHERE upper(trim(include)) = 'TRUE'"),
        "flat_table_csv": "SELECT cast(n_nationkey AS varchar) AS n_nationkey, n_name, cast(NULL AS varchar) AS note FROM nation",
        "json_records": "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 <> 0 THEN round(s_suppkey / 7, 10) END AS x, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS s FROM supplier",
        "entity_files": f"SELECT {slug('n_name')} AS slug, cast(n_nationkey AS bigint) AS n_nationkey, cast(n_regionkey AS bigint) AS n_regionkey FROM nation",
        "curated_migration": """SELECT employer, include, CASE WHEN trim(canonical_name) <> '' THEN trim(canonical_name) WHEN include = 'TRUE' THEN 'found by' ELSE '' END AS canonical_name, 'found by' AS matched_searches FROM (SELECT c_name AS employer,
 CASE c_custkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' WHEN 3 THEN 'TRUE' WHEN 5 THEN 'FALSE' END AS include, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS canonical_name FROM customer WHERE c_custkey <= 300) WHERE include IS NOT NULL""",
        "alias_states": sql(f"SELECT canonical_name, state, count(*) AS n_rows, count(DISTINCT name) AS n_donors, {ms('transaction_amt')} AS total FROM itcont i JOIN (SELECT upper(trim(employer)) AS k, upper(sector) AS canonical_name FROM curated WHERE upper(sector) <> 'OTHER') a ON upper(trim(i.employer)) = k GROUP BY 1, 2"),
        "inflow_paths": sql(f"SELECT source_file, transaction_tp, memo_cd, count(*) AS n_rows, {ms('transaction_amt')} AS total FROM {GIVEN} WHERE cmte_id = 'C3' GROUP BY ALL"),
        "inflow_givers": sql(f"SELECT source_file, name, {ms('transaction_amt')} AS total FROM {GIVEN} WHERE cmte_id = 'C3' GROUP BY ALL ORDER BY total DESC, name LIMIT 20"),
        "memo_only_types": sql("SELECT transaction_tp, count(*) AS n_rows FROM itoth WHERE transaction_tp IN ('24C', '15J') GROUP BY 1"),
        "first_seen_rows": "SELECT user_id, min(event_id) AS event_id, min_by(event_type, event_id) AS event_type FROM events WHERE user_id % 7 <> 0 GROUP BY user_id UNION ALL SELECT NULL, event_id, event_type FROM events WHERE user_id % 7 = 0",
        "composite_overlap": sql("SELECT count(*) FILTER (l AND r) AS n_both, count(*) FILTER (l AND NOT r) AS n_left_only, count(*) FILTER (r AND NOT l) AS n_right_only FROM (SELECT cmte_id, upper(trim(name)) AS name, bool_or(memo_cd = 'X') AS l, bool_or(memo_cd = '') AS r FROM itcont GROUP BY 1, 2)"),
        "number_labels": f"""SELECT c_custkey, CASE WHEN {LABEL_X} IS NULL THEN '' ELSE concat(CASE WHEN {LABEL_X} < 0 THEN '-' ELSE '' END, '$', format('{{:,}}', cast(abs({LABEL_X}) AS bigint))) END AS money,
 CASE WHEN c_custkey % 9 <> 0 THEN concat(format('{{:,.1f}}', c_custkey / 4), '%') ELSE '' END AS pct, cast(c_custkey * CASE c_custkey % 5 WHEN 0 THEN 1e3 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1 END AS double) AS parsed,
 concat(c_mktsegment, ' ', c_name) AS joined, strftime(DATE '2024-01-01' + cast(c_custkey AS int), '%Y-%m-%d') AS day FROM customer""",
        "lean_order": f"SELECT place, entity_type, entity_id FROM (SELECT *, {place('''CASE entity_type WHEN 'company' THEN 1 WHEN 'committee' THEN 2 ELSE 3 END, lean_measure_total DESC NULLS LAST, coverage_total DESC NULLS LAST, entity_name NULLS LAST, entity_id''')} FROM ({lean})) WHERE place <= 100",
        "race_order": sql(f"SELECT place, cand_id, race_key FROM (SELECT *, {place('is_display_candidate DESC, is_major_party DESC, tech_itemized_receipts DESC, ie_support_total DESC, linked_principal_committee_count DESC, cand_name, cand_id')} FROM races) WHERE place <= 25"),
        "state_order": f"SELECT place, state_code FROM (SELECT *, {place('tech_itemized_receipts DESC, house_district_count DESC, state_code')} FROM ({states}))",
        "house_page": sql(f"SELECT place, cand_id, cand_name FROM (SELECT *, {place('tech_itemized_receipts DESC, ie_support_total DESC, linked_committee_count DESC, cand_name, cand_id')} FROM races WHERE cand_office = 'H' AND (is_display_candidate OR NOT EXISTS (SELECT 1 FROM races r2 WHERE r2.cand_office = 'H' AND r2.is_display_candidate))) WHERE place <= 18"),
        "home_leaders": sql(f"SELECT * FROM (SELECT {place('net_total DESC, tech_canonical_name')}, tech_canonical_name, net_total FROM companies) WHERE place <= 5"),
        "political_bodies": sql("SELECT cmte_id, tech_receipts, recipient_bucket FROM export WHERE is_featured AND NOT is_candidate_committee"),
        "donor_shares": sql("SELECT name, pct_d, coalesce(CASE WHEN n_committees % 2 = 0 THEN pct_r END, 1 - pct_d) AS pct_r FROM donors"),
        "tile_map": f"SELECT state_code, tiles.x AS tile_x, tiles.y AS tile_y, tiles.x IS NOT NULL AS is_mapped, coalesce(names.name, state_code) AS state_name FROM ({states}) s LEFT JOIN {TILES} ON tiles.st = state_code LEFT JOIN {NAMES} ON names.st = state_code",
        "badges": sql(f"SELECT cmte_id, concat('party-', lower(coalesce(party_dr, 'Unknown'))) AS badge, {slug('concat(cmte_nm, chr(32), cmte_id)')} AS slug FROM classes"),
        "weekly_chart": f"SELECT week_end, cumulative_net_total, (week_end - min(week_end) OVER ()) / nullif(max(week_end) OVER () - min(week_end) OVER (), 0) * 720 AS x, 220 - (cumulative_net_total - least(min(cumulative_net_total) OVER (), 0)) / nullif(greatest(max(cumulative_net_total) OVER (), 0) - least(min(cumulative_net_total) OVER (), 0), 0) * 220 AS y FROM ({known['weekly_totals']})",
        "weekly_stream": f"SELECT {WEEK.format('cast(ts AS date)')} AS week_end, {ms('value')} AS net_total, count(*) AS n_rows FROM events GROUP BY 1",
        "first_seen_stream": "SELECT DISTINCT user_id FROM events",
    }
