"""SQL for each registered query, written independently of the plans; it runs on the driver's tables.

Every statement starts from the analog views; ``STEPS`` are the shared steps, each a named subquery.
"""

from __future__ import annotations

from moneyflow import codes
from moneyflow.analog import CYCLE, VIEWS


def ms(x: str) -> str:
    return f"cast(coalesce(sum(cast({x} AS decimal(18,2))), 0) AS double)"


def cat(x: str, sep: str = "; ") -> str:
    return f"coalesce(string_agg(DISTINCT {x}, '{sep}' ORDER BY {x}), '')"


def inlist(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


SEATS = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in codes.HOUSE_SEATS.items()) + ") seats(st, n)"
SUFFIXES = "|".join(codes.NAME_SUFFIXES)
WEEK = "cast(date_trunc('week', {}) AS date) + 6"


def lean(d: str, r: str, start: str) -> str:
    return f"CASE WHEN {r} / nullif({d} + {r}, 0) >= 0.7 THEN 'R' WHEN {d} / nullif({d} + {r}, 0) >= 0.7 THEN 'D' ELSE {start} END"


def norm(x: str) -> str:
    return f"trim(regexp_replace(replace(upper({x}), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g'))"


def core(x: str) -> str:
    return f"trim(regexp_replace({x}, '((^| )({SUFFIXES}))+$', ''))"


def slug(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


CLEAN = "CASE WHEN upper(trim(cand_office_district)) IN ('', 'NAN', 'NONE') THEN '' ELSE regexp_replace(upper(trim(cand_office_district)), '\\.0$', '') END"
DISTRICT = f"CASE WHEN ({CLEAN}) = '' THEN '' WHEN try_cast(({CLEAN}) AS double) IS NULL THEN ({CLEAN}) WHEN cast(trunc(cast(({CLEAN}) AS double)) AS int) = 0 THEN 'AL' ELSE lpad(cast(cast(trunc(cast(({CLEAN}) AS double)) AS int) AS varchar), 2, '0') END"
VALID = "coalesce(CASE WHEN seats.n IS NULL THEN district <> '' WHEN seats.n = 1 THEN district = 'AL' ELSE coalesce(try_cast(district AS int), 0) BETWEEN 1 AND seats.n END, false)"
RACE = "CASE cand_office WHEN 'P' THEN 'PRES' WHEN 'S' THEN concat('SEN-', cand_office_st) WHEN 'H' THEN concat('HOUSE-', cand_office_st, '-', cand_office_district) ELSE concat(cand_office, '-', cand_office_st, '-', cand_office_district) END"
BUCKET = (
    "CASE "
    + " ".join(f"WHEN cmte_tp IN {inlist(v)} THEN '{k}'" for k, v in codes.RECIPIENT_BUCKETS.items())
    + " ELSE 'other' END"
)
PERIOD = "CASE filing_period " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.PERIOD_ORDER.items()) + f" ELSE {codes.PERIOD_LAST} END"
SPEND = f"{ms('income')} AS total_income, {ms('expenses')} AS total_expenses, {ms('income')} + {ms('expenses')} AS total_reported_spend"
ISSUE_SPEND = f"{ms('income')} AS income_sum, {ms('expenses')} AS expenses_sum, {ms('income')} + {ms('expenses')} AS total_reported_spend"
PKEYS = "filing_year, filing_period, filing_period_display"

STEPS: dict[str, str] = {k: sql for k, (_, sql) in VIEWS.items()} | {
    "contrib": f"""SELECT i.*, transaction_tp IN {inlist(codes.REFUND_CODES)} AS is_refund, CASE WHEN transaction_tp IN {inlist(codes.REFUND_CODES)} THEN -transaction_amt ELSE transaction_amt END AS net_amt,
 cm.cmte_nm, cm.cmte_tp, cm.cmte_dsgn, cm.cmte_pty_affiliation, cm.cand_id FROM itcont i LEFT JOIN cm ON i.cmte_id = cm.cmte_id
 WHERE transaction_tp IN {inlist(codes.CONTRIBUTION_CODES + codes.REFUND_CODES)} AND NOT (memo_cd = 'X' AND transaction_tp = '15E')""",
    "spending": f"""SELECT o.*, transaction_amt AS net_amt, cm.cmte_nm AS filer_cmte_nm, cm.cmte_tp AS filer_cmte_tp FROM itoth o LEFT JOIN cm ON o.cmte_id = cm.cmte_id
 WHERE transaction_tp IN {inlist(codes.SPENDING_CODES)} AND memo_cd <> 'X'""",
    "lookup": """SELECT k, canonical_name AS tech_canonical_name, sector AS tech_sector FROM (SELECT upper(trim(employer)) AS k, *, row_number() OVER (PARTITION BY upper(trim(employer)) ORDER BY _row_ord) AS rn FROM curated WHERE upper(include) = 'TRUE') WHERE rn = 1""",
    "tagged": "SELECT c.*, tech_canonical_name, tech_sector, coalesce(tech_canonical_name <> '', false) AS is_tech_employer FROM contrib c LEFT JOIN lookup ON upper(trim(c.employer)) = k",
    "tech": "SELECT * FROM tagged WHERE is_tech_employer",
    "dated": f"SELECT *, {WEEK.format('contribution_date')} AS week_end FROM (SELECT *, cast(try_strptime(transaction_dt, '%m%d%Y') AS date) AS contribution_date FROM tech) WHERE contribution_date IS NOT NULL",
    "party": f"SELECT cand_id, CASE cand_pty_affiliation WHEN 'DEM' THEN 'D' ELSE 'R' END AS cand_party FROM cn WHERE cand_election_yr = '{CYCLE}' AND cand_pty_affiliation IN ('DEM', 'REP')",
    "first_link": "SELECT cmte_id AS lc, min_by(cand_id, _row_ord) AS linked FROM ccl WHERE cand_id <> '' GROUP BY cmte_id",
    "ie_sides": """SELECT o.cmte_id, o.transaction_amt, CASE WHEN (transaction_tp = '24E') = (cand_party = 'D') THEN 'D' ELSE 'R' END AS side, 'ie_spending' AS source
 FROM itoth o LEFT JOIN first_link ON o.other_id = lc JOIN party ON party.cand_id = CASE WHEN coalesce(linked, '') <> '' THEN linked ELSE o.other_id END WHERE transaction_tp IN ('24E', '24A')""",
    "gift_sides": "SELECT p.cmte_id, transaction_amt, cand_party AS side, '24k_contributions' AS source FROM itpas2 p JOIN party ON p.cand_id = party.cand_id WHERE transaction_tp = '24K' AND memo_cd <> 'X'",
    "ev0": f"""SELECT cmte_id, {ms("CASE WHEN side = 'D' THEN transaction_amt END")} AS dem_evidence_amt, {ms("CASE WHEN side = 'R' THEN transaction_amt END")} AS rep_evidence_amt, {cat('source', '+')} AS evidence_sources
 FROM (SELECT * FROM ie_sides UNION ALL SELECT * FROM gift_sides) GROUP BY cmte_id""",
    "evidence": f"""SELECT cmte_id, dem_evidence_amt, rep_evidence_amt, dem_evidence_amt + rep_evidence_amt AS evidence_total, dem_evidence_amt / nullif(dem_evidence_amt + rep_evidence_amt, 0) AS evidence_pct_dem,
 rep_evidence_amt / nullif(dem_evidence_amt + rep_evidence_amt, 0) AS evidence_pct_rep, {lean('dem_evidence_amt', 'rep_evidence_amt', "'Mixed'")} AS behavioral_party, evidence_sources FROM ev0""",
    "filed_party": f"""SELECT *, CASE cmte_pty_affiliation WHEN 'DEM' THEN 'D' WHEN 'REP' THEN 'R' END AS filed, CASE WHEN cmte_pty_affiliation IN ('DEM', 'REP') AND cmte_tp IN ('H', 'S', 'P', 'X', 'Y') THEN 'party_field' ELSE '' END AS src FROM cm""",
    "classes": """SELECT f.cmte_id, cmte_nm, cmte_tp, cmte_pty_affiliation, cand_id, CASE WHEN src = '' AND behavioral_party IS NOT NULL THEN behavioral_party ELSE filed END AS party_dr,
 CASE WHEN src = '' AND behavioral_party IS NOT NULL THEN evidence_sources ELSE src END AS classification_source, coalesce(evidence_sources, '') AS evidence_sources,
 coalesce(dem_evidence_amt, 0.0) AS dem_evidence_amt, coalesce(rep_evidence_amt, 0.0) AS rep_evidence_amt, coalesce(evidence_total, 0.0) AS evidence_total, evidence_pct_dem, evidence_pct_rep
 FROM filed_party f LEFT JOIN evidence e ON f.cmte_id = e.cmte_id""",
    "sided": "SELECT t.*, coalesce(party_dr, 'Unknown') AS cmte_party FROM tagged t LEFT JOIN classes c ON t.cmte_id = c.cmte_id",
    "d0": "SELECT name, " + ", ".join(f"{ms(f'''CASE WHEN cmte_party = '{p}' THEN net_amt END''')} AS {p}" for p in ("D", "R", "Mixed", "Unknown")) + " FROM sided GROUP BY name",
    "donor_class": f"""SELECT name, D, R, Mixed, Unknown, D + R + Mixed + Unknown AS overall_total, D + R AS classified_total, D / nullif(D + R, 0) AS pct_d, R / nullif(D + R, 0) AS pct_r,
 (D + R) / nullif(D + R + Mixed + Unknown, 0) AS pct_classified, CASE WHEN D + R <= 0 THEN 'Unknown' ELSE {lean('D', 'R', "'Mixed'")} END AS donor_party FROM d0""",
    "top_c": f"""SELECT name, cmte_nm AS top_committee, cmte_tp AS top_committee_type, amt AS top_committee_amt FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY amt DESC, cmte_id) AS rn
 FROM (SELECT name, cmte_id, cmte_nm, cmte_tp, {ms('net_amt')} AS amt FROM tech WHERE cmte_nm IS NOT NULL AND cmte_tp IS NOT NULL GROUP BY name, cmte_id, cmte_nm, cmte_tp)) WHERE rn = 1""",
    "don0": f"""SELECT name, {ms('net_amt')} AS net_total, {ms('CASE WHEN transaction_amt > 0 THEN transaction_amt END')} AS gross_positive, count(*) AS n_contributions, count(DISTINCT cmte_id) AS n_committees,
 {cat('employer')} AS employers, {cat('occupation')} AS occupations, {cat('state')} AS states, {cat('tech_canonical_name')} AS tech_companies, {cat('tech_sector')} AS tech_sectors FROM tech GROUP BY name""",
    "donors": "SELECT a.*, top_committee, top_committee_type, top_committee_amt, d.* EXCLUDE (name) FROM don0 a LEFT JOIN top_c t ON a.name = t.name LEFT JOIN donor_class d ON a.name = d.name",
    "comp0": "SELECT tech_canonical_name, "
    + f"{ms('net_amt')} AS net_total, count(DISTINCT name) AS n_donors, count(*) AS n_contributions, count(DISTINCT cmte_id) AS n_committees, {cat('tech_sector')} AS sectors, "
    + ", ".join(f"{ms(f'''CASE WHEN cmte_party = '{p}' THEN net_amt END''')} AS {n}" for p, n in (("D", "amt_dem"), ("R", "amt_rep"), ("Mixed", "amt_mixed"), ("Unknown", "amt_unknown")))
    + " FROM sided WHERE is_tech_employer GROUP BY tech_canonical_name",
    "companies": """SELECT *, amt_mixed + amt_unknown AS amt_other, amt_dem + amt_rep AS classified_recipient_total, amt_dem / nullif(amt_dem + amt_rep, 0) * 100 AS pct_dem,
 (amt_dem + amt_rep) / nullif(net_total, 0) * 100 AS pct_classified_recipients FROM comp0""",
    "rec0": f"""SELECT cmte_id, {ms('net_amt')} AS total_receipts, count(DISTINCT name) AS total_donors, count(*) AS total_contributions, {ms('CASE WHEN is_tech_employer THEN net_amt END')} AS tech_receipts,
 count(DISTINCT CASE WHEN is_tech_employer THEN name END) AS tech_donors, count(*) FILTER (is_tech_employer) AS tech_contributions, {cat('CASE WHEN is_tech_employer THEN tech_canonical_name END')} AS tech_companies
 FROM tagged GROUP BY cmte_id""",
    "receipts": """SELECT r.*, tech_receipts / nullif(total_receipts, 0) * 100 AS tech_pct, cm.cmte_nm, cm.cmte_tp, cm.cmte_dsgn, cm.cmte_pty_affiliation, cm.connected_org_nm, cm.cand_id, party_dr, classification_source, evidence_sources,
 dem_evidence_amt, rep_evidence_amt, evidence_total, evidence_pct_dem FROM rec0 r LEFT JOIN cm ON r.cmte_id = cm.cmte_id LEFT JOIN classes c ON r.cmte_id = c.cmte_id""",
    "export": f"""SELECT cmte_id, tech_receipts, tech_pct, {BUCKET.replace('cmte_tp', "coalesce(cmte_tp, '')")} AS recipient_bucket, coalesce(cmte_tp, '') IN ('H', 'S', 'P') AS is_candidate_committee,
 tech_receipts >= 100000 OR coalesce(tech_pct, 0) >= 10 AS is_featured, coalesce(tech_pct, 0) >= 50 AS is_tech_dominated, cmte_nm, connected_org_nm, total_contributions, cmte_tp, party_dr, tech_donors FROM receipts WHERE tech_receipts > 0""",
    "by_donor": "SELECT *, donor_amt_D + donor_amt_R + donor_amt_Mixed + donor_amt_Unknown AS donor_amt_total, n_donors_D + n_donors_R + n_donors_Mixed + n_donors_Unknown AS n_donors_total, donor_amt_D / nullif(donor_amt_D + donor_amt_R, 0) * 100 AS pct_dem_by_donor FROM (SELECT tech_canonical_name, "
    + ", ".join(f"{ms(f'''CASE WHEN coalesce(donor_party, 'Unknown') = '{p}' THEN net_amt END''')} AS donor_amt_{p}, count(DISTINCT CASE WHEN coalesce(donor_party, 'Unknown') = '{p}' THEN t.name END) AS n_donors_{p}" for p in ("D", "R", "Mixed", "Unknown"))
    + " FROM tech t LEFT JOIN donor_class d ON t.name = d.name GROUP BY tech_canonical_name)",
    "company_table": f"SELECT c.*, b.* EXCLUDE (tech_canonical_name), {slug('c.tech_canonical_name')} AS slug FROM companies c LEFT JOIN by_donor b ON c.tech_canonical_name = b.tech_canonical_name",
    "top_donor_rows": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tech_canonical_name ORDER BY net_total DESC, name) AS rank FROM
 (SELECT tech_canonical_name, name, {ms('net_amt')} AS net_total, {ms('CASE WHEN transaction_amt > 0 THEN transaction_amt END')} AS gross_positive, count(*) AS n_contributions, count(DISTINCT cmte_id) AS n_committees,
 {cat('employer')} AS employers, {cat('state')} AS states FROM dated GROUP BY ALL) a LEFT JOIN (SELECT tech_canonical_name, name, cmte_nm AS top_committee, cmte_tp AS top_committee_type, amt AS top_committee_amt FROM
 (SELECT *, row_number() OVER (PARTITION BY tech_canonical_name, name ORDER BY amt DESC, cmte_nm, cmte_tp) AS rn FROM (SELECT tech_canonical_name, name, cmte_nm, cmte_tp, {ms('net_amt')} AS amt FROM dated
 WHERE cmte_nm IS NOT NULL AND cmte_tp IS NOT NULL GROUP BY ALL)) WHERE rn = 1) b USING (tech_canonical_name, name))""",
    "top_cmte_rows": f"""SELECT *, row_number() OVER (PARTITION BY tech_canonical_name ORDER BY net_total DESC, cmte_id) AS rank FROM (SELECT d.tech_canonical_name, d.cmte_id, d.cmte_nm, d.cmte_tp, coalesce(party_dr, 'Unknown') AS party_dr, classification_source,
 {BUCKET.replace('cmte_tp', "coalesce(d.cmte_tp, '')")} AS recipient_bucket, {ms('net_amt')} AS net_total, count(DISTINCT name) AS n_donors, count(*) AS n_contributions FROM dated d JOIN classes c ON d.cmte_id = c.cmte_id
 WHERE d.cmte_nm IS NOT NULL AND d.cmte_tp IS NOT NULL GROUP BY ALL)""",
    "links": f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cand_id, cmte_id ORDER BY _row_ord) AS rn FROM ccl WHERE cand_election_yr = '{CYCLE}' OR fec_election_yr = '{CYCLE}') WHERE rn = 1",
    "linked": f"""SELECT l.cand_id, count(DISTINCT l.cmte_id) AS linked_committee_count, count(*) FILTER (l.cmte_dsgn = 'P') AS linked_principal_committee_count, {cat('l.cmte_id')} AS linked_committee_ids,
 {cat('cm.cmte_nm')} AS linked_committee_names, {cat('l.cmte_tp')} AS linked_committee_types FROM links l LEFT JOIN cm ON l.cmte_id = cm.cmte_id GROUP BY l.cand_id""",
    "fin0": f"""SELECT l.cand_id, {ms('total_receipts')} AS total_itemized_receipts, cast(coalesce(sum(total_donors), 0) AS bigint) AS total_itemized_donors, {ms('tech_receipts')} AS tech_itemized_receipts,
 cast(coalesce(sum(tech_donors), 0) AS bigint) AS tech_itemized_donors, cast(coalesce(sum(tech_contributions), 0) AS bigint) AS tech_itemized_contributions FROM links l LEFT JOIN rec0 r ON l.cmte_id = r.cmte_id GROUP BY l.cand_id""",
    "tags": f"SELECT l.cand_id, {cat('tech_canonical_name')} AS tech_company_tags FROM links l JOIN tech t ON l.cmte_id = t.cmte_id GROUP BY l.cand_id",
    "last_link": "SELECT cmte_id AS lc, max_by(cand_id, _row_ord) AS linked FROM links GROUP BY cmte_id",
    "ie_rows": """SELECT CASE WHEN coalesce(linked, '') <> '' THEN linked ELSE other_id END AS cand_id, transaction_tp, net_amt, coalesce(r.tech_receipts > 0, false) AS funded
 FROM spending s LEFT JOIN last_link ON s.other_id = lc LEFT JOIN rec0 r ON s.cmte_id = r.cmte_id WHERE transaction_tp IN ('24E', '24A')""",
    "ie": f"""SELECT cand_id, {ms("CASE WHEN transaction_tp = '24E' THEN net_amt END")} AS ie_support_total, {ms("CASE WHEN transaction_tp = '24A' THEN net_amt END")} AS ie_oppose_total,
 {ms("CASE WHEN transaction_tp = '24E' AND funded THEN net_amt END")} AS tech_funded_ie_support_total, {ms("CASE WHEN transaction_tp = '24A' AND funded THEN net_amt END")} AS tech_funded_ie_oppose_total
 FROM ie_rows WHERE cand_id <> '' GROUP BY cand_id""",
    "race0": f"""SELECT cn.* EXCLUDE (_row_ord), CASE cand_pty_affiliation WHEN 'DEM' THEN 'D' WHEN 'REP' THEN 'R' END AS party_dr, cand_pty_affiliation IN ('DEM', 'REP') AS is_major_party, {RACE} AS race_key,
 coalesce(linked_committee_count, 0) AS linked_committee_count, coalesce(linked_principal_committee_count, 0) AS linked_principal_committee_count, coalesce(linked_committee_ids, '') AS linked_committee_ids,
 coalesce(linked_committee_names, '') AS linked_committee_names, coalesce(linked_committee_types, '') AS linked_committee_types, coalesce(total_itemized_receipts, 0) AS total_itemized_receipts,
 coalesce(total_itemized_donors, 0) AS total_itemized_donors, coalesce(tech_itemized_receipts, 0) AS tech_itemized_receipts, coalesce(tech_itemized_donors, 0) AS tech_itemized_donors,
 coalesce(tech_itemized_contributions, 0) AS tech_itemized_contributions, coalesce(tech_company_tags, '') AS tech_company_tags, tech_itemized_receipts / nullif(total_itemized_receipts, 0) * 100 AS tech_pct_itemized_receipts,
 coalesce(ie_support_total, 0) AS ie_support_total, coalesce(ie_oppose_total, 0) AS ie_oppose_total, coalesce(tech_funded_ie_support_total, 0) AS tech_funded_ie_support_total,
 coalesce(tech_funded_ie_oppose_total, 0) AS tech_funded_ie_oppose_total FROM cn LEFT JOIN linked ON cn.cand_id = linked.cand_id LEFT JOIN fin0 ON cn.cand_id = fin0.cand_id
 LEFT JOIN tags ON cn.cand_id = tags.cand_id LEFT JOIN ie ON cn.cand_id = ie.cand_id WHERE cand_election_yr = '{CYCLE}'""",
    "races": """SELECT *, ie_support_total - ie_oppose_total AS ie_net_support, tech_funded_ie_support_total - tech_funded_ie_oppose_total AS tech_funded_ie_net_support,
 linked_principal_committee_count > 0 AS has_principal_candidate_committee, active AS has_finance_activity, linked_principal_committee_count > 0 OR active AS is_display_candidate
 FROM (SELECT *, greatest(total_itemized_receipts, tech_itemized_receipts, ie_support_total, ie_oppose_total, tech_funded_ie_support_total, tech_funded_ie_oppose_total) > 0 AS active FROM race0)""",
    "placed": f"SELECT races.* EXCLUDE (active), {CLEAN.replace('cand_office_district', 'cand_office_st')} AS state_code, {DISTRICT} AS district FROM races",
    "valid": f"SELECT placed.* FROM placed LEFT JOIN {SEATS} ON seats.st = state_code WHERE state_code <> '' AND (cand_office <> 'H' OR {VALID})",
    "entities": f"""SELECT entity_id, n, {core('n')} AS c FROM (SELECT cast(p_partkey AS varchar) AS entity_id, {norm("concat(p_type, ' ', p_brand, CASE WHEN p_size % 2 = 0 THEN ' Inc.' ELSE '' END)")} AS n FROM part)""",
    "alias0": """SELECT * FROM (VALUES ('STANDARD POLISHED TIN Brand#11', 'employer'), ('Polished steel', 'matched_searches'), ('Tin Co', 'canonical_name'), ('Anodized Copper', 'employer'), ('ANODIZED COPPER Holdings', 'canonical_name'),
 ('small', 'employer'), ('Brand#2', 'matched_searches'), ('ECONOMY', 'canonical_name'), ('MEDIUM PLATED BRASS Brand#33 LLC', 'employer'), ('x; y', 'matched_searches'), ('Plated Brass Inc', 'canonical_name')) a(matched_alias, alias_source)""",
    "alias1": f"SELECT *, {core('an')} AS ac, length(replace(an, ' ', '')) >= 6 OR regexp_matches(an, '[0-9]') AS ok FROM (SELECT *, {norm('matched_alias')} AS an FROM alias0)",
    "matched": """SELECT * FROM (SELECT entity_id, matched_alias, alias_source, CASE WHEN n = an THEN 100 WHEN ac <> '' AND c = ac THEN 96 WHEN ok AND contains(n, an) THEN 86 WHEN ok AND ac <> '' AND contains(c, ac) THEN 82 END AS match_score
 FROM entities, alias1) WHERE match_score IS NOT NULL""",
    "facts": f"SELECT a.*, f.filing_year, f.filing_period, f.filing_period_display, client_api_id, client_name, registrant_api_id, income, expenses FROM activities a LEFT JOIN filed f ON a.filing_uuid = f.filing_uuid",
    "paged": "SELECT concat('E', cast(event_id - CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS varchar)) AS filing_uuid, event_id, event_type, cast(floor(event_id / 100.0) AS bigint) AS _page, event_id % 100 AS _pos, cast(cast(floor(event_id / 7.0) AS bigint) AS varchar) AS dt_posted FROM events",
    "parts": """SELECT employer, count(*) AS n_contributions, cast(sum(cast(p_retailprice AS decimal(18,2))) AS double) AS total_usd, count(DISTINCT p_size) AS n_donors FROM (SELECT concat(p_name, ' ', p_brand, ' ', p_type) AS employer, * FROM part) GROUP BY employer""",
    "found": """SELECT *, regexp_matches(employer, '(?i)BOLT|\\bGEAR\\b') AS bolt, regexp_matches(employer, '(?i)^hot') AS hot1, regexp_matches(employer, '(?i)MEDIUM') AS medium, regexp_matches(employer, '9$') AS end9,
 upper(trim(employer)) = 'SMALL RING BRAND#2 ECONOMY' AS exact_ring, upper(trim(employer)) = 'RED WIDGET BRAND#17 ECONOMY' AS hot2 FROM parts""",
    "candidates": """SELECT employer, n_contributions, total_usd, n_donors, concat_ws('; ', CASE WHEN bolt THEN 'bolt' END, CASE WHEN end9 THEN 'end9' END, CASE WHEN exact_ring THEN 'exact_ring' END, CASE WHEN hot1 OR hot2 THEN 'hot' END, CASE WHEN medium THEN 'medium' END) AS matched_searches,
 concat_ws('; ', CASE WHEN bolt OR hot1 OR medium OR end9 THEN 'regex' END, CASE WHEN exact_ring OR hot2 THEN 'exact' END) AS match_types, regexp_matches(employer, '(?i)WIDGET|BLUE') AS flagged_noisy
 FROM found WHERE bolt OR hot1 OR medium OR end9 OR exact_ring OR hot2""",
}


def sql(body: str) -> str:
    """The statement with the steps that it needs, in order."""
    import re

    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in STEPS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(STEPS[name])
    steps = ",\n".join(f"{n} AS ({s})" for n, s in STEPS.items() if n in needed)
    return f"WITH {steps}\n{body}" if steps else body


METRICS = f"""count(*) AS candidate_count, count(*) FILTER (is_major_party) AS major_party_candidate_count, {ms('total_itemized_receipts')} AS total_itemized_receipts, {ms('tech_itemized_receipts')} AS tech_itemized_receipts,
 {ms('ie_support_total')} AS ie_support_total, {ms('ie_oppose_total')} AS ie_oppose_total, {ms('tech_funded_ie_support_total')} AS tech_funded_ie_support_total, {ms('tech_funded_ie_oppose_total')} AS tech_funded_ie_oppose_total,
 {ms("CASE WHEN party_dr = 'D' THEN tech_itemized_receipts END")} AS dem_tech_itemized_receipts, {ms("CASE WHEN party_dr = 'R' THEN tech_itemized_receipts END")} AS rep_tech_itemized_receipts"""
DT, RT = "dem_tech_itemized_receipts", "rep_tech_itemized_receipts"
PCTS = f"""{DT} / nullif({DT} + {RT}, 0) * 100 AS pct_dem, {RT} / nullif({DT} + {RT}, 0) * 100 AS pct_rep, ie_support_total - ie_oppose_total AS ie_net_support,
 tech_funded_ie_support_total - tech_funded_ie_oppose_total AS tech_funded_ie_net_support,
 CASE WHEN {RT} / nullif({DT} + {RT}, 0) * 100 >= 70 THEN 'R' WHEN {DT} / nullif({DT} + {RT}, 0) * 100 >= 70 THEN 'D' WHEN {DT} + {RT} > 0 THEN 'Mixed' ELSE 'Unknown' END AS party_label"""


def rollup(rows: str, keys: str, more: str, sides: bool) -> str:
    """Metrics of all candidates, names of the leading display candidates."""
    best = lambda cond: f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY tech_itemized_receipts DESC, ie_support_total DESC, linked_committee_count DESC, cand_name, cand_id) AS rn FROM rows WHERE is_display_candidate AND {cond}) WHERE rn = 1)"
    joins = f" LEFT JOIN (SELECT {keys}, cand_name AS top_candidate_name, party_dr AS top_candidate_party, tech_itemized_receipts AS top_candidate_tech_itemized_receipts FROM {best('true')}) USING ({keys})"
    columns = ", top_candidate_name, top_candidate_party, top_candidate_tech_itemized_receipts"
    if sides:
        for p, n in (("D", "dem"), ("R", "rep")):
            joins += f""" LEFT JOIN (SELECT {keys}, cand_name AS {n}_candidate_name FROM {best(f"party_dr = '{p}'")}) USING ({keys})"""
            columns += f", {n}_candidate_name"
        joins += f" LEFT JOIN (SELECT {keys}, {cat('cand_name')} AS other_candidate_names FROM rows WHERE is_display_candidate AND party_dr IS NULL GROUP BY {keys}) USING ({keys})"
        columns += ", coalesce(other_candidate_names, '') AS other_candidate_names"
    inner = sql(rows)
    head = inner[: inner.rindex("\nSELECT")]
    return f"{head},\nrows AS ({rows}),\nbase AS (SELECT *, {PCTS} FROM (SELECT {keys}, {METRICS}{more} FROM rows GROUP BY {keys}))\nSELECT base.*{columns} FROM base{joins}"


CUM = "cast(sum(cast(net_total AS decimal(28,2))) OVER ({} ORDER BY week_end ROWS UNBOUNDED PRECEDING) AS double) AS {}"
WEEK_M = f"{ms('net_amt')} AS net_total, {ms('CASE WHEN transaction_amt > 0 THEN transaction_amt END')} AS gross_positive, count(*) AS n_contributions, count(DISTINCT name) AS n_donors"
WEEKLY = f"SELECT {CYCLE} AS cycle, *, {CUM.format('', 'cumulative_net_total')} FROM (SELECT week_end, {WEEK_M}, count(DISTINCT cmte_id) AS n_committees FROM dated GROUP BY week_end)"
PARTIES = ("D", "R", "Mixed", "Unknown")
RAW_NAME = "concat(c_mktsegment, ' & ', c_name, CASE WHEN c_custkey % 2 = 0 THEN ', Inc. Co' ELSE ' Holdings  llc' END)"

SQL: dict[str, str] = {
    "contrib_net_by_type": sql(f"SELECT transaction_tp, is_refund, count(*) AS n_rows, {ms('net_amt')} AS net_total FROM contrib GROUP BY ALL"),
    "spending_filter_join": sql(f"""SELECT filer_cmte_tp, transaction_tp, count(*) AS n_rows, {ms('net_amt')} AS total, {ms("CASE WHEN transaction_tp = '24E' THEN net_amt END")} AS support, {ms("CASE WHEN transaction_tp = '24A' THEN net_amt END")} AS oppose FROM spending GROUP BY ALL"""),
    "employer_tag_exact": sql("SELECT employer, tech_canonical_name, tech_sector, is_tech_employer, count(*) AS n_rows, count(DISTINCT name) AS n_donors FROM tagged GROUP BY ALL"),
    "company_party_split": sql("SELECT * FROM companies"),
    "company_donor_pivot2": sql("SELECT * FROM by_donor"),
    "donor_summary": sql("SELECT * FROM donors"),
    "donor_top_committee": sql(f"SELECT name, cmte_nm, amt FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY amt DESC, cmte_nm) AS rn FROM (SELECT name, cmte_nm, {ms('net_amt')} AS amt FROM tech WHERE cmte_nm IS NOT NULL GROUP BY ALL)) WHERE rn = 1"),
    "donor_party_class": sql("SELECT * FROM donor_class"),
    "committee_behavior": sql("SELECT * FROM evidence"),
    "committee_evidence_merge": sql("SELECT * FROM classes"),
    "committee_receipts_share": sql("SELECT * FROM receipts"),
    "outbound_inner": sql("SELECT s.cmte_id, transaction_tp, name, other_id, sub_id, net_amt, f.cmte_nm AS filer_cmte_nm, f.cmte_tp AS filer_cmte_tp, f.cmte_dsgn AS filer_cmte_dsgn, f.cmte_pty_affiliation AS filer_cmte_pty_affiliation, f.connected_org_nm AS filer_connected_org_nm, f.cand_id AS filer_cand_id, tech_receipts, total_receipts, tech_pct, tech_companies FROM spending s JOIN receipts r ON s.cmte_id = r.cmte_id LEFT JOIN cm f ON s.cmte_id = f.cmte_id WHERE tech_receipts > 0"),
    "funded_semi": sql("SELECT cmte_id, cmte_nm, cmte_tp FROM cm WHERE cmte_id IN (SELECT cmte_id FROM tech)"),
    "review_anti": "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "sankey_edges": sql(f"""SELECT * EXCLUDE (cmte_id) FROM (SELECT name AS source, 'donor' AS source_type, tech_canonical_name AS source_company, cmte_id, cmte_nm AS target, cmte_tp AS target_type, 'donor_to_committee' AS edge_type, {ms('net_amt')} AS amount FROM tech WHERE cmte_nm IS NOT NULL AND cmte_tp IS NOT NULL GROUP BY ALL)
 UNION ALL SELECT * EXCLUDE (cmte_id) FROM (SELECT filer_cmte_nm, filer_cmte_tp, '' AS c, cmte_id, name, transaction_tp, 'committee_to_candidate' AS e, {ms('net_amt')} AS amount FROM spending WHERE filer_cmte_nm IS NOT NULL AND filer_cmte_tp IS NOT NULL AND cmte_id IN (SELECT cmte_id FROM receipts WHERE tech_receipts > 0) GROUP BY ALL)"""),
    "entity_lean_union": sql(f"""SELECT {CYCLE} AS cycle, *, 1 - party_score_dem AS party_score_rep FROM (
 SELECT 'company' AS entity_type, tech_canonical_name AS entity_id, tech_canonical_name AS entity_name, 'tech_company' AS entity_subtype, CASE WHEN 100 - pct_dem >= 70 THEN 'R' WHEN pct_dem >= 70 THEN 'D' WHEN classified_recipient_total > 0 THEN 'Mixed' ELSE 'Unknown' END AS party_label,
 CASE WHEN classified_recipient_total > 0 THEN pct_dem / 100 END AS party_score_dem, amt_dem AS lean_dem_amt, amt_rep AS lean_rep_amt, amt_mixed AS mixed_amt, amt_unknown AS unknown_amt, classified_recipient_total AS lean_measure_total, net_total AS coverage_total,
 pct_classified_recipients / 100 AS coverage_ratio, 'employee_recipient_committee_lean' AS classification_method, 'company_employee_giving' AS classification_source, 'tech_companies' AS scope FROM companies
 UNION ALL SELECT 'committee', cmte_id, cmte_nm, coalesce(cmte_tp, ''), coalesce(party_dr, 'Unknown'), CASE party_dr WHEN 'D' THEN 1.0 WHEN 'R' THEN 0.0 WHEN 'Mixed' THEN evidence_pct_dem END, dem_evidence_amt, rep_evidence_amt, 0.0, 0.0, evidence_total, evidence_total,
 CASE WHEN evidence_total > 0 THEN 1.0 END, CASE WHEN classification_source = 'party_field' THEN 'filed_committee_party' WHEN classification_source IN ('ie_spending', '24k_contributions', '24k_contributions+ie_spending') THEN 'candidate_facing_committee_activity' ELSE 'unknown' END, classification_source, 'all_committees' FROM classes
 UNION ALL SELECT 'donor', name, name, 'tech_donor', coalesce(donor_party, 'Unknown'), pct_d, coalesce(D, 0), coalesce(R, 0), coalesce(Mixed, 0), coalesce(Unknown, 0), classified_total, overall_total, pct_classified, 'recipient_committee_lean', 'donor_recipient_committee_lean', 'tech_donors' FROM donors)"""),
    "candidate_race": sql("SELECT * EXCLUDE (active) FROM races"),
    "state_rollup": rollup(
        "SELECT * FROM valid WHERE cand_office IN ('H', 'S') AND state_code <> 'US'", "state_code",
        ", count(*) FILTER (cand_office = 'H') AS house_candidate_count, count(*) FILTER (cand_office = 'S') AS senate_candidate_count, count(DISTINCT CASE WHEN cand_office = 'H' THEN district END) AS house_district_count,"
        " count(DISTINCT CASE WHEN is_major_party AND cand_office = 'H' THEN district END) AS major_party_house_district_count, cast(bool_or(cand_office = 'S') AS bigint) AS has_senate_race", False,
    ),
    "district_rollup": rollup("SELECT *, district AS district_code FROM valid WHERE cand_office = 'H'", "state_code, district_code", ", cast(sum(tech_itemized_donors) AS bigint) AS tech_itemized_donors, concat(state_code, '-', district_code) AS district_label, any_value(cast(CASE WHEN district = 'AL' THEN 0 ELSE coalesce(try_cast(district AS int), 999) END AS bigint)) AS district_sort", True),
    "senate_rollup": rollup("SELECT * FROM valid WHERE cand_office = 'S'", "state_code", ", cast(sum(tech_itemized_donors) AS bigint) AS tech_itemized_donors", True),
    "office_page": sql("SELECT cand_id, cand_name, cand_office_st, is_display_candidate, tech_itemized_receipts FROM races WHERE cand_office = 'H' AND (is_display_candidate OR NOT EXISTS (SELECT 1 FROM races r2 WHERE r2.cand_office = 'H' AND r2.is_display_candidate))"),
    "district_normalize": sql(f"""SELECT cand_id, code, district, CASE WHEN district = 'AL' THEN 0 ELSE coalesce(try_cast(district AS bigint), 999) END AS district_order, {VALID} AS is_valid, race_key
 FROM (SELECT *, {CLEAN} AS code, {DISTRICT} AS district, {RACE} AS race_key FROM cn) LEFT JOIN {SEATS} ON seats.st = cand_office_st"""),
    "weekly_totals": sql(WEEKLY),
    "weekly_by_company": sql(f"SELECT {CYCLE} AS cycle, *, {CUM.format('PARTITION BY tech_canonical_name', 'cumulative_net_total')}, {slug('tech_canonical_name')} AS company_slug FROM (SELECT tech_canonical_name, week_end, {WEEK_M} FROM dated GROUP BY ALL)"),
    "weekly_by_bucket": sql(f"""SELECT {CYCLE} AS cycle, {BUCKET.replace('cmte_tp', "coalesce(cmte_tp, '')")} AS recipient_bucket, week_end, {ms('net_amt')} AS net_total, count(*) AS n_contributions, count(DISTINCT name) AS n_donors, count(DISTINCT cmte_id) AS n_committees FROM dated GROUP BY ALL"""),
    "weekly_by_party": sql(f"SELECT {CYCLE} AS cycle, coalesce(party_dr, 'Unknown') AS recipient_party, week_end, {ms('net_amt')} AS net_total, count(*) AS n_contributions, count(DISTINCT name) AS n_donors, count(DISTINCT t.cmte_id) AS n_committees FROM dated t LEFT JOIN classes c ON t.cmte_id = c.cmte_id GROUP BY ALL"),
    "weekly_events": f"SELECT *, {CUM.format('PARTITION BY event_type', 'running_total')} FROM (SELECT event_type, {WEEK.format('cast(ts AS date)')} AS week_end, {ms('value')} AS net_total, count(*) AS n_events FROM events GROUP BY ALL)",
    "weekly_display": sql(f"SELECT * FROM ({WEEKLY}) WHERE week_end >= DATE '1996-01-01'"),
    "company_top_k": sql("SELECT * FROM top_donor_rows WHERE rank <= 5").replace("FROM dated", "FROM tech"),
    "company_top_committees": sql("SELECT * FROM top_cmte_rows WHERE rank <= 5").replace("FROM dated", "FROM tech"),
    "payload_top_donors": sql("SELECT * FROM top_donor_rows WHERE rank <= 7"),
    "payload_top_committees": sql("SELECT * FROM top_cmte_rows WHERE rank <= 7"),
    "payload_summary": sql("SELECT * FROM company_table"),
    "company_payload_nested": sql(f"""SELECT tech_canonical_name, 'summary' AS section, 1 AS place, slug AS entry, net_total, n_donors_total AS n FROM company_table
 UNION ALL SELECT tech_canonical_name, 'weekly_series', row_number() OVER (PARTITION BY tech_canonical_name ORDER BY week_end), cast(week_end AS varchar), net_total, n_donors FROM (SELECT tech_canonical_name, week_end, {WEEK_M} FROM dated GROUP BY ALL)
 UNION ALL SELECT tech_canonical_name, 'top_donors', rank, name, net_total, n_committees FROM top_donor_rows WHERE rank <= 3
 UNION ALL SELECT tech_canonical_name, 'top_committees', rank, cmte_id, net_total, n_donors FROM top_cmte_rows WHERE rank <= 3"""),
    "homepage_lists": sql("""SELECT * FROM (SELECT 'top_companies' AS list, tech_canonical_name AS entry, net_total AS amount FROM company_table ORDER BY net_total DESC, entry LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'top_candidates', cmte_id, tech_receipts FROM export WHERE recipient_bucket = 'candidate' ORDER BY tech_receipts DESC, cmte_id LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'top_political_bodies', cmte_id, tech_receipts FROM export WHERE recipient_bucket <> 'candidate' ORDER BY tech_receipts DESC, cmte_id LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'top_donors', name, net_total FROM donors WHERE net_total >= 100000 ORDER BY net_total DESC, name LIMIT 20)"""),
    "headline_numbers": sql(f"SELECT * FROM (SELECT {ms('net_amt')} AS net_total, count(*) AS n_contributions, min(contribution_date) AS first_date, max(contribution_date) AS last_date FROM dated), (SELECT count(DISTINCT name) AS n_donors, count(DISTINCT tech_canonical_name) AS n_companies FROM tech), (SELECT count(*) AS n_committees, count(*) FILTER (is_featured) AS n_featured, count(*) FILTER (is_tech_dominated) AS n_dominated FROM export)"),
    "featured_committees": sql("SELECT * EXCLUDE (cmte_tp, party_dr, tech_donors) FROM export"),
    "major_donors": sql("SELECT name, net_total, donor_party FROM donors WHERE net_total >= 100000"),
    "ranked_donors": sql("SELECT name, net_total FROM donors ORDER BY net_total DESC NULLS LAST, name LIMIT 25"),
    "employer_stats": sql("SELECT * FROM parts"),
    "employer_candidates": sql("SELECT * FROM candidates"),
    "review_queue": sql("SELECT *, '' AS include, '' AS canonical_name, '' AS sector, '' AS notes FROM candidates WHERE upper(trim(employer)) NOT IN (SELECT upper(concat(p_name, ' ', p_brand, ' ', p_type)) FROM part WHERE p_size % 2 = 0)"),
    "top_donor_variants": sql(f"SELECT name, {ms('net_amt')} AS net_total, count(*) AS n_contributions, {cat('employer')} AS employers, {cat('state')} AS states, count(DISTINCT state) AS n_states, count(DISTINCT state) >= 3 AS possible_collision FROM contrib GROUP BY name ORDER BY net_total DESC, name LIMIT 2000"),
    "committees_by_sponsor": sql("SELECT cmte_id, cmte_nm, cmte_tp, connected_org_nm FROM cm WHERE regexp_matches(connected_org_nm, '(?i)supplier#0+[0-9]*7$|00003')"),
    "text_norm": f"SELECT c_custkey, norm, core, replace(norm, ' ', '') AS compact, regexp_matches(norm, '[0-9]') AS has_digit, length(replace(core, ' ', '')) >= 6 OR regexp_matches(core, '[0-9]') AS contains_ok, {slug('raw')} AS slug, upper(raw) AS key FROM (SELECT *, {core('norm')} AS core FROM (SELECT c_custkey, {RAW_NAME} AS raw, {norm(RAW_NAME)} AS norm FROM customer))",
    "url_slugs": f"SELECT page_id, {slug('url')} AS slug, cast(length(url) - length(replace(url, '/', '')) AS bigint) AS n_slashes FROM pages",
    "alias_unpivot": sql(f"""SELECT matched_alias, alias_source, canonical_name, an AS alias_norm, {core('an')} AS alias_core, length(replace(an, ' ', '')) >= 6 OR regexp_matches(an, '[0-9]') AS contains_ok, cast(length(replace(an, ' ', '')) AS bigint) AS alias_length
 FROM (SELECT DISTINCT matched_alias, alias_source, canonical_name, sector, employer, notes, {norm('matched_alias')} AS an FROM (SELECT *, employer AS matched_alias, 'employer' AS alias_source FROM curated UNION ALL SELECT *, matched_searches, 'matched_searches' FROM curated UNION ALL SELECT *, canonical_name, 'canonical_name' FROM curated) WHERE upper(include) = 'TRUE' AND matched_alias <> '') WHERE an <> ''"""),
    "entity_alias_match": sql("SELECT entity_id, match_score, CASE match_score WHEN 100 THEN 'exact_name' WHEN 96 THEN 'exact_core_name' WHEN 86 THEN 'phrase_in_name' ELSE 'phrase_in_core_name' END AS match_type, CASE WHEN match_score >= 95 THEN 'high' ELSE 'medium' END AS match_confidence, matched_alias, alias_source FROM matched"),
    "entity_review": sql("SELECT entity_id, max(match_score) AS best_match_score, first(matched_alias ORDER BY match_score DESC, matched_alias, alias_source) AS best_alias, first(alias_source ORDER BY match_score DESC, matched_alias, alias_source) AS best_alias_source, count(matched_alias) AS n_candidate_matches, string_agg(matched_alias, ' | ' ORDER BY match_score DESC, matched_alias, alias_source) AS candidate_aliases FROM matched GROUP BY entity_id"),
    "json_props": "SELECT event_type, count(try_cast(json_extract_string(props, '$.k') AS bigint)) AS n_k, cast(sum(try_cast(json_extract_string(props, '$.k') AS bigint)) AS bigint) AS sum_k, count(*) FILTER (props <> '') AS n_present FROM events GROUP BY event_type",
    "nested_explode": "SELECT concat(cast(conv_id AS varchar), ':turn:', cast(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS varchar)) AS turn_id, conv_id, count(*) OVER (PARTITION BY conv_id) AS n_turns, role FROM conversations",
    "snapshot_first_wins": sql("SELECT filing_uuid, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY filing_uuid ORDER BY _page, _pos) AS rn FROM paged) WHERE rn = 1"),
    "snapshot_completeness": sql("SELECT cast(sum(n) AS bigint) AS n_rows, count(*) AS n_ids, count(*) FILTER (n > 1) AS n_duplicated FROM (SELECT filing_uuid, count(*) AS n FROM paged GROUP BY 1)"),
    "tied_boundaries": sql("SELECT b._page, b.dt_posted, a.filing_uuid AS last_key_before, b.filing_uuid AS first_key FROM (SELECT *, row_number() OVER (PARTITION BY _page ORDER BY _pos) AS rn FROM paged) b JOIN (SELECT *, row_number() OVER (PARTITION BY _page ORDER BY _pos DESC) AS rn FROM paged) a ON a._page = b._page - 1 AND a.rn = 1 AND b.rn = 1 WHERE a.dt_posted = b.dt_posted"),
    "dimension_upsert": "SELECT o_custkey, max_by(o_orderstatus, o_orderkey) FILTER (o_orderstatus <> 'P') AS status, max_by(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS priority FROM orders GROUP BY o_custkey",
    "client_quarter": sql(f"SELECT {PKEYS}, client_api_id, client_name, count(DISTINCT filing_uuid) AS n_filings, count(DISTINCT registrant_api_id) AS n_registrants, {SPEND}, cast(coalesce(sum(n_activities), 0) AS bigint) AS total_activities, cast(sum(n_foreign_entities) AS bigint) AS total_foreign_entities, cast(sum(n_affiliated_organizations) AS bigint) AS total_affiliated_organizations, cast({PERIOD} AS bigint) AS period_order FROM filed GROUP BY {PKEYS}, client_api_id, client_name"),
    "client_issue": sql(f"SELECT {PKEYS}, client_api_id, client_name, general_issue_code, general_issue_code_display, count(DISTINCT filing_uuid) AS n_filings, count(DISTINCT activity_id) AS n_activities, {ISSUE_SPEND}, cast({PERIOD} AS bigint) AS period_order FROM facts GROUP BY {PKEYS}, client_api_id, client_name, general_issue_code, general_issue_code_display"),
    "issue_quarter": sql(f"SELECT {PKEYS}, general_issue_code, general_issue_code_display, count(DISTINCT filing_uuid) AS n_filings, count(DISTINCT client_api_id) AS n_clients, count(DISTINCT activity_id) AS n_activities, {ISSUE_SPEND}, cast({PERIOD} AS bigint) AS period_order FROM facts GROUP BY {PKEYS}, general_issue_code, general_issue_code_display"),
    "client_lobbyist": sql(f"SELECT {PKEYS}, client_api_id, client_name, lobbyist_api_id, lobbyist_first_name, lobbyist_last_name, count(DISTINCT filing_uuid) AS n_filings, count(DISTINCT activity_id) AS n_activities, count(DISTINCT registrant_api_id) AS n_registrants, count(covered_position) AS n_covered_positions, bool_or(is_new) AS ever_marked_new, cast({PERIOD} AS bigint) AS period_order FROM (SELECT a.*, f.filing_year, f.filing_period, f.filing_period_display, client_api_id, client_name, registrant_api_id FROM activities a LEFT JOIN filed f ON a.filing_uuid = f.filing_uuid) GROUP BY {PKEYS}, client_api_id, client_name, lobbyist_api_id, lobbyist_first_name, lobbyist_last_name"),
    "agency_issue": sql(f"SELECT {PKEYS}, government_entity_id, government_entity_name, general_issue_code, general_issue_code_display, count(DISTINCT filing_uuid) AS n_filings, count(DISTINCT activity_id) AS n_activities, count(DISTINCT client_api_id) AS n_clients, cast({PERIOD} AS bigint) AS period_order FROM (SELECT a.activity_id, a.filing_uuid, a.government_entity_id, a.government_entity_name, i.general_issue_code, i.general_issue_code_display, filing_year, filing_period, filing_period_display, client_api_id FROM activities a LEFT JOIN activities i ON a.activity_id = i.activity_id AND a.filing_uuid = i.filing_uuid LEFT JOIN filed f ON a.filing_uuid = f.filing_uuid) GROUP BY {PKEYS}, government_entity_id, government_entity_name, general_issue_code, general_issue_code_display"),
    "contribution_rollup": sql(f"SELECT {PKEYS}, registrant_api_id, registrant_name, lobbyist_api_id, lobbyist_name, count(DISTINCT filing_uuid) AS n_filings, count(amount) AS n_items, {ms('amount')} AS contribution_amount, cast(sum(cast(no_contributions AS int)) AS bigint) AS filings_marked_no_contributions, cast({PERIOD} AS bigint) AS period_order FROM (SELECT f.filing_uuid, {PKEYS}, registrant_api_id, registrant_name, f.lobbyist_api_id, f.lobbyist_name, no_contributions, a.amount FROM filed f LEFT JOIN activities a ON f.filing_uuid = a.filing_uuid) GROUP BY {PKEYS}, registrant_api_id, registrant_name, lobbyist_api_id, lobbyist_name"),
    "entity_summary_null_safe": sql("SELECT e.client_api_id, e.client_name, n_filings, first_posted, last_posted FROM (SELECT DISTINCT client_api_id, client_name FROM filed) e LEFT JOIN (SELECT client_api_id, count(DISTINCT filing_uuid) AS n_filings, min(dt_posted) AS first_posted, max(dt_posted) AS last_posted FROM filed GROUP BY 1) s ON e.client_api_id IS NOT DISTINCT FROM s.client_api_id"),
    "key_overlap": "SELECT count(*) FILTER (l AND r) AS n_both, count(*) FILTER (l AND NOT r) AS n_left_only, count(*) FILTER (r AND NOT l) AS n_right_only FROM (SELECT k, bool_or(s = 1) AS l, bool_or(s = 2) AS r FROM (SELECT o_orderkey AS k, 1 AS s FROM orders UNION ALL SELECT l_orderkey, 2 FROM lineitem WHERE l_quantity > 45) GROUP BY k)",
    "messy_donors": sql(f"SELECT *, abs(negative) / nullif(positive, 0) * 100 AS negative_pct FROM (SELECT name, {ms('greatest(transaction_amt, 0.0)')} AS positive, {ms('least(transaction_amt, 0.0)')} AS negative, count(*) FILTER (transaction_amt < 0) AS n_negative FROM itcont GROUP BY name) WHERE positive > 100000 AND abs(negative) / nullif(positive, 0) * 100 > 10 ORDER BY negative, name LIMIT 50"),
    "histogram_bins": f"SELECT l_returnflag AS transaction_tp, cast(CASE WHEN l_extendedprice <= 1000 THEN 0 WHEN l_extendedprice <= 5000 THEN 1 WHEN l_extendedprice <= 10000 THEN 2 WHEN l_extendedprice <= 25000 THEN 3 WHEN l_extendedprice <= 50000 THEN 4 ELSE 5 END AS bigint) AS bin, count(*) AS n_rows, {ms('l_extendedprice')} AS total FROM lineitem GROUP BY ALL",
    "value_counts": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
    "describe_numbers": "SELECT count(l_extendedprice) AS n, cast(cast(sum(cast(l_extendedprice AS decimal(18,2))) / count(*) AS decimal(22,6)) AS double) AS mean, min(l_extendedprice) AS low, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS high FROM lineitem",
    "negatives_by_type": sql("SELECT transaction_tp, count(*) FILTER (transaction_amt < 0) AS n_negative, count(*) FILTER (transaction_amt > 0) AS n_positive, count(*) FILTER (transaction_amt = 0) AS n_zero, min(transaction_amt) AS low, max(transaction_amt) AS high, cast(cast(sum(cast(transaction_amt AS decimal(18,2))) / count(*) AS decimal(22,6)) AS double) AS mean FROM itcont GROUP BY 1"),
    "memo_share": sql(f"SELECT *, n_memo / nullif(n_rows, 0) * 100 AS pct_memo FROM (SELECT transaction_tp, count(*) AS n_rows, count(*) FILTER (memo_cd = 'X') AS n_memo, {ms('transaction_amt')} AS total, {ms("CASE WHEN memo_cd = 'X' THEN transaction_amt END")} AS memo_total FROM itcont GROUP BY 1)"),
    "prefixed_types": sql(f"SELECT transaction_tp, memo_cd, count(*) AS n_rows, {ms('transaction_amt')} AS total FROM itcont WHERE transaction_tp LIKE '15%' OR transaction_tp LIKE '22%' GROUP BY ALL"),
    "uninvestigated_types": sql(f"SELECT transaction_tp, count(*) AS n FROM itoth WHERE transaction_tp NOT IN {inlist(codes.SPENDING_CODES)} GROUP BY 1"),
    "counterparties": sql(f"SELECT transaction_tp, a.cmte_tp AS filer_tp, b.cmte_tp AS other_tp, count(*) AS n_rows, {ms('transaction_amt')} AS total FROM itoth o LEFT JOIN cm a ON o.cmte_id = a.cmte_id LEFT JOIN cm b ON o.other_id = b.cmte_id GROUP BY ALL"),
    "donor_net": sql(f"SELECT label, {ms('CASE WHEN NOT is_refund THEN transaction_amt END')} AS gross, {ms('CASE WHEN is_refund THEN transaction_amt END')} AS refunds, {ms('net_amt')} AS net, {ms("CASE WHEN cmte_tp IN ('O', 'U', 'W') THEN net_amt END")} AS outside_net FROM (SELECT *, 'seven' AS label FROM contrib WHERE regexp_matches(name, '7$') UNION ALL SELECT *, 'one_hundreds' FROM contrib WHERE regexp_matches(name, '#0+1[0-9][0-9]$')) GROUP BY label"),
    "refund_origins": sql(f"SELECT r.sub_id, r.name, r.cmte_id, r.transaction_amt, given, n_given FROM (SELECT * FROM contrib WHERE is_refund ORDER BY transaction_amt DESC, sub_id LIMIT 10) r LEFT JOIN (SELECT name, cmte_id, {ms('transaction_amt')} AS given, count(*) AS n_given FROM contrib WHERE NOT is_refund GROUP BY 1, 2) g ON r.name = g.name AND r.cmte_id = g.cmte_id"),
    "named_rows": sql("SELECT name, cmte_id, transaction_tp, transaction_amt, sub_id, 'itcont' AS source_file FROM itcont WHERE regexp_matches(name, '(?i)(?:customer#0+[12]|payee 7)$') UNION ALL SELECT name, cmte_id, transaction_tp, transaction_amt, sub_id, 'itoth' FROM itoth WHERE regexp_matches(name, '(?i)(?:customer#0+[12]|payee 7)$')"),
    "fallback_to_all": "SELECT c_custkey, c_nationkey, c_acctbal FROM (SELECT *, bool_or(c_acctbal > 9900) OVER (PARTITION BY c_nationkey) AS flagged FROM customer) WHERE c_acctbal > 9900 OR NOT flagged",
    "sort_direction": "SELECT user_id, coalesce(bool_and(v >= b), true) AS ascending, coalesce(bool_and(v <= b), true) AS descending FROM (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM (SELECT user_id, event_id, CASE WHEN user_id % 2 = 0 THEN cast(event_id AS double) ELSE value END AS v FROM events)) GROUP BY user_id",
    "page_labels": "SELECT c_custkey, concat(upper(c_mktsegment[1]), lower(c_mktsegment[2:])) AS label, CASE WHEN length(c_name) <= 12 THEN c_name ELSE concat(rtrim(substr(c_name, 1, 11)), '…') END AS short, lower(substr(c_mktsegment, 1, 1)) IN ('1', 'true', 't', 'yes', 'y') AS truthy FROM customer",
    "row_filter": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(concat_ws(' ', c_name, c_mktsegment)), 'auto')",
}


from moneyflow import oracles_nested  # noqa: E402  needs what is above

SQL |= oracles_nested.build(SQL)
