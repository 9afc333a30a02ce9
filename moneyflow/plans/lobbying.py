"""Lobbying disclosures: snapshot dedup, flattening of nested filings, summaries, entity overlay, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R

# ---- snapshot


def snapshot(pages: DataFrame, supplemental: DataFrame | None = None, key: str = "filing_uuid", order: Sequence[str] = ("_page", "_pos")) -> DataFrame:
    """One row for each id: the first on the pages, unless a supplemental row (the last one) replaces it. Rows without an id go."""
    rows = pages.where(F.col(key).isNotNull()).withColumn("__p", F.lit(1))
    by = [F.col("__p").asc(), *[F.when(F.col("__p") == 1, F.col(c)).otherwise(-F.col(c)).asc() for c in order]]
    if supplemental is not None:
        rows = rows.unionByName(supplemental.where(F.col(key).isNotNull()).withColumn("__p", F.lit(0)), allowMissingColumns=True)
    return R.first_by(rows, [key], by).drop("__p")


def completeness(pages: DataFrame, key: str = "filing_uuid") -> DataFrame:
    """Rows, distinct ids and ids that occur more than once; ``n_ids`` is held against the live count."""
    per = pages.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(key).alias("n_ids"), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("n_duplicated")
    )


def tied_boundaries(rows: DataFrame, stamp: str = "dt_posted", key: str = "filing_uuid") -> DataFrame:
    """Pages whose first row has the same time stamp as the last row of the page before: rows may have slipped.

    Neighbours are found within blocks of pages; a block's first page looks at the last page of the block before.
    """
    end = F.struct(F.col(stamp).alias("t"), F.col(key).alias("k"))
    ends = rows.groupBy("_page").agg(F.min_by(end, "_pos").alias("first"), F.max_by(end, "_pos").alias("last")).withColumn("__block", F.floor(F.col("_page") / PAGE_BLOCK))
    blocks = ends.groupBy("__block").agg(F.max_by("last", "_page").alias("__last")).withColumn("__before", F.lag("__last").over(Window.orderBy("__block")))  # one row a block
    before = F.lag("last").over(Window.partitionBy("__block").orderBy("_page"))
    out = ends.withColumn("before", before).join(blocks.select("__block", "__before"), "__block").withColumn("before", F.coalesce("before", "__before"))
    out = out.where(F.col("before.t") == F.col("first.t"))
    return out.select("_page", F.col("first.t").alias(stamp), F.col("before.k").alias("last_key_before"), F.col("first.k").alias("first_key"))


#: Pages whose ends one task holds.
PAGE_BLOCK = 100_000


def unseen(new: DataFrame, known: DataFrame, key: str = "filing_uuid") -> DataFrame:
    """Rows to append: ids that the snapshot lacks."""
    return new.join(known.select(key).distinct(), key, "left_anti")


# ---- flattening


def _struct_field(df: DataFrame, path: str) -> Column:
    """A nested field, or null where the schema lacks it."""
    kind: DataType = df.schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.fieldNames():
            return F.lit(None).cast("string")
        kind = kind[part].dataType
    return F.col(path)


def _pick(df: DataFrame, spec: dict[str, str]) -> list[Column]:
    return [_struct_field(df, path).alias(name) for name, path in spec.items()]


def _same(*names: str, prefix: str = "") -> dict[str, str]:
    return {n: prefix + n for n in names}


def _exploded(df: DataFrame, array: str, keys: Sequence[str], index: str, item: str) -> DataFrame:
    """One row for each member with its position from 1; empty and missing arrays give none."""
    if not isinstance(_kind(df, array), ArrayType):
        return df.select(*keys, F.lit(None).cast("long").alias(index), F.lit(None).cast("struct<_: string>").alias(item)).limit(0)
    return df.select(*keys, F.posexplode(array).alias("__pos", item)).withColumn(index, (F.col("__pos") + 1).cast("long")).drop("__pos")


def _kind(df: DataFrame, path: str) -> DataType | None:
    kind: DataType | None = df.schema
    for part in path.split("."):
        kind = kind[part].dataType if isinstance(kind, StructType) and part in kind.fieldNames() else None
    return kind


_PERSON = ["first_name", "middle_name", "last_name", "nickname", "prefix", "prefix_display", "suffix", "suffix_display"]
_PLACE = ["state", "state_display", "country", "country_display", "ppb_state", "ppb_state_display", "ppb_country", "ppb_country_display"]
_REGISTRANT = [
    "house_registrant_id", "name", "description", "address_1", "address_2", "address_3", "address_4", "city", "state", "state_display", "zip",
    "country", "country_display", "ppb_country", "ppb_country_display", "contact_name", "contact_telephone", "dt_updated",
]


def _length(df: DataFrame, path: str, name: str) -> Column:
    return (N.array_length(F.col(path)) if isinstance(_kind(df, path), ArrayType) else F.lit(0).cast("long")).alias(name)


def filings(df: DataFrame) -> DataFrame:
    head = _same(
        "filing_uuid", "filing_year", "filing_period", "filing_period_display", "filing_type", "filing_type_display", "dt_posted", "posted_by_name"
    )
    mid = _same("expenses_method", "expenses_method_display", "termination_date", "filing_document_url", "filing_document_content_type", "url")
    parties = {
        "client_api_id": "client.id", "client_source_id": "client.client_id", "client_name": "client.name", "registrant_api_id": "registrant.id",
        "registrant_house_id": "registrant.house_registrant_id", "registrant_name": "registrant.name",
    }
    where = _same(*[f"registrant_{c}" for c in ("address_1", "address_2", "city", "state", "zip", "country", "ppb_country", "different_address")])
    return df.select(
        *_pick(df, head), N.money_or_null(_struct_field(df, "income").cast("string")).alias("income"),
        N.money_or_null(_struct_field(df, "expenses").cast("string")).alias("expenses"), *_pick(df, mid | parties | where),
        _length(df, "lobbying_activities", "n_activities"), _length(df, "foreign_entities", "n_foreign_entities"),
        _length(df, "affiliated_organizations", "n_affiliated_organizations"), _length(df, "conviction_disclosures", "n_conviction_disclosures"),
    )


def _activities(df: DataFrame) -> DataFrame:
    rows = _exploded(df, "lobbying_activities", ["filing_uuid"], "activity_index", "a")
    return rows.withColumn("activity_id", F.concat("filing_uuid", F.lit(":activity:"), F.col("activity_index").cast("string")))


def filing_activities(df: DataFrame) -> DataFrame:
    rows = _activities(df)
    spec = {k: f"a.{k}" for k in ("general_issue_code", "general_issue_code_display", "description", "foreign_entity_issues")}
    return rows.select(
        "activity_id", "filing_uuid", "activity_index", *_pick(rows, spec), _length(rows, "a.lobbyists", "n_lobbyists"), _length(rows, "a.government_entities", "n_government_entities")
    )


def filing_activity_lobbyists(df: DataFrame) -> DataFrame:
    rows = _exploded(_activities(df), "a.lobbyists", ["activity_id", "filing_uuid", "activity_index"], "activity_lobbyist_index", "l")
    spec = {"lobbyist_api_id": "l.lobbyist.id"} | {(f"lobbyist_{k}" if "name" in k else k): f"l.lobbyist.{k}" for k in _PERSON}
    return rows.select(
        "activity_id", "filing_uuid", "activity_index", "activity_lobbyist_index", *_pick(rows, spec | {"covered_position": "l.covered_position", "is_new": "l.new"})
    )


def filing_activity_government_entities(df: DataFrame) -> DataFrame:
    keys = ["activity_id", "filing_uuid", "activity_index"]
    rows = _exploded(_activities(df), "a.government_entities", keys, "activity_government_entity_index", "g")
    return rows.select(*keys, "activity_government_entity_index", *_pick(rows, {"government_entity_id": "g.id", "government_entity_name": "g.name"}))


def filing_foreign_entities(df: DataFrame) -> DataFrame:
    rows = _exploded(df, "foreign_entities", ["filing_uuid"], "foreign_entity_index", "f")
    names = ["name", "contribution", "ownership_percentage", "address", "city", "state", "state_display", "country", "country_display", "ppb_city", *_PLACE[4:]]
    return rows.select("filing_uuid", "foreign_entity_index", *_pick(rows, {n: f"f.{n}" for n in names}))


def _open_rows(df: DataFrame, array: str, index: str) -> DataFrame:
    """Members with whatever fields they have, as columns beside the key and the position."""
    rows = _exploded(df, array, ["filing_uuid"], index, "x")
    kind = rows.schema["x"].dataType
    own = [n for n in kind.fieldNames() if n not in ("filing_uuid", index, "_")] if isinstance(kind, StructType) else []
    return rows.select("filing_uuid", index, *[F.col(f"x.`{n}`").alias(n) for n in own])


def filing_affiliated_organizations(df: DataFrame) -> DataFrame:
    return _open_rows(df, "affiliated_organizations", "affiliated_organization_index")


def filing_conviction_disclosures(df: DataFrame) -> DataFrame:
    return _open_rows(df, "conviction_disclosures", "conviction_disclosure_index")


def contributions(df: DataFrame) -> DataFrame:
    head = _same(
        "filing_uuid", "filing_year", "filing_period", "filing_period_display", "filing_type", "filing_type_display", "filer_type", "filer_type_display",
        "dt_posted", "comments", "contact_name", "address_1", "address_2", "city", "state", "state_display", "zip", "country", "country_display", "no_contributions",
    )
    pacs = F.array_join("pacs", "; ") if isinstance(_kind(df, "pacs"), ArrayType) else F.lit(None).cast("string")
    parties = {"registrant_api_id": "registrant.id", "registrant_house_id": "registrant.house_registrant_id", "registrant_name": "registrant.name", "lobbyist_api_id": "lobbyist.id"}
    name = T.join_parts(*[_struct_field(df, f"lobbyist.{k}") for k in ("first_name", "middle_name", "last_name")])
    tail = _same("filing_document_url", "filing_document_content_type", "url")
    return df.select(*_pick(df, head), pacs.alias("pacs"), _length(df, "contribution_items", "n_contribution_items"), *_pick(df, parties), name.alias("lobbyist_name"), *_pick(df, tail))


def contribution_items(df: DataFrame) -> DataFrame:
    rows = _exploded(df, "contribution_items", ["filing_uuid"], "item_index", "i")
    spec = {k: f"i.{k}" for k in ("contribution_type", "contribution_type_display", "contributor_name", "payee_name", "honoree_name")}
    item = F.concat("filing_uuid", F.lit(":item:"), F.col("item_index").cast("string")).alias("contribution_item_id")
    return rows.select(item, "filing_uuid", "item_index", *_pick(rows, spec), N.money_or_null(_struct_field(rows, "i.amount").cast("string")).alias("amount"), *_pick(rows, {"date": "i.date"}))


def _dimension(parts: list[tuple[DataFrame, dict[str, str], str]], key: str) -> DataFrame:
    """Members seen in several sources, in the order given, then in the source's order: the last filled value of each field counts."""
    out = None
    for n, (df, spec, order) in enumerate(parts):
        rows = df.select(*[c.cast("string").alias(k) for k, c in ((k, _struct_field(df, p)) for k, p in spec.items())], F.struct(F.lit(n).alias("s"), F.col(order).cast("long").alias("o")).alias("__o"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return R.upsert_dimension(out, key, F.col("__o"), [c for c in out.columns if c != "__o"])


def clients(filed: DataFrame, order: str = "_row_ord") -> DataFrame:
    spec = {"client_api_id": "client.id", "client_source_id": "client.client_id", "client_name": "client.name"}
    spec |= {k: f"client.{k}" for k in ("general_description", "client_self_select", "client_government_entity", *_PLACE, "effective_date")}
    return _dimension([(filed, spec | {"registrant_api_id": "registrant.id"}, order)], "client_api_id")


def registrants(filed: DataFrame, reports: DataFrame, order: str = "_row_ord") -> DataFrame:
    spec = {"registrant_api_id": "registrant.id"} | {("registrant_name" if k == "name" else k): f"registrant.{k}" for k in _REGISTRANT}
    return _dimension([(filed, spec, order), (reports, spec, order)], "registrant_api_id")


def lobbyists(filed: DataFrame, reports: DataFrame, order: str = "_row_ord") -> DataFrame:
    keep = filed.select("filing_uuid", order, *[c for c in ("registrant", "lobbying_activities") if c in filed.columns])
    inner = _exploded(keep, "lobbying_activities", ["registrant", order], "ai", "a")
    inner = _exploded(inner, "a.lobbyists", ["registrant", order, "ai"], "li", "l")
    inner = inner.withColumn("__seq", F.col(order).cast("long") * 1_000_000 + F.col("ai") * 1_000 + F.col("li"))
    spec = lambda at: {"lobbyist_api_id": f"{at}.id"} | {k: f"{at}.{k}" for k in _PERSON} | {"registrant_api_id": "registrant.id"}
    return _dimension([(inner, spec("l.lobbyist"), "__seq"), (reports, spec("lobbyist"), order)], "lobbyist_api_id")


def flatten(filed: DataFrame, reports: DataFrame) -> dict[str, DataFrame]:
    """The twelve flat tables of nested filings and contribution reports (both with ``_row_ord``)."""
    return {
        "filings": filings(filed), "filing_activities": filing_activities(filed), "filing_activity_lobbyists": filing_activity_lobbyists(filed),
        "filing_activity_government_entities": filing_activity_government_entities(filed), "filing_foreign_entities": filing_foreign_entities(filed),
        "filing_affiliated_organizations": filing_affiliated_organizations(filed), "filing_conviction_disclosures": filing_conviction_disclosures(filed),
        "contributions": contributions(reports), "contribution_items": contribution_items(reports), "clients": clients(filed),
        "registrants": registrants(filed, reports), "lobbyists": lobbyists(filed, reports),
    }


# ---- summaries: groups with missing keys stay

PERIOD = ["filing_year", "filing_period", "filing_period_display"]


def _spend(names: tuple[str, str] = ("total_income", "total_expenses")) -> list[Column]:
    income, expenses = N.money_sum(F.col("income")), N.money_sum(F.col("expenses"))
    return [income.alias(names[0]), expenses.alias(names[1]), (income + expenses).alias("total_reported_spend")]


def _ordered(df: DataFrame) -> DataFrame:
    return df.withColumn("period_order", N.period_order(F.col("filing_period")).cast("long"))


def client_quarter(filed: DataFrame) -> DataFrame:
    count = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    out = filed.groupBy(*PERIOD, "client_api_id", "client_name").agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct("registrant_api_id").alias("n_registrants"), *_spend(), count("n_activities", "total_activities"),
        count("n_foreign_entities", "total_foreign_entities"), count("n_affiliated_organizations", "total_affiliated_organizations"),
    )
    return _ordered(out)


def _by_filing(activities: DataFrame, filed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Activities added up by key, filing and activity id, with the filing's columns; ``__rows`` counts them.

    A filing's income repeats for each activity row, so sums over issues do not add up to the filings' own.
    """
    own = activities.groupBy("filing_uuid", "activity_id", *keys).agg(F.count(F.lit(1)).alias("__rows"))
    return own.join(filed.select("filing_uuid", *PERIOD, *columns), "filing_uuid", "left")


def _issue_sums() -> list[Column]:
    income, expenses = (F.sum(F.col(c).cast(N.MONEY) * F.col("__rows")) for c in ("income", "expenses"))
    income, expenses = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (income, expenses))
    return [income.alias("income_sum"), expenses.alias("expenses_sum"), (income + expenses).alias("total_reported_spend")]


ISSUE = ["general_issue_code", "general_issue_code_display"]


def client_issue(activities: DataFrame, filed: DataFrame) -> DataFrame:
    keys = [*PERIOD, "client_api_id", "client_name", *ISSUE]
    out = _by_filing(activities, filed, ISSUE, ["client_api_id", "client_name", "income", "expenses"]).groupBy(*keys).agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct("activity_id").alias("n_activities"), *_issue_sums()
    )
    return _ordered(out)


def issue_quarter(activities: DataFrame, filed: DataFrame) -> DataFrame:
    out = _by_filing(activities, filed, ISSUE, ["client_api_id", "income", "expenses"]).groupBy(*PERIOD, *ISSUE).agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct("client_api_id").alias("n_clients"), F.count_distinct("activity_id").alias("n_activities"), *_issue_sums()
    )
    return _ordered(out)


def client_lobbyist(people: DataFrame, filed: DataFrame) -> DataFrame:
    who = ["lobbyist_api_id", "lobbyist_first_name", "lobbyist_last_name"]
    own = people.groupBy("filing_uuid", "activity_id", *who).agg(F.count("covered_position").alias("__covered"), F.bool_or("is_new").alias("__new"))
    rows = own.join(filed.select("filing_uuid", *PERIOD, "client_api_id", "client_name", "registrant_api_id"), "filing_uuid", "left")
    out = rows.groupBy(*PERIOD, "client_api_id", "client_name", *who).agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct("activity_id").alias("n_activities"), F.count_distinct("registrant_api_id").alias("n_registrants"),
        F.sum("__covered").alias("n_covered_positions"), F.bool_or("__new").alias("ever_marked_new"),
    )
    return _ordered(out)


def agency_issue(agencies: DataFrame, activities: DataFrame, filed: DataFrame) -> DataFrame:
    issue = activities.select("activity_id", "filing_uuid", "general_issue_code", "general_issue_code_display")
    rows = agencies.join(issue, ["activity_id", "filing_uuid"], "left").join(filed.select("filing_uuid", *PERIOD, "client_api_id"), "filing_uuid", "left")
    out = rows.groupBy(*PERIOD, "government_entity_id", "government_entity_name", "general_issue_code", "general_issue_code_display").agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct("activity_id").alias("n_activities"), F.count_distinct("client_api_id").alias("n_clients")
    )
    return _ordered(out)


def contribution_rollup(reports: DataFrame, items: DataFrame) -> DataFrame:
    """Items by report period, registrant and lobbyist; the flag of reports without contributions is summed over joined rows."""
    keys = [*PERIOD, "registrant_api_id", "registrant_name", "lobbyist_api_id", "lobbyist_name"]
    per = items.groupBy("filing_uuid").agg(F.count(F.lit(1)).alias("__rows"), F.count("amount").alias("__items"), N.total("amount").alias("__amount"))
    rows = reports.select("filing_uuid", *keys, "no_contributions").join(per, "filing_uuid", "left")
    out = rows.groupBy(*keys).agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.coalesce(F.sum("__items"), F.lit(0)).alias("n_items"),
        F.coalesce(F.sum("__amount").cast("double"), F.lit(0.0)).alias("contribution_amount"),
        F.sum(F.when(F.col("no_contributions"), F.coalesce("__rows", F.lit(1))).otherwise(0)).alias("filings_marked_no_contributions"),
    )
    return _ordered(out)


# ---- entity overlay


def aliases(curated: DataFrame) -> DataFrame:
    """Alias texts of included rows from three columns, normalised; ordered by length by whoever collects them."""
    rows = curated.where(F.upper(F.col("include")) == "TRUE")
    kept = [F.col("canonical_name").alias("alias_canonical"), "sector", F.col("employer").alias("source_employer"), F.col("notes").alias("source_notes")]
    long = rows.select(*kept, F.explode(F.array(*[F.struct(F.lit(c).alias("alias_source"), F.col(c).alias("matched_alias")) for c in ("employer", "matched_searches", "canonical_name")])).alias("x"))
    out = long.select("x.matched_alias", "x.alias_source", F.col("alias_canonical").alias("canonical_name"), "sector", "source_employer", "source_notes")
    out = out.where(F.col("matched_alias") != "").dropDuplicates().withColumn("alias_norm", T.normalize_name(F.col("matched_alias"))).where("alias_norm != ''")
    out = out.withColumn("alias_core", T.core_name(F.col("alias_norm"))).withColumn("contains_ok", T.long_enough_to_contain(F.col("alias_norm")))
    return out.withColumn("alias_length", F.length(T.compact(F.col("alias_norm"))))


ENTITY = ["entity_type", "entity_id", "entity_name", "entity_description", "entity_state", "entity_country", "n_filings", "n_counterparties", "counterparty_label", "total_reported_spend", "first_posted", "last_posted"]


def _entity(filed: DataFrame, dim: DataFrame, kind: str, key: str, name: str, other: str, label: str, description: str) -> DataFrame:
    """Entities with their filings; entities are matched to the dimension with missing ids equal."""
    per = filed.groupBy(key).agg(
        F.count_distinct("filing_uuid").alias("n_filings"), F.count_distinct(other).alias("n_counterparties"), _spend()[2],
        F.min("dt_posted").alias("first_posted"), F.max("dt_posted").alias("last_posted"),
    )
    rows = R.null_safe_join(dim.select(key, name, description, "state", "country").dropDuplicates(), per, [key])
    out = rows.select(
        F.lit(kind).alias("entity_type"), F.col(key).cast("string").alias("entity_id"), F.col(name).alias("entity_name"), F.col(description).alias("entity_description"),
        F.col("state").alias("entity_state"), F.col("country").alias("entity_country"), "n_filings", "n_counterparties", F.lit(label).alias("counterparty_label"),
        "total_reported_spend", "first_posted", "last_posted",
    )
    return out


def entities(filed: DataFrame, client_dim: DataFrame, registrant_dim: DataFrame) -> DataFrame:
    c = _entity(filed, client_dim, "client", "client_api_id", "client_name", "registrant_api_id", "registrants", "general_description")
    r = _entity(filed, registrant_dim, "registrant", "registrant_api_id", "registrant_name", "client_api_id", "clients", "description")
    out = c.unionByName(r).withColumn("entity_name_norm", T.normalize_name(F.col("entity_name")))
    return out.withColumn("entity_name_core", T.core_name(F.col("entity_name_norm")))


def match_entities(ents: DataFrame, alias: DataFrame) -> DataFrame:
    """Scored pairs of entities and aliases.

    Exact names and exact cores are equi-joins. Containment (the alias inside the name) is an equi-join too:
    every alias is found by its first six characters (or its whole, if shorter) among the substrings of the
    names, and then compared in full; no pair of an entity and an alias that share nothing is ever made.
    """
    e = ents.select(*ENTITY, "entity_name_norm", "entity_name_core")
    exact = e.join(alias, F.col("entity_name_norm") == F.col("alias_norm")).withColumn("match_score", F.lit(100))
    core = e.join(alias.where("alias_core != ''"), F.col("entity_name_core") == F.col("alias_core")).withColumn("match_score", F.lit(96))
    names = ents.select(F.col("entity_name_norm").alias("n"), F.col("entity_name_core").alias("c")).distinct()
    short = alias.where("contains_ok").withColumn("probe", F.explode(F.array_distinct(F.array(F.substring("alias_norm", 1, 6), F.substring("alias_core", 1, 6)))))
    short = short.where("probe != ''")
    sizes = sorted(r.k for r in short.select(F.length("probe").alias("k")).distinct().collect())  # six at most
    cut = lambda k: F.when(F.length("n") >= k, F.transform(F.sequence(F.lit(1), F.length("n") - k + 1), lambda i: F.substr(F.col("n"), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    grams = F.array_distinct(F.concat(F.array().cast("array<string>"), *[cut(k) for k in sizes]))
    probes = names.where("n != ''").withColumn("probe", F.explode(grams)).join(short.select("probe").distinct(), "probe", "left_semi")
    in_name, in_core = F.col("n").contains(F.col("alias_norm")), (F.col("alias_core") != "") & F.col("c").contains(F.col("alias_core"))
    inside = probes.join(short, "probe").where(in_name | in_core).withColumn("match_score", F.when(in_name, 86).otherwise(82)).drop("probe").dropDuplicates()
    part = e.join(inside, (F.col("entity_name_norm") == F.col("n")) & (F.col("entity_name_core") == F.col("c"))).drop("n", "c")
    every = exact.unionByName(core).unionByName(part)
    # one alias gives an entity its best match only
    keys = ["entity_type", "entity_id", "matched_alias", "alias_source"]
    w = Window.partitionBy(*keys).orderBy(F.desc("match_score"), "canonical_name", "sector", "source_employer", "source_notes")
    best = every.withColumn("__n", F.row_number().over(w)).where("__n = 1")
    kind = F.when(F.col("match_score") == 100, "exact_name").when(F.col("match_score") == 96, "exact_core_name").when(F.col("match_score") == 86, "phrase_in_name").otherwise("phrase_in_core_name")
    return best.select(
        *ENTITY, "entity_name_norm", "entity_name_core", "match_score", N.confidence(F.col("match_score")).alias("match_confidence"), kind.alias("match_type"),
        "matched_alias", "alias_source", "canonical_name", "sector", "source_employer", "source_notes", F.lit("needs_review").alias("review_status"), F.lit("").alias("analyst_notes"),
    )


def review_matches(matches: DataFrame) -> DataFrame:
    """One row for each entity: the best match and all aliases in the order of their scores; a missing value gives way to the next."""
    order = F.struct((-F.col("match_score")).alias("s"), F.col("matched_alias").alias("a"), F.col("alias_source").alias("o"))
    first = lambda c, name: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(name)
    out = matches.groupBy(*ENTITY).agg(
        F.max("match_score").alias("best_match_score"), first("match_confidence", "best_match_confidence"), first("match_type", "best_match_type"),
        first("matched_alias", "best_alias"), first("alias_source", "best_alias_source"), first("canonical_name", "canonical_name"), first("sector", "sector"),
        F.count("matched_alias").alias("n_candidate_matches"), R.concat_in_order(F.col("matched_alias"), order).alias("candidate_aliases"),
    )
    return out.withColumn("review_status", F.lit("needs_review")).withColumn("analyst_notes", F.lit(""))


def overlay(matches: DataFrame) -> dict[str, DataFrame]:
    review = review_matches(matches)
    return {
        f"{kind}_{name}": rows.where(F.col("entity_type") == kind)
        for kind in ("client", "registrant")
        for name, rows in (("matches", matches), ("review", review))
    }


# ---- profile


def structure(schema: StructType) -> list[tuple[str, str]]:
    """(path, kind) of every scalar, object and array in a nested schema."""
    out: list[tuple[str, str]] = []

    def walk(kind: DataType, path: str) -> None:
        if isinstance(kind, StructType):
            if path:
                out.append((path, "object"))
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, ArrayType):
            out.append((path, "array"))
            walk(kind.elementType, f"{path}[]")
        else:
            out.append((path, "scalar"))

    walk(schema, "")
    return out


def presence(df: DataFrame) -> DataFrame:
    """(path, kind, n_present): rows in which a path is not null, for paths outside arrays; one pass."""
    paths = [(p, k) for p, k in structure(df.schema) if "[]" not in p]
    counts = df.agg(*[F.count(F.col(p)).alias(str(i)) for i, (p, _) in enumerate(paths)])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(k).alias("kind"), F.col(str(i)).alias("n_present")) for i, (p, k) in enumerate(paths)])
    return counts.select(F.inline(rows))


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_columns)."""
    frames = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows", F.lit(len(t.columns)).alias("n_columns")) for n, t in tables.items()]
    return R.union_all(*frames)
