"""Registered queries and the DuckDB SQL that checks them.

Each query runs the operators over the inputs that are derived from a folder's star-schema tables. Arrays are joined to
texts, so that both engines give the same values; confidences are compared as doubles.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.functions import names
from idloom.operators import hygiene, invariants, pairs, report
from idloom.operators.project import Projection, consolidation, project, rejected_by_reason
from idloom.operators.resolve import GROUP, KEY, Questions, Resolution, block_keys, concerned, questions, reread, resolution_stats, resolve
from idloom.plans.storage import materialize
from idloom.policy import Policy
from idloom.sources import integrity, tables

#: Pair budget, alias policy and labels that the catalogue's queries use.
BUDGET = 5_000
ALIAS_POLICY = Policy(merge_on_alias=True, alias_min_support=2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class _Package:
    """The inputs of a folder and what is derived from them, each built once a query."""

    def __init__(self, spark: SparkSession, sf_dir: str, policy: Policy = Policy()) -> None:
        self.spark, self.sf_dir, self.policy = spark, sf_dir, policy
        self.inputs = tables.star_inputs(spark, sf_dir)
        self.scoped = tables.scoped(self.inputs.occurrences, self.inputs.ledger)

    @property
    def keyed(self) -> DataFrame:
        return block_keys(self.scoped, self.policy)

    @property
    def resolution(self) -> Resolution:
        return resolve(self.scoped, self.policy)

    @property
    def projection(self) -> Projection:
        return project(self.inputs.facts, self.resolution.assignments, self.policy)

    @functools.cached_property
    def settled(self) -> Resolution:
        """The resolution with entities and assignments written out, for queries that read them many times."""
        result = self.resolution
        entities, assignments = materialize(result.entities, "entities")[0], materialize(result.assignments, "assignments")[0]
        return reread(result, entities, assignments)

    @functools.cached_property
    def questions(self) -> Questions:
        """Members, links and spots for queries about open questions; only the occurrences concerned are written, and no entities."""
        inputs = tables.star_inputs(self.spark, self.sf_dir, written=True)
        kept = tables.scoped(inputs.occurrences, inputs.ledger).select("candidate_entity_id", "source_event_id", "type", "name_key", "aliases", "org_id", "workspace_id")
        result = questions(materialize(concerned(kept), "scoped")[0], self.policy)
        return dataclasses.replace(result, links=materialize(result.links, "links")[0], members=materialize(result.members, "members")[0])

    @functools.cached_property
    def settled_projection(self) -> Projection:
        """The projection of :attr:`settled`, with its tables written out."""
        found = project(self.inputs.facts, self.settled.assignments, self.policy)
        return dataclasses.replace(found, assignments=materialize(found.assignments, "fact-assignments")[0], edges=materialize(found.edges, "edges")[0])


def _query(sql: str, policy: Policy = Policy(), base: Callable[[str], str] = str):
    """Register a query with its SQL; ``base`` changes the tables that all SQL shares."""

    def register(build: Callable[[_Package], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: build(_Package(spark, sf_dir, policy))
        ORACLES[name] = f"with recursive {base(_BASE)}\n{sql}"
        return build

    return register


def _text(values: Column | str) -> Column:
    return F.array_join(values, ",")


_TOKEN = names.TOKEN.replace("'", "''")
_NAMES = {t: t for t in ("orders", "customer", "nation", "region", "lineitem", "part", "supplier")}
_ID = "'canon_' || substr(sha256(concat_ws(chr(31), 'entity', {0}org_id, {0}workspace_id, {0}type, {0}name_key, {0}locality)), 1, 20)"
_KEYS = "org_id, workspace_id, type, name_key, locality"

_BASE = f"""
ledger as ({tables.LEDGER.format(**_NAMES)}),
lines as ({tables.LINES.format(**_NAMES)}),
occurrences as ({tables.OCCURRENCES.format(lines="lines", **_NAMES)}),
facts as ({tables.FACTS.format(lines="lines")}),
occ as (
  select *, case when otp then source_event_id else '' end as locality from (
    select o.*, lower(o.name) as name_key, l.org_id, l.workspace_id,
           lower(o.type) = 'person' and len(regexp_extract_all(lower(o.name), '{_TOKEN}')) = 1 as otp
    from occurrences o join ledger l using (source_event_id))),
grp as (
  select org_id, workspace_id, name_key, count(*) as occurrences, count(distinct source_event_id) as events
  from occ where otp group by all having count(distinct source_event_id) > 1),
spelled as (
  select {_KEYS}, name, row_number() over (partition by {_KEYS} order by count(*) desc, name) as place from occ group by {_KEYS}, name),
ent as (
  select {_ID.format("o.")} as id, o.org_id, o.workspace_id, o.type, o.name_key, o.locality, any_value(s.name) as canonical_name, bool_or(otp) as otp,
         count(*) as n, count(distinct source_event_id) as ne, count(distinct chunk_id) as nc,
         cast(round(sum(cast(confidence as decimal(20,10))) * 100) as bigint) as hundredths,
         string_agg(candidate_entity_id, ',' order by candidate_entity_id) as members
  from occ o join spelled s on s.place = 1 and o.org_id = s.org_id and o.workspace_id = s.workspace_id and o.type = s.type
    and o.name_key = s.name_key and o.locality = s.locality
  group by o.org_id, o.workspace_id, o.type, o.name_key, o.locality),
asg as (
  select o.candidate_entity_id, e.id, o.org_id, o.workspace_id, o.type, o.name_key, o.source_event_id, o.otp, e.n,
         o.otp and g.events is not null as questioned,
         case when o.otp and g.events is not null then 'POSSIBLE_DUPLICATE' when e.n > 1 then 'MERGED' else 'NEW_CANONICAL' end as decision,
         case when e.n = 1 then 1.0::double when o.otp then 0.95::double else 0.99::double end as confidence,
         case when o.otp then 'ONE_TOKEN_PERSON_SOURCE_SCOPED,' else '' end || case when e.n > 1 then 'EXACT_NAME_IN_SCOPE' else 'SINGLETON_NAME' end
           || case when o.otp and g.events is not null then ',ONE_TOKEN_PERSON_UNRESOLVED_CROSS_SOURCE' else '' end as codes
  from occ o join ent e using ({_KEYS}) left join grp g using (org_id, workspace_id, name_key)),
alias_said as (
  select candidate_entity_id, source_event_id, org_id, workspace_id, type, name_key, locality, lower(alias) as alias,
         case when lower(type) = 'person' and len(regexp_extract_all(lower(alias), '{_TOKEN}')) = 1 then source_event_id else '' end as alias_locality
  from occ where alias is not null and lower(alias) <> name_key),
alias_pairs as (
  select s.*, a.id as own, b.id as other from alias_said s join ent a using ({_KEYS})
  join ent b on s.org_id = b.org_id and s.workspace_id = b.workspace_id and s.type = b.type and s.alias = b.name_key and s.alias_locality = b.locality),
links as (
  select least(own, other) as l, greatest(own, other) as r, list_sort(list_distinct(list(candidate_entity_id))) as asserters,
         list_sort(list_distinct(list(source_event_id))) as events
  from alias_pairs where own <> other group by 1, 2),
judged as (
  select f.*, s.id as sid, o.id as oid,
         case when coalesce(f.predicate, '') = '' then 'MISSING_PREDICATE' when s.id is null then 'UNRESOLVED_SUBJECT'
              when f.object_candidate_id is not null and o.id is null then 'UNRESOLVED_OBJECT'
              when f.object_candidate_id is null and f.object_value is null then 'UNRESOLVED_OBJECT'
              when f.object_candidate_id is not null and (s.org_id, s.workspace_id) <> (o.org_id, o.workspace_id) then 'CROSS_SCOPE_ENDPOINTS'
              when f.object_candidate_id is not null and s.id = o.id then 'SELF_LOOP_AFTER_CANONICALIZATION' else 'ENDPOINTS_RESOLVED' end as reason
  from facts f left join asg s on f.subject_candidate_id = s.candidate_entity_id left join asg o on f.object_candidate_id = o.candidate_entity_id),
placed as (
  select *, case when reason = 'ENDPOINTS_RESOLVED' then 'cedge_' || substr(sha256(concat_ws(chr(31), 'edge', sid, predicate, coalesce(oid, ''),
              case when oid is null then coalesce(object_value, '') else '' end)), 1, 20) end as edge from judged),
edges as (
  select edge, any_value(sid) as subject, any_value(predicate) as predicate, any_value(oid) as object, min(case when oid is null then object_value end) as value,
         string_agg(candidate_fact_id, ',' order by candidate_fact_id) as facts,
         array_to_string(list_sort(list_distinct(list(source_event_id))), ',') as events, array_to_string(list_sort(list_distinct(list(chunk_id))), ',') as chunks,
         max(confidence) as confidence, count(*) as n, cast(round(sum(cast(confidence as decimal(20,10))) * 100) as bigint) as hundredths
  from placed where edge is not null group by edge),
mem as (select org_id, workspace_id, name_key, source_event_id, candidate_entity_id, id from asg where questioned),
by_event as (select org_id, workspace_id, name_key, source_event_id, count(*) as n from mem group by all),
pair_n as (
  select org_id, workspace_id, name_key, cast(sum(n) as bigint) as occurrences, count(*) as events,
         cast((sum(n) * sum(n) - sum(n * n)) / 2 as bigint) as pairs,
         case when count(*) < 2 then 0.5 else round(least(0.5, greatest(0.05, 1 / (1 + log2(count(*))))), 4) end as confidence
  from by_event group by all),
ordered as (
  select *, row_number() over (order by -(cast(occurrences as double) / pairs), org_id, workspace_id, name_key) as place from pair_n),
plan as (
  select place, org_id, workspace_id, name_key, occurrences, events, pairs, confidence, pairs <= {BUDGET} as taken,
         case when pairs <= {BUDGET} then pairs else 0 end as spent from ordered where place = 1
  union all
  select o.place, o.org_id, o.workspace_id, o.name_key, o.occurrences, o.events, o.pairs, o.confidence, p.spent + o.pairs <= {BUDGET},
         p.spent + case when p.spent + o.pairs <= {BUDGET} then o.pairs else 0 end
  from plan p join ordered o on o.place = p.place + 1)
"""


@_query("select candidate_entity_id, chunk_id, source_event_id, type, name, confidence, org_id, workspace_id, coalesce(alias, '') as aliases from occ")
def occurrences_scoped(p: _Package) -> DataFrame:
    return p.scoped.select("candidate_entity_id", "chunk_id", "source_event_id", "type", "name", "confidence", "org_id", "workspace_id", _text("aliases").alias("aliases"))


@_query("select candidate_entity_id, source_event_id from occurrences o where not exists (select 1 from ledger l where l.source_event_id = o.source_event_id)")
def orphan_occurrences(p: _Package) -> DataFrame:
    return integrity.orphan_occurrences(p.inputs).select("candidate_entity_id", "source_event_id")


@_query(
    """, ids as (select candidate_entity_id from occurrences)
    select 'candidate_facts' as file, 'unknown object' as "check", candidate_fact_id as key from facts
    where object_candidate_id is not null and object_candidate_id not in (select candidate_entity_id from ids)
    union all select 'candidate_facts', 'unknown subject', candidate_fact_id from facts where subject_candidate_id not in (select candidate_entity_id from ids)
    union all select 'candidate_entities', 'duplicate id', candidate_entity_id from ids group by candidate_entity_id having count(*) > 1
    union all select 'source_ledger', 'duplicate source_event_id', source_event_id from ledger group by source_event_id having count(*) > 1
    union all select 'extraction_artifacts', 'unknown source event', 'event_' || l_orderkey from lines where 'event_' || l_orderkey not in (select source_event_id from ledger) group by l_orderkey"""
)
def validate_lineage(p: _Package) -> DataFrame:
    return integrity.lineage_violations(p.inputs)


@_query(
    """select (select count(*) from occurrences) as candidate_entities, (select count(distinct source_event_id) from occurrences) as distinct_source_events_referenced,
    (select count(*) from facts) as candidate_facts, (select count(*) from ledger) as source_ledger_rows,
    (select count(distinct l_orderkey) from lines) as extraction_artifacts, (select count(*) from lines) as chunks"""
)
def input_counts(p: _Package) -> DataFrame:
    return integrity.input_counts(p.inputs)


@_query("select count(*) as chunks from lines")
def chunk_count(p: _Package) -> DataFrame:
    return integrity.chunk_count(p.inputs.artifacts)


@_query(f"select {_KEYS}, count(*) as occurrences from occ group by {_KEYS}")
def block_keys_(p: _Package) -> DataFrame:
    return p.keyed.groupBy(*KEY).agg(F.count("*").alias("occurrences"))


@_query("select id as canonical_entity_id, canonical_name, type as entity_type, org_id, workspace_id, n as member_count, ne as source_event_count, members from ent")
def canonical_entities(p: _Package) -> DataFrame:
    quality = [F.col(f"component_quality.{c}").cast("long").alias(c) for c in ("member_count", "source_event_count")]
    return p.resolution.entities.select("canonical_entity_id", "canonical_name", "entity_type", "org_id", "workspace_id", *quality, _text("member_candidate_entity_ids").alias("members"))


@_query("select id as canonical_entity_id, canonical_name from ent")
def canonical_name_mode(p: _Package) -> DataFrame:
    return p.resolution.entities.select("canonical_entity_id", "canonical_name")


@_query(
    f"""select id as canonical_entity_id, n as member_count, ne as source_event_count, nc as chunk_count,
    len(regexp_extract_all(name_key, '{_TOKEN}')) as name_token_count,
    case when otp then 'ONE_TOKEN_PERSON_SOURCE_SCOPED' when n > 1 then 'EXACT_NAME_IN_SCOPE' else 'SINGLETON_NAME' end as evidence_tier, otp as source_scoped,
    case when otp and events is not null then events - 1 else 0 end as unresolved_partner_components,
    ((2 * hundredths * 100 + n) // (2 * n)) / 10000.0::double as mean_extraction_confidence
    from ent left join grp using (org_id, workspace_id, name_key)"""
)
def component_quality(p: _Package) -> DataFrame:
    whole = {"member_count", "source_event_count", "chunk_count", "name_token_count", "unresolved_partner_components"}
    fields = p.resolution.entities.select("canonical_entity_id", "component_quality.*")
    return fields.select(*[F.col(c).cast("long").alias(c) if c in whole else F.col(c) for c in fields.columns])


@_query("select candidate_entity_id, id as canonical_entity_id, decision, confidence, codes as reason_codes from asg")
def entity_assignments(p: _Package) -> DataFrame:
    return p.resolution.assignments.select("candidate_entity_id", "canonical_entity_id", "decision", "confidence", _text("reason_codes").alias("reason_codes"))


@_query("select decision, count(*) as n from asg group by decision")
def decision_counts(p: _Package) -> DataFrame:
    return report.tally(p.resolution.assignments, "decision", "decision")


@_query("select code as reason_code, count(*) as n from (select unnest(string_split(codes, ',')) as code from asg) group by code")
def reason_code_counts(p: _Package) -> DataFrame:
    return report.reason_code_counts(p.resolution.assignments)


def _global(base: str) -> str:
    """The shared tables where one-token persons are one entity across source events."""
    kept = base.replace("case when otp then source_event_id else '' end as locality", "'' as locality")
    return kept.replace("case when o.otp then 'ONE_TOKEN_PERSON_SOURCE_SCOPED,' else '' end || ", "")


@_query(
    "select code as reason_code, count(*) as n from (select unnest(string_split(codes, ',')) as code from asg) group by code",
    Policy(one_token_person_scope="global"),
    _global,
)
def reason_code_counts_global(p: _Package) -> DataFrame:
    return report.reason_code_counts(p.resolution.assignments)


@_query("select printf('%.2f', confidence) as confidence, count(*) as n from asg group by 1")
def confidence_histogram(p: _Package) -> DataFrame:
    return report.confidence_histogram(p.resolution.assignments)


@_query("select * from grp")
def unresolved_groups(p: _Package) -> DataFrame:
    return p.resolution.groups


@_query("select org_id, workspace_id, name_key, occurrences, events, pairs from pair_n")
def pair_counts(p: _Package) -> DataFrame:
    return pairs.pair_counts(pairs.members(p.resolution))


@_query(
    """select a.org_id, a.workspace_id, a.name_key, a.source_event_id as left_event, b.source_event_id as right_event, a.candidate_entity_id as left_id,
    b.candidate_entity_id as right_id, least(a.id, b.id) as left_canonical_entity_id, greatest(a.id, b.id) as right_canonical_entity_id, n.confidence
    from mem a join mem b on a.org_id = b.org_id and a.workspace_id = b.workspace_id and a.name_key = b.name_key and a.source_event_id < b.source_event_id
    join pair_n n on a.org_id = n.org_id and a.workspace_id = n.workspace_id and a.name_key = n.name_key"""
)
def unresolved_pairs(p: _Package) -> DataFrame:
    rows, _ = materialize(pairs.members(p.resolution), "members")
    return pairs.unresolved_pairs(rows, pairs.pair_counts(rows))


@_query("select distinct events, confidence from pair_n")
def pair_confidence(p: _Package) -> DataFrame:
    counts = pairs.pair_counts(pairs.members(p.resolution))
    return counts.select("events", names.pair_confidence(F.col("events")).alias("confidence")).distinct()


@_query("select printf('%.2f', confidence) as confidence, cast(sum(pairs) as bigint) as pairs from pair_n group by 1")
def pair_confidence_histogram(p: _Package) -> DataFrame:
    return pairs.confidence_histogram(pairs.pair_counts(pairs.members(p.resolution)))


@_query("select org_id, workspace_id, name_key, occurrences, events, pairs, taken from plan")
def budget_plan(p: _Package) -> DataFrame:
    return pairs.budget_plan(pairs.pair_counts(pairs.members(p.resolution)), BUDGET)


@_query(
    """, firsts as (
      select m.org_id, m.workspace_id, m.name_key, m.source_event_id, min(m.candidate_entity_id) as first, arg_min(m.id, m.candidate_entity_id) as id, any_value(p.confidence) as confidence
      from mem m join plan p on m.org_id = p.org_id and m.workspace_id = p.workspace_id and m.name_key = p.name_key where not p.taken group by all)
    select org_id, workspace_id, name_key, arg_min(id, source_event_id) as left_canonical_entity_id, arg_max(id, source_event_id) as right_canonical_entity_id,
    any_value(confidence) as confidence, 'ONE_TOKEN_PERSON_CROSS_SOURCE,GROUP_LEVEL_AMBIGUITY' as reason_codes,
    array_to_string(list_sort(list_distinct(list(first)))[1:64], ',') as evidence from firsts group by org_id, workspace_id, name_key"""
)
def truncated_groups(p: _Package) -> DataFrame:
    rows = pairs.members(p.settled)
    found = pairs.truncated_groups(rows, pairs.budget_plan(pairs.pair_counts(rows), BUDGET))
    return found.select(*GROUP, "left_canonical_entity_id", "right_canonical_entity_id", "confidence", _text("reason_codes").alias("reason_codes"), _text("evidence_candidate_entity_ids").alias("evidence"))


@_query(
    f"""select (select cast(sum(pairs) as bigint) from plan) as unresolved_pairs_total, (select cast(coalesce(sum(pairs), 0) as bigint) from plan where taken) as pairwise_rows,
    (select count(*) from plan) as unresolved_groups, (select count(*) from plan where taken) as groups_fully_enumerated,
    (select count(*) from plan where not taken) as truncated_groups, (select count(*) from links) as alias_group_rows,
    round((select sum(pairs) from plan where taken) / (select cast(sum(pairs) as double) from plan), 6) as unresolved_pair_coverage, {BUDGET} as budget"""
)
def enumeration_stats(p: _Package) -> DataFrame:
    rows, result = pairs.members(p.settled), p.settled
    plan = pairs.budget_plan(pairs.pair_counts(rows), BUDGET)
    return pairs.enumeration_stats(rows, plan, result.links, BUDGET).withColumn("budget", F.lit(BUDGET))


@_query("select l as left_canonical_entity_id, r as right_canonical_entity_id, array_to_string(asserters, ',') as asserters, array_to_string(events, ',') as events from links")
def alias_links(p: _Package) -> DataFrame:
    return p.resolution.links.select("left_canonical_entity_id", "right_canonical_entity_id", _text("asserters").alias("asserters"), _text("events").alias("events"))


@_query(
    """, firsts as (select id, string_split(members, ',')[1:3] as first from ent), said as (
      select l, r, list_sort(list_distinct(asserters || a.first || b.first)) as evidence from links join firsts a on l = a.id join firsts b on r = b.id)
    select l as left_canonical_entity_id, r as right_canonical_entity_id, 0.4::double as confidence, array_to_string(evidence, ',') as evidence,
    'ALIAS_ASSERTED_UNCORROBORATED' || case when len(evidence) > 2 then ',GROUP_LEVEL_AMBIGUITY' else '' end as reason_codes from said"""
)
def alias_questions(p: _Package) -> DataFrame:
    found = pairs.alias_questions(p.settled)
    return found.select("left_canonical_entity_id", "right_canonical_entity_id", "confidence", _text("evidence_candidate_entity_ids").alias("evidence"), _text("reason_codes").alias("reason_codes"))


@_query(
    f"""select l as left_canonical_entity_id, r as right_canonical_entity_id, 0.4::double as confidence, 1 as level, evidence from (
      select l, r, array_to_string(list_sort(list_distinct(asserters || string_split(a.members, ',')[1:3] || string_split(b.members, ',')[1:3])), ',') as evidence
      from links join ent a on l = a.id join ent b on r = b.id)
    union all
    select arg_min(id, source_event_id), arg_max(id, source_event_id), any_value(confidence), 1, array_to_string(list_sort(list(first))[1:64], ',') from (
      select m.org_id, m.workspace_id, m.name_key, m.source_event_id, min(m.candidate_entity_id) as first, arg_min(m.id, m.candidate_entity_id) as id, any_value(p.confidence) as confidence
      from mem m join plan p on m.org_id = p.org_id and m.workspace_id = p.workspace_id and m.name_key = p.name_key where not p.taken group by all)
    group by org_id, workspace_id, name_key
    union all
    select least(a.id, b.id), greatest(a.id, b.id), p.confidence, 0, least(a.candidate_entity_id, b.candidate_entity_id) || ',' || greatest(a.candidate_entity_id, b.candidate_entity_id)
    from mem a join mem b on a.org_id = b.org_id and a.workspace_id = b.workspace_id and a.name_key = b.name_key and a.source_event_id < b.source_event_id
    join plan p on a.org_id = p.org_id and a.workspace_id = p.workspace_id and a.name_key = p.name_key where p.taken"""
)
def possible_duplicates_within_budget(p: _Package) -> DataFrame:
    found = pairs.possible_duplicates(p.settled, BUDGET)
    return found.select("left_canonical_entity_id", "right_canonical_entity_id", "confidence", "level", _text("evidence_candidate_entity_ids").alias("evidence"))


@_query(
    """select l as left_canonical_entity_id, r as right_canonical_entity_id, 0.4::double as confidence, 1 as level, evidence from (
      select l, r, array_to_string(list_sort(list_distinct(asserters || string_split(a.members, ',')[1:3] || string_split(b.members, ',')[1:3])), ',') as evidence
      from links join ent a on l = a.id join ent b on r = b.id)
    union all
    select least(a.id, b.id), greatest(a.id, b.id), p.confidence, 0, least(a.candidate_entity_id, b.candidate_entity_id) || ',' || greatest(a.candidate_entity_id, b.candidate_entity_id)
    from mem a join mem b on a.org_id = b.org_id and a.workspace_id = b.workspace_id and a.name_key = b.name_key and a.source_event_id < b.source_event_id
    join pair_n p on a.org_id = p.org_id and a.workspace_id = p.workspace_id and a.name_key = p.name_key"""
)
def possible_duplicates(p: _Package) -> DataFrame:
    found = pairs.possible_duplicates(p.questions, None)
    return found.select("left_canonical_entity_id", "right_canonical_entity_id", "confidence", "level", _text("evidence_candidate_entity_ids").alias("evidence"))


_MERGED = f""", strong as (
      select org_id, workspace_id, type, least(a, b) as a, greatest(a, b) as b from (
        select org_id, workspace_id, type, name_key || chr(31) || locality as a, alias || chr(31) || alias_locality as b, source_event_id from alias_pairs)
      group by all having count(distinct source_event_id) >= {ALIAS_POLICY.alias_min_support}),
    strong_both as (select org_id, workspace_id, type, a, b from strong union select org_id, workspace_id, type, b, a from strong),
    reach(org_id, workspace_id, type, a, b) as (
      select * from strong_both union
      select r.org_id, r.workspace_id, r.type, r.a, s.b from reach r join strong_both s on r.org_id = s.org_id and r.workspace_id = s.workspace_id and r.type = s.type and r.b = s.a),
    merged as (select org_id, workspace_id, type, a, least(a, min(b)) as rep from reach group by org_id, workspace_id, type, a)"""


# Supports of the least size: each event asserts an alias once, so the catalogue's merges need only one event.
@_query(
    _MERGED.replace(f">= {ALIAS_POLICY.alias_min_support}", ">= 1")
    + """ select org_id, workspace_id, type, split_part(a, chr(31), 1) as name_key, split_part(a, chr(31), 2) as locality,
    split_part(rep, chr(31), 1) as component_name, split_part(rep, chr(31), 2) as component_locality from merged""",
    Policy(merge_on_alias=True, alias_min_support=1),
)
def alias_merge_components(p: _Package) -> DataFrame:
    return p.resolution.merged.select("org_id", "workspace_id", "type", "name_key", "locality", F.col("rep.name").alias("component_name"), F.col("rep.locality").alias("component_locality"))


@_query(
    _MERGED.replace(f">= {ALIAS_POLICY.alias_min_support}", ">= 1")
    + """, rooted as (select o.*, coalesce(m.rep, name_key || chr(31) || locality) as root from occ o
      left join merged m on o.org_id = m.org_id and o.workspace_id = m.workspace_id and o.type = m.type and o.name_key || chr(31) || o.locality = m.a)
    select org_id, workspace_id, type as entity_type, count(*) as member_count, count(distinct source_event_id) as source_event_count,
    string_agg(candidate_entity_id, ',' order by candidate_entity_id) as members from rooted group by org_id, workspace_id, type, root""",
    Policy(merge_on_alias=True, alias_min_support=1),
)
def alias_merged_entities(p: _Package) -> DataFrame:
    quality = [F.col(f"component_quality.{c}").cast("long").alias(c) for c in ("member_count", "source_event_count")]
    return p.resolution.entities.select("org_id", "workspace_id", "entity_type", *quality, _text("member_candidate_entity_ids").alias("members"))


@_query(
    f"""select (select count(*) from ent) as canonical_entities, (select count(*) from occ) as occurrences, (select count(*) from ent where n > 1) as merged_components,
    (select count(*) from ent where n = 1) as singleton_components, (select count(*) from ent where otp) as source_scoped_components,
    (select count(*) from (select distinct {_KEYS} from occ)) as block_keys, (select count(*) from grp) as unresolved_groups,
    (select cast(coalesce(sum(occurrences), 0) as bigint) from grp) as unresolved_occurrences, (select count(*) from links) as alias_edges,
    (select count(*) from links) as alias_links, 0 as alias_merged_components, 0 as alias_links_within_components"""
)
def resolution_stats_(p: _Package) -> DataFrame:
    return resolution_stats(p.resolution, p.policy)


@_query("select candidate_fact_id, case when edge is null then 'DROPPED_INVALID' else 'PROJECTED' end as disposition, edge as canonical_edge_id, reason as reason_codes from placed")
def fact_assignments(p: _Package) -> DataFrame:
    return p.projection.assignments.select("candidate_fact_id", "disposition", "canonical_edge_id", _text("reason_codes").alias("reason_codes"))


@_query("select reason, count(*) as facts from judged where reason <> 'ENDPOINTS_RESOLVED' group by reason")
def facts_rejected_by_reason(p: _Package) -> DataFrame:
    return rejected_by_reason(p.projection.assignments)


@_query(
    """select edge as canonical_edge_id, subject as subject_canonical_entity_id, predicate, object as object_canonical_entity_id, value as object_value,
    confidence, n as contributing_fact_count, ((2 * hundredths * 10000 + n) // (2 * n)) / 1000000.0::double as confidence_mean from edges"""
)
def canonical_edges(p: _Package) -> DataFrame:
    shape = ["canonical_edge_id", "subject_canonical_entity_id", "predicate", "object_canonical_entity_id", "object_value", "confidence", "contributing_fact_count", "confidence_mean"]
    return p.projection.edges.select(*shape)


@_query("select edge as canonical_edge_id, facts, events, chunks from edges")
def edge_provenance(p: _Package) -> DataFrame:
    return p.projection.edges.select("canonical_edge_id", _text("source_candidate_fact_ids").alias("facts"), _text("source_event_ids").alias("events"), _text("chunk_ids").alias("chunks"))


@_query("select edge as canonical_edge_id, subject as subject_canonical_entity_id, predicate, value as object_value, n as contributing_fact_count from edges where object is null")
def literal_edges(p: _Package) -> DataFrame:
    found = p.projection.edges.where("object_canonical_entity_id is null")
    return found.select("canonical_edge_id", "subject_canonical_entity_id", "predicate", "object_value", "contributing_fact_count")


@_query(
    """select count(*) as facts, count(edge) as projected, count(distinct edge) as edges,
    case when count(edge) = 0 then 0.0::double else round(1 - count(distinct edge) / cast(count(edge) as double), 6) end as consolidation_rate from placed"""
)
def consolidation_rate(p: _Package) -> DataFrame:
    return consolidation(p.projection.assignments)


@_query("select id as canonical_entity_id from ent where id not in (select subject from edges) and id not in (select object from edges where object is not null)")
def isolated_entities(p: _Package) -> DataFrame:
    return report.isolated(p.settled.entities.select("canonical_entity_id"), project(p.inputs.facts, p.settled.assignments, p.policy).edges)


@_query("select type as entity_type, count(*) as n from ent group by type")
def entities_by_type(p: _Package) -> DataFrame:
    return report.entities_by(p.resolution.entities).where("grouping = 'type'").select(F.col("value").alias("entity_type"), "n")


@_query("select org_id || '/' || workspace_id as scope, count(*) as n from ent group by 1")
def entities_by_scope(p: _Package) -> DataFrame:
    return report.entities_by(p.resolution.entities).where("grouping = 'scope'").select(F.col("value").alias("scope"), "n")


@_query("select id as canonical_entity_id, canonical_name, type as entity_type, n as member_count, ne as source_event_count, nc as chunk_count from ent order by n desc, id limit 20")
def largest_components(p: _Package) -> DataFrame:
    return report.largest_components(p.resolution.entities)


@_query(
    """select cast(quantile_disc(n, 0.5) as bigint) as p50, cast(quantile_disc(n, 0.9) as bigint) as p90, cast(quantile_disc(n, 0.95) as bigint) as p95,
    cast(quantile_disc(n, 0.99) as bigint) as p99, max(n) as max from ent"""
)
def size_percentiles(p: _Package) -> DataFrame:
    return report.size_percentiles(p.resolution.entities)


@_query(
    """, c as (select (select count(*) from occurrences) as o, (select count(*) from facts) as f, (select count(*) from ent) as e, (select count(*) from edges) as g, (select count(*) from asg) as a, (select count(*) from placed) as j),
    m(metric, numerator, denominator) as (
      select 'entity_assignment_coverage', a, o from c union all select 'canonical_membership_coverage', a, o from c union all select 'membership_uniqueness', a, o from c
      union all select 'fact_disposition_coverage', j, f from c union all select 'endpoint_validity', g, g from c union all select 'reasoned_fact_coverage', j, f from c
      union all select 'provenance_coverage', e + g, e + g from c)
    select metric, numerator, denominator, case when denominator = 0 then 1.0::double else round(numerator / cast(denominator as double), 6) end as rate from m"""
)
def coverage_metrics(p: _Package) -> DataFrame:
    return report.coverage(p.inputs.occurrences, p.inputs.facts, p.settled, p.settled_projection)


_ENTITY_CHECKS = (
    "cross_organization_components", "cross_workspace_components", "cross_type_components", "declared_scope_mismatch", "declared_type_mismatch",
    "duplicate_members", "entities_without_provenance", "prohibited_one_token_person_components", "members_in_multiple_components",
    "membership_coverage_gap", "assignment_coverage_gap", "orphan_canonical_entities", "assignments_without_reason",
)
_EDGE_CHECKS = (
    "edges_without_endpoint_or_value", "edges_without_source_facts", "edges_without_provenance", "self_loop_edges", "edges_with_unknown_subject",
    "edges_with_unknown_object", "facts_on_multiple_edges", "projected_without_edge", "dropped_with_edge", "dropped_without_reason",
    "dropped_without_valid_reason", "edge_assignment_mismatch", "edge_provenance_mismatch",
)


def _checks(names_: tuple[str, ...], counted: dict[str, str] | None = None) -> str:
    return " union all ".join(f"select '{c}' as invariant, cast(({(counted or {}).get(c, '0')}) as bigint) as violations" for c in names_)


@_query(_checks(_ENTITY_CHECKS))
def entity_invariants(p: _Package) -> DataFrame:
    result = p.settled
    return invariants.entity_invariants(result.entities, result.assignments, result.keyed)


@_query(
    _checks(
        _ENTITY_CHECKS,
        {
            "prohibited_one_token_person_components": """select count(*) from (select org_id, workspace_id, type, name_key from occ where otp
               group by all having count(*) > 1 and count(distinct source_event_id) > 1)"""
        },
    ),
    Policy(one_token_person_scope="global"),
)
def entity_invariants_global_scope(p: _Package) -> DataFrame:
    """The policy that merges one-token persons everywhere must be found out."""
    result = p.settled
    return invariants.entity_invariants(result.entities, result.assignments, result.keyed)


@_query(_checks(_EDGE_CHECKS))
def edge_invariants(p: _Package) -> DataFrame:
    projection = p.settled_projection
    return invariants.edge_invariants(projection.edges, projection.assignments, p.settled.entities)


@_query(
    _checks(
        _EDGE_CHECKS,
        {
            "self_loop_edges": "select count(*) from (select distinct sid, predicate from judged where reason = 'SELF_LOOP_AFTER_CANONICALIZATION')",
        },
    ),
    Policy(drop_self_loops=False),
)
def edge_invariants_kept_loops(p: _Package) -> DataFrame:
    """The policy that keeps self-loops must be found out."""
    projection = p.settled_projection
    return invariants.edge_invariants(projection.edges, projection.assignments, p.settled.entities)


# Labels: for each name of a scope and type its first two occurrences, as MERGE; of each unresolved group the first members
# of its first two events, as POSSIBLE_DUPLICATE; first occurrences of neighbouring names, as NO_MERGE. Every seventh is mislabelled.
_LABELLED = """, spots as (select *, row_number() over (partition by org_id, workspace_id, type, name_key, locality order by candidate_entity_id) as nth from occ),
    firsts as (select *, lead(candidate_entity_id) over (partition by org_id, workspace_id, type order by name_key, locality) as following,
               lead(name_key) over (partition by org_id, workspace_id, type order by name_key, locality) as following_name from spots where nth = 1),
    asked as (
      select a.candidate_entity_id as "left", b.candidate_entity_id as "right", 'MERGE' as truth from spots a join spots b on a.nth = 1 and b.nth = 2
        and a.org_id = b.org_id and a.workspace_id = b.workspace_id and a.type = b.type and a.name_key = b.name_key and a.locality = b.locality
      union all
      select candidate_entity_id, following, case when name_key = following_name then 'POSSIBLE_DUPLICATE' else 'NO_MERGE' end from firsts where following is not null),
    labels as (select "left", "right", case when length("left") % 7 = 0 then 'NO_MERGE' else truth end as label from asked)"""


@_query(
    _LABELLED
    + """, predicted as (
      select label, case when a.id = b.id then 'MERGE' when a.questioned and b.questioned and a.name_key = b.name_key and a.org_id = b.org_id and a.workspace_id = b.workspace_id then 'POSSIBLE_DUPLICATE' else 'NO_MERGE' end as predicted
      from labels join asg a on "left" = a.candidate_entity_id join asg b on "right" = b.candidate_entity_id),
    c as (select x as label, count(*) filter (where label = x and predicted = x) as tp, count(*) filter (where label <> x and predicted = x) as fp,
          count(*) filter (where label = x and predicted <> x) as fn from predicted, (values ('MERGE'), ('NO_MERGE'), ('POSSIBLE_DUPLICATE')) v(x) group by x),
    d as (select *, case when tp + fp = 0 then 0 else tp / cast(tp + fp as double) end as p, case when tp + fn = 0 then 0 else tp / cast(tp + fn as double) end as r from c)
    select label, tp as true_positive, fp as false_positive, fn as false_negative, round(p, 6) as precision, round(r, 6) as recall,
    round(case when p + r = 0 then 0 else 2 * p * r / (p + r) end, 6) as f1 from d"""
)
def pair_scoring(p: _Package) -> DataFrame:
    result = p.settled
    rows = pairs.members(result)
    labels = p.spark.sql(f"with {_LABELLED.lstrip(', ').replace(chr(34), '`')} select * from labels".replace(" from occ)", " from {occ})"), occ=result.keyed)
    return report.pair_scores(report.predict(labels, result.assignments, pairs.asked_pairs(labels, rows, pairs.pair_counts(rows))))


@_query(
    """select (select count(*) from occ) as occurrences, (select count(distinct source_event_id) from occ) as source_events_referenced_by_occurrences,
    (select count(distinct chunk_id) from occ) as chunks_referenced_by_occurrences,
    (select count(*) from (select distinct org_id, workspace_id, type, name_key from occ)) as distinct_scope_type_name_keys,
    (select count(*) from occ where alias is not null) as occurrences_with_aliases, (select count(*) from occ where otp) as one_token_person_occurrences,
    (select count(distinct name_key) from occ where otp) as one_token_person_distinct_names,
    (select count(*) from (select distinct name_key, source_event_id from occ where otp)) as one_token_person_source_scoped_components,
    (select count(*) from facts) as facts, (select count(distinct predicate) from facts) as distinct_predicates,
    (select count(*) from facts where object_candidate_id is null) as facts_without_object_entity, (select count(*) from ledger) as ledger_rows,
    (select count(*) from (select distinct org_id, workspace_id from ledger)) as distinct_scopes, (select count(distinct org_id) from ledger) as distinct_organizations,
    (select count(distinct workspace_id) from ledger) as distinct_workspaces,
    round(1 - (select count(*) from (select distinct org_id, workspace_id, type, name_key from occ)) / cast((select count(*) from occ) as double), 4) as repetition_ratio"""
)
def profile_summary(p: _Package) -> DataFrame:
    return report.profile_summary(p.keyed, p.inputs.facts, p.inputs.ledger)


@_query("select type as entity_type, count(*) as n from occ group by type")
def occurrences_by_type(p: _Package) -> DataFrame:
    return report.tally(p.keyed, "type", "entity_type")


@_query(f"select len(regexp_extract_all(name_key, '{_TOKEN}')) as tokens, count(*) as n from occ where lower(type) = 'person' group by 1")
def name_token_histogram(p: _Package) -> DataFrame:
    return report.tally(p.keyed.where(names.is_person(F.col("type"))), names.token_count(F.col("name_key")).cast("long"), "tokens")


@_query("select predicate, count(*) as facts from facts group by predicate order by 2 desc, 1 limit 15")
def top_predicates(p: _Package) -> DataFrame:
    return report.top_predicates(p.inputs.facts)


@_query(
    """select count(*) filter (where type not in ('DateRef','Department','Document','LegalClaim','LegalEntity','LegalNorm','LegalProvision','LegalRole','Matter','Money','Topic','Person','Place')) as unexpected_entity_types,
    count(*) filter (where not case type when 'Person' then regexp_full_match(name, '[A-Za-z]+-[0-9A-F]{10}( [A-Za-z]+-[0-9A-F]{10})*|Person-[0-9A-F]{12}')
      when 'LegalEntity' then regexp_full_match(name, 'Organization-[0-9A-F]{12}') else regexp_full_match(name, 'Topic-[0-9A-F]{12}') end) as type_semantic_name_failures,
    count(*) filter (where alias is not null and not regexp_full_match(alias, 'Organization-[0-9A-F]{12}')) as type_semantic_alias_failures,
    0 as normalized_name_mismatches from occ"""
)
def hygiene_types(p: _Package) -> DataFrame:
    return hygiene.type_hits(p.inputs.occurrences)


def hygiene_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What hygiene finds in each document, but for phone numbers, whose pattern SQL's regular expressions lack."""
    found = hygiene.text_hits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.drop("text", "nonfiction_phone_hits")


def hygiene_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers like phone numbers in each document."""
    return hygiene.text_hits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "nonfiction_phone_hits")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# In RE2 \b and \w are ASCII as in Java, but not case folding, which only two letters outside ASCII have to do with.
_PLAIN = "coalesce(text, '')"
for _pattern in (hygiene.URL, hygiene.EMAIL, r"\B\+1-202-555-\d{4}\b", hygiene.DATE, hygiene.AMOUNT, hygiene.PSEUDONYM):
    _PLAIN = f"regexp_replace({_PLAIN}, {_quoted(_pattern)}, '', 'g')"
_SAFE = ", ".join(f"'{w}'" for w in hygiene.SAFE_TOKENS)

QUERIES |= {"hygiene_scan": hygiene_scan, "hygiene_phones": hygiene_phones}
QUERIES["block_keys"] = QUERIES.pop("block_keys_")
ORACLES["block_keys"] = ORACLES.pop("block_keys_")
QUERIES["resolution_stats"] = QUERIES.pop("resolution_stats_")
ORACLES["resolution_stats"] = ORACLES.pop("resolution_stats_")
ORACLES["hygiene_scan"] = f"""
    select doc_id, len(regexp_extract_all(coalesce(text, ''), {_quoted(hygiene.UUID)})) as uuid_hits,
    len(list_filter(regexp_extract_all(coalesce(text, ''), {_quoted(hygiene.EMAIL)}), lambda x: not lower(x) like '%@fiction.example')) as nonfiction_email_hits,
    len(list_filter(regexp_extract_all(coalesce(text, ''), {_quoted(hygiene.URL)}), lambda x: not lower(x) like '%.example/%')) as nonfiction_url_hits,
    len(list_filter(regexp_extract_all({_PLAIN}, '{_TOKEN}'), lambda x: lower(x) not in ({_SAFE}))) as unapproved_lexical_token_hits
    from documents"""
