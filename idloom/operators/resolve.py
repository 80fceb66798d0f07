"""Entity resolution: occurrences to canonical entities.

Occurrences that agree in organization, workspace, type and normalized name, and for one-token persons in the source
event, are one entity. All of it is grouping; only merging by aliases, which the default policy leaves off, needs
connected components over the names that aliases tie together.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom import vocabulary as V
from idloom.functions import ids, names
from idloom.plans.components import connected_components
from idloom.plans.storage import materialize
from idloom.policy import Policy

KEY = ["org_id", "workspace_id", "type", "name_key", "locality"]
GROUP = ["org_id", "workspace_id", "name_key"]
ROOT = ["org_id", "workspace_id", "type", "rep"]
#: Tied names that are broadcast at most, and types that are looked for by value.
BROADCAST_NAMES = 200_000
FEW_TYPES = 32


def sorted_set(values: Column) -> Column:
    """Distinct values of arrays that are gathered from groups, in order."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(values))))


def present(*codes: Column) -> Column:
    """An array of the codes that aren't null, in order."""
    return F.array_compact(F.array(*codes))


def block_keys(scoped: DataFrame, policy: Policy) -> DataFrame:
    """Occurrences with ``otp`` (one-token person) and ``locality``, which completes their ``KEY``."""
    kind, name = F.col("type"), F.col("name_key")
    return scoped.withColumn("otp", names.is_one_token_person(kind, name)).withColumn(
        "locality", names.locality(kind, name, F.col("source_event_id"), policy.one_token_person_scope)
    )


def unresolved_groups(keyed: DataFrame) -> DataFrame:
    """Names of one-token persons that several source events of a scope have: ``GROUP``, occurrences, events."""
    grouped = keyed.where("otp").groupBy(*GROUP).agg(F.count("*").alias("occurrences"), F.count_distinct("source_event_id").alias("events"))
    return grouped.where("events > 1")


def alias_edges(keyed: DataFrame, policy: Policy, fold=F.lower) -> DataFrame:
    """Pairs of keys that an alias ties: scope, type, both (name, locality), asserters and their events.

    An alias counts if it isn't the occurrence's own name and names another key of its scope and type.
    """
    said = keyed.select("candidate_entity_id", "source_event_id", *KEY, F.explode("aliases").alias("alias"))
    said = said.withColumn("alias", fold(F.col("alias"))).where("alias <> '' and alias <> name_key")
    target = names.locality(F.col("type"), F.col("alias"), F.col("source_event_id"), policy.one_token_person_scope)
    aimed = said.withColumn("alias_locality", target)
    known = keyed.select(*[F.col(c).alias(n) for c, n in zip(KEY, ["org_id", "workspace_id", "type", "alias", "alias_locality"], strict=True)]).distinct()
    real = aimed.join(known, ["org_id", "workspace_id", "type", "alias", "alias_locality"], "left_semi")
    own, other = F.struct(F.col("name_key").alias("name"), "locality"), F.struct(F.col("alias").alias("name"), F.col("alias_locality").alias("locality"))
    return real.groupBy("org_id", "workspace_id", "type", F.least(own, other).alias("left"), F.greatest(own, other).alias("right")).agg(
        F.array_sort(F.collect_set("candidate_entity_id")).alias("asserters"), F.array_sort(F.collect_set("source_event_id")).alias("events")
    )


def alias_components(edges: DataFrame, policy: Policy) -> DataFrame:
    """Keys that strong aliases merge: ``KEY`` and ``rep``, the least (name, locality) of the component."""
    strong = edges.where(F.size("events") >= policy.alias_min_support)
    node = lambda side: F.struct("org_id", "workspace_id", "type", F.col(side).alias("key"))
    found = connected_components(strong.select(node("left").alias("a"), node("right").alias("b")), "a", "b")
    return found.select("node.org_id", "node.workspace_id", "node.type", F.col("node.key.name").alias("name_key"), F.col("node.key.locality").alias("locality"), F.col("component.key").alias("rep"))


@dataclass(frozen=True)
class Resolution:
    """The results, all of them lazy. ``keyed`` has each occurrence with its entity's facts.

    ``spots`` (candidate_entity_id, canonical_entity_id) and ``members``, the occurrences of the unresolved groups, need
    no entity to be put together; :func:`reread` takes them from assignments that are written anyway.
    """

    keyed: DataFrame
    entities: DataFrame
    assignments: DataFrame
    groups: DataFrame
    edges: DataFrame
    links: DataFrame
    merged: DataFrame | None
    spots: DataFrame
    members: DataFrame


@dataclass(frozen=True)
class Questions:
    """What open questions are read from: ``links``, ``spots`` and ``members`` of a :class:`Resolution`."""

    links: DataFrame
    spots: DataFrame
    members: DataFrame


MEMBER = [*GROUP, "source_event_id", "candidate_entity_id", "canonical_entity_id"]


def reread(result: Resolution, entities: DataFrame, assignments: DataFrame) -> Resolution:
    """The result with entities and assignments that were written, and what can be read from those."""
    spots, members = assignments.select("candidate_entity_id", "canonical_entity_id"), assignments.where("questioned").select(*MEMBER)
    return replace(result, entities=entities, assignments=assignments, spots=spots, members=members)


def _place(scoped: DataFrame, policy: Policy, fold) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame, DataFrame]:
    """Keyed occurrences, alias edges, merged keys, occurrences with ``rep`` and ``by_alias``, and unresolved groups."""
    keyed = block_keys(scoped, policy)
    edges = alias_edges(keyed, policy, fold)
    merged = alias_components(edges, policy) if policy.merge_on_alias else None
    own = F.struct(F.col("name_key").alias("name"), "locality")
    if merged is None:
        placed = keyed.withColumn("rep", own).withColumn("by_alias", F.lit(False))
    else:
        placed = keyed.join(merged, KEY, "left").withColumn("by_alias", F.col("rep").isNotNull()).withColumn("rep", F.coalesce("rep", own))
    return keyed, edges, merged, placed, unresolved_groups(keyed)


def _asked(edges: DataFrame, placed: DataFrame, groups: DataFrame, identify: ids.Identify) -> Questions:
    own_id = ids.entity_id(identify, F.col("org_id"), F.col("workspace_id"), F.col("type"), F.col("rep.name"), F.col("rep.locality")).alias("canonical_entity_id")
    spots = placed.where(" and ".join(f"{c} is not null" for c in ROOT)).select("candidate_entity_id", own_id)
    members = placed.where("otp").join(groups.select(*GROUP), GROUP, "left_semi").select(*GROUP, "source_event_id", "candidate_entity_id", own_id)
    return Questions(_links(edges, placed, own_id), spots, members)


def concerned(scoped: DataFrame, fold=F.lower) -> DataFrame:
    """The scoped occurrences that open questions are about: one-token persons, and those whose type and name an alias ties to others.

    :func:`questions` has the same links and members of these as of all occurrences, and the same spots of linked entities.
    Who says an alias is found first and written. Then all occurrences are read again for the tied names, and those with
    other types or names are left out before their scope is looked up.
    """
    told = scoped.where(names.is_person(F.col("type")) | (F.size("aliases") > 0))
    told = told.where(names.is_one_token_person(F.col("type"), F.col("name_key")) | (F.size("aliases") > 0))
    told, _ = materialize(told, "told")
    said = told.select("type", "name_key", F.explode("aliases").alias("alias")).withColumn("alias", fold(F.col("alias"))).where("alias <> '' and alias <> name_key")
    tied, _ = materialize(said.select("type", F.explode(F.array("name_key", "alias")).alias("name_key")).distinct(), "tied")
    types = [r[0] for r in tied.select("type").distinct().limit(FEW_TYPES + 1).collect()]
    looked = scoped.where(F.col("type").isin(types)) if len(types) <= FEW_TYPES else scoped
    few = F.broadcast(tied) if tied.count() <= BROADCAST_NAMES else tied
    single = told.where(names.is_one_token_person(F.col("type"), F.col("name_key")))
    return single.join(few, ["type", "name_key"], "left_anti").unionByName(looked.join(few, ["type", "name_key"], "left_semi"))


def questions(scoped: DataFrame, policy: Policy = Policy(), identify: ids.Identify = ids.native, fold=F.lower) -> Questions:
    """What open questions are read from, without entities and assignments; of the occurrences, :func:`concerned` ones will do."""
    _, edges, _, placed, groups = _place(scoped, policy, fold)
    return _asked(edges, placed, groups, identify)


def resolve(scoped: DataFrame, policy: Policy = Policy(), identify: ids.Identify = ids.native, fold=F.lower) -> Resolution:
    """Entities and assignments of scoped occurrences (see ``sources.tables.scoped``)."""
    keyed, edges, merged, placed, groups = _place(scoped, policy, fold)
    root = ROOT

    spelled = placed.groupBy(*root, "name").agg(
        F.count("*").alias("n"),
        F.collect_set("candidate_entity_id").alias("ids"),
        F.collect_set("source_event_id").alias("events"),
        F.collect_set("chunk_id").alias("chunks"),
        F.array_distinct(F.flatten(F.collect_set("aliases"))).alias("aliases"),
        F.sum(F.col("confidence").cast("decimal(20,10)")).alias("confidence"),
        F.max("by_alias").alias("by_alias"),
    )
    whole = spelled.groupBy(*root).agg(
        F.min_by("name", F.struct(-F.col("n"), F.col("name"))).alias("canonical_name"),
        F.sum("n").alias("member_count"),
        sorted_set("aliases").alias("aliases"),
        sorted_set("ids").alias("member_candidate_entity_ids"),
        sorted_set("events").alias("source_event_ids"),
        sorted_set("chunks").alias("chunk_ids"),
        (F.sum("confidence") / F.sum("n")).alias("confidence_mean"),
        F.max("by_alias").alias("by_alias"),
    )
    name = F.col("rep.name")
    otp = names.is_one_token_person(F.col("type"), name)
    known = whole.withColumn("otp", otp).withColumn("name_key", name).join(groups.withColumnRenamed("events", "partners").drop("occurrences"), GROUP, "left")
    known = known.withColumn("partners", F.when(F.col("otp"), F.col("partners")))
    codes = present(
        F.when(F.col("otp") & F.lit(policy.one_token_person_scope == "source_event"), V.ONE_TOKEN_PERSON_SOURCE_SCOPED),
        F.when(F.col("member_count") > 1, V.EXACT_NAME_IN_SCOPE).otherwise(V.SINGLETON_NAME),
        F.when(F.col("by_alias"), V.SOURCE_LOCAL_ALIAS),
    )
    confidence = (
        F.when(F.col("by_alias"), V.ALIAS_MERGE_CONFIDENCE)
        .when(F.col("member_count") == 1, V.SINGLETON_CONFIDENCE)
        .when(F.col("otp"), V.SOURCE_LOCAL_CONFIDENCE)
        .otherwise(V.EXACT_CONFIDENCE)
    )
    entities = known.select(
        ids.entity_id(identify, F.col("org_id"), F.col("workspace_id"), F.col("type"), name, F.col("rep.locality")).alias("canonical_entity_id"),
        "canonical_name", F.col("type").alias("entity_type"), "org_id", "workspace_id", "aliases", "member_candidate_entity_ids", "source_event_ids", "chunk_ids",
        F.struct(
            F.col("member_count").cast("int").alias("member_count"),
            F.size("source_event_ids").alias("source_event_count"),
            F.size("chunk_ids").alias("chunk_count"),
            names.token_count(name).alias("name_token_count"),
            codes[0].alias("evidence_tier"),
            F.col("otp").alias("source_scoped"),
            F.greatest(F.lit(0), F.coalesce(F.col("partners") - 1, F.lit(0))).cast("int").alias("unresolved_partner_components"),
            F.round("confidence_mean", 4).cast("double").alias("mean_extraction_confidence"),
        ).alias("component_quality"),
        "rep", "otp", "partners", confidence.alias("confidence"), codes.alias("codes"),
    )
    facts = entities.select("org_id", "workspace_id", F.col("entity_type").alias("type"), "rep", "canonical_entity_id", "component_quality.member_count", F.col("confidence").alias("tier"), "codes")
    questioned = groups.select(*GROUP, F.lit(True).alias("questioned"))
    joined = placed.join(facts, root).join(questioned, GROUP, "left").withColumn("questioned", F.coalesce("questioned", F.lit(False)) & F.col("otp"))
    assignments = joined.select(
        "candidate_entity_id", "canonical_entity_id",
        F.when(F.col("questioned"), V.POSSIBLE_DUPLICATE).when(F.col("member_count") > 1, V.MERGED).otherwise(V.NEW_CANONICAL).alias("decision"),
        F.col("tier").alias("confidence"),
        F.when(F.col("questioned"), F.array_append("codes", F.lit(V.ONE_TOKEN_PERSON_UNRESOLVED_CROSS_SOURCE))).otherwise(F.col("codes")).alias("reason_codes"),
        "org_id", "workspace_id", F.col("type").alias("entity_type"), "name_key", "source_event_id", "questioned",
    )
    asked = _asked(edges, placed, groups, identify)
    return Resolution(keyed, entities, assignments, groups, edges, asked.links, merged, asked.spots, asked.members)


def _links(edges: DataFrame, placed: DataFrame, own_id: Column) -> DataFrame:
    """Alias edges between different entities: left and right id in order, asserters and events."""
    scope = ["org_id", "workspace_id", "type"]
    named = placed.select(*scope, F.struct(F.col("name_key").alias("name"), "locality").alias("key"), "rep").distinct().select(*scope, "key", own_id)
    side = lambda key, out: named.select(*scope, F.col("key").alias(key), F.col("canonical_entity_id").alias(out))
    both = edges.join(side("left", "a"), [*scope, "left"]).join(side("right", "b"), [*scope, "right"]).where("a <> b")
    return both.select(F.least("a", "b").alias("left_canonical_entity_id"), F.greatest("a", "b").alias("right_canonical_entity_id"), "asserters", "events")


def resolution_stats(result: Resolution, policy: Policy) -> DataFrame:
    """One row of counters."""
    size = F.col("component_quality.member_count")
    counted = result.entities.agg(
        F.count("*").alias("canonical_entities"),
        F.coalesce(F.sum(size), F.lit(0)).alias("occurrences"),
        F.count_if(size > 1).alias("merged_components"),
        F.count_if(size == 1).alias("singleton_components"),
        F.count_if(F.col("component_quality.source_scoped")).alias("source_scoped_components"),
    )
    keys = result.keyed.select(*KEY).distinct().agg(F.count("*").alias("block_keys"))
    groups = result.groups.agg(F.count("*").alias("unresolved_groups"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("unresolved_occurrences"))
    edges = result.edges.agg(F.count("*").alias("alias_edges"))
    links = result.links.agg(F.count("*").alias("alias_links"))
    merges = (result.merged.select("org_id", "workspace_id", "type", "rep").distinct() if result.merged is not None else result.keyed.limit(0)).agg(F.count("*").alias("alias_merged_components"))
    one = counted  # every side has one row
    for other in (keys, groups, edges, links, merges):
        one = one.join(F.broadcast(other), F.lit(True))
    return one.withColumn("alias_links_within_components", F.col("alias_edges") - F.col("alias_links"))
