"""The four inputs as tables: how they are scoped, and how they are derived from a star schema.

The derivation is SQL that more than one engine takes as it is: orders are source events, regions organizations, nations
workspaces, and order lines give an occurrence and a fact each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.plans.storage import materialize

LEDGER = """select 'event_'||o_orderkey as source_event_id, 'org_'||lower(r_name) as org_id, 'ws_'||lower(n_name) as workspace_id
from {orders} join {customer} on o_custkey=c_custkey join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey"""

#: Line numbers repeat inside an order, so lines are numbered anew.
LINES = """select l.*, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as ln
from {lineitem} l"""

OCCURRENCES = """select 'cent_'||l_orderkey||'_'||ln as candidate_entity_id, 'chunk_'||l_orderkey||'_'||ln as chunk_id, 'event_'||l_orderkey as source_event_id,
  case when ln%4 in (1,2) then 'Person' when ln%4=3 then 'LegalEntity' else 'Topic' end as type,
  case when ln%4=1 and l_quantity>=46 then split_part(p_name,' ',1) when ln%4 in (1,2) then p_name when ln%4=3 then s_name else p_type end as name,
  round(1-l_discount,2) as confidence,
  case when ln%4=3 and l_discount>=0.09 then 'Supplier#'||lpad(cast(l_suppkey+1 as varchar(20)),9,'0') end as alias
from {lines} join {part} on l_partkey=p_partkey join {supplier} on l_suppkey=s_suppkey"""

FACTS = """select 'cfact_'||l_orderkey||'_'||ln as candidate_fact_id, 'chunk_'||l_orderkey||'_'||ln as chunk_id, 'event_'||l_orderkey as source_event_id,
  'cent_'||l_orderkey||'_'||ln as subject_candidate_id,
  case when l_tax>=0.08 then null when l_discount<=0.01 and ln=1 then 'cent_'||(l_orderkey+1)||'_1' else 'cent_'||l_orderkey||'_'||(ln+1) end as object_candidate_id,
  case when l_tax>=0.08 and l_linestatus='F' then l_returnflag end as object_value,
  case when l_tax=0 and l_quantity<=2 then '' when l_returnflag='R' then 'RelatedTo' when l_returnflag='A' then 'WorksAt' else 'PartyTo' end as predicate,
  round(1-l_tax,2) as confidence
from {lines}"""


@dataclass(frozen=True)
class Inputs:
    """Ledger, occurrences (not scoped yet), facts and artifacts (an event and its chunks a row)."""

    ledger: DataFrame
    occurrences: DataFrame
    facts: DataFrame
    artifacts: DataFrame


#: What occurrences have of the lines.
LINE = ["l_orderkey", "ln", "l_partkey", "l_suppkey", "l_quantity", "l_discount"]


def star_inputs(spark: SparkSession, sf_dir: str, written: bool = False) -> Inputs:
    """The four inputs from Parquet tables in ``sf_dir``; if ``written``, the occurrences are of written lines, which numbers them once."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    lines = spark.sql(LINES, lineitem=read("lineitem"))
    numbered = materialize(lines.select(*LINE), "lines")[0] if written else lines
    ledger = spark.sql(LEDGER, **{t: read(t) for t in ("orders", "customer", "nation", "region")})
    occurrences = spark.sql(OCCURRENCES, lines=numbered, part=read("part"), supplier=read("supplier"))
    occurrences = occurrences.withColumn("aliases", F.array_compact(F.array("alias"))).drop("alias").withColumn("normalized_name", F.lower("name"))
    facts = spark.sql(FACTS, lines=lines)
    chunk = F.struct(F.concat(F.lit("chunk_"), "l_orderkey", F.lit("_"), "ln").alias("chunk_id"), F.concat(F.lit("event_"), "l_orderkey").alias("source_event_id"))
    artifacts = lines.select("l_orderkey", chunk.alias("chunk")).groupBy("l_orderkey").agg(F.collect_list("chunk").alias("chunks"))
    return Inputs(ledger, occurrences, facts, artifacts.select(F.concat(F.lit("event_"), "l_orderkey").alias("source_event_id"), "chunks"))


def scoped(occurrences: DataFrame, ledger: DataFrame) -> DataFrame:
    """Occurrences with the scope of their event and ``name_key``; those of unknown events are left out.

    Which side is broadcast, if any, is for the optimizer to find out from sizes.
    """
    named = occurrences.withColumn("name_key", F.coalesce(F.nullif("normalized_name", F.lit("")), "name", F.lit("")))
    if "org_id" in named.columns:
        named = named.withColumnRenamed("org_id", "declared_org_id")
    return named.join(ledger.select("source_event_id", "org_id", "workspace_id"), "source_event_id")
