"""Configuration and log files: domain policies, search cases and cutover logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.policy import TARGET_STORES, Policy, Rule, checked

CASES = "name string, consumer_id string, tenant_id string, entity_type string, raw_params map<string,string>, weight int"
TRANSITIONS = "domain_name string, track string, from_state string, to_state string, operator string, reason string, timestamp_utc timestamp, seq long"


def policies(spark: SparkSession, path: str) -> list[Policy]:
    """Policies of a file of domains, in YAML or JSON, read through Spark so that any store serves.

    A domain has name, entity_type, target_store and projection_policy with rules. Unknown target stores are refused.
    """
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    try:
        loaded = json.loads(text)
    except ValueError:
        import yaml

        loaded = yaml.safe_load(text)
    domains = loaded["domains"] if isinstance(loaded, dict) and "domains" in loaded else loaded
    found = []
    for d in domains if isinstance(domains, list) else [domains]:
        if d.get("target_store") not in (None, *TARGET_STORES):
            raise ValueError(f"unknown target store {d['target_store']!r}")
        rules = d.get("projection_policy", {})
        found.append(Policy(d["entity_type"], tuple(Rule(r["owner"], r.get("required", True), r.get("freshness_ttl_seconds")) for r in rules.get("rules", [])), d.get("name"), rules.get("allow_partial_optional_publish", False)))
    return checked(found)


def search_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases from JSON lines (.jsonl) or one array; a missing weight is 1."""
    return spark.read.schema(CASES).json(path, multiLine=not path.endswith(".jsonl")).withColumn("weight", F.coalesce("weight", F.lit(1)))


def transition_log(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    log = spark.read.schema(TRANSITIONS).json(path)
    return log if domain is None else log.where(F.col("domain_name") == domain)


def append_transitions(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)
