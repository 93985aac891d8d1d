"""Tenant routing, ingestion partitions and traffic sampling as column functions."""

from __future__ import annotations

import hashlib
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from converge.functions.hashing import md5_mod, sha256_mod


def _one_of(tenant: Column, tenants: Collection[str]) -> Column:
    return F.coalesce(tenant.isin(*sorted(tenants)), F.lit(False)) if tenants else F.lit(False)


def tenant_route(tenant: Column, entity_type: Column, dedicated: Collection[str] = ()) -> dict[str, Column]:
    """routing_class, read_alias, write_alias and routing_key; tenants with an index of their own have no routing key."""
    own = _one_of(tenant, dedicated)
    shared = F.when(sha256_mod(tenant, 2) == 0, F.lit("shared_a")).otherwise(F.lit("shared_b"))
    base = F.concat_ws("-", entity_type, F.when(own, tenant).otherwise(shared))
    return {
        "routing_class": F.when(own, F.lit("dedicated")).otherwise(shared),
        "read_alias": F.concat(base, F.lit("-read")),
        "write_alias": F.concat(base, F.lit("-write")),
        "routing_key": F.when(~own, tenant),
    }


def route_of(tenant: str, entity_type: str, dedicated: Collection[str] = ()) -> dict[str, str | None]:
    """The same route for one request, without a table."""
    shared = ("shared_a", "shared_b")[int(hashlib.sha256(tenant.encode()).hexdigest(), 16) % 2]
    kind = "dedicated" if tenant in dedicated else shared
    base = f"{entity_type}-{tenant if tenant in dedicated else shared}"
    return {"routing_class": kind, "read_alias": f"{base}-read", "write_alias": f"{base}-write", "routing_key": None if tenant in dedicated else tenant}


def ingest_partition(tenant: Column, entity_type: Column, whales: Collection[str] = (), shared_partitions: int = 32) -> dict[str, Column]:
    """partition_group, partition_key and dedicated; whales have lanes of their own."""
    whale = _one_of(tenant, whales)
    lane = F.lpad(sha256_mod(F.concat_ws(":", tenant, entity_type), shared_partitions).cast("string"), 2, "0")
    group = F.when(whale, F.concat_ws("-", entity_type, tenant)).otherwise(F.concat(entity_type, F.lit("-shared-"), lane))
    return {
        "partition_group": group,
        "partition_key": F.concat_ws(":", group, F.when(whale, F.lit("dedicated")).otherwise(tenant)),
        "dedicated": whale,
    }


def traffic_bucket(value: Column) -> Column:
    """A number from 0 to 99 that depends on the value only."""
    return md5_mod(value, 100)


def in_canary(tenant: Column, consumer: Column, percent: int) -> Column:
    return traffic_bucket(F.concat_ws(":", tenant, consumer)) < percent
