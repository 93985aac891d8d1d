"""Search requests over a table: filter, full text, order, page, count and facets as plan operators."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from converge.functions import routing
from converge.operators import odata

#: Rows of a page unless asked for, and at most; values of a facet.
PAGE, LARGEST_PAGE, FACET_VALUES = 10, 1000, 10
#: Fields that full text looks into, with their weights. Fixed values.
WEIGHTS = {"title": 4.0, "customerName": 3.0, "content": 1.0, "description": 1.0}


def terms(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def text_score(search: str, weights: Mapping[str, float]) -> Column:
    """The largest, over the fields, of weight times the number of query terms that the field holds; 0 if it holds none.

    A documented, deterministic score for boolean matching; it does not reproduce the ranking of a search engine.
    """
    wanted = terms(F.lit(search))
    scores = [F.lit(w) * F.size(F.array_intersect(terms(F.coalesce(F.col(c).cast("string"), F.lit(""))), wanted)) for c, w in weights.items()]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


class Search:
    """One request over a table, within one tenant if `tenant` gives the column that names it and the value; over a table
    that is partitioned by that column, only that tenant's partition is read.

    params: $search (* or nothing matches everything), $filter, $orderby, $top, $skip, $facets or facet, $select, $count. key: a unique column that breaks
    ties, without which pages overlap.
    """

    def __init__(self, table: DataFrame, params: Mapping[str, str], fields: Mapping[str, str], key: str, weights: Mapping[str, float] = WEIGHTS, tenant: tuple[str, str] | None = None) -> None:
        self.params, self.fields, self.key = params, fields, key
        rows = table if tenant is None else table.where(F.col(tenant[0]) == tenant[1])
        if filt := params.get("$filter"):
            rows = rows.where(odata.predicate(filt, fields, table.schema))
        if (text := params.get("$search")) and text.strip() != "*":
            rows = rows.withColumn("_score", text_score(text, {c: w for c, w in weights.items() if c in table.columns})).where("_score > 0")
        self.matched = rows

    def page(self) -> DataFrame:
        top, skip = int(self.params.get("$top") or PAGE), int(self.params.get("$skip") or 0)
        if top < 0 or skip < 0:
            raise ValueError("$top and $skip cannot be negative")
        if by := self.params.get("$orderby"):
            keys = odata.order(by, self.fields)
        else:
            keys = [F.col("_score").desc()] if "_score" in self.matched.columns else []
        rows = self.matched.orderBy(*keys, F.col(self.key))
        rows = rows.offset(skip).limit(min(top, LARGEST_PAGE)) if skip else rows.limit(min(top, LARGEST_PAGE))
        if chosen := self.params.get("$select"):
            rows = rows.select(*[odata.mapped(c.strip(), self.fields) for c in chosen.split(",")])
        return rows

    def count(self) -> DataFrame:
        return self.matched.agg(F.count("*").alias("total"))

    def facets(self) -> DataFrame:
        """field, value, n: the most frequent values of each facet among all matched rows, before paging."""
        named = odata.facets(self.params.get("$facets") or self.params["facet"], self.fields)
        each = [self.matched.where(F.col(f).isNotNull()).groupBy(F.col(f).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(FACET_VALUES).select(F.lit(f).alias("field"), "value", "n") for f in named]
        return reduce(DataFrame.unionByName, each)


def routed(tables: Mapping[str, DataFrame], tenant: str, entity_type: str, params: Mapping[str, str], fields: Mapping[str, str], key: str, tenant_column: str, dedicated: Collection[str] = ()) -> Search:
    """One request of a tenant: its route's read alias names the table, and in a table that tenants share its routing key the rows.

    tables: read aliases and their tables, of which only the one is read. An alias without a table is an error.
    """
    route = routing.route_of(tenant, entity_type, dedicated)
    if route["read_alias"] not in tables:
        raise ValueError(f"no table for {route['read_alias']}")
    key_of = route["routing_key"]
    return Search(tables[route["read_alias"]], params, fields, key, tenant=None if key_of is None else (tenant_column, key_of))
