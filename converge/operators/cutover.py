"""Cutover logs: the latest state of each track, transitions that the state machines do not allow, replay and checked append.

A request to move is a function from states to states: to its target where that is an edge, else it leaves the state as it
is. Functions compose, so a long log of requests, refused ones among them, is replayed in segments: each segment is composed
on its own, the compositions (a few numbers each) tell where every segment starts, and all segments run side by side. Segments
are composed to stretches of FAN segments, these to stretches of FAN stretches and so on, so no list holds a whole log.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.lineage import cut
from converge.tables.log import NumberedLog

# The states of each track in their order, and its edges.
BACKEND = ("azure_primary", "azure_primary_gcp_warming", "gcp_shadow_validated", "gcp_primary_fallback_window", "gcp_primary_stable")
SEARCH = ("azure_search_primary_elastic_dark", "azure_search_primary_elastic_shadow", "elastic_canary", "elastic_primary_fallback_window", "elastic_primary_stable")
FORWARD = {track: list(zip(states, states[1:], strict=False)) for track, states in (("backend", BACKEND), ("search", SEARCH))}
BACK = {"backend": [(BACKEND[3], BACKEND[0])], "search": [(SEARCH[2], SEARCH[1]), (SEARCH[3], SEARCH[1])]}
EDGES = [(track, a, b) for track in FORWARD for a, b in FORWARD[track] + BACK[track]]
START = {"backend": BACKEND[0], "search": SEARCH[0]}


def latest(log: DataFrame) -> DataFrame:
    """domain_name, backend_state, search_state: the last of each track, or where the track starts."""
    last = lambda track: F.coalesce(F.max_by(F.when(F.col("track") == track, F.col("to_state")), F.when(F.col("track") == track, F.col("seq"))), F.lit(START[track]))
    return log.groupBy("domain_name").agg(last("backend").alias("backend_state"), last("search").alias("search_state"))


def checked(log: DataFrame) -> DataFrame:
    """The log with problem: unknown_track, not_from_current_state, illegal_transition, missing_operator_or_reason, or null."""
    order = Window.partitionBy("domain_name", "track").orderBy("seq")
    start = F.when(F.col("track") == "backend", START["backend"]).otherwise(START["search"])
    current = F.coalesce(F.lag("to_state").over(order), start)
    edge = F.concat_ws(">", "track", "from_state", "to_state").isin(*[">".join(e) for e in EDGES])
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    problem: Column = F.when(~F.col("track").isin(*START), "unknown_track").when(F.col("from_state") != current, "not_from_current_state").when(~edge, "illegal_transition").when(blank("operator") | blank("reason"), "missing_operator_or_reason")
    return log.withColumn("problem", problem)


STATES = {"backend": BACKEND, "search": SEARCH}
#: Requests of a segment, at most; values of seq that a segment spans.
SEGMENT = 256
#: Segments of a stretch, and stretches of the next larger one.
FAN = 64


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def _moves(state: Column, request: Column) -> Column:
    """The number of the state after a request, which has its reach: the states (numbers) that it moves from."""
    return F.when(F.array_contains(request["reach"], state), request["target"]).otherwise(state)


def _starts(segments: DataFrame, by: list[str], levels: int) -> DataFrame:
    """The state in which each segment (numbers from 0) starts, from _composed, what each makes of every state."""
    up = F.floor(F.col("_segment") / FAN).cast("long") if levels else F.lit(0).cast("long")
    stretches = segments.groupBy(*by, up.alias("_up")).agg(F.array_sort(F.collect_list(F.struct("_segment", "_composed"))).alias("_parts"))
    if levels:
        states = F.sequence(F.lit(0), F.lit(len(BACKEND) - 1))
        made = F.transform(states, lambda s: F.aggregate("_parts", s, lambda at, part: F.element_at(part["_composed"], at + 1)))
        above = _starts(cut(stretches.select(*by, F.col("_up").alias("_segment"), made.alias("_composed"))), by, levels - 1)
        begun = stretches.join(above.select(*by, F.col("_segment").alias("_up"), "_start"), [*by, "_up"])
    else:
        begun = stretches.withColumn("_start", F.lit(0))
    walk = F.aggregate("_parts", F.array(F.col("_start")), lambda seen, part: F.concat(seen, F.array(F.element_at(part["_composed"], F.element_at(seen, -1) + 1))))
    each = begun.withColumn("_walk", walk).select(*by, F.posexplode("_parts").alias("_at", "_part"), "_walk")
    return each.select(*by, F.col("_part._segment").alias("_segment"), F.get("_walk", F.col("_at")).alias("_start"))


def replayed(requests: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Requests (domain_name, track, to_state, operator, reason, seq) with from_state, state (after it), accepted and problem.

    A request is refused, and the state stays, if its target is no edge from the state that then holds, is unknown, or if it
    names no operator or reason. Of requests with equal seq the order is that of their targets. An unknown track has no state.
    """
    number = lambda c: reduce(lambda at, k: at.when(c == k[0], k[1]), [(n, i) for names in STATES.values() for i, n in enumerate(names)], F.when(F.lit(False), 0))
    reach = F.lit(None).cast("array<int>")
    for track, a, b in EDGES:
        names = STATES[track]
        sources = [names.index(x) for t, x, z in EDGES if (t, z) == (track, b)]
        reach = F.when((F.col("track") == track) & (F.col("to_state") == b), F.array(*[F.lit(i) for i in sources])).otherwise(reach)
    named = ~_blank("operator") & ~_blank("reason")
    rows = requests.withColumn("_target", number(F.col("to_state"))).withColumn("_reach", F.when(named, F.coalesce(reach, F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>")))
    at = F.floor(F.col("seq") / segment).cast("long")
    first, last = requests.agg(F.min(at), F.max(at)).first()
    # Requests without a seq are the first, in a segment of their own.
    rows = rows.withColumn("_segment", F.coalesce(at - F.lit(first or 0) + 1, F.lit(0)).cast("long"))
    levels, largest = 0, (last or 0) - (first or 0) + 1
    while largest >= FAN:
        levels, largest = levels + 1, largest // FAN
    entry = F.struct("seq", "to_state", F.col("_target").alias("target"), F.col("_reach").alias("reach"), F.struct(*requests.columns).alias("row"))
    by = ["domain_name", "track"]
    segments = rows.groupBy(*by, "_segment").agg(F.array_sort(F.collect_list(entry)).alias("log"))
    states = F.sequence(F.lit(0), F.lit(len(BACKEND) - 1))
    composed = F.transform(states, lambda s: F.aggregate("log", s, _moves))
    # A row of five numbers for each segment tells where the segments start.
    starts = _starts(cut(segments.select(*by, "_segment", composed.alias("_composed"))), by, levels)
    begun = segments.join(starts, [*by, "_segment"])
    # Within a segment the states after each request, one after the other.
    first = F.array(F.col("_start"))
    walk = F.aggregate("log", first, lambda seen, r: F.concat(seen, F.array(_moves(F.element_at(seen, -1), r))))
    each = begun.withColumn("_walk", walk).select(*by, F.posexplode("log").alias("_at", "_r"), "_walk")
    name = lambda s: F.when(F.col("track") == "backend", F.element_at(F.array(*map(F.lit, BACKEND)), s + 1)).when(F.col("track") == "search", F.element_at(F.array(*map(F.lit, SEARCH)), s + 1))
    before, after = F.get("_walk", F.col("_at")), F.get("_walk", F.col("_at") + 1)
    out = each.select("_r.row.*", name(before).alias("from_state"), name(after).alias("state"), F.array_contains("_r.reach", before).alias("accepted"))
    problem = F.when(~F.col("track").isin(*START), "unknown_track").when(F.col("accepted"), F.lit(None)).when(~F.concat_ws(">", "track", "from_state", "to_state").isin(*[">".join(e) for e in EDGES]), "illegal_transition").otherwise("missing_operator_or_reason")
    return out.withColumn("problem", problem)


def append(log: NumberedLog, domain: str, track: str, target: str, operator: str, reason: str, moment: float | None = None) -> dict:
    """Add a transition to the log of all domains if it is allowed from the state that the log's entries so far lead to.

    Raises ValueError, and adds nothing, if it is not. Of two writers at once one is first, and the other is judged again by
    the state that it finds then.
    """
    if track not in START:
        raise ValueError(f"no such track: {track}")
    if not operator.strip() or not reason.strip():
        raise ValueError("a transition names its operator and its reason")

    def decide(entries: list[dict]) -> dict:
        state = next((e["to_state"] for e in reversed(entries) if (e["domain_name"], e["track"]) == (domain, track)), START[track])
        if (track, state, target) not in EDGES:
            raise ValueError(f"{track} of {domain} cannot go from {state} to {target}")
        return {"domain_name": domain, "track": track, "from_state": state, "to_state": target, "operator": operator, "reason": reason, "seq": len(entries), "at": time.time() if moment is None else moment}

    return log.append(decide)
