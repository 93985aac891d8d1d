"""Relevance of rankings, cutover logs and reports over request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.operators import cutover, relevance, reports
from converge.plans.inputs import RANKINGS, REQUESTS, rankings, requests, table


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _cases(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return rankings(spark, sf_dir).select("query_id", F.col(side).alias("retrieved"), "judged")


def ndcg_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(relevance.evaluate(_cases(spark, sf_dir, "primary")).select("query_id", "ndcg_at_k"))


def mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(relevance.evaluate(_cases(spark, sf_dir, "shadow")).select("query_id", "mrr"))


def overlap_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rankings(spark, sf_dir).select("query_id", *[c.alias(k) for k, c in relevance.overlap(F.col("primary"), F.col("shadow")).items()]))


def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(relevance.corpus_report(relevance.evaluate(_cases(spark, sf_dir, "primary"))))


def shadow_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(relevance.gate(rankings(spark, sf_dir)).drop("overlap_rate_at_k", "identical_order"))


def shadow_gate_unjudged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without judgments only the overlap of the two rankings decides."""
    return _rounded(relevance.gate(rankings(spark, sf_dir).withColumn("judged", F.lit(None).cast("map<string,double>"))).select("query_id", "overlap_rate_at_k", "code", "severity"))


def shadow_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of both sides to the same requests; the shadow did not answer the first query by name."""
    r = rankings(spark, sf_dir).withColumn("request_id", F.md5("query_id"))
    first = r.agg(F.min("query_id").alias("_first"))
    answered = r.join(F.broadcast(first)).where("query_id <> _first").select("request_id", F.col("shadow").alias("retrieved"))
    pairs = relevance.paired(r.select("request_id", "query_id", F.col("primary").alias("retrieved")), answered)
    return pairs.select("request_id", "query_id", relevance.overlap(F.col("primary"), F.col("shadow"))["overlap_at_k"].alias("overlap_at_k"))


def canary_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of each backend that ran before its canary was frozen by the first slow failure, and after."""
    e = requests(spark, sf_dir).withColumn("code", F.when(~F.col("ok") & (F.col("latency_ms") > 50), F.lit("shadow_relevance_regression")))
    return relevance.frozen(e.select("seq", "backend", "code"), ["backend"]).groupBy("backend", "frozen").agg(F.count("*").alias("requests"), F.min("seq").alias("first_seq"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log per nation: two steps of the search track and one of the backend; every third leaps, every fifth names nobody."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("domain_name"), F.col("n_nationkey").alias("k"))
    s, b = cutover.SEARCH, cutover.BACKEND
    step = lambda seq, track, a, z: F.struct(F.lit(seq).alias("seq"), F.lit(track).alias("track"), F.lit(a).alias("from_state"), z.alias("to_state"))
    steps = F.array(step(1, "search", s[0], F.lit(s[1])), step(2, "search", s[1], F.when(F.col("k") % 3 == 0, s[3]).otherwise(s[2])), step(3, "backend", b[0], F.lit(b[1])), step(4, "search", s[2], F.lit(s[1])))
    return n.select("domain_name", "k", F.explode(steps).alias("x")).select("domain_name", "x.*", F.when(F.col("k") % 5 == 0, F.lit(" ")).otherwise("ops").alias("operator"), F.lit("planned").alias("reason"))


def cutover_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutover.latest(_log(spark, sf_dir))


def cutover_illegal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutover.checked(_log(spark, sf_dir)).where("problem is not null").select("domain_name", "seq", "track", "problem")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests to move either track of 25 domains, most of them not allowed where they come."""
    e = table(spark, sf_dir, "events")
    track = F.when(F.col("event_id") % 2 == 0, "backend").otherwise("search")
    at = (F.col("event_id") * 31 % 101 % 5).cast("int")
    target = F.when(F.col("event_id") % 2 == 0, F.element_at(F.array(*map(F.lit, cutover.BACKEND)), at + 1)).otherwise(F.element_at(F.array(*map(F.lit, cutover.SEARCH)), at + 1))
    who = F.when(F.col("event_type") == "error", " ").otherwise("ops")
    return e.select(F.concat(F.lit("domain-"), (F.col("user_id") % 25).cast("string")).alias("domain_name"), track.alias("track"), target.alias("to_state"), who.alias("operator"), F.lit("planned").alias("reason"), F.col("event_id").alias("seq"))


def cutover_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with the state before and after it, and why it was refused."""
    return cutover.replayed(_requests(spark, sf_dir)).select("domain_name", "track", "seq", "from_state", "state", "accepted", "problem")


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.latency(requests(spark, sf_dir), ["case_name"]))


def error_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.error_samples(requests(spark, sf_dir))


def case_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = table(spark, sf_dir, "nation").select(F.col("n_name").alias("case_name"), (F.col("n_nationkey") % 4).cast("int").alias("weight"))
    return reports.expanded(cases, 3)


def _counted(spark: SparkSession, sf_dir: str, upto: str) -> DataFrame:
    e = requests(spark, sf_dir).where(upto)
    return reports.counters(e.select(F.when(F.col("ok"), "search.backend.success").otherwise("search.backend.failure").alias("name"), F.create_map(F.lit("backend"), F.col("backend"), F.lit("area"), F.col("case_name")).alias("tags"), F.lit(1).cast("long").alias("amount")))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(spark, sf_dir, "true")


def counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counter_deltas(_counted(spark, sf_dir, "true"), _counted(spark, sf_dir, "backend <> 'backend-3'"))


def failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.failure_runs(requests(spark, sf_dir), "backend", threshold=3)


QUERIES = {f.__name__: f for f in (ndcg_at_10, mrr, overlap_at_k, corpus_report, shadow_gate, shadow_gate_unjudged, shadow_pairs, canary_freeze, cutover_latest, cutover_illegal, cutover_replay, latency_percentiles, error_samples, case_expansion, counters, counter_deltas, failure_runs)}
_S, _B = cutover.SEARCH, cutover.BACKEND
_EDGES = ", ".join(f"('{t}', '{a}', '{b}')" for t, a, b in cutover.EDGES)
_REPLAY = f"""WITH RECURSIVE edges(track, a, b) AS (VALUES {_EDGES}),
asked AS (
  SELECT 'domain-' || (user_id % 25) AS domain_name, CASE WHEN event_id % 2 = 0 THEN 'backend' ELSE 'search' END AS track, CASE WHEN event_id % 2 = 0 THEN {list(_B)} ELSE {list(_S)} END[event_id * 31 % 101 % 5 + 1] AS to_state,
         event_type <> 'error' AS named, event_id AS seq FROM events),
numbered AS (SELECT *, row_number() OVER (PARTITION BY domain_name, track ORDER BY seq) AS n FROM asked),
walk AS (
  SELECT domain_name, track, 0::BIGINT AS n, NULL::BIGINT AS seq, NULL::VARCHAR AS from_state, CASE WHEN track = 'backend' THEN '{_B[0]}' ELSE '{_S[0]}' END AS state, NULL::BOOLEAN AS accepted, NULL::VARCHAR AS problem FROM (SELECT DISTINCT domain_name, track FROM asked)
  UNION ALL
  SELECT w.domain_name, w.track, r.n, r.seq, w.state, CASE WHEN r.named AND e.a IS NOT NULL THEN r.to_state ELSE w.state END, r.named AND e.a IS NOT NULL,
         CASE WHEN e.a IS NULL THEN 'illegal_transition' WHEN NOT r.named THEN 'missing_operator_or_reason' END
  FROM walk w JOIN numbered r ON w.domain_name = r.domain_name AND w.track = r.track AND r.n = w.n + 1 LEFT JOIN edges e ON e.track = w.track AND e.a = w.state AND e.b = r.to_state)
SELECT domain_name, track, seq, from_state, state, accepted, problem FROM walk WHERE n > 0"""
_LOG = f"""
log AS (
  SELECT n_name AS domain_name, n_nationkey AS k, seq, track, from_state, to_state
  FROM nation, (VALUES (1, 'search', '{_S[0]}', '{_S[1]}'), (2, 'search', '{_S[1]}', ''), (3, 'backend', '{_B[0]}', '{_B[1]}'), (4, 'search', '{_S[2]}', '{_S[1]}')) AS v(seq, track, from_state, to_state))"""
_TAGS = "'area=' || case_name || ',backend=' || backend"
_NAME = "CASE WHEN ok THEN 'search.backend.success' ELSE 'search.backend.failure' END"
ORACLE_SQL = {
    "ndcg_at_10": f"WITH {RANKINGS} SELECT lang AS query_id, round(ndcg, 9) AS ndcg_at_k FROM measures WHERE side = 'primary'",
    "mrr": f"WITH {RANKINGS} SELECT lang AS query_id, round(mrr, 9) AS mrr FROM measures WHERE side = 'shadow'",
    "overlap_at_k": f"""WITH {RANKINGS}, t AS (
          SELECT lang, (SELECT count(*) FROM p JOIN s USING (lang, doc_id) WHERE p.r <= 10 AND s.r <= 10 AND lang = langs.lang) AS n,
                 (SELECT count(*) FROM p WHERE r <= 10 AND lang = langs.lang) AS size,
                 (SELECT list(doc_id ORDER BY r) FROM p WHERE r <= 10 AND lang = langs.lang) = (SELECT list(doc_id ORDER BY r) FROM s WHERE r <= 10 AND lang = langs.lang) AS same FROM langs)
        SELECT lang AS query_id, n::INTEGER AS overlap_at_k, round(n::DOUBLE / size, 9) AS overlap_rate_at_k, same AS identical_order FROM t""",
    "corpus_report": f"WITH {RANKINGS} SELECT count(*) AS query_count, round(avg(ndcg), 9) AS average_ndcg_at_k, round(avg(mrr), 9) AS average_mrr, 0.0::DOUBLE AS zero_result_rate FROM measures WHERE side = 'primary'",
    "shadow_gate": f"""WITH {RANKINGS}, o AS (SELECT p.lang, count(*)::INTEGER AS n FROM p JOIN s USING (lang, doc_id) WHERE p.r <= 10 AND s.r <= 10 GROUP BY p.lang)
        SELECT a.lang AS query_id, coalesce(o.n, 0)::INTEGER AS overlap_at_k, round(a.ndcg, 9) AS primary_ndcg, round(b.ndcg, 9) AS shadow_ndcg, round(a.mrr, 9) AS primary_mrr, round(b.mrr, 9) AS shadow_mrr,
               CASE WHEN b.ndcg < 0.85 OR a.ndcg - b.ndcg > 0.1 OR b.mrr < 0.5 THEN 'shadow_relevance_regression' END AS code, CASE WHEN b.ndcg < 0.85 OR a.ndcg - b.ndcg > 0.1 OR b.mrr < 0.5 THEN 'high' END AS severity
        FROM measures a JOIN measures b USING (lang) LEFT JOIN o USING (lang) WHERE a.side = 'primary' AND b.side = 'shadow'""",
    "shadow_gate_unjudged": f"""WITH {RANKINGS}, o AS (SELECT lang, (SELECT count(*) FROM p JOIN s USING (lang, doc_id) WHERE p.r <= 10 AND s.r <= 10 AND lang = langs.lang)::DOUBLE / (SELECT count(*) FROM p WHERE r <= 10 AND lang = langs.lang) AS rate FROM langs)
        SELECT lang AS query_id, round(rate, 9) AS overlap_rate_at_k, CASE WHEN rate < 0.5 THEN 'shadow_overlap_regression' END AS code, CASE WHEN rate < 0.5 THEN 'medium' END AS severity FROM o""",
    "shadow_pairs": f"""WITH {RANKINGS} SELECT md5(lang) AS request_id, lang AS query_id, (SELECT count(*) FROM p JOIN s USING (lang, doc_id) WHERE p.r <= 10 AND s.r <= 10 AND lang = langs.lang)::INTEGER AS overlap_at_k
        FROM langs WHERE lang <> (SELECT min(lang) FROM langs)""",
    "canary_freeze": f"""WITH {REQUESTS}, f AS (SELECT backend, min(seq) AS first FROM requests WHERE NOT ok AND latency_ms > 50 GROUP BY 1)
        SELECT backend, coalesce(seq > first, false) AS frozen, count(*) AS requests, min(seq) AS first_seq FROM requests LEFT JOIN f USING (backend) GROUP BY 1, 2""",
    "cutover_latest": f"SELECT n_name AS domain_name, '{_B[1]}' AS backend_state, '{_S[1]}' AS search_state FROM nation",
    "cutover_illegal": f"""WITH {_LOG}
        SELECT domain_name, seq, track, CASE WHEN seq = 4 AND k % 3 = 0 THEN 'not_from_current_state' WHEN seq = 2 AND k % 3 = 0 THEN 'illegal_transition' ELSE 'missing_operator_or_reason' END AS problem
        FROM log WHERE k % 5 = 0 OR (k % 3 = 0 AND seq IN (2, 4))""",
    "cutover_replay": _REPLAY,
    "latency_percentiles": f"""WITH {REQUESTS}
        SELECT case_name, count(*) AS total_requests, count(*) FILTER (ok) AS successful_requests, count(*) FILTER (NOT ok) AS failed_requests, round(avg(latency_ms), 9) AS average_latency_ms, round(min(latency_ms), 9) AS min_latency_ms, round(max(latency_ms), 9) AS max_latency_ms,
               round(coalesce(avg(result_count) FILTER (ok), 0), 9) AS average_result_count, round(quantile_cont(latency_ms, 0.5), 9) AS p50_latency_ms, round(quantile_cont(latency_ms, 0.95), 9) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 9) AS p99_latency_ms
        FROM requests GROUP BY case_name""",
    "error_samples": f"WITH {REQUESTS} SELECT seq, case_name, error_type FROM requests WHERE NOT ok ORDER BY seq LIMIT 5",
    "case_expansion": "SELECT n_name AS case_name, (n_nationkey % 4)::INTEGER AS weight, unnest(range(1, (n_nationkey % 4) * 3 + 1))::INTEGER AS request FROM nation",
    "counters": f"WITH {REQUESTS} SELECT {_NAME} AS name, {_TAGS} AS tags, count(*) AS value FROM requests GROUP BY ALL",
    "counter_deltas": f"WITH {REQUESTS} SELECT {_NAME} AS name, {_TAGS} AS tags, count(*) AS delta FROM requests WHERE backend = 'backend-3' GROUP BY ALL",
    "failure_runs": f"""WITH {REQUESTS}, r AS (SELECT *, sum(ok::INTEGER) OVER (PARTITION BY backend ORDER BY seq) AS run FROM requests)
        SELECT backend, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS failures, count(*) >= 3 AS opened FROM r WHERE NOT ok GROUP BY backend, run""",
}
