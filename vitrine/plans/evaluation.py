"""Registered metric, gate and loss queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import vectors as V
from ..operators import gate, losses, metrics, retrieve
from ..session import work_dir
from ..sources.snapshots import Snapshots
from .inputs import AS_OF, DIM, Inputs
from .registry import query, rounded, text_time
from .retrieval import SHORT, ranking_sql

KS = metrics.K_VALUES
NAMES = metrics.metric_names()
# Model versions evaluated: leading dimensions used and when.
VERSIONS = [("1", SHORT, "2024-01-05"), ("2", 32, "2024-01-15"), ("3", DIM, "2024-01-25")]
MODEL = "encoder"


def per_query(i: Inputs, dim: int = DIM) -> DataFrame:
    ranked = retrieve.truncated_topk(i.queries(), i.catalogue(), max(KS), dim)
    return metrics.query_metrics(
        i.queries().select("query_id", *metrics.SLICE_DIMENSIONS), ranked, i.relevance()
    )


def evaluation(i: Inputs, dim: int = DIM) -> DataFrame:
    # Ten digits, so that equal slices of two versions differ by exactly zero.
    return rounded(metrics.slice_metrics(per_query(i, dim)), *NAMES, digits=10)


_HISTORIES: dict[tuple[str, str], str] = {}


def history(i: Inputs) -> DataFrame:
    """The stored metric history of the three versions; each is evaluated once per session and set of tables."""
    key = (i.spark.sparkContext.applicationId, i.sf_dir)
    log = Snapshots(i.spark, _HISTORIES.setdefault(key, work_dir(i.spark, "metric-history")))
    for version, dim, at in VERSIONS:
        gate.fold_evaluation(log, lambda dim=dim: evaluation(i, dim), MODEL, version, at)
    return log.read()


def evaluated(i: Inputs, dim: int) -> DataFrame:
    """The stored evaluation of the version that uses ``dim`` components."""
    version = next(v for v, d, _ in VERSIONS if d == dim)
    return history(i).where(F.col("model_version") == version).drop("model_name", "model_version", "evaluated_at")


def per_query_sql(dim: int = DIM) -> str:
    hits = ", ".join(
        f"count(*) FILTER (rank <= {k}) AS h{k}, coalesce(sum(grade / log2(rank + 1)) FILTER (rank <= {k}), 0) AS d{k}" for k in KS
    )
    ideal = ", ".join(f"sum(grade / log2(place + 1)) FILTER (place <= {k}) AS i{k}" for k in KS)
    recall = ", ".join(f"coalesce(h.h{k}, 0) / n.n AS recall_at_{k}" for k in KS)
    ndcg = ", ".join(f"CASE WHEN i{k} > 0 THEN coalesce(d{k}, 0) / i{k} END AS ndcg_at_{k}" for k in KS)
    return f"""
SELECT q.query_id, q.category, q.query_condition, q.size_band, q.occlusion, {recall}, {ndcg},
       coalesce(1 / h.first, 0)::DOUBLE AS mrr
FROM f_queries q
LEFT JOIN (SELECT query_id, min(rank) AS first, {hits}
           FROM ({ranking_sql(k=max(KS), dim=dim)}) t JOIN f_relevance USING (query_id, product_id) GROUP BY query_id) h USING (query_id)
LEFT JOIN (SELECT query_id, count(DISTINCT product_id) AS n FROM f_relevance GROUP BY query_id) n USING (query_id)
LEFT JOIN (SELECT query_id, {ideal} FROM (
             SELECT query_id, grade, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC) AS place FROM f_relevance) g
           GROUP BY query_id) i USING (query_id)"""


def evaluation_sql(dim: int = DIM) -> str:
    means = ", ".join(f"round(avg({m}), 10) AS {m}" for m in NAMES)
    parts = [f"SELECT 'overall' AS slice_dim, 'all' AS slice_value, count(*) AS n_queries, {means} FROM pq"]
    parts += [
        f"SELECT '{d}', {d}, count(*), {means} FROM pq WHERE {d} IS NOT NULL GROUP BY {d}" for d in metrics.SLICE_DIMENSIONS
    ]
    return f"WITH pq AS ({per_query_sql(dim)}) " + " UNION ALL ".join(parts)


HISTORY_SQL = " UNION ALL ".join(
    f"SELECT *, '{MODEL}' AS model_name, '{v}' AS model_version, TIMESTAMP '{at}' AS evaluated_at FROM ({evaluation_sql(dim)}) e{v}"
    for v, dim, at in VERSIONS
)
_ROUNDED = ", ".join(f"round({m}, 6) + 0 AS {m}" for m in NAMES)
_SLICE = "slice_dim, slice_value, n_queries"


@query("query_metrics", f"SELECT query_id, category, query_condition, size_band, occlusion, {_ROUNDED} FROM ({per_query_sql()}) t")
def query_metrics(i):
    return rounded(per_query(i), *NAMES)


@query("slice_metrics", f"SELECT {_SLICE}, {_ROUNDED} FROM ({evaluation_sql()}) t")
def slice_metrics(i):
    return rounded(evaluation(i), *NAMES)


PROTECTED = (("category", "bag"), ("category", "hat"), ("size_band", "small"), ("category", "scarf"))


def verdicts_sql(candidate: int, champion: int) -> str:
    protected = ", ".join(f"('{d}', '{v}', {n})" for n, (d, v) in enumerate(PROTECTED))

    def worst(name: str, rows: str, limit: float) -> str:
        return f"""
SELECT '{name}' AS name, w.drop <= {limit} AS passed, w.drop AS observed, {limit}::DOUBLE AS threshold,
       CASE WHEN w.drop > 0 THEN concat('worst: ', w.label) ELSE 'no regression' END AS detail
FROM (SELECT coalesce(max(drop), 0)::DOUBLE AS drop, first(label ORDER BY drop DESC, position, label) AS label
      FROM ({rows}) d WHERE drop > 0) w"""

    drop = "h.recall_at_20 - c.recall_at_20 AS drop, concat(c.slice_dim, '=', c.slice_value) AS label"
    return f"""
WITH cand AS ({evaluation_sql(candidate)}), champ AS ({evaluation_sql(champion)}),
guard(slice_dim, slice_value, position) AS (VALUES {protected}),
overall AS (SELECT coalesce((SELECT ndcg_at_20 FROM cand WHERE slice_dim = 'overall'), 0) AS c,
                   coalesce((SELECT ndcg_at_20 FROM champ WHERE slice_dim = 'overall'), 0) AS h),
covered AS (SELECT count(*) AS total, count(*) FILTER (coalesce(c.n_queries, 0) < 20) AS missing,
                   string_agg(concat(g.slice_dim, '=', g.slice_value), ', ' ORDER BY position) FILTER (coalesce(c.n_queries, 0) < 20) AS which
            FROM guard g LEFT JOIN cand c USING (slice_dim, slice_value))
SELECT 'overall_ndcg20_not_worse' AS name, c >= h - 1e-9 AS passed, c AS observed, h AS threshold, 'candidate vs champion' AS detail FROM overall
UNION ALL {worst('recall20_no_slice_regression', f"SELECT {drop}, 0 AS position FROM cand c JOIN champ h USING (slice_dim, slice_value) WHERE c.slice_dim <> 'overall' AND c.n_queries >= 20", 0.01)}
UNION ALL {worst('protected_slices_no_regression', f"SELECT {drop}, position FROM guard g JOIN cand c USING (slice_dim, slice_value) JOIN champ h USING (slice_dim, slice_value)", 0.005)}
UNION ALL SELECT 'protected_slice_coverage', missing = 0, (total - missing)::DOUBLE, total::DOUBLE,
       CASE WHEN missing > 0 THEN concat('too few queries: ', which) ELSE 'all covered' END FROM covered"""


def _verdicts(i: Inputs, candidate: int, champion: int) -> DataFrame:
    return gate.gate_verdicts(evaluated(i, candidate), evaluated(i, champion), gate.GateConfig(protected=PROTECTED))


_VERDICT_COLUMNS = "name, passed, round(observed, 6) + 0 AS observed, round(threshold, 6) + 0 AS threshold, detail"


@query("gate_verdicts", f"SELECT {_VERDICT_COLUMNS} FROM ({verdicts_sql(DIM, SHORT)}) t")
def gate_verdicts(i):
    """All dimensions as the candidate against the short champion."""
    return rounded(_verdicts(i, DIM, SHORT), "observed", "threshold")


@query("gate_blocks", f"SELECT {_VERDICT_COLUMNS} FROM ({verdicts_sql(SHORT, DIM)}) t")
def gate_blocks(i):
    """The short model as the candidate: the gate must block it."""
    return rounded(_verdicts(i, SHORT, DIM), "observed", "threshold")


@query(
    "gate_report",
    f"SELECT bool_and(passed) AS passed, coalesce(string_agg(name, ', ' ORDER BY name) FILTER (NOT passed), '') AS failures FROM ({verdicts_sql(SHORT, DIM)}) t",
)
def gate_report(i):
    return gate.gate_report(_verdicts(i, SHORT, DIM)).select("passed", "failures")


@query(
    "matryoshka_gate",
    f"""
WITH s AS (SELECT recall_at_50 AS short FROM ({evaluation_sql(SHORT)}) a WHERE slice_dim = 'overall'),
f AS (SELECT recall_at_50 AS full_dim FROM ({evaluation_sql(DIM)}) a WHERE slice_dim = 'overall')
SELECT 'truncated_recall_retained' AS name, short / full_dim >= 0.95 AS passed, round(short / full_dim, 6) AS observed, 0.95::DOUBLE AS threshold,
       'truncated Recall@50 as a fraction of full' AS detail FROM s, f""",
)
def matryoshka_gate(i):
    return rounded(gate.matryoshka_retention(evaluation(i, SHORT), evaluation(i, DIM)), "observed", "threshold")


_HISTORY_COLUMNS = f"model_name, model_version, strftime(evaluated_at, '%Y-%m-%d %H:%M:%S') AS evaluated_at, {_SLICE}, {_ROUNDED}"


@query(
    "latest_metrics",
    f"SELECT {_HISTORY_COLUMNS} FROM (SELECT *, max(evaluated_at) OVER (PARTITION BY model_name, model_version) AS newest FROM ({HISTORY_SQL}) h) t WHERE evaluated_at = newest",
)
def latest_metrics(i):
    return rounded(text_time(gate.latest_metrics(history(i)), "evaluated_at"), *NAMES)




@query(
    "champion_baseline",
    f"""
SELECT {_HISTORY_COLUMNS} FROM ({HISTORY_SQL}) h
WHERE model_version = (SELECT arg_max(version, moved_at)::VARCHAR FROM (
  SELECT version % 3 + 1 AS version, moved_at FROM f_alias_moves WHERE alias = 'production' AND moved_at <= TIMESTAMP '{AS_OF}') m)""",
)
def champion_baseline(i):
    """Every production move of the log, read as moves of one model among its three versions."""
    moves = i.alias_moves().withColumns({"model_name": F.lit(MODEL), "version": F.col("version") % 3 + 1})
    rows = gate.champion_baseline(history(i), moves, MODEL, "production", AS_OF)
    return rounded(text_time(rows, "evaluated_at"), *NAMES)


@query(
    "metric_trend",
    f"""
SELECT model_name, model_version, strftime(evaluated_at, '%Y-%m-%d %H:%M:%S') AS evaluated_at, n_queries,
       round(recall_at_20, 6) AS recall_at_20, round(ndcg_at_20, 6) AS ndcg_at_20, round(mrr, 6) AS mrr, round(delta, 6) + 0 AS delta,
       CASE WHEN delta IS NULL THEN 'first' WHEN delta > 0.005 THEN 'improved' WHEN delta < -0.005 THEN 'declined' ELSE 'held steady' END AS trend,
       coalesce(delta < -0.02, false) AS degraded
FROM (SELECT *, ndcg_at_20 - lag(ndcg_at_20) OVER (PARTITION BY model_name ORDER BY evaluated_at) AS delta
      FROM ({HISTORY_SQL}) h WHERE slice_dim = 'overall') t""",
)
def metric_trend(i):
    return rounded(
        text_time(gate.metric_trend(history(i)), "evaluated_at"), "recall_at_20", "ndcg_at_20", "mrr", "delta"
    )


@query(
    "weak_slices",
    f"""
WITH m AS ({evaluation_sql(SHORT)}), o AS (SELECT recall_at_20 * 0.95 AS floor FROM m WHERE slice_dim = 'overall')
SELECT {_SLICE}, round(m.recall_at_20, 3) AS recall_at_20, round(o.floor, 6) AS floor
FROM m, o WHERE slice_dim <> 'overall' AND n_queries >= 20 AND round(m.recall_at_20, 3) < o.floor""",
)
def weak_slices(i):
    return rounded(gate.weak_slices(evaluated(i, SHORT), 0.95), "floor")


@query(
    "alias_asof",
    f"""
SELECT model_name, alias, arg_max(version, (moved_at, version)) AS version, strftime(max(moved_at), '%Y-%m-%d %H:%M:%S') AS moved_at
FROM f_alias_moves WHERE moved_at <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY model_name, alias""",
)
def alias_asof(i):
    return text_time(gate.alias_asof(i.alias_moves(), "2024-01-20 12:00:00"), "moved_at")


@query(
    "version_numbers",
    "SELECT model_name, max(version) AS latest_version, max(version) + 1 AS next_version FROM f_alias_moves GROUP BY model_name",
)
def version_numbers(i):
    return gate.latest_version(i.alias_moves())


@query(
    "promotion_log",
    """
SELECT strftime(promoted_at, '%Y-%m-%d %H:%M:%S') AS promoted_at, model_name, alias, from_version, to_version, gate_status, promoted_by
FROM (SELECT * FROM f_promotions WHERE gate_status <> 'FAILED' ORDER BY promoted_at DESC, to_version DESC LIMIT 10) t""",
)
def promotion_log(i):
    return text_time(gate.promotion_log(_promoted(i).read()), "promoted_at")


_HALFWAY = "2024-01-16"


def _promoted(i) -> Snapshots:
    """The promotion log after two appends, the second one made on top of the first."""
    log = Snapshots(i.spark, work_dir(i.spark, "promotions"))
    early = F.col("promoted_at") < F.lit(_HALFWAY).cast("timestamp")
    first = gate.promote(log, gate.accepted(i.promotions()).where(early), 0)
    gate.promote(log, gate.accepted(i.promotions()).where(~early), first)
    return log


@query(
    "promotion_versions",
    f"""
SELECT version, count(*) AS n_promotions, max(to_version) AS newest, count(*) FILTER (gate_status = 'FORCED') AS forced
FROM f_promotions, (VALUES (1), (2)) v(version)
WHERE gate_status <> 'FAILED' AND (version = 2 OR promoted_at < TIMESTAMP '{_HALFWAY}') GROUP BY version""",
)
def promotion_versions(i):
    """What the log held at each of its versions: an append leaves the version before it readable."""
    log = _promoted(i)
    held = [log.read(n).withColumn("version", F.lit(n)) for n, _ in log.versions()]
    return held[0].unionByName(held[1]).groupBy("version").agg(
        F.count(F.lit(1)).alias("n_promotions"), F.max("to_version").alias("newest"),
        F.count(F.when(F.col("gate_status") == "FORCED", 1)).alias("forced"),
    )


# Loss reports: each query and its own product are a pair; batches of about 64.
BATCH = 64


def _pairs(i: Inputs) -> DataFrame:
    positives = i.catalogue().select(F.col("product_id").alias("pair_id"), F.col("embedding").alias("positive"))
    return i.queries().select(F.col("query_id").alias("pair_id"), F.col("embedding").alias("anchor")).join(positives, "pair_id")


def _n_batches(pairs: DataFrame) -> int:
    return max(1, pairs.count() // BATCH)


def _report(i: Inputs, loss) -> DataFrame:
    n = _n_batches(i.catalogue())
    return rounded(losses.loss_report(losses.batch_losses(_pairs(i), loss, n)), "loss")


_PAIRS_SQL = f"""
pairs AS (SELECT q.query_id AS pair_id, q.embedding AS anchor, p.embedding AS positive,
                 ('0x' || substr(md5(q.query_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, count(*) // {BATCH}) FROM f_catalogue) AS batch
          FROM f_queries q JOIN f_catalogue p ON p.product_id = q.query_id)"""


def _logits(dim: int = DIM) -> str:
    return (
        f"SELECT a.batch, a.pair_id AS a_id, b.pair_id AS b_id, list_cosine_similarity(a.anchor[1:{dim}], b.positive[1:{dim}]) / 0.07 AS z "
        "FROM pairs a JOIN pairs b ON a.batch = b.batch"
    )


def _nce_sql(dim: int = DIM) -> str:
    return f"""
SELECT batch, count(*) AS n, avg(la + lb - 2 * own) / 2 AS loss FROM (
  SELECT r.batch, r.a_id, r.la, r.own, c.lb
  FROM (SELECT batch, a_id, ln(sum(exp(z))) AS la, max(z) FILTER (a_id = b_id) AS own FROM ({_logits(dim)}) l GROUP BY batch, a_id) r
  JOIN (SELECT batch, b_id, ln(sum(exp(z))) AS lb FROM ({_logits(dim)}) l GROUP BY batch, b_id) c ON c.batch = r.batch AND c.b_id = r.a_id) t
GROUP BY batch"""


_LOSS_COLUMNS = "SELECT count(*) AS n_batches, sum(n)::BIGINT AS n_pairs, round(avg(loss), 6) + 0 AS loss FROM"


@query("infonce_report", f"WITH {_PAIRS_SQL} {_LOSS_COLUMNS} ({_nce_sql()}) b")
def infonce_report(i):
    return _report(i, losses.info_nce())


@query(
    "siglip_report",
    f"""WITH {_PAIRS_SQL} {_LOSS_COLUMNS} (
SELECT batch, count(DISTINCT a_id) AS n, sum(greatest(s, 0) + ln(1 + exp(-abs(s)))) / count(DISTINCT a_id) AS loss
FROM (SELECT batch, a_id, CASE WHEN a_id = b_id THEN -(z - 10) ELSE z - 10 END AS s FROM ({_logits()}) l) t GROUP BY batch) b""",
)
def siglip_report(i):
    return _report(i, losses.sig_lip())


_DIMS = (16, 32, 64)
_WEIGHTS = {d: d**-0.5 / sum(e**-0.5 for e in _DIMS) for d in _DIMS}


@query(
    "matryoshka_loss",
    f"WITH {_PAIRS_SQL} {_LOSS_COLUMNS} (SELECT batch, max(n) AS n, sum(loss) AS loss FROM ("
    + " UNION ALL ".join(f"SELECT batch, n, {w}::DOUBLE * loss AS loss FROM ({_nce_sql(d)}) d{d}" for d, w in _WEIGHTS.items())
    + ") w GROUP BY batch) b",
)
def matryoshka_loss(i):
    return _report(i, losses.matryoshka(losses.info_nce(), _DIMS))


N_HARD = 4
K_MINE = N_HARD + 1


@query(
    "hardneg_report",
    f"""
WITH {_PAIRS_SQL},
mined AS (SELECT query_id, product_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS nth
          FROM ({ranking_sql(k=K_MINE)}) t WHERE query_id <> product_id),
extra AS (SELECT m.query_id AS a_id, list_cosine_similarity(q.embedding, p.embedding) / 0.07 AS z
          FROM mined m JOIN f_queries q USING (query_id) JOIN f_catalogue p USING (product_id) WHERE nth <= {N_HARD}),
logits AS ({_logits()})
{_LOSS_COLUMNS} (
SELECT batch, count(*) AS n, avg(ln(total) - own) AS loss FROM (
  SELECT batch, a_id, sum(exp(z)) AS total, max(own) AS own FROM (
    SELECT batch, a_id, z, CASE WHEN a_id = b_id THEN z END AS own FROM logits
    UNION ALL SELECT p.batch, e.a_id, e.z, NULL FROM extra e JOIN pairs p ON p.pair_id = e.a_id) u
  GROUP BY batch, a_id) t GROUP BY batch) b""",
)
def hardneg_report(i):
    """Each anchor's nearest wrong products join its in-batch negatives."""
    ranked = retrieve.exact_topk(i.queries(), i.catalogue(), K_MINE)
    wrong = ranked.where(F.col("query_id") != F.col("product_id"))
    vectors = i.catalogue().select("product_id", V.as_double("embedding").alias("v"))
    # At most K_MINE rows per query, so the array is bounded.
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("rank", "v"))), 1, N_HARD)
    mined = wrong.join(vectors, "product_id").groupBy(F.col("query_id").alias("pair_id")).agg(nearest["v"].alias("negatives"))
    pairs = _pairs(i).join(mined, "pair_id", "left")  # an anchor without wrong neighbours has only its batch
    n = _n_batches(i.catalogue())
    return rounded(losses.loss_report(losses.batch_losses(pairs, losses.hard_negative_nce(), n, "negatives")), "loss")
