"""DuckDB text of the deterministic plans, for side-by-side checks.

Each constant is a CTE chain over the driver's tables; the names mirror the
Spark builders in ``tastemap.plans.catalog``.  Every computed column is
aliased to the Spark name, integer results are BIGINT and metric doubles are
rounded to the same number of digits as on the Spark side.
"""

from __future__ import annotations

from tastemap.functions.buckets import SAMPLE_BUCKETS, bucket_thresholds, fraction_threshold, hash_bucket_sql
from tastemap.operators.ranking import METRIC_DIGITS
from tastemap.operators.split import PAIR_FRACTIONS, SPLIT_SEED, USER_FRACTIONS
from tastemap.params import (IMPLICIT_ALS, MEAN_CUTOFFS, MEAN_DAMPINGS, RANK1_GRID, SAMPLE_FRACTION, SAMPLED_GRID, TEST_K,
                             TOP_N, TUNE_K)
from tastemap.sources.interactions import INTERACTIONS_SQL
from tastemap.sources.tables import TABLES


PIVOT_ITEMS = 20  # the registered dense pivot lists the most popular items; any list can be given
LAYOUT_FILES = 16  # files of the written layout
VECTOR_WIDTH = 64
VECTOR_LIST = 10  # length of the registered lists of vectors
ROW_CHUNK = 16  # items of a stored row in the registered query, so that users have several
D = METRIC_DIGITS


def _label(bucket: str, fractions, names=("train", "val", "test")) -> str:
    bounds = bucket_thresholds(fractions)
    whens = " ".join(f"WHEN {bucket} < {b} THEN '{n}'" for b, n in zip(bounds[:-1], names[:-1]))
    return f"CASE {whens} ELSE '{names[-1]}' END"


BASE = f"""inter AS ({INTERACTIONS_SQL}),
rated AS (SELECT * FROM inter WHERE rating <> 0)"""

SPLIT = f"""{BASE},
active AS (SELECT user_id, count(*) AS n_rows FROM rated GROUP BY user_id HAVING count(*) >= 10),
groups AS (SELECT user_id, {_label(hash_bucket_sql(['user_id'], SPLIT_SEED), USER_FRACTIONS)} AS grp FROM active),
labeled AS (SELECT r.*, g.grp FROM rated r JOIN groups g USING (user_id)),
held AS (SELECT *, row_number() OVER (ORDER BY user_id, ts, item_id, ok, ln, rating) - 1 AS row_index,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id, ok, ln, rating) - 1 AS user_row
         FROM labeled WHERE grp <> 'train'),
split AS (SELECT user_id, item_id, rating, ts, ok, ln, 'train' AS split FROM labeled WHERE grp = 'train'
          UNION ALL
          SELECT user_id, item_id, rating, ts, ok, ln,
                 CASE WHEN user_row % 2 = 0 THEN 'train' ELSE grp END AS split FROM held)"""

POPULARITY = f"""{SPLIT},
train AS (SELECT * FROM split WHERE split = 'train'),
scores AS (SELECT item_id, count(user_id) AS score FROM train GROUP BY item_id),
top AS (SELECT * FROM (SELECT item_id, score, row_number() OVER (ORDER BY score DESC, item_id) AS rank
                       FROM scores) WHERE rank <= {TOP_N})"""


def _metrics_ctes(target: str) -> str:
    """Per-user metrics of the popularity list against ``target`` rows."""
    k = TOP_N
    return f"""
recs_{target} AS (SELECT u.user_id, t.item_id, t.rank
                  FROM (SELECT DISTINCT user_id FROM split WHERE split = '{target}') u CROSS JOIN top t),
truth_{target} AS (SELECT DISTINCT user_id, item_id FROM split WHERE split = '{target}'),
sizes_{target} AS (SELECT user_id, count(*) AS n_truth FROM truth_{target} GROUP BY user_id),
hits_{target} AS (SELECT r.user_id, r.rank,
                         row_number() OVER (PARTITION BY r.user_id ORDER BY r.rank) AS hit_no
                  FROM recs_{target} r JOIN truth_{target} t ON r.user_id = t.user_id AND r.item_id = t.item_id),
hstats_{target} AS (SELECT user_id,
                           CAST(sum(CASE WHEN rank <= {k} THEN 1 ELSE 0 END) AS BIGINT) AS hits_at_k,
                           count(*) AS n_hits, sum(hit_no / rank) AS ap_sum,
                           sum(CASE WHEN rank <= {k} THEN 1.0 / ln(rank + 1.0) ELSE 0.0 END) AS dcg
                    FROM hits_{target} GROUP BY user_id),
ideal_{target} AS (SELECT s.user_id, sum(1.0 / ln(g.i + 1.0)) AS idcg
                   FROM sizes_{target} s JOIN range(1, {k + 1}) g(i) ON g.i <= s.n_truth GROUP BY s.user_id),
per_user_{target} AS (
  SELECT s.user_id, s.n_truth, coalesce(h.n_hits, 0) AS n_hits,
         coalesce(h.hits_at_k, 0) / CAST({k} AS DOUBLE) AS precision_at_k,
         coalesce(h.ap_sum, 0.0) / s.n_truth AS average_precision,
         coalesce(h.dcg, 0.0) / i.idcg AS ndcg_at_k
  FROM (SELECT DISTINCT user_id FROM recs_{target}) l
  JOIN sizes_{target} s USING (user_id)
  JOIN ideal_{target} i USING (user_id)
  LEFT JOIN hstats_{target} h USING (user_id))"""


METRICS = POPULARITY + "," + _metrics_ctes("val") + "," + _metrics_ctes("test")

_INLINE_RATED = f"(SELECT * FROM ({INTERACTIONS_SQL}) WHERE rating <> 0)"


def _pivot_cols():
    return ", ".join(f"coalesce(avg(rating) FILTER (WHERE place = {i}), 0.0) AS top_{i}"
                     for i in range(1, PIVOT_ITEMS + 1))


def _vector_cols() -> str:
    return ", ".join(f"embedding[{i + 1}] AS f_{i}" for i in range(VECTOR_WIDTH))


MEAN_GRID = f"""{SPLIT},
train AS (SELECT * FROM split WHERE split = 'train'),
val AS (SELECT * FROM split WHERE split = 'val'),
overall AS (SELECT sum(rating) / count(*) AS mean FROM train),
items AS (SELECT item_id, sum(rating) AS total, count(*) AS n FROM train GROUP BY item_id),
dampings AS (SELECT CAST(unnest([{", ".join(map(str, MEAN_DAMPINGS))}]) AS DOUBLE) AS damping),
cutoffs AS (SELECT CAST(unnest([{", ".join(map(str, MEAN_CUTOFFS))}]) AS INTEGER) AS k),
scored AS (SELECT damping, item_id, (total + damping * mean) / (n + damping) AS score
           FROM items CROSS JOIN overall CROSS JOIN dampings),
errors AS (SELECT damping, round(sqrt(avg((rating - score) * (rating - score))), {D}) AS rmse
           FROM val JOIN scored USING (item_id) GROUP BY damping),
listed AS (SELECT damping, item_id, row_number() OVER (PARTITION BY damping ORDER BY score DESC, item_id) AS place
           FROM scored),
truth AS (SELECT DISTINCT user_id, item_id FROM val),
users AS (SELECT count(DISTINCT user_id) AS n_users FROM truth),
hits AS (SELECT damping, k, count(*) AS n_hits FROM truth JOIN listed USING (item_id) JOIN cutoffs ON place <= k
         GROUP BY damping, k),
grid AS (SELECT damping, k, rmse, round(coalesce(n_hits, 0) / (k * n_users), {D}) AS precision_at_k
         FROM errors CROSS JOIN cutoffs CROSS JOIN users LEFT JOIN hits USING (damping, k))"""


PAIR_SPLIT = f"""{SPLIT},
means AS (SELECT user_id, item_id, avg(rating) AS rating FROM split GROUP BY user_id, item_id),
pairs AS (SELECT user_id, item_id, rating,
                 {_label(hash_bucket_sql(['user_id', 'item_id'], SPLIT_SEED), PAIR_FRACTIONS)} AS split FROM means)"""


def _coverage() -> str:
    """Rows predicted and users ranked do not depend on a point: user and item must have been trained."""
    points = ", ".join(f"({r}, {i}, {g})" for r in SAMPLED_GRID["ranks"] for i in SAMPLED_GRID["iters"] for g in SAMPLED_GRID["regs"])
    return f"""WITH {PAIR_SPLIT},
users AS (SELECT DISTINCT user_id FROM pairs WHERE split = 'train'),
items AS (SELECT DISTINCT item_id FROM pairs WHERE split = 'train'),
seen AS (SELECT (SELECT count(*) FROM pairs JOIN users USING (user_id) JOIN items USING (item_id) WHERE split = 'val') AS n_rows,
                (SELECT count(DISTINCT user_id) FROM pairs JOIN users USING (user_id) WHERE split = 'val') AS n_users)
SELECT CAST(p.r AS INTEGER) AS rank, CAST(p.i AS INTEGER) AS max_iter, CAST(p.g AS DOUBLE) AS reg, CAST(1 AS DOUBLE) AS alpha,
       true AS implicit, CAST({TUNE_K} AS INTEGER) AS k, n_rows, n_users
FROM (VALUES {points}) p(r, i, g) CROSS JOIN seen"""


def _rank1() -> str:
    """Alternating least squares of rank 1 in SQL: from factors of 1, each round
    sets an item's factor to sum(r u) / (sum(u u) + reg n), then a user's likewise.
    Factors are 32-bit between the steps, as in Spark."""
    regs = ", ".join(f"({g})" for g in RANK1_GRID["regs"])
    out = f"""{SPLIT},
train AS (SELECT user_id, item_id, rating FROM split WHERE split = 'train'),
regs AS (SELECT CAST(g AS DOUBLE) AS reg FROM (VALUES {regs}) x(g)),
u0 AS MATERIALIZED (SELECT DISTINCT user_id, reg, CAST(1 AS FLOAT) AS f FROM train CROSS JOIN regs)"""
    for n in range(1, max(RANK1_GRID["iters"]) + 1):
        for own, other, name, given in (("item_id", "user_id", f"i{n}", f"u{n - 1}"), ("user_id", "item_id", f"u{n}", f"i{n}")):
            out += f""",
{name} AS MATERIALIZED (
  SELECT t.{own}, o.reg, CAST(greatest(sum(t.rating * o.f) / (sum(CAST(o.f AS DOUBLE) * o.f) + o.reg * count(*)), 0) AS FLOAT) AS f
  FROM train t JOIN {given} o USING ({other}) GROUP BY t.{own}, o.reg)"""
    for kind in ("u", "i"):
        out += f""",
{kind} AS ({" UNION ALL ".join(f"SELECT *, {n} AS rounds FROM {kind}{n}" for n in RANK1_GRID["iters"])})"""
    return out


def _rank1_metrics(target: str, k: int) -> str:
    """Metrics of every point on the rows of ``target``: all users have a
    positive factor, so their lists are the items by falling factor."""
    return f""",
errors AS (SELECT rounds, reg, count(*) AS n_rows, round(sqrt(avg(pow(s.rating - CAST(u.f AS DOUBLE) * i.f, 2))), {D}) AS rmse
           FROM split s JOIN u USING (user_id) JOIN i USING (item_id, reg, rounds) WHERE s.split = '{target}' GROUP BY rounds, reg),
listed AS (SELECT * FROM (SELECT item_id, reg, rounds, row_number() OVER (PARTITION BY reg, rounds ORDER BY f DESC, item_id) AS place FROM i)
           WHERE place <= {k}),
truth AS (SELECT DISTINCT user_id, item_id FROM split WHERE split = '{target}' AND user_id IN (SELECT user_id FROM train)),
sizes AS (SELECT user_id, count(*) AS n_truth FROM truth GROUP BY user_id),
ideal AS (SELECT s.user_id, sum(1.0 / ln(g.i + 1.0)) AS idcg
          FROM sizes s JOIN range(1, {k + 1}) g(i) ON g.i <= s.n_truth GROUP BY s.user_id),
hits AS (SELECT user_id, reg, rounds, place, row_number() OVER (PARTITION BY user_id, reg, rounds ORDER BY place) AS hit_no
         FROM truth JOIN listed USING (item_id)),
stats AS (SELECT user_id, reg, rounds, count(*) AS n_hits, sum(hit_no / place) AS ap_sum, sum(1.0 / ln(place + 1.0)) AS dcg
          FROM hits GROUP BY user_id, reg, rounds),
ranked AS (SELECT p.reg, p.rounds, count(*) AS n_users,
                  round(avg(coalesce(n_hits, 0) / CAST({k} AS DOUBLE)), {D}) AS precision_at_k,
                  round(avg(coalesce(ap_sum, 0.0) / n_truth), {D}) AS map, round(avg(coalesce(dcg, 0.0) / idcg), {D}) AS ndcg_at_k
           FROM sizes JOIN ideal USING (user_id) CROSS JOIN (SELECT DISTINCT reg, rounds FROM i) p
           LEFT JOIN stats USING (user_id, reg, rounds) GROUP BY p.reg, p.rounds),
grid AS (SELECT CAST(rounds AS INTEGER) AS max_iter, reg, CAST({k} AS INTEGER) AS k, rmse, precision_at_k, map, ndcg_at_k, n_rows, n_users
         FROM errors JOIN ranked USING (rounds, reg))"""


RANK1 = _rank1()
RANK1_VAL = RANK1 + _rank1_metrics("val", TOP_N)
TYPE_OF = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
           "FLOAT[]": "array<float>"}


def _schemas() -> str:
    kinds = " ".join(f"WHEN '{sql}' THEN '{spark}'" for sql, spark in TYPE_OF.items())
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type {kinds} ELSE column_type END AS type FROM (DESCRIBE {t})""" for t in TABLES)


ORACLE_SQL: dict[str, str] = {
    "interactions": INTERACTIONS_SQL,

    "nonzero_ratings": f"""WITH {BASE}
SELECT user_id, user_id AS user_id2, item_id, rating, ts FROM rated""",

    "drop_null_rows": f"""WITH {BASE}
SELECT * FROM inter WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL
  AND ts IS NOT NULL AND ok IS NOT NULL AND ln IS NOT NULL""",

    "hash_sample": f"""WITH {BASE}
SELECT * FROM rated WHERE {hash_bucket_sql(['user_id', 'item_id', 'ok', 'ln'], SPLIT_SEED, SAMPLE_BUCKETS)} < {fraction_threshold(SAMPLE_FRACTION, SAMPLE_BUCKETS)}""",

    "active_users": f"""WITH {BASE}
SELECT user_id, count(*) AS n_rows FROM rated GROUP BY user_id HAVING count(*) >= 10""",

    "user_groups": f"""WITH {SPLIT}
SELECT user_id, grp FROM groups""",

    "row_numbers": f"""WITH {SPLIT}
SELECT user_id, item_id, rating, ts, ok, ln, grp, row_index, user_row FROM held""",

    "half_split": f"""WITH {SPLIT}
SELECT user_id, item_id, rating, ts, ok, ln,
       CASE WHEN user_row % 2 = 0 THEN 'train' ELSE grp END AS split FROM held""",

    "train_val_test": f"WITH {SPLIT}\nSELECT * FROM split",

    "parquet_split_round_trip": f"WITH {SPLIT}\nSELECT * FROM split",

    "split_folder_scan": f"""WITH {SPLIT}
SELECT user_id, item_id, rating, ts, ok, ln FROM split WHERE split = 'val'""",

    "repartition_layout": f"""WITH {BASE}
SELECT user_id, item_id, rating, ts FROM inter WHERE rating <> 0""",

    "layout_files": f"""WITH {BASE}
SELECT CAST(least({LAYOUT_FILES}, count(*)) AS BIGINT) AS n_files, count(*) AS n_rows FROM rated""",

    "csv_round_trip": f"""WITH {BASE}
SELECT CAST(user_id AS INTEGER) AS userId, CAST(item_id AS INTEGER) AS movieId, rating,
       CAST(epoch(ts) AS INTEGER) AS timestamp FROM rated""",

    "table_schemas": _schemas(),

    "bucketed_counts": f"""WITH {SPLIT},
t AS (SELECT user_id, count(*) AS n_train, sum(rating) AS sum_train FROM split WHERE split = 'train' GROUP BY user_id)
SELECT user_id, n_val, n_train, sum_train FROM (SELECT user_id, count(*) AS n_val FROM split WHERE split = 'val' GROUP BY user_id)
LEFT JOIN t USING (user_id)""",

    "row_counts": f"""WITH {SPLIT}
SELECT 'interactions' AS name, count(*) AS n_rows FROM inter
UNION ALL SELECT 'rated', count(*) FROM rated
UNION ALL SELECT 'active_users', count(*) FROM active
UNION ALL SELECT 'train', count(*) FROM split WHERE split = 'train'
UNION ALL SELECT 'val', count(*) FROM split WHERE split = 'val'
UNION ALL SELECT 'test', count(*) FROM split WHERE split = 'test'""",

    "split_counts": f"""WITH {SPLIT}
SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM split GROUP BY split""",

    "interaction_split": f"""WITH {SPLIT},
pairs AS (SELECT user_id, item_id, avg(rating) AS rating FROM split GROUP BY user_id, item_id)
SELECT user_id, item_id, rating,
       {_label(hash_bucket_sql(['user_id', 'item_id'], SPLIT_SEED), PAIR_FRACTIONS)} AS split FROM pairs""",

    "popularity_scores": f"WITH {POPULARITY}\nSELECT item_id, score FROM scores",

    "popularity_top100": f"WITH {POPULARITY}\nSELECT item_id, score, rank FROM top",

    "popularity_report_csv": f"""WITH {POPULARITY}
SELECT CAST(item_id AS BIGINT) AS item_id, score, rank FROM top""",

    "popularity_report_parquet": f"WITH {POPULARITY}\nSELECT item_id, score, rank FROM top",

    "popularity_for_users": f"""WITH {POPULARITY}
SELECT u.user_id, t.item_id, t.score, t.rank
FROM (SELECT DISTINCT user_id FROM split WHERE split = 'val') u CROSS JOIN top t""",

    "truth_sets": f"""WITH {SPLIT}
SELECT DISTINCT user_id, item_id FROM split WHERE split = 'val'""",

    "popularity_user_metrics": f"""WITH {METRICS}
SELECT user_id, n_truth, n_hits, round(precision_at_k, {D}) AS precision_at_k,
       round(average_precision, {D}) AS average_precision, round(ndcg_at_k, {D}) AS ndcg_at_k
FROM per_user_val""",

    "popularity_metrics": f"""WITH {METRICS}
SELECT 'val' AS split, count(*) AS n_users, round(avg(precision_at_k), {D}) AS precision_at_k,
       round(avg(average_precision), {D}) AS map, round(avg(ndcg_at_k), {D}) AS ndcg_at_k FROM per_user_val
UNION ALL
SELECT 'test', count(*), round(avg(precision_at_k), {D}), round(avg(average_precision), {D}),
       round(avg(ndcg_at_k), {D}) FROM per_user_test""",

    "item_mean_rmse": f"""WITH {SPLIT},
means AS (SELECT item_id, avg(rating) AS prediction FROM split WHERE split = 'train' GROUP BY item_id),
scored AS (SELECT s.split, s.rating, m.prediction FROM split s JOIN means m USING (item_id)
           WHERE s.split IN ('val', 'test'))
SELECT split, count(*) AS n_rows,
       round(sqrt(avg((rating - prediction) * (rating - prediction))), {D}) AS rmse
FROM scored GROUP BY split""",

    "user_item_means": f"""WITH {BASE}
SELECT user_id, item_id, avg(rating) AS rating FROM rated GROUP BY user_id, item_id""",

    "dense_ids": f"""WITH {BASE}
SELECT dense_rank() OVER (ORDER BY user_id) - 1 AS user_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item_id, rating FROM rated""",

    "user_item_maps": f"""WITH {BASE}
SELECT user_id, item_id, avg(rating) AS rating FROM rated GROUP BY user_id, item_id""",

    "user_item_pivot": f"""WITH {BASE},
listed AS (SELECT item_id, row_number() OVER (ORDER BY count(user_id) DESC, item_id) AS place
           FROM rated GROUP BY item_id)
SELECT user_id, {_pivot_cols()} FROM rated LEFT JOIN listed USING (item_id) GROUP BY user_id""",

    "vector_columns": f"SELECT vec_id, label, {_vector_cols()} FROM embeddings",

    "als_prediction_rows": f"""WITH {SPLIT}
SELECT user_id, item_id, rating FROM split WHERE split = 'val'
  AND user_id IN (SELECT user_id FROM split WHERE split = 'train')
  AND item_id IN (SELECT item_id FROM split WHERE split = 'train')""",

    "als_list_shape": f"""WITH {SPLIT},
size AS (SELECT least({TOP_N}, count(DISTINCT item_id)) AS n FROM split WHERE split = 'train')
SELECT user_id, n AS n_rows, n AS n_items, CAST(1 AS BIGINT) AS first_rank, n AS last_rank, true AS scores_fall
FROM (SELECT DISTINCT user_id FROM split WHERE split = 'train') CROSS JOIN size""",

    "als_factor_ids": f"""WITH {SPLIT}
SELECT DISTINCT 'user' AS kind, user_id AS id, CAST({IMPLICIT_ALS["rank"]} AS BIGINT) AS width FROM split WHERE split = 'train'
UNION ALL
SELECT DISTINCT 'item', item_id, CAST({IMPLICIT_ALS["rank"]} AS BIGINT) FROM split WHERE split = 'train'""",

    "als_unseen_shape": f"""WITH {SPLIT},
train AS (SELECT DISTINCT user_id, item_id FROM split WHERE split = 'train'),
lengths AS (SELECT user_id, least({TOP_N}, (SELECT count(DISTINCT item_id) FROM train) - count(*)) AS n
            FROM train GROUP BY user_id)
SELECT user_id, n AS n_rows, n AS last_rank, CAST(0 AS BIGINT) AS n_seen FROM lengths WHERE n > 0""",

    "als_evaluated_users": f"""WITH {SPLIT}
SELECT split, count(DISTINCT user_id) AS n_users FROM split
WHERE split <> 'train' AND user_id IN (SELECT user_id FROM split WHERE split = 'train') GROUP BY split""",

    "sliced_list_shape": f"""WITH {SPLIT},
size AS (SELECT least({TOP_N}, count(DISTINCT item_id)) AS n FROM split WHERE split = 'train')
SELECT user_id, n AS n_rows, n AS n_items, CAST(1 AS BIGINT) AS first_rank, n AS last_rank, true AS scores_fall
FROM (SELECT DISTINCT user_id FROM split WHERE split = 'train') CROSS JOIN size""",

    "vector_lists": f"""
WITH pairs AS (
  SELECT a.vec_id, b.vec_id AS other_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
  FROM embeddings a CROSS JOIN embeddings b)
SELECT vec_id, rank, other_id, round(score, 8) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, other_id) AS rank FROM pairs) WHERE rank <= {VECTOR_LIST}""",

    "rank1_factors": f"""WITH {RANK1},
every AS (SELECT 'user' AS kind, user_id AS id, reg, f FROM u{max(RANK1_GRID["iters"])}
          UNION ALL SELECT 'item', item_id, reg, f FROM i{max(RANK1_GRID["iters"])})
SELECT kind, id, {", ".join(f"round(max(CAST(f AS DOUBLE)) FILTER (WHERE reg = {g}), 4) AS f_{n}" for n, g in enumerate(RANK1_GRID["regs"]))}
FROM every GROUP BY kind, id""",

    "rank1_grid": f"WITH {RANK1_VAL}\nSELECT * FROM grid",

    "rank1_best_rmse": f"WITH {RANK1_VAL}\nSELECT * FROM grid ORDER BY rmse, max_iter, reg LIMIT 1",

    "rank1_best_precision": f"WITH {RANK1_VAL}\nSELECT * FROM grid ORDER BY precision_at_k DESC, max_iter, reg LIMIT 1",

    "rank1_cross_table": f"""WITH {RANK1_VAL}
SELECT reg, {", ".join(f'max(rmse) FILTER (WHERE max_iter = {i}) AS "{i}"' for i in RANK1_GRID["iters"])} FROM grid GROUP BY reg""",

    "rank1_refit": f"""WITH best AS (WITH {RANK1_VAL}
SELECT max_iter, reg FROM grid ORDER BY rmse, max_iter, reg LIMIT 1),
every AS (WITH {RANK1 + _rank1_metrics("test", TEST_K)}
SELECT * FROM grid)
SELECT every.* FROM every JOIN best USING (max_iter, reg)""",

    "implicit_grid_coverage": _coverage(),

    "mean_grid": f"WITH {MEAN_GRID}\nSELECT damping, k, rmse, precision_at_k FROM grid",

    "best_mean_rmse": f"WITH {MEAN_GRID}\nSELECT damping, k, rmse, precision_at_k FROM grid ORDER BY rmse, damping, k LIMIT 1",

    "best_mean_precision": f"""WITH {MEAN_GRID}
SELECT damping, k, rmse, precision_at_k FROM grid ORDER BY precision_at_k DESC, damping, k LIMIT 1""",

    "mean_cross_table": f"""WITH {MEAN_GRID}
SELECT damping, {", ".join(f'max(precision_at_k) FILTER (WHERE k = {k}) AS "{k}"' for k in MEAN_CUTOFFS)}
FROM grid GROUP BY damping""",
}
