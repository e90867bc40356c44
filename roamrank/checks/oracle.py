"""The same queries in plain SQL, trained models included.

ALS needs only sums and, at rank 1 and 2, a closed-form solution, so SQL trains
the model itself: one common table expression per half-step.
"""

from __future__ import annotations

from roamrank.checks.queries import AS_OF, EXACT, FULL, K, SEED
from roamrank.functions.expressions import (
    HASH_PRIME,
    ITEM_FACTOR,
    SEED_FACTOR,
    USER_FACTOR,
    split_mix,
)
from roamrank.operators.model import AlsConfig

BASE = """
listings AS (
  SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS host_id, s_name AS host_name,
         n_name AS neighbourhood, s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
areas AS (
  SELECT n_name AS neighbourhood, r_name AS neighbourhood_group,
         CAST(row_number() OVER (ORDER BY n_name) - 1 AS BIGINT) AS neighbourhood_id
  FROM nation JOIN region ON n_regionkey = r_regionkey),
reviews AS (
  SELECT l_suppkey AS listing_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
         o_custkey AS reviewer_id, c_name AS reviewer_name,
         l_orderkey, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
listing_area AS (
  SELECT id, host_id, host_name, neighbourhood, neighbourhood_id
  FROM listings JOIN areas USING (neighbourhood)),
visits AS (
  SELECT host_id, host_name, neighbourhood, neighbourhood_id, listing_id, date,
         reviewer_id, reviewer_name
  FROM listing_area JOIN reviews ON id = listing_id),
reviewers AS (
  SELECT reviewer_id, max_by(reviewer_name, {'a': date, 'b': reviewer_name}) AS reviewer_name
  FROM reviews WHERE reviewer_name IS NOT NULL GROUP BY reviewer_id),
ratings AS MATERIALIZED (
  SELECT reviewer_id AS u, neighbourhood_id AS i, CAST(count(*) AS DOUBLE) AS rating
  FROM visits GROUP BY 1, 2)
"""

_FACTOR, _SHIFT = split_mix(SEED)
_PAIR = f"(((u % {HASH_PRIME}) * {USER_FACTOR} + (i % {HASH_PRIME}) * {ITEM_FACTOR}) % {HASH_PRIME})"
_MIXED = f"(({_PAIR} * {_FACTOR} + {_SHIFT}) % {HASH_PRIME})"
BUCKET = f"({_MIXED} * ({_MIXED} + {ITEM_FACTOR})) % {HASH_PRIME} % 100"


def _sql(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([BASE, *extra]) + "\n" + body


def _solution(sums: str, rank: int, reg: float) -> str:
    """Factors f0, f1, ... from n, a{i}_{j} and b{i}: a Cholesky decomposition, a column at a time."""
    a = lambda i, j: f"a{i}_{j}" + (f" + {reg} * n" if i == j else "")
    less = lambda pairs: "".join(f" - {x} * {y}" for x, y in pairs)
    for j in range(rank):
        root = f"sqrt({a(j, j)}" + less((f"l{j}_{k}", f"l{j}_{k}") for k in range(j)) + f") AS l{j}_{j}"
        sums = f"(SELECT *, {root} FROM {sums} AS r{j})"
        below = [
            f"(a{j}_{i}" + less((f"l{i}_{k}", f"l{j}_{k}") for k in range(j)) + f") / l{j}_{j} AS l{i}_{j}"
            for i in range(j + 1, rank)
        ]
        forward = f"(b{j}" + less((f"l{j}_{k}", f"y{k}") for k in range(j)) + f") / l{j}_{j} AS y{j}"
        sums = f"(SELECT *, {', '.join([*below, forward])} FROM {sums} AS c{j})"
    for j in reversed(range(rank)):
        back = f"(y{j}" + less((f"l{k}_{j}", f"f{k}") for k in range(j + 1, rank)) + f") / l{j}_{j} AS f{j}"
        sums = f"(SELECT *, {back} FROM {sums} AS x{j})"
    return f"SELECT id, {_factors(rank)} FROM {sums} AS solved"


def _factors(rank: int) -> str:
    return ", ".join(f"f{d}" for d in range(rank))


def _trained(source: str, config: AlsConfig) -> list[str]:
    """Factors after the configured rounds, as tables uf(id, f0, f1, ...) and itf."""
    rank, shift = config.rank, config.seed % HASH_PRIME * SEED_FACTOR % HASH_PRIME

    def start(d: int) -> str:
        number = f"(((u % {HASH_PRIME}) * {USER_FACTOR * (2 * d + 1)} + {shift}) % {HASH_PRIME} + 1)"
        return f"{number} / {HASH_PRIME}.0::DOUBLE AS s{d}"

    norm = "sqrt(" + " + ".join(f"s{d} * s{d}" for d in range(rank)) + ")"
    steps = [
        f"""u0 AS MATERIALIZED (
  SELECT u AS id, {', '.join(f's{d} / {norm} AS f{d}' for d in range(rank))}
  FROM (SELECT u, {', '.join(map(start, range(rank)))}
        FROM (SELECT DISTINCT u FROM {source}) AS ids) AS starts)"""
    ]
    gram = ", ".join(f"sum(f{i} * f{j}) AS a{i}_{j}" for i in range(rank) for j in range(i, rank))
    right = ", ".join(f"sum(rating * f{i}) AS b{i}" for i in range(rank))

    def half_step(name: str, by: str, other: str, factors: str) -> list[str]:
        sums = f"SELECT {by} AS id, count(*) AS n, {gram}, {right} FROM {source} JOIN {factors} ON {other} = id GROUP BY 1"
        return [f"{name}s AS MATERIALIZED ({sums})", f"{name} AS MATERIALIZED ({_solution(f'{name}s', rank, config.reg)})"]

    for n in range(1, config.iterations + 1):
        steps += half_step(f"i{n}", "i", "u", f"u{n - 1}")
        steps += half_step(f"u{n}", "u", "i", f"i{n}")
    steps.append(f"uf AS (SELECT * FROM u{config.iterations})")
    steps.append(f"itf AS (SELECT * FROM i{config.iterations})")
    return steps


def _rank1() -> list[str]:
    """Item weights w and user weights p after enough rounds to settle."""
    rounds = 40
    steps = ["q0 AS MATERIALIZED (SELECT DISTINCT i AS id, CAST(1 AS DOUBLE) AS f FROM ratings)"]
    for n in range(1, rounds + 1):
        steps.append(
            f"""p{n} AS MATERIALIZED (SELECT u AS id, sum(rating * f) / (sum(f * f) + 0.01 * count(*)) AS f
  FROM ratings JOIN q{n - 1} ON i = id GROUP BY 1)"""
        )
        steps.append(
            f"""q{n} AS MATERIALIZED (SELECT i AS id, sum(rating * f) / (sum(f * f) + 0.01 * count(*)) AS f
  FROM ratings JOIN p{n} ON u = id GROUP BY 1)"""
        )
    steps.append(f"uf AS (SELECT id, f AS f0, CAST(0 AS DOUBLE) AS f1 FROM p{rounds})")
    steps.append(f"itf AS (SELECT id, f AS f0, CAST(0 AS DOUBLE) AS f1 FROM q{rounds})")
    return steps




def _product(rank: int) -> str:
    return " + ".join(f"uf.f{d} * itf.f{d}" for d in range(rank))


def _predicted(source: str, rank: int = 2) -> str:
    return f"""predicted AS (
  SELECT u, i, rating, {_product(rank)} AS prediction
  FROM {source} JOIN uf ON u = uf.id JOIN itf ON i = itf.id)"""


def _scored(rank: int) -> str:
    return f"""scored AS (
  SELECT uf.id AS u, itf.id AS i, {_product(rank)} AS score FROM uf CROSS JOIN itf)"""


SCORED = _scored(2)


def _best(unseen: bool) -> str:
    new = "WHERE NOT EXISTS (SELECT 1 FROM ratings WHERE ratings.u = scored.u AND ratings.i = scored.i)"
    return f"""best AS (
  SELECT u, i, rk FROM (
    SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rk
    FROM scored {new if unseen else ''}) AS ranked
  WHERE rk <= {K})"""


RANKED = "SELECT u AS reviewer_id, CAST(rk AS BIGINT) AS rk, i AS neighbourhood_id FROM best"


def _named(known: str = "areas") -> str:
    return f"""
SELECT uf.id AS "reviewerId", coalesce(reviewer_name, 'empty') AS "reviewerName",
       coalesce(names, '') AS "neighbourhoodNames", '{AS_OF}' AS date
FROM uf LEFT JOIN reviewers ON uf.id = reviewer_id
LEFT JOIN (
  SELECT u, string_agg(coalesce(neighbourhood, 'empty'), '|' ORDER BY rk) AS names
  FROM best LEFT JOIN {known} ON i = neighbourhood_id GROUP BY u) AS lists ON uf.id = u"""


REVIEW_RECORDS = """
SELECT listing_id, l_orderkey AS id, date, reviewer_id, reviewer_name,
       'Line "' || l_returnflag || '", first' || chr(10) || 'and ' || l_linestatus || ' second' AS comments
FROM reviews"""

MEANS = """
WITH parts AS (
  SELECT label, place, avg(CAST(x AS DOUBLE)) AS m
  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place
        FROM embeddings) AS flat
  GROUP BY 1, 2),
means AS (SELECT label, list(m ORDER BY place) AS mean FROM parts GROUP BY 1),
scored AS (
  SELECT vec_id, means.label, list_inner_product(CAST(embedding AS DOUBLE[]), mean) AS score
  FROM embeddings CROSS JOIN means),
ranked AS (
  SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rk
  FROM scored)
"""

# What evaluation returns, from the table `predicted`.
MSE = "round(avg((rating - prediction) * (rating - prediction)), 6) AS mse, count(*) AS n"


def queries() -> dict[str, str]:
    rank2 = _trained("ratings", EXACT)
    full = [*_trained("ratings", FULL), _scored(FULL.rank), _best(unseen=False)]
    rank1 = _rank1()
    split = f"split AS (SELECT u, i, rating, {BUCKET} < 80 AS fit FROM ratings)"
    fit_on = "fit_on AS MATERIALIZED (SELECT u, i, rating FROM split WHERE fit)"
    return {
        "scan_listings": _sql("SELECT id, host_id, host_name, neighbourhood FROM listings"),
        "scan_reviews": _sql("SELECT listing_id, date, reviewer_id, reviewer_name FROM reviews"),
        "area_dim": _sql("SELECT neighbourhood, neighbourhood_id FROM areas"),
        "csv_roundtrip": _sql(REVIEW_RECORDS),
        "csv_quarantine": _sql(
            "SELECT listing_id, CASE WHEN l_returnflag <> 'R' THEN id ELSE -1 END AS id, date, reviewer_id,"
            " reviewer_name, comments, l_returnflag = 'R' AS quarantined FROM ("
            + REVIEW_RECORDS.replace("AS comments", "AS comments, l_returnflag")
            + ") AS records"
        ),
        "listing_area_join": _sql("SELECT * FROM listing_area"),
        "visits": _sql("SELECT * FROM visits"),
        "unmatched_listings": _sql(
            "SELECT id, host_id, host_name, neighbourhood FROM listings WHERE neighbourhood NOT IN"
            " (SELECT neighbourhood FROM areas WHERE neighbourhood_group <> 'ASIA')"
        ),
        "unmatched_reviews": _sql(
            "SELECT listing_id, date, reviewer_id, reviewer_name FROM reviews WHERE listing_id NOT IN"
            " (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"
        ),
        "visit_counts_named": _sql(
            "SELECT reviewer_id, reviewer_name, neighbourhood_id, neighbourhood, count(*) AS count"
            " FROM visits GROUP BY 1, 2, 3, 4"
        ),
        "ratings": _sql("SELECT u AS reviewer_id, i AS neighbourhood_id, rating FROM ratings"),
        "reviewer_dim": _sql("SELECT reviewer_id, reviewer_name FROM reviewers"),
        "dense_reviewer_ids": (
            "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS id"
            " FROM (SELECT DISTINCT c_name FROM customer) AS names"
        ),
        "trainer_ids": _sql(
            'SELECT dense_rank() OVER (ORDER BY u) - 1 AS "user", i AS item, rating FROM ratings'
        ),
        "holdout_split": _sql(
            "SELECT u AS \"user\", i AS item, rating, CASE WHEN fit THEN 'train' ELSE 'test' END AS part"
            " FROM split",
            split,
        ),
        "evaluate_user_mean": _sql(
            f"SELECT {MSE} FROM (SELECT rating, avg(rating) OVER (PARTITION BY u) AS prediction"
            " FROM ratings) AS predicted"
        ),
        "als_factors": _sql(
            "SELECT 'user' AS side, id, round(f0, 4) AS f0, round(f1, 4) AS f1 FROM uf"
            " UNION ALL SELECT 'item', id, round(f0, 4), round(f1, 4) FROM itf",
            *rank2,
        ),
        "predict_pairs": _sql(
            'SELECT u AS "user", i AS item, rating, round(prediction, 4) AS prediction FROM predicted',
            *rank2,
            _predicted("ratings"),
        ),
        "evaluate_mse": _sql(
            f"SELECT 'train' AS sample, {MSE}, {EXACT.rank} AS rank, {EXACT.iterations} AS iterations,"
            f" CAST({EXACT.reg} AS DOUBLE) AS reg FROM predicted",
            *rank2,
            _predicted("ratings"),
        ),
        "evaluate_holdout": _sql(
            f"SELECT 'holdout' AS sample, {MSE} FROM predicted",
            split,
            fit_on,
            *_trained("fit_on", EXACT),
            "held AS (SELECT u, i, rating FROM split WHERE NOT fit)",
            _predicted("held"),
        ),
        "recommend_topk": _sql(RANKED, *rank2, SCORED, _best(unseen=False)),
        "recommend_unseen": _sql(RANKED, *rank2, SCORED, _best(unseen=True)),
        "recommend_in_chunks": _sql(RANKED, *rank2, SCORED, _best(unseen=True)),
        "topk_bruteforce": MEANS
        + f"SELECT vec_id, rk, CAST(label AS BIGINT) AS label FROM ranked WHERE rk <= {K}",
        "als_rank1_items": _sql(
            "SELECT id AS neighbourhood_id, row_number() OVER (ORDER BY f0 DESC, id) AS rk FROM itf", *rank1
        ),
        "recommend_rank1": _sql(RANKED, *rank1, SCORED, _best(unseen=False)),
        "recommend_novel": _sql(RANKED, *rank1, SCORED, _best(unseen=True)),
        "recommend_named": _sql(
            _named("(SELECT * FROM areas WHERE neighbourhood_group <> 'ASIA') AS known"),
            *rank1,
            SCORED,
            _best(unseen=False),
        ),
        "recommend_full": _sql(RANKED, *full),
        "publish_named": _sql(_named(), *rank2, SCORED, _best(unseen=False)),
        "publish_novel": _sql(_named(), *rank2, SCORED, _best(unseen=True)),
        "jdbc_rows": _sql(_named(), *rank2, SCORED, _best(unseen=False)),
        "publish_full": _sql(_named(), *full),
        "sink_parquet_overwrite": _sql("SELECT reviewer_id, reviewer_name FROM reviewers"),
        "preview_recommendations": _sql(
            _named() + "\nORDER BY uf.id LIMIT 10", *rank2, SCORED, _best(unseen=False)
        ),
        "metrics_table": _sql(
            f"SELECT 'train' AS sample, mse, n, {SEED} AS seed, 'sums' AS solver FROM"
            f" (SELECT {MSE} FROM predicted) AS metric, (VALUES (1), (2)) AS runs(run)",
            *rank2,
            _predicted("ratings"),
        ),
        "metrics_rerun": _sql(
            f"SELECT run_id, 'train' AS sample, mse, n FROM (SELECT {MSE} FROM predicted) AS metric,"
            " (VALUES ('first'), ('second')) AS runs(run_id)",
            *rank2,
            _predicted("ratings"),
        ),
        "predict_from_rdd_layout": _sql(
            'SELECT u AS "user", i AS item, rating, round(prediction, 4) AS prediction FROM predicted',
            *rank2,
            _predicted("ratings"),
        ),
        "route_reviews": _sql(
            "SELECT listing_id, date, person AS reviewer_id,"
            " CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS BIGINT) END AS neighbourhood_id,"
            " CASE WHEN person IS NULL THEN 'null_key' WHEN s_acctbal >= 0 THEN 'used' ELSE 'unmatched' END AS route"
            " FROM (SELECT *, CASE WHEN l_linestatus <> 'F' OR l_orderkey % 5 <> 0 THEN reviewer_id END AS person"
            " FROM reviews) AS told JOIN supplier ON listing_id = s_suppkey"
        ),
        # Invariants: SQL states what must hold for whom; it doesn't refit.
        "als_normal_equations": _sql(
            "SELECT u AS reviewer_id, TRUE AS ok FROM (SELECT DISTINCT u FROM ratings) AS rated"
        ),
        "model_roundtrip": _sql(
            "SELECT 'user' AS side, u AS id, TRUE AS ok FROM (SELECT DISTINCT u FROM ratings) AS rated"
            " UNION ALL SELECT 'item', i, TRUE FROM (SELECT DISTINCT i FROM ratings) AS visited"
        ),
        "evaluate_full": _sql(
            f"SELECT 'train' AS sample, {MSE}, {FULL.rank} AS rank, {FULL.iterations} AS iterations FROM predicted",
            *_trained("ratings", FULL),
            _predicted("ratings", FULL.rank),
        ),
        "csv_listings": (
            "SELECT s_suppkey AS id, s_name AS host_name, n_name AS neighbourhood, s_acctbal < 0 AS in_debt,"
            " 'Flat \"' || s_name || '\",' || chr(10) || 'second line' AS name"
            " FROM supplier JOIN nation ON s_nationkey = n_nationkey"
        ),
        "csv_areas": (
            "SELECT n_name AS neighbourhood, r_name AS neighbourhood_group"
            " FROM nation JOIN region ON n_regionkey = r_regionkey"
        ),
        "record_balance": _sql(
            """
SELECT 'reviews' AS input, count(*) AS read, count(*) FILTER (good AND person AND known) AS used,
       count(*) FILTER (NOT good) AS malformed, count(*) FILTER (good AND NOT person) AS null_key,
       count(*) FILTER (good AND person AND NOT known) AS unmatched
FROM (SELECT l_returnflag <> 'R' AS good, l_linestatus <> 'F' OR l_orderkey % 5 <> 0 AS person,
             coalesce(listing_id IN (SELECT id FROM listings WHERE s_acctbal >= 0 AND neighbourhood IN
                 (SELECT neighbourhood FROM areas WHERE neighbourhood_group <> 'ASIA')), FALSE) AS known
      FROM reviews) AS r
UNION ALL
SELECT 'listings', count(*), count(*) FILTER (s_acctbal >= 0 AND inside), 0, count(*) FILTER (s_acctbal < 0),
       count(*) FILTER (s_acctbal >= 0 AND NOT inside)
FROM (SELECT s_acctbal, neighbourhood IN (SELECT neighbourhood FROM areas WHERE neighbourhood_group <> 'ASIA') AS inside
      FROM listings) AS l
UNION ALL
SELECT 'areas', count(*), count(*) FILTER (neighbourhood_group <> 'ASIA'), 0,
       count(*) FILTER (neighbourhood_group = 'ASIA'), 0
FROM areas"""
        ),
        "run_date_today": "SELECT DISTINCT CAST(current_date AS VARCHAR) AS date, count(*) AS n FROM nation",
    }
