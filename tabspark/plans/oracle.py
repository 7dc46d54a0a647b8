"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code paths: plain SQL over the driver's
pre-registered views, using window functions where the Spark side uses the
scalable two-level forms.
"""

from __future__ import annotations

from decimal import Decimal

from tabspark.contract import CENSUS, CENSUS_NUMERIC_FEATURES, TrainingConfig
from tabspark.sources import fixtures as fx

C = CENSUS
CFG = TrainingConfig()
SEED = CFG.random_seed

NUM_COLS = [n for n, _ in C.columns if n != C.code_column]
ALL_RAW = [n for n, _ in C.columns] + ["k"]


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def raw_cte() -> str:
    return f"raw AS ({fx.ACS_RAW_SQL})"


def norm_cte() -> str:
    sel = []
    for n, t in C.columns:
        if n == C.code_column:
            sel.append(f"upper(regexp_replace(CAST({n} AS VARCHAR), '^\\s+|\\s+$', '', 'g')) AS {n}")
        else:
            sel.append(f"TRY_CAST({n} AS {t.upper()}) AS {n}")
    sel.append("k")
    return f"norm AS (SELECT {', '.join(sel)} FROM raw)"


def reason_sql() -> str:
    nulls = " OR ".join(f"{n} IS NULL" for n in C.required)
    parts = [f"WHEN {nulls} THEN 'null'",
             f"WHEN NOT regexp_matches({C.code_column}, '{C.code_pattern}') THEN 'invalid_state'"]
    for r in C.ranges:
        parts.append(f"WHEN {r.column} < {r.low} OR {r.column} > {r.high} THEN '{r.reason}'")
    return "CASE " + " ".join(parts) + " END"


def tagged_cte() -> str:
    return f"tag AS (SELECT *, {reason_sql()} AS reason FROM norm)"


def clean_cte() -> str:
    cols = ", ".join(ALL_RAW)
    return f"clean AS (SELECT DISTINCT {cols} FROM tag WHERE reason IS NULL)"


def with_clean(body: str, extra_ctes: list[str] | None = None) -> str:
    ctes = [raw_cte(), norm_cte(), tagged_cte(), clean_cte()] + (extra_ctes or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


def clean_waterfall() -> str:
    steps = ["null", "invalid_state"] + [r.reason for r in C.ranges]
    parts = [f"SELECT {i} AS step, '{s}' AS reason, (SELECT count(*) FROM tag WHERE reason = '{s}') AS rows"
             for i, s in enumerate(steps)]
    n = len(steps)
    parts.append(f"SELECT {n} AS step, 'duplicate' AS reason, "
                 "(SELECT count(*) FROM tag WHERE reason IS NULL) - (SELECT count(*) FROM clean) AS rows")
    parts.append(f"SELECT {n + 1} AS step, 'kept' AS reason, (SELECT count(*) FROM clean) AS rows")
    return with_clean(" UNION ALL ".join(parts))


def clean_rows() -> str:
    cols = ", ".join(f"CAST({n} AS {t.upper()}) AS {n}" for n, t in C.columns)
    return with_clean(f"SELECT {cols}, k FROM clean")


def clean_store() -> str:
    return clean_rows()


def head_batch() -> str:
    return f"WITH {raw_cte()} SELECT {', '.join(ALL_RAW)} FROM raw ORDER BY k LIMIT 1000"


def column_profile() -> str:
    types = {"STATE": "string", "YEAR": "bigint", "WKHP": "string", "SEX": None}
    columns = [(n, "required", types.get(n, "double"), {"WKHP": "type", "SEX": "missing"}.get(n), n) for n, _ in C.columns]
    columns += [(n, "optional", None, None, None) for n in C.optional_columns]
    columns += [("k", "passthrough", "bigint", None, "k"), ("note", "extra", "bigint", "extra", "nullif(k % 5, 0)")]
    text = lambda x: f"'{x}'" if x else "CAST(NULL AS VARCHAR)"
    parts = [f"SELECT {i} AS position, '{n}' AS column_name, '{kind}' AS declared, {text(t)} AS type, "
             f"{f'(SELECT count({of}) FROM raw)' if t else 'CAST(0 AS BIGINT)'} AS non_null_rows, {text(problem)} AS problem"
             for i, (n, kind, t, problem, of) in enumerate(columns)]
    return f"WITH {raw_cte()} " + " UNION ALL ".join(parts)


def null_profile() -> str:
    parts = []
    for i, c in enumerate(C.required):
        lim = C.max_null_rate[c]
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) END AS null_rate, "
            f"{_dbl(lim)} AS max_null_rate FROM raw")
    body = " UNION ALL ".join(parts)
    return (f"WITH {raw_cte()}, p AS ({body}) SELECT position, column_name, null_count, null_rate, max_null_rate, "
            "CASE WHEN null_rate > max_null_rate THEN 'fatal' WHEN null_rate > 0 THEN 'warn' ELSE 'ok' END AS status FROM p")


def duplicate_rate() -> str:
    return (f"WITH {raw_cte()}, s AS (SELECT (SELECT count(*) FROM raw) AS row_count, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS distinct_rows) "
            "SELECT row_count, distinct_rows, row_count - distinct_rows AS duplicate_rows, "
            "CASE WHEN row_count = 0 THEN 0.0 ELSE CAST(row_count - distinct_rows AS DOUBLE) / row_count END AS duplicate_rate, "
            f"CASE WHEN row_count > 0 AND CAST(row_count - distinct_rows AS DOUBLE) / row_count > {_dbl(C.max_duplicate_rate)} THEN 'fatal' "
            "WHEN row_count - distinct_rows > 0 THEN 'warn' ELSE 'ok' END AS status FROM s")


def pattern_range_violations() -> str:
    code = f"upper(regexp_replace(CAST({C.code_column} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    rules = [("invalid_state_rows", f"NOT regexp_matches({code}, '{C.code_pattern}')", C.max_invalid_code_rate)]
    for c in C.warning_order:
        r = C.range_rule(c)
        v = f"TRY_CAST({c} AS {r.cast.upper()})"
        rules.append((r.warning, f"{v} < {r.low} OR {v} > {r.high}", None))
    parts = []
    for name, cond, lim in rules:
        lim_sql = _dbl(lim) if lim is not None else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {cond}) AS rows, count(*) AS n, {lim_sql} AS lim FROM raw")
    return (f"WITH {raw_cte()}, r AS ({' UNION ALL '.join(parts)}) "
            "SELECT rule, rows, CASE WHEN n = 0 THEN 0.0 ELSE CAST(rows AS DOUBLE) / n END AS rate, "
            "CASE WHEN lim IS NOT NULL AND n > 0 AND CAST(rows AS DOUBLE) / n > lim THEN 'fatal' "
            "WHEN rows > 0 THEN 'warn' ELSE 'ok' END AS status FROM r")


def class_counts() -> str:
    t = CFG.target_income_threshold
    return (f"WITH {raw_cte()} SELECT count(*) FILTER (WHERE TRY_CAST(PINCP AS DOUBLE) >= {t}) AS at_or_above, "
            f"count(*) FILTER (WHERE TRY_CAST(PINCP AS DOUBLE) < {t}) AS below, "
            f"count(*) FILTER (WHERE TRY_CAST(PINCP AS DOUBLE) >= {t}) > 0 AND "
            f"count(*) FILTER (WHERE TRY_CAST(PINCP AS DOUBLE) < {t}) > 0 AS both_present FROM raw")


# ----------------------------------------------------------------------------
# labelling, split, features, evaluation
# ----------------------------------------------------------------------------
SCORE_SQL = "CAST((k * 7919) % 1000 AS DOUBLE) / 1000"


def split_ctes() -> list[str]:
    t = CFG.target_income_threshold
    f = CFG.fractions
    parts = ", ".join(f"({i}, '{n}', {x!r})" for i, (n, x) in enumerate(zip(("train", "validation", "test"), f)))
    return [
        f"lab AS (SELECT *, CAST(CASE WHEN TRY_CAST(PINCP AS DOUBLE) >= {t} THEN 1 ELSE 0 END AS BIGINT) AS TARGET FROM clean)",
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY md5(concat_ws('|', '{SEED}', CAST(k AS VARCHAR)))) - 1 AS rk FROM lab)",
        "classes AS (SELECT TARGET, count(*) AS n FROM lab GROUP BY TARGET)",
        f"parts AS (SELECT * FROM (VALUES {parts}) p(i, name, f))",
        "alloc AS (SELECT c.TARGET, p.i, p.name, c.n, floor(CAST(p.f AS DOUBLE) * c.n) AS fl, "
        "CAST(p.f AS DOUBLE) * c.n - floor(CAST(p.f AS DOUBLE) * c.n) AS rm "
        "FROM (SELECT TARGET, n, unnest(range(3)) AS i FROM classes) c JOIN parts p ON p.i = c.i)",
        "alloc2 AS (SELECT *, n - sum(fl) OVER (PARTITION BY TARGET) AS rem, "
        "row_number() OVER (PARTITION BY TARGET ORDER BY rm DESC, i) - 1 AS pos FROM alloc)",
        "cnt AS (SELECT TARGET, i, name, fl + CASE WHEN pos < rem THEN 1 ELSE 0 END AS c FROM alloc2)",
        "cuts AS (SELECT TARGET, name, sum(c) OVER (PARTITION BY TARGET ORDER BY i) - c AS lo, "
        "sum(c) OVER (PARTITION BY TARGET ORDER BY i) AS hi FROM cnt)",
        "splitted AS (SELECT r.* EXCLUDE (rk), cuts.name AS split FROM ranked r JOIN cuts "
        "ON r.TARGET = cuts.TARGET AND r.rk >= cuts.lo AND r.rk < cuts.hi)",
        f"scored AS (SELECT split, TARGET, k, {SCORE_SQL} AS score FROM splitted)",
    ]


def with_split(body: str, extra: list[str] | None = None) -> str:
    return with_clean(body, split_ctes() + (extra or []))


def label() -> str:
    return with_split("SELECT * FROM lab")


def split_sizes() -> str:
    return with_split("SELECT split, TARGET, count(*) AS rows FROM splitted GROUP BY split, TARGET")


def split_members() -> str:
    return with_split("SELECT k, TARGET, split FROM splitted")


def subset_members() -> str:
    return with_split("SELECT k, TARGET FROM lab WHERE k IN (SELECT o_orderkey FROM orders WHERE o_totalprice >= 200000)")


def target_report() -> str:
    return with_split(
        "SELECT *, CASE WHEN class_null > 0 THEN 'null target' WHEN class_other > 0 THEN 'target not binary' "
        "WHEN class_0 = 0 OR class_1 = 0 THEN 'one class only' END AS problem FROM (SELECT frame, count(*) AS rows, "
        "count(*) FILTER (WHERE y = 0) AS class_0, count(*) FILTER (WHERE y = 1) AS class_1, count(*) FILTER (WHERE y IS NULL) AS class_null, "
        "count(*) FILTER (WHERE y NOT IN (0, 1)) AS class_other FROM (SELECT k % 4 AS frame, CASE WHEN k % 4 = 1 AND k % 7 = 0 THEN NULL "
        "WHEN k % 4 = 2 AND k % 7 = 0 THEN 2 WHEN k % 4 = 3 THEN 1 ELSE TARGET END AS y FROM lab) GROUP BY frame)")


VOCAB_CTE = ("vocab AS (SELECT STATE, CAST(row_number() OVER (ORDER BY STATE) - 1 AS INTEGER) AS idx "
             "FROM (SELECT DISTINCT STATE FROM splitted WHERE split = 'train' AND STATE IS NOT NULL))")


def vocabulary() -> str:
    return with_split("SELECT STATE, idx AS index FROM vocab", [VOCAB_CTE])


def one_hot() -> str:
    parts = [f"SELECT k, split, {i} AS feature_index, '{c}' AS feature, CAST(TRY_CAST({c} AS DOUBLE) AS FLOAT) AS value FROM splitted"
             for i, c in enumerate(CENSUS_NUMERIC_FEATURES)]
    n = len(CENSUS_NUMERIC_FEATURES)
    parts.append(f"SELECT s.k, s.split, CAST({n} + v.idx AS INTEGER) AS feature_index, concat('STATE__', v.STATE) AS feature, "
                 "CAST(CASE WHEN s.STATE = v.STATE THEN 1.0 ELSE 0.0 END AS FLOAT) AS value "
                 "FROM (SELECT k, split, STATE, unnest(range(CAST((SELECT count(*) FROM vocab) AS BIGINT))) AS j FROM splitted) s "
                 "JOIN vocab v ON v.idx = s.j")
    return with_split(" UNION ALL ".join(parts), [VOCAB_CTE])


def sparse_vectors() -> str:
    numeric = " UNION ALL ".join(f"SELECT k, split, {i} AS feature_index, CAST(CAST({c} AS FLOAT) AS DOUBLE) AS value FROM splitted" for i, c in enumerate(CENSUS_NUMERIC_FEATURES))
    return with_split(f"SELECT * FROM ({numeric} UNION ALL SELECT k, split, CAST({len(CENSUS_NUMERIC_FEATURES)} + idx AS INTEGER), CAST(1.0 AS DOUBLE) "
                      "FROM splitted JOIN vocab USING (STATE)) WHERE value <> 0", [VOCAB_CTE])


def ensemble_scores() -> str:
    lit = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)
    rows = ", ".join(f"({', '.join(map(lit, r))})" for r in fx.FIXED_TREES)
    numeric = " ".join(f"WHEN '{c}' THEN CAST(CAST({c} AS FLOAT) AS DOUBLE)" for c in CENSUS_NUMERIC_FEATURES)
    value = f"CASE n.feature {numeric} ELSE CASE WHEN concat('STATE__', s.STATE) = n.feature THEN 1.0 ELSE 0.0 END END"
    step = ("SELECT a.k, a.tree, CASE WHEN n.feature IS NULL THEN a.node "
            f"WHEN {value} <= n.threshold THEN n.lo ELSE n.hi END AS node "
            "FROM {} a JOIN nodes n ON a.tree = n.tree AND a.node = n.node JOIN splitted s ON s.k = a.k")
    return with_split(
        "SELECT k, split, CAST(margin AS DOUBLE) AS margin, CAST(margin AS DOUBLE) AS joined_margin, "
        "round(1 / (1 + exp(-CAST(margin AS DOUBLE))), 9) AS score, "
        f"CAST(CASE WHEN 1 / (1 + exp(-CAST(margin AS DOUBLE))) >= {CFG.threshold} THEN 1 ELSE 0 END AS BIGINT) AS prediction, "
        "'fixed-1' AS model_version FROM total JOIN splitted USING (k)",
        [f"nodes AS (SELECT * FROM (VALUES {rows}) v(tree, node, feature, threshold, lo, hi, value))",
         "at0 AS (SELECT k, tree, 0 AS node FROM splitted, (SELECT DISTINCT tree FROM nodes) t)",
         f"at1 AS ({step.format('at0')})", f"at2 AS ({step.format('at1')})", f"at3 AS ({step.format('at2')})",
         "total AS (SELECT k, sum(CAST(value AS DECIMAL(30,15))) AS margin FROM at3 JOIN nodes USING (tree, node) GROUP BY k)"])


def table_digest() -> str:
    cols = ("doc_id", "text", "lang", "source", "n_chars")
    parts = ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END" for c in cols)
    words = ", ".join(f"CAST(coalesce(sum(CAST(concat('0x', substr(h, {1 + 8 * k}, 8)) AS BIGINT)), 0) AS VARCHAR)" for k in range(8))
    return (f"WITH hashed AS (SELECT sha256(concat_ws(',', {parts})) AS h FROM documents) "
            f"SELECT count(*) AS rows, sha256(concat_ws(',', CAST(count(*) AS VARCHAR), {words})) AS sha256 FROM hashed")


CONFUSION_CTE = (
    "conf AS (SELECT split, count(*) FILTER (WHERE TARGET = 0 AND NOT score >= 0.5) AS tn, "
    "count(*) FILTER (WHERE TARGET = 0 AND score >= 0.5) AS fp, "
    "count(*) FILTER (WHERE TARGET = 1 AND NOT score >= 0.5) AS fn, "
    "count(*) FILTER (WHERE TARGET = 1 AND score >= 0.5) AS tp, count(*) AS row_count FROM scored GROUP BY split)")
CONF_SELECT = (
    "split, tn, fp, fn, tp, row_count, "
    "CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision, "
    "CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall, "
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1, "
    "CASE WHEN row_count = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / row_count END AS accuracy")
RANK_CTES = [
    "sc AS (SELECT split, score, sum(TARGET) AS np, count(*) - sum(TARGET) AS nn FROM scored GROUP BY split, score)",
    "cum AS (SELECT *, sum(np) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tpc, "
    "sum(nn) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fpc, "
    "sum(np) OVER (PARTITION BY split) AS totp, sum(nn) OVER (PARTITION BY split) AS totn FROM sc)",
    "rnk AS (SELECT split, CASE WHEN totp > 0 AND totn > 0 THEN CAST(sum(nn * (2 * (tpc - np) + np)) AS DOUBLE) / "
    "(CAST(2 AS DOUBLE) * totp * totn) ELSE 0.5 END AS roc_auc, "
    "CASE WHEN totp > 0 AND totn > 0 THEN CAST(sum(CAST(np AS HUGEINT) * ((CAST(tpc AS HUGEINT) * 1000000000000000) // (tpc + fpc))) // totp AS DOUBLE) / 1e15 "
    "ELSE CAST(totp AS DOUBLE) / (totp + totn) END AS average_precision FROM cum GROUP BY split, totp, totn)",
]


def confusion_metrics() -> str:
    return with_split(f"SELECT {CONF_SELECT} FROM conf", [CONFUSION_CTE])


def roc_auc_ap() -> str:
    return with_split("SELECT split, roc_auc, average_precision FROM rnk", RANK_CTES)


METRIC_NAMES = ("roc_auc", "average_precision", "f1", "precision", "recall", "accuracy",
                "tn", "fp", "fn", "tp", "row_count")


def metrics_long() -> str:
    ctes = [CONFUSION_CTE, f"conf2 AS (SELECT {CONF_SELECT} FROM conf)", *RANK_CTES,
            "allm AS (SELECT c.*, r.roc_auc, r.average_precision FROM conf2 c JOIN rnk r ON c.split = r.split)"]
    parts = [f"SELECT concat(split, '_{m}') AS metric, CAST({m} AS DOUBLE) AS value FROM allm" for m in METRIC_NAMES]
    return with_split(" UNION ALL ".join(parts), ctes)


def gate_decision() -> str:
    g = CFG
    ctes = [CONFUSION_CTE, f"conf2 AS (SELECT {CONF_SELECT} FROM conf)", *RANK_CTES,
            "allm AS (SELECT c.*, r.roc_auc, r.average_precision FROM conf2 c JOIN rnk r ON c.split = r.split)",
            f"req AS ({fx.telemetry_sql('requests')})",
            f"pq AS ({pct_sql('SELECT * FROM req', [], 'DurationMs', {'p95': 0.95})})",
            "perf AS (SELECT pq.p95, (SELECT count(*) / (sum(DurationMs) / 1000.0) FROM req) AS tput FROM pq)",
            f"q AS (SELECT a.split, a.roc_auc >= {g.min_auc} AND a.f1 >= {g.min_f1} AND a.precision >= {g.min_precision} "
            f"AND a.recall >= {g.min_recall} AS quality_passed, "
            f"coalesce((SELECT p95 FROM perf) <= {g.max_p95_latency_ms} "
            f"AND (SELECT tput FROM perf) >= {g.min_throughput_rows_per_sec}, false) AS performance_passed FROM allm a)"]
    return with_split(
        "SELECT split, quality_passed, performance_passed, quality_passed AND performance_passed AS register, "
        "CASE WHEN NOT quality_passed THEN 'quality_thresholds_not_met' "
        "WHEN NOT performance_passed THEN 'performance_thresholds_not_met' ELSE NULL END AS skip_reason FROM q", ctes)


def latency_percentiles() -> str:
    req = fx.telemetry_sql("requests")
    pct = pct_sql(req, ["Name"], "DurationMs",
                  {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99})
    return (f"WITH req AS ({req}), t AS (SELECT Name, count(*) AS runs, "
            f"count(*) / ({_exact_sum('DurationMs')} / CAST(1000.0 AS DOUBLE)) AS throughput_rows_per_sec FROM req GROUP BY Name), "
            f"p AS ({pct}) SELECT t.Name, runs, throughput_rows_per_sec, p50_latency_ms, p95_latency_ms, p99_latency_ms "
            "FROM t LEFT JOIN p ON t.Name = p.Name")


def score_parity() -> str:
    return with_split(
        "SELECT count(a.k) AS rows_a, count(b.k) AS rows_b, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS matched, "
        "count(*) FILTER (WHERE a.k IS NULL) AS missing_in_a, count(*) FILTER (WHERE b.k IS NULL) AS missing_in_b, "
        "count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL AND (isnan(a.p) OR isinf(a.p) OR isnan(b.p) OR isinf(b.p))) AS nonfinite, "
        "max(abs(a.p - b.p)) AS max_abs_diff, "
        "count(*) FILTER (WHERE a.k IS NULL OR b.k IS NULL) = 0 AND coalesce(max(abs(a.p - b.p)), 0) <= 0.001 "
        "AND count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL AND (isnan(a.p) OR isinf(a.p) OR isnan(b.p) OR isinf(b.p))) = 0 AS passed "
        "FROM (SELECT k, score AS p FROM scored) a FULL OUTER JOIN "
        "(SELECT k, CAST(CAST(score AS FLOAT) AS DOUBLE) AS p FROM scored) b ON a.k = b.k")


# ----------------------------------------------------------------------------
# exact fixed-point mean / percentile twins (integer arithmetic in DuckDB)
# ----------------------------------------------------------------------------
def _half_up(num: str, den: str) -> str:
    return (f"(CASE WHEN ({num}) >= 0 THEN (2 * ({num}) + ({den})) // (2 * ({den})) "
            f"ELSE -((-2 * ({num}) + ({den})) // (2 * ({den}))) END)")


def _units(v: str) -> str:
    return f"CAST(round(CAST({v} AS DOUBLE) * 1000000000) AS HUGEINT)"


def mean_sql(v: str, decimals: int = 9) -> str:
    """Aggregate expression equal to ``exact_mean(v, decimals)``."""
    d = 10 ** (9 - decimals)
    s = f"sum({_units(v)})"
    n = f"count({v})"
    return f"CAST({_half_up(s, f'{n} * {d}')} AS DOUBLE) / {10 ** decimals}"


def pct_sql(src: str, by: list[str], v: str, ps: dict[str, float], decimals: int = 9) -> str:
    """SELECT equal to ``exact_percentiles(src, by, v, ps, decimals=...)``."""
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    ranked = (f"SELECT {''.join(b + ', ' for b in by)}{v} AS _v, row_number() OVER ({part}ORDER BY {v}) - 1 AS _rn, "
              f"count(*) OVER ({part.strip()}) AS _n FROM ({src}) _s WHERE {v} IS NOT NULL")
    cols = []
    for name, p in ps.items():
        dp = Decimal(repr(float(p))).normalize()
        digits = max(0, -dp.as_tuple().exponent)
        den = 10 ** digits
        pint = int(dp * den)
        lo_r = f"(((_n - 1) * {pint}) // {den})"
        fr = f"(((_n - 1) * {pint}) % {den})"
        lo = f"max(CASE WHEN _rn = {lo_r} THEN _v END)"
        hi = f"max(CASE WHEN _rn = {lo_r} + CASE WHEN {fr} > 0 THEN 1 ELSE 0 END THEN _v END)"
        frm = f"max({fr})"
        val = f"({_units(lo)} * {den} + ({_units(hi)} - {_units(lo)}) * {frm})"
        divisor = den * 10 ** (9 - decimals)
        cols.append(f"CAST({_half_up(val, str(divisor))} AS DOUBLE) / {10 ** decimals} AS {name}")
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {''.join(b + ', ' for b in by)}{', '.join(cols)} FROM ({ranked}) _r{grp}"


# ----------------------------------------------------------------------------
# telemetry
# ----------------------------------------------------------------------------
AS_OF = fx.AS_OF


def _recent(name: str, lookback: str = fx.LOOKBACK) -> str:
    return (f"SELECT * FROM ({fx.telemetry_sql(name)}) "
            f"WHERE TimeGenerated > TIMESTAMP '{AS_OF}' - INTERVAL '{lookback}'")


def _bin(width: str = "1 hour") -> str:
    return f"time_bucket(INTERVAL '{width}', TimeGenerated)"


def request_health() -> str:
    pct = pct_sql("SELECT * FROM b", ["_bin"], "DurationMs", {"P95DurationMs": 0.95}, 2)
    return (f"WITH req AS ({_recent('requests')}), b AS (SELECT *, {_bin()} AS _bin FROM req), "
            "agg AS (SELECT _bin, count(*) AS TotalRequests, count(*) FILTER (WHERE Success = false) AS FailedRequests, "
            f"{mean_sql('DurationMs', 2)} AS AvgDurationMs FROM b GROUP BY _bin), p AS ({pct}) "
            "SELECT agg._bin AS TimeGenerated, TotalRequests, FailedRequests, AvgDurationMs, P95DurationMs "
            "FROM agg LEFT JOIN p ON agg._bin = p._bin")


def failed_requests() -> str:
    return (f"SELECT {_bin()} AS TimeGenerated, count(*) AS FailedRequests FROM ({_recent('requests')}) "
            "WHERE Success = false GROUP BY 1")


def slow_requests() -> str:
    src = f"SELECT *, {_bin()} AS _bin FROM ({_recent('requests')}) WHERE Success = true"
    return f"SELECT _bin AS TimeGenerated, P95DurationMs FROM ({pct_sql(src, ['_bin'], 'DurationMs', {'P95DurationMs': 0.95})})"


def _correlated(failed_only: bool) -> str:
    where = "WHERE Success = false" if failed_only else ""
    succ = "" if failed_only else "l.Success, "
    dp = pct_sql("SELECT * FROM deps", ["OperationId"], "DurationMs", {"P95DependencyMs": 0.95})
    return (
        f"WITH req AS (SELECT * FROM ({_recent('requests')}) {where}), "
        "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY OperationId "
        "ORDER BY TimeGenerated DESC, event_id DESC) AS rn FROM req) WHERE rn = 1), "
        f"deps AS ({_recent('dependencies')}), "
        "dr AS (SELECT OperationId, count(*) AS DependencyCount, count(*) FILTER (WHERE Success = false) "
        f"AS FailedDependencies FROM deps GROUP BY OperationId), dp AS ({dp}), "
        f"tr AS (SELECT OperationId, count(*) AS TraceCount, count(*) FILTER (WHERE SeverityLevel >= 3) "
        f"AS ErrorTraceCount FROM ({_recent('traces')}) GROUP BY OperationId), "
        f"ex AS (SELECT OperationId, count(*) AS ExceptionCount FROM ({_recent('exceptions')}) GROUP BY OperationId) "
        f"SELECT l.TimeGenerated AS RequestTime, l.OperationId, l.Name AS RequestName, {succ}l.DurationMs, "
        "l.ResultCode, l.Url, l.AppRoleName, l.AppRoleInstance, l.OperationName, "
        "coalesce(dr.DependencyCount, 0) AS DependencyCount, coalesce(dr.FailedDependencies, 0) AS FailedDependencies, "
        "dp.P95DependencyMs, coalesce(tr.TraceCount, 0) AS TraceCount, coalesce(tr.ErrorTraceCount, 0) AS ErrorTraceCount, "
        "coalesce(ex.ExceptionCount, 0) AS ExceptionCount FROM latest l "
        "LEFT JOIN dr ON l.OperationId = dr.OperationId LEFT JOIN dp ON l.OperationId = dp.OperationId "
        "LEFT JOIN tr ON l.OperationId = tr.OperationId LEFT JOIN ex ON l.OperationId = ex.OperationId")


def correlated_ops() -> str:
    return _correlated(False)


def failed_drilldown() -> str:
    return _correlated(True)


def exceptions_hourly() -> str:
    return f"SELECT {_bin()} AS TimeGenerated, count(*) AS Exceptions FROM ({_recent('exceptions')}) GROUP BY 1"


def error_traces() -> str:
    return (f"SELECT {_bin()} AS TimeGenerated, count(*) AS ErrorTraces FROM ({_recent('traces')}) "
            "WHERE SeverityLevel >= 3 GROUP BY 1")


def custom_metrics() -> str:
    names = ", ".join(f"'{n}'" for n in ("prediction_latency_ms", "prediction_count", "validation_failures"))
    src = (f"SELECT Name, {_bin()} AS _bin, TRY_CAST(Value AS DOUBLE) AS _val FROM ({_recent('metrics')}) "
           f"WHERE Name IN ({names})")
    pct = pct_sql("SELECT * FROM m", ["Name", "_bin"], "_val", {"P95Value": 0.95})
    return (f"WITH m AS ({src}), agg AS (SELECT Name, _bin, {mean_sql('_val')} AS AvgValue FROM m GROUP BY Name, _bin), "
            f"p AS ({pct}) SELECT agg.Name, agg._bin AS TimeGenerated, AvgValue, P95Value FROM agg "
            "LEFT JOIN p ON agg.Name = p.Name AND agg._bin = p._bin")


def _exact_sum(v: str) -> str:
    return f"CAST(sum({_units(v)}) AS DOUBLE) / 1000000000"


def alerts_15m() -> str:
    w = _bin("15 minutes")
    req = f"SELECT *, {w} AS window_start FROM ({fx.telemetry_sql('requests')})"
    p95 = pct_sql(req, ["window_start"], "DurationMs", {"v": 0.95})
    parts = [
        f"SELECT 'app_request_failures' AS alert, window_start, CAST(count(*) FILTER (WHERE Success = false) AS DOUBLE) AS value FROM ({req}) GROUP BY window_start",
        f"SELECT 'app_slow_requests' AS alert, window_start, v AS value FROM ({p95})",
        f"SELECT 'app_exceptions' AS alert, {w} AS window_start, CAST(count(*) AS DOUBLE) AS value FROM ({fx.telemetry_sql('exceptions')}) GROUP BY 2",
        f"SELECT 'app_validation_failures' AS alert, {w} AS window_start, {_exact_sum('TRY_CAST(Value AS DOUBLE)')} AS value "
        f"FROM ({fx.telemetry_sql('metrics')}) WHERE Name = 'validation_failures' GROUP BY 2",
    ]
    return ("SELECT alert, window_start, value, true AS fired FROM (" + " UNION ALL ".join(parts) + ") "
            "WHERE CASE WHEN alert = 'app_slow_requests' THEN value > 200 ELSE value > 0 END")


def alerts_append() -> str:
    """Per rule: rows are dropped whose window had ended by the watermark that the micro-batch before theirs
    ran with, so that of the slices before that one; windows that the last watermark has passed are written.
    Watermarks are whole milliseconds."""
    w = _bin("15 minutes")
    log2 = "CAST(floor(log2(DurationMs) * 4096) AS BIGINT)"
    parts = []
    for rule, view, where, value in (
            ("app_request_failures", "requests", "true", "CAST(count(*) FILTER (WHERE Success = false) AS DOUBLE)"),
            ("app_slow_requests", "requests", "true", "round(pow(2.0, (quantile_disc(b, 0.95) + 1) / 4096.0), 6)"),
            ("app_exceptions", "exceptions", "true", "CAST(count(*) AS DOUBLE)"),
            ("app_validation_failures", "metrics", "Name = 'validation_failures'", _exact_sum("TRY_CAST(Value AS DOUBLE)"))):
        bucket = f"{log2} AS b" if view == "requests" else "0 AS b"
        limit = "200" if rule == "app_slow_requests" else "0"
        parts.append(
            f"SELECT alert, window_start, value FROM (WITH v AS (SELECT *, {w} AS window_start, {bucket} FROM ({fx.telemetry_sql(view)}) WHERE {where}), "
            f"r AS (SELECT v.*, s.slice FROM v JOIN slices s USING (event_id)), "
            "m AS (SELECT i AS slice, date_trunc('millisecond', max(TimeGenerated)) - INTERVAL 15 MINUTE AS mark FROM r, range(3) t(i) WHERE r.slice <= i GROUP BY i), "
            "kept AS (SELECT r.* FROM r LEFT JOIN m ON m.slice = r.slice - 2 WHERE m.mark IS NULL OR r.window_start + INTERVAL 15 MINUTE > m.mark) "
            f"SELECT '{rule}' AS alert, window_start, {value} AS value FROM kept "
            "WHERE window_start + INTERVAL 15 MINUTE <= (SELECT max(mark) FROM m) GROUP BY window_start) "
            f"WHERE value > {limit}")
    return (f"WITH slices AS (SELECT event_id, {fx.ARRIVAL_SLICE.replace('AS INT)', 'AS INTEGER)')} AS slice FROM events) "
            "SELECT alert, window_start, value, true AS fired FROM (" + " UNION ALL ".join(parts) + ")")


def trace_search() -> str:
    return (f"SELECT TimeGenerated, Message FROM ({_recent('traces')}) "
            "WHERE contains(lower(Message), 'blob trigger') OR contains(lower(Message), 'aca job') "
            "ORDER BY TimeGenerated DESC, event_id DESC LIMIT 10")


def run_log() -> str:
    return (f"SELECT TimeGenerated, Log_s FROM ({fx.derived_sql('container_logs')}) "
            "WHERE starts_with(lower(ContainerGroupName_s), 'job-exec-1') ORDER BY TimeGenerated, event_id LIMIT 200")


def cohort_gate() -> str:
    req = f"SELECT * FROM ({fx.telemetry_sql('requests')}) WHERE Revision IN ('baseline', 'candidate')"
    p = pct_sql(req, ["Revision"], "DurationMs", {"p95": 0.95})
    return (
        f"WITH s AS (SELECT Revision, count(*) AS n, count(*) FILTER (WHERE Success = false) AS f FROM ({req}) GROUP BY Revision), "
        f"p AS ({p}), per AS (SELECT s.Revision, CAST(f AS DOUBLE) / n AS err, p.p95 FROM s LEFT JOIN p ON s.Revision = p.Revision), "
        "r AS (SELECT max(CASE WHEN Revision = 'baseline' THEN p95 END) AS baseline_p95_ms, "
        "max(CASE WHEN Revision = 'baseline' THEN err END) AS baseline_error_rate, "
        "max(CASE WHEN Revision = 'candidate' THEN p95 END) AS candidate_p95_ms, "
        "max(CASE WHEN Revision = 'candidate' THEN err END) AS candidate_error_rate FROM per), "
        "r2 AS (SELECT *, greatest(baseline_p95_ms * 1.5, 200.0) AS p95_limit_ms, "
        "greatest(baseline_error_rate * 2.0, 0.01) AS error_rate_limit FROM r), "
        "r3 AS (SELECT *, CASE WHEN candidate_p95_ms IS NULL OR candidate_error_rate IS NULL OR baseline_p95_ms IS NULL "
        "OR baseline_error_rate IS NULL THEN 'missing_metrics' WHEN candidate_error_rate > error_rate_limit THEN 'error_rate_above_limit' "
        "WHEN candidate_p95_ms > p95_limit_ms THEN 'p95_above_limit' END AS reason FROM r2) "
        "SELECT *, reason IS NULL AS passed FROM r3")


def log_levels() -> str:
    return (f"WITH l AS ({fx.LOG_LINES_SQL}) SELECT CASE WHEN starts_with(value, '{{') AND json_valid(value) "
            "THEN upper(json_extract_string(value, '$.level')) END AS level, count(*) AS lines FROM l GROUP BY 1")


_POLICY = "upper(coalesce(Severity, '')) IN ('CRITICAL', 'HIGH')"


def findings_rollup() -> str:
    return (f"WITH f AS (SELECT Target, upper(coalesce(Severity, '')) AS Severity FROM ({fx.derived_sql('findings')}) WHERE {_POLICY}), "
            "g AS (SELECT Target, count(*) AS findings, count(*) FILTER (WHERE Severity = 'CRITICAL') AS critical, "
            "count(*) FILTER (WHERE Severity = 'HIGH') AS high FROM f GROUP BY Target) "
            "SELECT Target, findings, critical, high, least(findings, 5) AS listed, greatest(findings - 5, 0) AS remaining, "
            "findings > 0 AS failed FROM g")


def findings_listed() -> str:
    return (f"WITH f AS (SELECT Target, coalesce(VulnerabilityID, 'unknown') AS VulnerabilityID, coalesce(PkgName, 'unknown') AS PkgName, "
            "coalesce(InstalledVersion, '?') AS InstalledVersion, coalesce(FixedVersion, 'unfixed') AS FixedVersion, "
            f"upper(coalesce(Severity, '')) AS Severity FROM ({fx.derived_sql('findings')}) WHERE {_POLICY}) "
            "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY Target ORDER BY VulnerabilityID) AS INTEGER) AS rank FROM f) "
            "WHERE rank <= 5")


def findings_reports() -> str:
    level = "CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 60 THEN 'HIGH' WHEN value >= 20 THEN 'MEDIUM' ELSE 'LOW' END"
    row = lambda target, result, where, severity: (
        f"SELECT {target} AS Target, {result} AS rp, p.pos, concat('CVE-', p.n, '-', event_id) AS VulnerabilityID, concat('pkg', event_id % 40) AS PkgName, "
        "CASE WHEN event_id % 4 = 0 THEN '?' ELSE '1.0' END AS InstalledVersion, CASE WHEN event_id % 3 = 0 THEN 'unfixed' ELSE '1.1' END AS FixedVersion, "
        f"{severity} AS Severity, concat(event_type, ' issue') AS Title FROM events, {where}")
    first = row("concat('img-', user_id % 13)", 0, "(VALUES (0, 2026), (1, 2024), (2, 2025)) p(pos, n) WHERE event_id % 2 = 0",
                f"CASE p.pos WHEN 0 THEN {level} WHEN 1 THEN 'HIGH' ELSE CASE WHEN user_id % 2 = 0 THEN 'CRITICAL' END END")
    second = row("CASE WHEN event_id % 5 = 0 THEN 'unknown' ELSE concat('base-', event_id % 7) END", 1, "(VALUES (0, 2023)) p(pos, n)", level)
    return (f"SELECT * EXCLUDE (rp, pos) FROM (SELECT *, CAST(row_number() OVER (PARTITION BY Target ORDER BY rp, pos, VulnerabilityID) AS INTEGER) AS rank "
            f"FROM ({first} UNION ALL {second}) WHERE Severity IN ('CRITICAL', 'HIGH')) WHERE rank <= 5")


# ----------------------------------------------------------------------------
# ledger, registry, keys, vectors
# ----------------------------------------------------------------------------
LATEST_RUNS = ("SELECT raw_blob_name, phase, status, run_id, written_at, duration_seconds FROM "
               f"(SELECT *, row_number() OVER (PARTITION BY raw_blob_name, phase ORDER BY written_at DESC, run_id DESC) AS rn "
               f"FROM ({fx.derived_sql('runs')})) WHERE rn = 1")


def latest_run() -> str:
    return LATEST_RUNS


def ledger_store() -> str:
    return LATEST_RUNS


def run_documents() -> str:
    docs = ", ".join(e.replace("AS STRING)", "AS VARCHAR)") for e in fx.RUN_DOCUMENTS)
    get = lambda *paths: "coalesce(" + ", ".join(f"json_extract_string(doc, '$.{p}')" for p in paths) + ")"
    ok = "CASE WHEN json_valid(doc) THEN json_type(doc) = 'OBJECT' END"
    when = lambda c, t: f"CASE WHEN ok THEN TRY_CAST({c} AS {t}) END"
    return (f"WITH raw AS (SELECT {docs} FROM events), d AS (SELECT *, coalesce({ok}, false) AS ok FROM raw), "
            f"v AS (SELECT event_id, ok, CASE WHEN ok THEN doc ELSE '{{}}' END AS doc FROM d) "
            f"SELECT event_id, {get('raw_blob_name')} AS raw_blob_name, "
            "CASE WHEN NOT ok THEN NULL WHEN json_extract(doc, '$.pipeline_run_id') IS NOT NULL THEN 'training' ELSE 'cleaning' END AS phase, "
            f"{get('status')} AS status, {get('run_id', 'pipeline_run_id')} AS run_id, {get('clean_blob_name')} AS clean_blob_name, "
            f"{when(get('started_at'), 'TIMESTAMP')} AS started_at, {when(get('finished_at'), 'TIMESTAMP')} AS finished_at, "
            f"{when(get('duration_seconds'), 'DOUBLE')} AS duration_seconds, {get('model_version')} AS model_version, "
            f"{when(get('metrics.test_roc_auc', 'metrics.test.roc_auc'), 'DOUBLE')} AS test_roc_auc, "
            f"{when(get('transform_metrics.output_rows'), 'BIGINT')} AS output_rows, "
            "CASE WHEN NOT ok THEN 'not a JSON object' WHEN json_extract_string(doc, '$.raw_blob_name') IS NULL THEN 'no raw_blob_name' END AS problem FROM v")


def latest_execution() -> str:
    return (f"WITH r AS ({fx.derived_sql('runs')}), t AS (SELECT * FROM r ORDER BY written_at DESC, run_id DESC LIMIT 1) "
            "SELECT t.run_id, t.status, t.raw_blob_name, (SELECT max(written_at) FROM r) AS latest_written_at, "
            f"(SELECT max(written_at) FROM r) >= TIMESTAMP '{AS_OF}' - INTERVAL '1 day' AS recent FROM t")


def pending_inputs() -> str:
    return (f"WITH l AS ({LATEST_RUNS.replace('FROM (SELECT *', 'FROM (SELECT *', 1)}) "
            f"SELECT DISTINCT raw_blob_name FROM ({fx.derived_sql('inputs')}) i WHERE raw_blob_name NOT IN "
            "(SELECT raw_blob_name FROM (SELECT *, row_number() OVER (PARTITION BY raw_blob_name ORDER BY written_at DESC, run_id DESC) AS rn2 "
            f"FROM ({fx.derived_sql('runs')}) WHERE phase = 'cleaning') WHERE rn2 = 1 AND status = 'COMPLETED')")


VERSIONS_SQL = (f"SELECT model_name, CAST(row_number() OVER (PARTITION BY model_name ORDER BY created_at, run_id) AS BIGINT) AS version, "
                f"run_id, created_at FROM ({fx.derived_sql('model_versions_src')})")
ALIASES_CUR = ("SELECT model_name, alias, version, set_at FROM (SELECT *, row_number() OVER (PARTITION BY model_name, alias "
               f"ORDER BY set_at DESC, version DESC) AS rn FROM ({fx.derived_sql('model_aliases')})) WHERE rn = 1")


def model_versions() -> str:
    return VERSIONS_SQL


def resolve_model() -> str:
    return (f"WITH v AS ({VERSIONS_SQL}), a AS ({ALIASES_CUR}), "
            f"req AS (SELECT DISTINCT model_name, alias FROM ({fx.derived_sql('model_aliases')})) "
            "SELECT req.model_name, req.alias, a.version, v.run_id, CASE WHEN a.version IS NULL THEN 'no_alias' "
            "WHEN v.run_id IS NULL THEN 'missing_version' WHEN length(trim(v.run_id)) = 0 THEN 'no_run_id' ELSE 'ok' END AS status "
            "FROM req LEFT JOIN a ON req.model_name = a.model_name AND req.alias = a.alias "
            "LEFT JOIN v ON req.model_name = v.model_name AND a.version = v.version")


def retention() -> str:
    return (f"WITH v AS ({VERSIONS_SQL}), a AS ({ALIASES_CUR}), loose AS (SELECT * FROM v WHERE NOT EXISTS "
            "(SELECT 1 FROM a WHERE a.model_name = v.model_name AND a.version = v.version)), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) AS rk FROM loose) "
            "SELECT model_name, version, run_id, created_at FROM r WHERE rk > 3")


def blob_keys() -> str:
    n = "regexp_replace(regexp_replace(raw_blob_name, '^\\s+|\\s+$', '', 'g'), '^/+', '')"
    return (f"SELECT raw_blob_name, CASE WHEN {n} = '' THEN NULL ELSE concat('clean/', regexp_replace({n}, '^[^/]*/', '')) END AS clean_blob_name, "
            f"CASE WHEN {n} = '' THEN NULL ELSE concat('elt/', {n}, '.json') END AS cleaning_ledger, "
            f"CASE WHEN {n} = '' THEN NULL ELSE concat('training/', regexp_replace({n}, '\\.parquet$', ''), '.json') END AS training_ledger "
            f"FROM (SELECT DISTINCT raw_blob_name FROM ({fx.derived_sql('runs')}))")


def vector_check() -> str:
    return ("WITH e AS (SELECT vec_id, embedding, CAST(len(embedding) AS INTEGER) AS length FROM embeddings), "
            "x AS (SELECT arg_min(len(embedding), vec_id) AS expected FROM e WHERE embedding IS NOT NULL) "
            "SELECT vec_id, length, CASE WHEN embedding IS NULL OR length = 0 THEN 'empty' "
            "WHEN length <> (SELECT expected FROM x) THEN 'length_mismatch' ELSE 'ok' END AS status FROM e")


def ingest_stream() -> str:
    """Per landing file (k modulo their number): contract gate in fatal order, then the clean count."""
    file = "k % files"
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in C.required)
    code = f"upper(regexp_replace(CAST({C.code_column} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    fatal = " OR ".join(f"CAST(n_{c} AS DOUBLE) / n > {_dbl(C.max_null_rate[c])}" for c in C.required)
    cols = ", ".join(ALL_RAW)
    return with_clean(
        "SELECT CASE WHEN v.bad THEN 'FAILED' ELSE 'COMPLETED' END AS status, "
        "CASE WHEN v.bad THEN NULL ELSE c.output_rows END AS output_rows FROM "
        f"(SELECT f, ({fatal}) OR CAST(n - d AS DOUBLE) / n > {_dbl(C.max_duplicate_rate)} "
        f"OR CAST(bad_code AS DOUBLE) / n > {_dbl(C.max_invalid_code_rate)} AS bad FROM "
        f"(SELECT {file} AS f, count(*) AS n, {nulls}, "
        f"count(*) FILTER (WHERE NOT regexp_matches({code}, '{C.code_pattern}')) AS bad_code FROM raw, nf GROUP BY {file}) a "
        f"JOIN (SELECT {file} AS f2, count(*) AS d FROM (SELECT DISTINCT * FROM raw), nf GROUP BY {file}) b ON a.f = b.f2) v "
        f"JOIN (SELECT {file} AS f, count(*) AS output_rows FROM (SELECT DISTINCT {cols} FROM tag WHERE reason IS NULL), nf "
        f"GROUP BY {file}) c ON v.f = c.f", ["nf AS (SELECT 24 + count(*) // 1000000 AS files FROM orders)"])


def validation_report() -> str:
    def pct(x: str) -> str:
        return f"printf('%.4f%%', ({x}) * 100.0)"

    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in C.required)
    code = f"upper(regexp_replace(CAST({C.code_column} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    ranges = ", ".join(
        f"count(*) FILTER (WHERE TRY_CAST({c} AS {C.range_rule(c).cast.upper()}) < {C.range_rule(c).low} "
        f"OR TRY_CAST({c} AS {C.range_rule(c).cast.upper()}) > {C.range_rule(c).high}) AS r_{c}"
        for c in C.warning_order)
    rate = {c: f"(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n_{c} AS DOUBLE) / n END)" for c in C.required}
    warn = [f"CASE WHEN {rate[c]} > 0 THEN concat('{c} null_rate=', {pct(rate[c])}) END" for c in C.max_null_rate]
    warn.append("CASE WHEN dup > 0 THEN concat('duplicate_rows=', CAST(dup AS VARCHAR)) END")
    warn.append("CASE WHEN bad_code > 0 THEN concat('invalid_state_rows=', CAST(bad_code AS VARCHAR)) END")
    for c in C.warning_order:
        warn.append(f"CASE WHEN r_{c} > 0 THEN concat('{C.range_rule(c).warning}=', CAST(r_{c} AS VARCHAR)) END")
    dup_rate = "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(dup AS DOUBLE) / n END)"
    code_rate = "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(bad_code AS DOUBLE) / n END)"
    fatal = [f"WHEN n < {C.min_rows} THEN 'Raw frame is empty'"]
    for c, lim in C.max_null_rate.items():
        fatal.append(f"WHEN {rate[c]} > {_dbl(lim)} THEN concat('Null rate for {c} is ', {pct(rate[c])}, "
                     f"', above allowed ', {pct(_dbl(lim))})")
    fatal.append(f"WHEN {dup_rate} > {_dbl(C.max_duplicate_rate)} THEN concat('Duplicate rate is ', {pct(dup_rate)}, "
                 f"', above allowed ', {pct(_dbl(C.max_duplicate_rate))})")
    fatal.append(f"WHEN {code_rate} > {_dbl(C.max_invalid_code_rate)} THEN concat('Invalid {C.code_column} rate is ', "
                 f"{pct(code_rate)}, ', above allowed ', {pct(_dbl(C.max_invalid_code_rate))})")
    return (f"WITH {raw_cte()}, c AS (SELECT count(*) AS n, {nulls}, "
            f"count(*) FILTER (WHERE NOT regexp_matches({code}, '{C.code_pattern}')) AS bad_code, {ranges}, "
            "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS dup FROM raw) "
            f"SELECT n AS row_count, dup AS duplicate_rows, bad_code AS invalid_state_rows, {dup_rate} AS duplicate_rate, "
            f"{code_rate} AS invalid_state_rate, concat_ws('; ', {', '.join(warn)}) AS warnings, "
            f"CASE {' '.join(fatal)} END AS fatal FROM c")
