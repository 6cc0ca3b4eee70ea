"""SQL counterparts of the registered queries, for an independent engine.

They are written from the meaning of each step, mostly in another form than the
Spark plan: theta joins for the train side, closed forms for least squares.
"""

from __future__ import annotations

from foldwise.operators.mlp import initial_weights
from foldwise.plans import bindings as b

SEED = 42

_CTES = {
    "orders_all": """
        SELECT *, year(o_orderdate) AS o_year
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "dirty": """
        SELECT o_orderkey, o_totalprice, o_year, c_acctbal, o_orderstatus, c_mktsegment,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN ''
                    ELSE o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE c_name END AS o_note
        FROM orders_all""",
    "lines": "SELECT *, year(l_shipdate) AS l_year FROM lineitem",
    "order_cats": """
        SELECT 'o_orderpriority' AS feature, o_orderpriority AS category FROM orders_all
        UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders_all
        UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM orders_all""",
    "cats": """
        SELECT 'lang' AS feature, lang AS category, 13.0 AS threshold, 15 AS max_cats
        FROM documents
        UNION ALL SELECT 'p_brand', p_brand, 4.0, 15 FROM part
        UNION ALL SELECT 'o_orderstatus', o_orderstatus, 33.5, 15 FROM orders_all""",
    "dist": """
        SELECT *, CASE WHEN is_rare THEN '__other__' ELSE category END AS final_category FROM (
            SELECT feature, category, max_cats, threshold, count(*) AS count,
                   count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) * 100 AS pct,
                   count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) * 100 < threshold
                       AS is_rare
            FROM cats GROUP BY feature, category, threshold, max_cats)""",
    "enc": """
        SELECT feature, max_cats, threshold, sum(count) AS rows, count(*) AS raw_categories,
               count(*) FILTER (NOT is_rare) AS own_categories,
               count(*) FILTER (is_rare) AS rare_categories,
               coalesce(sum(pct) FILTER (is_rare), 0.0) AS other_pct,
               count(*) FILTER (NOT is_rare)
                   + CASE WHEN count(*) FILTER (is_rare) > 0 THEN 1 ELSE 0 END AS final_categories
        FROM dist GROUP BY feature, max_cats, threshold""",
    "task_rows": """
        SELECT 'orders' AS task, CAST(o_year AS VARCHAR) AS fold FROM orders_all
        UNION ALL SELECT 'lineitem', CAST(l_year AS VARCHAR) FROM lines
        UNION ALL SELECT 'documents', source FROM documents
        UNION ALL SELECT 'part', p_type FROM part
        UNION ALL SELECT 'two', l_linestatus FROM lineitem
        UNION ALL SELECT 'many', concat(o_year, '-', c_mktsegment) FROM orders_all""",
    # Rank form of the score: pairs of folds instead of pairs of rows.
    "ranked": """
        SELECT task, fold, count(*) AS n,
               dense_rank() OVER (PARTITION BY task ORDER BY fold) - 1 AS r
        FROM task_rows GROUP BY task, fold""",
    "stats": """
        SELECT *, CASE WHEN gini >= 0 AND gini < 0.5 THEN 'relatively_balanced'
                       WHEN gini >= 0.5 AND gini < 0.75 THEN 'moderately_imbalanced'
                       WHEN gini >= 0.75 AND gini < 1 THEN 'highly_imbalanced'
                       ELSE 'unknown' END AS balance
        FROM (SELECT a.task, count(DISTINCT a.fold) AS folds,
                     sum(a.n * b.n * abs(a.r - b.r))::DOUBLE
                         / (2 * sum(b.n * a.n * a.r)) AS gini,
                     sum(abs(a.n - b.n))::DOUBLE
                         / (2 * count(DISTINCT a.fold) * any_value(t.n)) AS fold_size_gini,
                     any_value(t.n) AS rows
              FROM ranked a JOIN ranked b ON a.task = b.task
              JOIN (SELECT task, sum(n) AS n FROM ranked GROUP BY task) t ON t.task = a.task
              GROUP BY a.task)""",
    "folded": """
        SELECT o_orderkey AS id, o_totalprice AS y, CAST(o_year AS VARCHAR) AS fold,
               c_acctbal AS x, c_mktsegment AS g, c_nationkey::DOUBLE AS x2 FROM orders_all""",
    "keys": "SELECT DISTINCT fold FROM folded",
    "means": """
        SELECT k.fold, count(*) AS train_rows, avg(r.y) AS train_mean,
               (SELECT count(*) FROM folded e WHERE e.fold = k.fold) AS evaluation_rows
        FROM keys k JOIN folded r ON r.fold <> k.fold GROUP BY k.fold""",
    "guessed": """
        SELECT f.fold, f.y, m.train_mean AS p, m.train_rows, m.evaluation_rows
        FROM folded f JOIN means m USING (fold)""",
    # Least squares on one number and one category: common slope within categories.
    "group_means": """
        SELECT k.fold, r.g, avg(r.x) AS mx, avg(r.y) AS my
        FROM keys k JOIN folded r ON r.fold <> k.fold GROUP BY k.fold, r.g""",
    "slopes": """
        SELECT m.fold, sum((r.x - m.mx) * (r.y - m.my)) / sum((r.x - m.mx) * (r.x - m.mx)) AS b
        FROM group_means m JOIN folded r ON r.fold <> m.fold AND r.g = m.g GROUP BY m.fold""",
    "fitted": """
        SELECT m.fold AS model_fold, r.id, r.fold, r.y, m.my + s.b * (r.x - m.mx) AS p
        FROM folded r JOIN group_means m ON r.g = m.g JOIN slopes s ON s.fold = m.fold""",
    "ols_folds": """
        SELECT f.fold, any_value(m.train_rows) AS train_rows,
               any_value(m.evaluation_rows) AS evaluation_rows, {train}, {evaluation},
               any_value(b.mse) AS baseline_mse, any_value(b.rmse) AS baseline_rmse,
               any_value(b.mae) AS baseline_mae, any_value(b.huber_loss) AS baseline_huber_loss
        FROM (SELECT model_fold AS fold, fold <> model_fold AS train, y, p FROM fitted) f
        JOIN means m USING (fold)
        JOIN (SELECT fold, {plain} FROM guessed GROUP BY fold) b USING (fold) GROUP BY f.fold""",
    # Two numbers: Cramer's rule on centred sums.
    "two_sums": """
        SELECT k.fold, avg(r.x) AS mx, avg(r.x2) AS mz, avg(r.y) AS my,
               covar_pop(r.x, r.x) AS xx, covar_pop(r.x2, r.x2) AS zz, covar_pop(r.x, r.x2) AS xz,
               covar_pop(r.x, r.y) AS xy, covar_pop(r.x2, r.y) AS zy
        FROM (SELECT fold FROM keys UNION ALL SELECT 'none') k
        JOIN folded r ON r.fold <> k.fold GROUP BY k.fold""",
    "two_fit": """
        SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1,
               (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM two_sums""",
    "numbers": """
        SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
        UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT 'l_tax', l_tax FROM lineitem""",
    "dirty_cells": """
        SELECT 'o_totalprice' AS "column", CAST(o_totalprice AS VARCHAR) AS v FROM dirty
        UNION ALL SELECT 'o_year', CAST(o_year AS VARCHAR) FROM dirty
        UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM dirty
        UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM dirty
        UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM dirty
        UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM dirty""",
}


def _errors(prefix: str = "", when: str | None = None, places: bool = False) -> str:
    """Select list of the four measures of ``p`` against ``y``."""
    clause = f" FILTER ({when})" if when else ""
    parts = {
        "mse": f"avg((p - y) * (p - y)){clause}",
        "rmse": f"sqrt(avg((p - y) * (p - y)){clause})",
        "mae": f"avg(abs(p - y)){clause}",
        "huber_loss": "avg(CASE WHEN abs(p - y) <= 1 THEN 0.5 * (p - y) * (p - y) "
                      f"ELSE abs(p - y) - 0.5 END){clause}",
    }
    return ", ".join(f"{sql} AS {prefix}{name}" for name, sql in parts.items())


_CTES["ols_folds"] = _CTES["ols_folds"].format(
    train=_errors("train_", "train"), evaluation=_errors("evaluation_", "NOT train"),
    plain=_errors())

_NEEDS = {
    "dirty": ["orders_all"], "order_cats": ["orders_all"], "cats": ["orders_all"],
    "dist": ["cats"], "enc": ["dist"], "task_rows": ["orders_all", "lines"],
    "ranked": ["task_rows"], "stats": ["ranked"], "folded": ["orders_all"], "keys": ["folded"],
    "means": ["keys"], "guessed": ["means"], "group_means": ["keys"], "slopes": ["group_means"],
    "fitted": ["slopes"], "ols_folds": ["fitted", "guessed"], "two_sums": ["keys"],
    "two_fit": ["two_sums"], "dirty_cells": ["dirty"],
}


def _with(names: list[str], body: str) -> str:
    """Put the named common tables, and those they need, before the query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    head = ",\n".join(f"{n} AS ({_CTES[n]})" for n in ordered)
    return f"WITH {head}\n{body}" if ordered else body


def _indicators(feature: str, categories: list[str]) -> str:
    return ", ".join(
        f"CAST({feature} = '{c}' AS INTEGER) AS \"{feature}_OHE__{c}\"" for c in categories)


# The categories of the test tables.
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_STATUSES = ["F", "O", "P"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_ORDER_INDICATORS = ", ".join(
    f"{_indicators(f, c)}, 0 AS \"{f}_OHE____other__\"" for f, c in (
        ("o_orderpriority", _PRIORITIES), ("o_orderstatus", _STATUSES),
        ("c_mktsegment", _SEGMENTS)))


def _hash(seed: int, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


def _summary(source: str, measures: list[str], places: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS measure, round(avg({m}), {places}) AS mean, "
        f"round(stddev_pop({m}), {places}) AS std FROM {source}" for m in measures)


def _short(x: str) -> str:
    return f"regexp_replace(printf('%.3f', round({x}, 3)), '(\\.\\d+?)0+$', '\\1')"


def _mean_std(measure: str, label: str) -> str:
    return (f"SELECT '{label}' AS key, concat('mean: ', {_short(f'avg({measure})')}, ' (std: ', "
            f"{_short(f'stddev_pop({measure})')}, ')') AS value FROM ols_folds")


def _comma(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _rounded(prefix: str) -> str:
    return ", ".join(f"round({prefix}_{m}, {0 if m == 'mse' else 3}) AS {prefix}_{m}"
                     for m in ("mse", "rmse", "mae", "huber_loss"))


_REMAINING = "count(*) FILTER (o_orderpriority <> '')::DOUBLE / count(*) * 100"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["impute_funnel"] = _with(["dirty"], f"""
        SELECT count(*) AS rows_before, count(*) FILTER (o_orderpriority <> '') AS rows_after,
               round({_REMAINING}, 6) AS remaining_pct, {_REMAINING} < 95 AS warned FROM dirty""")
    out["impute_rows"] = _with(["dirty"], """
        SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_number, o_orderkey,
               o_totalprice, o_year, c_acctbal, o_orderpriority, o_orderstatus, c_mktsegment,
               nullif(o_note, '') AS o_note
        FROM dirty WHERE o_orderpriority <> ''""")
    out["empty_columns"] = _with(["dirty"], " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '')
               AS missing, count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') > 0
               AS refused FROM dirty"""
        for c in ("c_acctbal", "o_orderpriority", "o_orderstatus", "c_mktsegment")))
    out["preprocessed_table"] = _with(["orders_all"], f"""
        SELECT o_orderkey AS row_id, o_totalprice AS y,
               CAST(o_year AS VARCHAR) AS evaluation_folds_key, c_acctbal, {_ORDER_INDICATORS}
        FROM orders_all""")
    out["preprocessed_shape"] = _with(["dist"], """
        SELECT (SELECT count(*) FROM part) AS rows,
               2 + 1 + count(DISTINCT final_category)
                 + (CASE WHEN bool_or(is_rare) THEN 0 ELSE 1 END) AS columns
        FROM dist WHERE feature = 'p_brand'""")

    out["category_distribution"] = _with(["order_cats"], """
        SELECT feature, category, count(*) AS count,
               round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) * 100, 6) AS pct,
               row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, category) AS rank
        FROM order_cats GROUP BY feature, category""")
    out["rare_categories"] = _with(["dist"], """
        SELECT feature, category, count, round(pct, 6) AS pct, is_rare, final_category
        FROM dist WHERE feature IN ('lang', 'p_brand')""")
    out["encoding_summary"] = _with(["enc"], """
        SELECT feature, rows, raw_categories, own_categories, rare_categories,
               round(other_pct, 6) AS other_pct, 0 AS empty_rows, false AS has_reserved,
               final_categories FROM enc""")
    out["other_breakdown"] = _with(["dist"], """
        SELECT feature, category, count, round(pct, 6) AS pct,
               round(pct / sum(pct) OVER () * 100, 6) AS share_of_other_pct
        FROM dist WHERE is_rare AND feature = 'p_brand'""")
    out["final_categories"] = _with(["dist"], """
        SELECT feature, final_category AS category, sum(count) AS count, round(sum(pct), 6) AS pct,
               row_number() OVER (PARTITION BY feature ORDER BY final_category) - 1 AS ordinal
        FROM dist WHERE feature = 'p_brand' GROUP BY feature, final_category""")
    out["known_categories"] = _with(["dist"], """
        SELECT feature, category FROM dist WHERE feature = 'p_brand'
        UNION SELECT feature, final_category FROM dist WHERE feature = 'p_brand'""")
    out["case_collision"] = """
        WITH c AS (
            SELECT DISTINCT 'o_orderpriority' AS feature,
                   CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority)
                        ELSE o_orderpriority END AS category FROM orders
            UNION ALL SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders)
        SELECT a.feature, a.category AS lower_form, min(b.category) AS example,
               count(*) + 1 AS forms
        FROM c a JOIN c b ON a.feature = b.feature AND a.category = lower(b.category)
             AND a.category <> b.category
        GROUP BY a.feature, a.category"""
    fit = """WITH fit AS (
            SELECT CAST(p_size AS VARCHAR) AS category,
                   count(*)::DOUBLE / sum(count(*)) OVER () * 100 < 0.5 AS is_rare
            FROM part WHERE p_size <= 40 GROUP BY p_size)"""
    out["unknown_categories"] = f"""{fit}
        SELECT DISTINCT 'size_label' AS feature, CAST(p_size AS VARCHAR) AS category FROM part
        WHERE CAST(p_size AS VARCHAR) NOT IN (SELECT category FROM fit)"""
    out["unknown_to_other"] = f"""{fit}
        SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_label,
               CASE WHEN NOT coalesce(is_rare, true) THEN category ELSE '__other__' END
                   AS final_category
        FROM part LEFT JOIN fit ON category = CAST(p_size AS VARCHAR)"""
    out["one_hot"] = _with(["orders_all"],
                           f"SELECT o_orderkey, {_ORDER_INDICATORS} FROM orders_all")
    out["one_hot_other"] = f"""
        SELECT doc_id, {_indicators('lang', ['en', 'fr'])},
               CAST(lang NOT IN ('en', 'fr') AS INTEGER) AS "lang_OHE____other__" FROM documents"""

    fold = f"CAST({_hash(SEED, 'o_orderkey')} % 5 AS VARCHAR)"
    out["hash_folds"] = f"SELECT o_orderkey, {fold} AS evaluation_folds_key FROM orders"
    out["hash_fold_sizes"] = f"""
        SELECT {fold} AS evaluation_folds_key,
               (SELECT count(*) FROM orders) - count(*) AS train_rows,
               count(*) AS evaluation_rows FROM orders GROUP BY 1"""
    out["fold_sizes"] = _with(["means"], """
        SELECT fold AS evaluation_folds_key, train_rows, evaluation_rows FROM means""")
    out["fold_gini"] = _with(["stats"], """
        SELECT folds, rows, round(gini, 9) AS gini, balance,
               round(fold_size_gini, 9) AS fold_size_gini, task
        FROM stats WHERE task NOT IN ('two', 'many')""")
    out["holdout_split"] = f"""
        SELECT o_orderkey, {_hash(SEED, 'o_orderkey')} < {int(0.2 * 2**32)} AS is_validation
        FROM orders"""
    out["sample_rows"] = f"""
        SELECT doc_id, n_chars FROM documents ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 100"""

    out["metrics_all"] = f"""
        SELECT l_returnflag, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
               round(huber_loss, 6) AS huber_loss
        FROM (SELECT l_returnflag, {_errors()}
              FROM (SELECT l_returnflag, l_quantity AS y, l_extendedprice / 1500 AS p FROM lineitem)
              GROUP BY l_returnflag)"""
    out["train_means"] = _with(["means"], """
        SELECT fold AS evaluation_folds_key, evaluation_rows, train_rows,
               round(train_mean, 4) AS train_mean FROM means""")
    out["baseline_by_fold"] = _with(["guessed"], f"""
        SELECT fold AS evaluation_folds_key, train_rows, evaluation_rows,
               round(p, 4) AS train_mean, round(mse, 0) AS baseline_mse,
               round(rmse, 4) AS baseline_rmse, round(mae, 4) AS baseline_mae,
               round(huber_loss, 4) AS baseline_huber_loss
        FROM (SELECT fold, train_rows, evaluation_rows, any_value(p) AS p, {_errors()}
              FROM guessed GROUP BY fold, train_rows, evaluation_rows)""")
    out["baseline_summary"] = _with(["guessed"], f"""
        , b AS (SELECT fold, {_errors('baseline_')} FROM guessed GROUP BY fold)
        {_summary('b', ['baseline_rmse', 'baseline_mae', 'baseline_huber_loss'], 4)}""")

    out["ols_cv_folds"] = _with(["ols_folds"], f"""
        SELECT fold, train_rows, evaluation_rows, {_rounded('train')}, {_rounded('evaluation')},
               {_rounded('baseline')} FROM ols_folds""")
    out["ols_two_numbers"] = _with(["two_fit"], f"""
        , scored AS (SELECT m.fold, r.fold <> m.fold AS train, r.y,
                            m.my + m.b1 * (r.x - m.mx) + m.b2 * (r.x2 - m.mz) AS p
                     FROM two_fit m JOIN folded r ON m.fold <> 'none'),
        e AS (SELECT fold, {_errors('train_', 'train')}, {_errors('evaluation_', 'NOT train')}
              FROM scored GROUP BY fold)
        SELECT fold, round(train_rmse, 3) AS train_rmse,
               round(evaluation_rmse, 3) AS evaluation_rmse,
               round(evaluation_mae, 3) AS evaluation_mae FROM e""")
    out["ols_summary"] = _with(["ols_folds"], _summary(
        "ols_folds", [f"{s}_{m}" for s in ("evaluation", "train", "baseline")
                      for m in ("rmse", "mae")], 3))
    out["oof_deviation"] = _with(["fitted"], """
        SELECT id AS row_id, fold AS fold_key, round(y, 2) AS y_true,
               round(p, 3) AS fold_model_y_pred, round(p - y, 3) AS deviation,
               row_number() OVER (ORDER BY fold, id) - 1 AS sample_index
        FROM fitted WHERE fold = model_fold""")
    out["fold_report"] = _with(["ols_folds"], f"""
        SELECT fold AS "fold key (o_year)", {_comma('train_rows')} AS "train set size",
               {_comma('evaluation_rows')} AS "evaluation set size", 1 AS "train epochs count",
               round(train_mae, 3) AS "train set model loss (MAE)",
               round(train_rmse, 3) AS "train set model RMSE",
               round(evaluation_mae, 3) AS "evaluation set model loss (MAE)",
               round(evaluation_rmse, 3) AS "evaluation set model RMSE",
               round(baseline_mae, 3) AS "guess evaluation set loss (MAE)",
               round(baseline_rmse, 3) AS "guess evaluation set RMSE" FROM ols_folds""")
    all_rows = _with(["folded"], """
        , gm AS (SELECT g, avg(x) AS mx, avg(y) AS my FROM folded GROUP BY g),
        s AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS b
              FROM folded JOIN gm USING (g)),
        scored AS (SELECT id, round(my + (SELECT b FROM s) * (x - mx), 3) AS model_prediction
                   FROM folded JOIN gm USING (g))""")
    out["score_ols"] = f"{all_rows} SELECT id AS row_id, model_prediction FROM scored"
    out["scored_input"] = f"""{all_rows}
        SELECT o_orderkey, c_acctbal, c_mktsegment, model_prediction
        FROM orders_all LEFT JOIN scored ON o_orderkey = id"""
    for check in ("score_stored", "score_stored_inline"):
        out[check] = f"""{all_rows}
            SELECT o_orderkey, c_acctbal, c_mktsegment, model_prediction
            FROM orders_all JOIN scored ON o_orderkey = id"""
    out["run_oof"] = _with(["fitted"], """
        SELECT CAST(id AS VARCHAR) AS sample_id, fold AS fold_key, round(y, 2) AS y_true,
               round(p, 3) AS fold_model_y_pred
        FROM fitted WHERE fold = model_fold""")
    out["run_fold_measures"] = out["ols_cv_folds"]
    out["run_preprocessing_page"] = _with(["orders_all"], f"""
        SELECT 'preprocessed dataset size' AS key,
               concat({_comma('count(*)')}, ' rows, ',
                      4 + count(DISTINCT c_mktsegment), ' columns') AS value FROM orders_all
        UNION ALL SELECT 'unused dropped columns count', CAST(
               (SELECT count(*) FROM information_schema.columns
                WHERE table_name IN ('orders', 'customer')) + 1 - 4 AS VARCHAR)
        UNION ALL SELECT 'imputation funnel', concat(
               '100.00% rows remained after the imputation funnel (before: ',
               {_comma('count(*)')}, ' | after: ', {_comma('count(*)')}, ')') FROM orders_all""")
    out["run_fold_table"] = _with(["ols_folds"], f"""
        SELECT CAST(fold AS BIGINT) AS "fold key (o_year)",
               {_comma('train_rows')} AS "train set size",
               {_comma('evaluation_rows')} AS "evaluation set size",
               CAST(1 AS BIGINT) AS "train epochs count",
               round(train_mse, 0) AS "train set model loss (MSE)",
               round(train_rmse, 3) AS "train set model RMSE",
               round(evaluation_mse, 0) AS "evaluation set model loss (MSE)",
               round(evaluation_rmse, 3) AS "evaluation set model RMSE",
               round(baseline_mse, 0) AS "guess evaluation set loss (MSE)",
               round(baseline_rmse, 3) AS "guess evaluation set RMSE" FROM ols_folds""")
    guess = "guess (train set target mean) evaluation sets RMSE"
    raised = "(folds NOT BETWEEN 3 AND 30)::INT + (balance <> 'relatively_balanced')::INT"
    out["run_summary_page"] = _with(["ols_folds", "stats"], f"""
        {_mean_std('evaluation_rmse', 'K fold model evaluation sets RMSE')}
        UNION ALL {_mean_std('train_rmse', 'K fold model train sets RMSE')}
        UNION ALL {_mean_std('baseline_rmse', guess)}
        UNION ALL SELECT 'preprocessed dataset size', concat({_comma('count(*)')}, ' rows, ',
                         4 + count(DISTINCT c_mktsegment), ' columns') FROM orders_all
        UNION ALL SELECT 'evaluation folds count', CAST(folds AS VARCHAR) FROM stats
                  WHERE task = 'orders'
        UNION ALL SELECT 'warnings raised', CASE WHEN {raised} = 0 THEN 'No'
                         ELSE concat('Yes (', {raised}, ' in total)') END FROM stats
                  WHERE task = 'orders'
        UNION ALL SELECT 'global random seed', '{SEED}'""")
    out["run_importance"] = f"""{all_rows}
        SELECT 'c_acctbal' AS feature,
               round(avg(abs((SELECT b FROM s) * (x - (SELECT avg(x) FROM folded)))), 3)
                   AS importance FROM folded"""
    out["holdout_fit"] = f"""
        SELECT round(regr_intercept(y, x), 2) AS intercept, round(regr_slope(y, x), 4) AS slope
        FROM (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS y, CAST(c_acctbal AS DOUBLE) AS x
              FROM orders JOIN customer ON o_custkey = c_custkey)
        WHERE {_hash(SEED + 1, 'o_orderkey')} >= {int(0.2 * 2**32)}"""
    out["oof_deviation_ranges"] = out["oof_deviation"]
    out["linear_attribution"] = _with(["two_fit"], f"""
        , s AS (SELECT id, x, x2 FROM folded ORDER BY md5('{SEED}:' || id), id LIMIT 100),
        w AS (SELECT * FROM two_fit WHERE fold = 'none')
        SELECT id AS row_id, 'c_acctbal' AS feature, round(b1 * (x - mx), 3) AS phi FROM s, w
        UNION ALL SELECT id, 'c_nationkey', round(b2 * (x2 - mz), 3) FROM s, w""")
    out["shapley_linear"] = _with(["two_fit"], f"""
        , s AS (SELECT id, x, x2 FROM folded ORDER BY md5('{SEED}:' || id), id LIMIT 100),
        bg AS (SELECT avg(x) AS mx, avg(x2) AS mz FROM (
            SELECT x, x2 FROM folded ORDER BY md5('{SEED + 1}:' || id), id LIMIT 100)),
        w AS (SELECT b1, b2 FROM two_fit WHERE fold = 'none')
        SELECT id AS row_id, 'c_acctbal' AS feature, round(b1 * (x - mx), 2) AS phi FROM s, w, bg
        UNION ALL SELECT id, 'c_nationkey', round(b2 * (x2 - mz), 2) FROM s, w, bg""")
    out["linear_importance"] = _with(["two_fit"], """
        , w AS (SELECT * FROM two_fit WHERE fold = 'none'),
        i AS (SELECT 'c_acctbal' AS feature, avg(abs(b1 * (x - mx))) AS importance FROM folded, w
              UNION ALL SELECT 'c_nationkey', avg(abs(b2 * (x2 - mz))) FROM folded, w)
        SELECT feature, round(importance, 3) AS importance,
               row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM i""")

    out["warnings_report"] = _with(["dirty", "enc", "stats"], f"""
        SELECT 'W1' AS rule, 'Dataset Preprocessing' AS pipeline_module,
               concat('only ', printf('%.2f%%', {_REMAINING}),
                      ' of the train dataset rows remained after the imputation funnel')
                   AS description, '' AS context FROM dirty HAVING {_REMAINING} < 95
        UNION ALL SELECT 'W2', 'Dataset Preprocessing',
               concat('the number of categories in this feature is ', final_categories,
                      ', which is relatively high and approaches the limit defined for this '
                      || 'feature'),
               concat('feature.max_allowed_categories_count: ', max_cats,
                      '  feature_column: ', feature)
        FROM enc WHERE final_categories >= ceil(max_cats * 2.0 / 3)
        UNION ALL SELECT 'W3', 'Dataset Preprocessing',
               concat('the percentage of the ''others'' category in this feature is ',
                      printf('%.2f%%', other_pct), ', which is relatively high'),
               concat('feature_column: ', feature) FROM enc WHERE other_pct > 10
        UNION ALL SELECT 'W4', 'Dataset Preprocessing',
               concat('there is no diversity in the categories of this features, when counting ',
                      'out the ''others'' category. consider changing the value of ',
                      'min_significant_category_percentage_threshold defined for this feature.'),
               concat('feature.min_significant_category_percentage_threshold: ', threshold,
                      '  feature_column: ', feature) FROM enc WHERE own_categories < 2
        UNION ALL SELECT CASE WHEN folds < 3 THEN 'W5' ELSE 'W6' END, 'Model training',
               concat('the number of evaluation folds is ',
                      CASE WHEN folds < 3 THEN 'low' ELSE 'high' END),
               concat('evaluation_folds_count: ', folds)
        FROM stats WHERE task IN ('two', 'many') AND (folds < 3 OR folds > 30)
        UNION ALL SELECT 'W7', 'Model training',
               concat('the distribution of the evaluation folds is considered imbalanced ',
                      'according to the gini coefficient test'),
               concat('distribution_balance: ', balance,
                      '  folds_distribution_gini_coefficient: ', printf('%.4f', gini))
        FROM stats WHERE task IN ('two', 'many') AND balance <> 'relatively_balanced'""")
    out["display_texts"] = _with(["dirty"], f"""
        SELECT 'imputation funnel' AS key,
               concat(printf('%.2f%%', {_REMAINING}),
                      ' rows remained after the imputation funnel (before: ',
                      {_comma('count(*)')}, ' | after: ',
                      {_comma("count(*) FILTER (o_orderpriority <> '')")}, ')') AS value FROM dirty
        UNION ALL SELECT 'dataset size', concat(
               {_comma("count(*) FILTER (o_orderpriority <> '')")}, ' rows, 6 columns') FROM dirty
        UNION ALL SELECT 'warnings raised',
               CASE WHEN {_REMAINING} < 95 THEN 'Yes (1 in total)' ELSE 'No' END FROM dirty
        UNION ALL SELECT 'split setup', 'by the key column ''o_year'''
        UNION ALL SELECT 'metric', 'Huber'""")
    out["summary_page"] = _with(["ols_folds", "stats"], f"""
        {_mean_std('evaluation_rmse', 'K fold model evaluation sets RMSE')}
        UNION ALL {_mean_std('train_rmse', 'K fold model train sets RMSE')}
        UNION ALL {_mean_std('baseline_rmse', guess)}
        UNION ALL SELECT 'loss function name', 'MAE'
        UNION ALL SELECT 'evaluation folds split setup', 'by the key column ''o_year'''
        UNION ALL SELECT 'evaluation folds count', CAST(folds AS VARCHAR) FROM stats
                  WHERE task = 'orders'
        UNION ALL SELECT 'folds distribution GINI coefficient', printf('%.4f', gini) FROM stats
                  WHERE task = 'orders'""")
    out["curve_cap"] = """
        SELECT event_id, round(least(greatest(value, 1.0), 1.5 * m), 6) AS value
        FROM events JOIN (SELECT event_type, avg(value) AS m FROM events GROUP BY event_type)
             USING (event_type)"""

    out["profile_overview"] = """
        WITH t AS (SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
                          nullif(l_linenumber, 1) AS l_linenumber FROM lineitem),
        a AS (SELECT (SELECT count(*) FROM t) AS rows, 6 AS columns,
                     (SELECT count(*) - count(l_linenumber) FROM t) AS missing_cells,
                     (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))
                         AS duplicate_rows)
        SELECT rows, columns, missing_cells,
               round(missing_cells::DOUBLE / (rows * columns) * 100, 6) AS missing_pct,
               duplicate_rows, round(duplicate_rows::DOUBLE / rows * 100, 6) AS duplicate_pct
        FROM a"""
    out["profile_variables"] = _with(["dirty_cells"], """
        , f AS (SELECT "column", v, count(*) AS n FROM dirty_cells GROUP BY "column", v)
        SELECT "column", coalesce(sum(n) FILTER (v IS NOT NULL), 0) AS count,
               coalesce(sum(n) FILTER (v IS NULL), 0) AS missing,
               count(v) AS "distinct", count(v) FILTER (n = 1) AS "unique"
        FROM f GROUP BY "column\"""")
    out["profile_numeric"] = _with(["numbers"], """
        SELECT "column", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
               round(var_samp(v), 2) AS variance, min(v) AS min, max(v) AS max,
               round(sum(v), 0) AS sum, count(*) FILTER (v = 0) AS zeros,
               count(*) FILTER (v < 0) AS negatives, round(stddev_samp(v) / avg(v), 6) AS cv
        FROM numbers GROUP BY "column\"""")
    out["profile_quantiles"] = _with(["numbers"], """
        SELECT "column", round(quantile_cont(v, 0.05), 6) AS q05,
               round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
               round(quantile_cont(v, 0.75), 6) AS q75, round(quantile_cont(v, 0.95), 6) AS q95,
               round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) AS iqr,
               round(max(v) - min(v), 6) AS range FROM numbers GROUP BY "column\"""")
    out["profile_shape"] = _with(["numbers"], """
        , m AS (SELECT "column", avg(v) AS mean, median(v) AS med FROM numbers GROUP BY "column")
        SELECT "column",
               round(avg(pow(v - mean, 3)) / pow(avg(pow(v - mean, 2)), 1.5), 6) AS skewness,
               round(avg(pow(v - mean, 4)) / pow(avg(pow(v - mean, 2)), 2) - 3, 6) AS kurtosis,
               round(median(abs(v - med)), 6) AS mad
        FROM numbers JOIN m USING ("column") GROUP BY "column\"""")
    out["profile_histogram"] = _with(["numbers"], """
        , l AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM numbers GROUP BY "column"),
        b AS (SELECT "column", lo, hi,
                     least(CAST(floor((v - lo) / (hi - lo) * 8) AS INTEGER), 7) AS bin
              FROM numbers JOIN l USING ("column"))
        SELECT "column", bin, round(lo + (hi - lo) / 8 * bin, 4) AS bin_start, count(*) AS count
        FROM b GROUP BY "column", bin, lo, hi""")
    out["profile_top_values"] = _with(["order_cats"], """
        , r AS (SELECT feature AS "column", category AS value, count(*) AS count,
                       row_number() OVER (PARTITION BY feature
                                          ORDER BY count(*) DESC, category) AS rank
                FROM order_cats GROUP BY feature, category)
        SELECT * FROM r WHERE rank <= 3""")
    heavy = """
        WITH c AS (""" + " UNION ALL ".join(f"""
            SELECT '{c}' AS "column", CAST({t} AS VARCHAR) AS value FROM lineitem"""
            for c, t in {"l_returnflag": "l_returnflag", "l_linenumber": "l_linenumber::DOUBLE",
                         "l_quantity": "l_quantity::DOUBLE", "l_linestatus": "l_linestatus",
                         "l_partkey": "l_partkey::DOUBLE", "l_shipdate": "l_shipdate"
                         }.items()) + ")"
    out["profile_heavy_values"] = heavy + """
        , r AS (SELECT "column", value, count(*) AS count, row_number() OVER (
                    PARTITION BY "column" ORDER BY count(*) DESC, value) AS rank
                FROM c WHERE value IS NOT NULL GROUP BY "column", value)
        SELECT * FROM r WHERE rank <= 3"""
    out["profile_distinct_sketches"] = heavy + """
        SELECT "column", count(value) AS count, count(*) - count(value) AS missing,
               count(DISTINCT value) AS distinct, true AS estimate_is_near
        FROM c GROUP BY "column\""""
    out["profile_extremes"] = _with(["numbers"], """
        , f AS (SELECT "column", v AS value, count(*) AS count FROM numbers GROUP BY "column", v),
        r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS a,
                     row_number() OVER (PARTITION BY "column" ORDER BY value DESC) AS d FROM f)
        SELECT "column", 'smallest' AS side, a AS rank, value, count FROM r WHERE a <= 5
        UNION ALL SELECT "column", 'largest', d, value, count FROM r WHERE d <= 5""")
    out["profile_text_lengths"] = " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", min(length({c})) AS min_length,
               round(avg(length({c})), 6) AS mean_length, max(length({c})) AS max_length
        FROM documents""" for c in ("text", "lang", "source"))
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out["profile_correlations"] = " UNION ALL ".join(f"""
        SELECT '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 9) AS correlation
        FROM lineitem""" for i, a in enumerate(names) for b in names[i + 1:])
    out["profile_missing"] = _with(["dirty_cells"], """
        SELECT "column", count(*) - count(v) AS missing, count(*) AS rows,
               round((count(*) - count(v))::DOUBLE / count(*) * 100, 6) AS missing_pct
        FROM dirty_cells GROUP BY "column\"""")
    gaps = """
        , g AS (SELECT o_orderpriority IS NULL AS a, o_orderkey % 6 = 0 AS b, o_note = '' AS c
                FROM dirty)"""
    out["profile_missing_patterns"] = _with(["dirty"], gaps + """
        SELECT concat(CAST(a AS INT), CAST(b AS INT), CAST(c AS INT), '0') AS pattern,
               CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) AS columns_missing,
               count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS pct
        FROM g GROUP BY a, b, c""")
    named = {"o_orderpriority": "a", "c_acctbal": "b", "o_note": "c", "o_totalprice": "false"}
    pairs = [(x, y) for i, x in enumerate(named) for y in list(named)[i + 1:]]
    out["profile_missing_together"] = _with(["dirty"], gaps + " UNION ALL ".join(f"""
        SELECT '{x}' AS "left", '{y}' AS "right",
               count(*) FILTER ({named[x]} AND {named[y]}) AS both,
               count(*) FILTER ({named[x]} OR {named[y]}) AS either FROM g""" for x, y in pairs))
    out["tree_attribution_gap"] = _with(["orders_all"], """
        SELECT o_orderkey, (SELECT 4 + count(DISTINCT o_orderpriority)
               + count(DISTINCT o_orderstatus) + count(DISTINCT c_mktsegment)
               FROM orders_all) AS features, 0.0 AS gap
        FROM orders_all""")
    out["boosted_stump_folds"] = _with(["lines"], """
        , f AS (SELECT DISTINCT CAST(l_year AS VARCHAR) AS fold FROM lines),
        v AS (SELECT fold, l_quantity AS q, count(*) AS n, sum(l_extendedprice) AS s
              FROM f JOIN lines ON CAST(l_year AS VARCHAR) <> fold GROUP BY fold, l_quantity),
        t AS (SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
                     sum(n) OVER (PARTITION BY fold) AS an, sum(s) OVER (PARTITION BY fold) AS a
              FROM v WINDOW w AS (PARTITION BY fold ORDER BY q)),
        r AS (SELECT *, a / an AS base, ls / ln - a / an AS l,
                     (a - ls) / (an - ln) - a / an AS r FROM t WHERE ln < an),
        k AS (SELECT *, row_number() OVER (PARTITION BY fold
                         ORDER BY ln * l * l + (an - ln) * r * r DESC, q) AS place FROM r)
        SELECT fold, round(base, 4) AS base, q AS threshold, CAST(ln AS BIGINT) AS left_rows,
               round(l, 4) AS left_step, round(r, 4) AS right_step FROM k WHERE place = 1""")
    out["network_descent"] = f"""
        WITH RECURSIVE m AS (
            SELECT count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS xx,
                   sum(x * y) AS xy, sum(y * y) AS yy
            FROM (SELECT (l_discount * 10)::DOUBLE AS x, (l_quantity / 50)::DOUBLE AS y
                  FROM lineitem)),
        g AS (SELECT 1 AS epoch, {float(initial_weights([1, 1], SEED)[0])!r}::DOUBLE AS w,
                     0::DOUBLE AS c
              UNION ALL
              SELECT epoch + 1, w - {b.DESCENT_RATE} * 2 * (w * xx + c * sx - xy) / n,
                     c - {b.DESCENT_RATE} * 2 * (w * sx + c * n - sy) / n
              FROM g, m WHERE epoch < {b.DESCENT_EPOCHS})
        SELECT epoch, round((w * w * xx + c * c * n + yy + 2 * w * c * sx - 2 * w * xy
                             - 2 * c * sy) / n, 6) AS loss FROM g, m"""
    out["profile_alerts"] = _with(["dirty"], """
        , c AS (SELECT 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS v FROM dirty
                UNION ALL SELECT 'o_totalprice', CAST(o_totalprice AS VARCHAR) FROM dirty
                UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM dirty
                UNION ALL SELECT 'quarter', CAST(o_orderkey % 4 AS VARCHAR) FROM dirty
                UNION ALL SELECT 'fixed', 'x' FROM dirty),
        s AS (SELECT "column", count(*) AS n, count(v) AS present, count(DISTINCT v) AS d,
                     count(*) FILTER (v IN ('0', '0.0') AND "column" <> 'o_orderpriority') AS z
              FROM c GROUP BY "column")
        SELECT "column", 'constant' AS alert FROM s WHERE d <= 1
        UNION ALL SELECT "column", 'unique' FROM s WHERE d = present AND d > 1
        UNION ALL SELECT "column", 'missing' FROM s WHERE present < n
        UNION ALL SELECT "column", 'zeros' FROM s WHERE z::DOUBLE / n > 0.1""")
    for name in ("profile_quantiles", "profile_shape"):
        out[f"{name}_ranges"] = out[name]
    out["profile_extremes_by_task"] = out["profile_extremes"]
    return out
