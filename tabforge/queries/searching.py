"""Searches, comparisons and ensembles with closed-form bases, so that SQL can say the whole result."""

from __future__ import annotations

import math

from tabforge.models.bayes import GaussianNB
from tabforge.operators.split import train_test
from tabforge.plans import board, ensemble, tune
from tabforge.queries.modelling import SEED, TEST_SHARE, TRAIN_TEST_SQL, TWO
from tabforge.queries.registry import LINE_FEATURES, LINES_SQL, lines, query, r6

SMOOTHINGS = [1e-9, 0.05, 0.4]
FEW = ["l_extendedprice", "l_tax"]


def bayes_sql(name: str, train: str, test: str, cols, by=(), smoothing: str = "1e-9") -> str:
    """CTEs that end in ``name``: the rows of ``test`` with ``prediction`` by Gaussian naive Bayes, one model per ``by``.

    ``smoothing`` is a number or a column of ``train``.
    """
    g = "".join(f"{b}, " for b in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    using = f"USING ({', '.join(by)})" if by else "ON true"
    moments = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in cols)
    widest = f"greatest({', '.join(f'var_pop({c})' for c in cols)})"
    terms = " + ".join(f"ln({2 * math.pi} * (v_{c} + eps)) + (t.{c} - m_{c}) * (t.{c} - m_{c}) / (v_{c} + eps)" for c in cols)
    return f"""
      {name}_c AS (SELECT {g} label AS cls, count(*) AS n, {moments} FROM {train} GROUP BY {g} label),
      {name}_w AS (SELECT {g} count(*) AS n_all, max({smoothing}) * {widest} AS eps FROM {train} {group}),
      {name}_s AS (SELECT t.*, cls, ln(n / n_all) - 0.5 * ({terms}) AS s
                   FROM {test} t JOIN {name}_c {using} JOIN {name}_w {using}),
      {name} AS (SELECT * EXCLUDE (cls, s), cls AS prediction FROM {name}_s
                 QUALIFY row_number() OVER (PARTITION BY {g} line_id ORDER BY s DESC, cls) = 1)"""


def _search_sql(values, folds: int, seed: int) -> str:
    """Mean score and half its deviation for each smoothing value; the first best one is marked."""
    cands = ", ".join(f"({i}, 'smoothing={v}', {v!r})" for i, v in enumerate(values))
    return f"""WITH {LINES_SQL}, cands(candidate, params, sm) AS (VALUES {cands}),
      folds AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', line_id, '{seed}'))) - 1) % {folds}
                AS fold FROM lines),
      held AS (SELECT unnest(range({folds})) AS held),
      tr AS (SELECT * FROM folds, held, cands WHERE fold <> held),
      te AS (SELECT * FROM folds, held, cands WHERE fold = held),
      {bayes_sql('judged', 'tr', 'te', LINE_FEATURES, ['candidate', 'held'], 'CAST(sm AS DOUBLE)')},
      per AS (SELECT candidate, held, avg(CAST(label = prediction AS INTEGER)) AS score FROM judged GROUP BY ALL),
      mean AS (SELECT candidate, avg(score) AS m, stddev_pop(score) / 2 AS h FROM per GROUP BY candidate)
      SELECT candidate, params, round(m, 6) AS mean_score, round(h, 6) AS half_std,
             candidate = (SELECT min(candidate) FROM mean WHERE m = (SELECT max(m) FROM mean)) AS best
      FROM mean JOIN cands USING (candidate)"""


def _rounded(table):
    return table.withColumns({c: r6(c) for c in ("mean_score", "half_std")})


@query("grid_search_nb", _search_sql(SMOOTHINGS, 3, 0))
def grid_search_nb(t):
    """Every smoothing value on three folds."""
    est = GaussianNB(LINE_FEATURES)
    return _rounded(tune.grid_search(est, tune.param_grid({est.smoothing: SMOOTHINGS}), lines(t), "line_id", "label", 3).table)


_SPACE = [1e-9, 0.01, 0.1, 0.4]


_EST = GaussianNB(LINE_FEATURES)
DRAWN = tune.param_draws({_EST.smoothing: _SPACE}, 2, seed=4)  # two of the four values, by the seed


@query("random_search_nb", _search_sql([d[_EST.smoothing] for d in DRAWN], 2, 4))
def random_search_nb(t):
    """Two drawn smoothing values on two folds."""
    space = {_EST.smoothing: _SPACE}
    return _rounded(tune.random_search(_EST, space, 2, lines(t), "line_id", "label", 2, seed=4).table)


@query("param_sweep_nb", f"""WITH {TRAIN_TEST_SQL}, cands(param_value, sm) AS (VALUES {", ".join(f"('{v}', {v!r})" for v in SMOOTHINGS)}),
      tr AS (SELECT * FROM train, cands),
      te AS (SELECT *, 'train' AS part FROM train, cands UNION ALL SELECT *, 'test' AS part FROM test, cands),
      {bayes_sql('judged', 'tr', 'te', LINE_FEATURES, ['param_value'], 'CAST(sm AS DOUBLE)')}
      SELECT 'smoothing' AS parameter, param_value,
             round(avg(CAST(label = prediction AS INTEGER)) FILTER (part = 'train'), 6) AS train_accuracy,
             round(avg(CAST(label = prediction AS INTEGER)) FILTER (part = 'test'), 6) AS test_accuracy
      FROM judged GROUP BY param_value""")
def param_sweep_nb(t):
    """Train and test accuracy for each smoothing value."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    est = GaussianNB(LINE_FEATURES)
    found = tune.sweep(est, {est.smoothing: SMOOTHINGS}, train, test)
    return found.withColumns({c: r6(c) for c in ("train_accuracy", "test_accuracy")})


_BASES = {"all": LINE_FEATURES, "two": TWO, "few": FEW}
_THREE = ",".join(bayes_sql(f"p_{n}", "train", "test", cols) for n, cols in _BASES.items())


@query("compare_models_nb", f"WITH {TRAIN_TEST_SQL}, {_THREE} " + " UNION ALL ".join(
    f"SELECT '{n}' AS classifier, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM p_{n}" for n in _BASES))
def compare_models_nb(t):
    """Accuracies of three models; their times are left out."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    found = board.compare({n: GaussianNB(cols) for n, cols in _BASES.items()}, train, test)
    return found.select("classifier", r6("accuracy").alias("accuracy"))


@query("vote_models_nb", f"""WITH {TRAIN_TEST_SQL}, {_THREE},
      votes AS ({" UNION ALL ".join(f"SELECT line_id, label, prediction FROM p_{n}" for n in _BASES)}),
      sums AS (SELECT line_id, label, prediction, count(*) AS n FROM votes GROUP BY ALL)
      SELECT line_id, label, prediction FROM sums
      QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY n DESC, prediction) = 1""")
def vote_models_nb(t):
    """Majority of three fitted models on the same row."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    model = ensemble.Voting([GaussianNB(cols) for cols in _BASES.values()]).fit(train)
    return model.transform(test).select("line_id", "label", "prediction")


def _outputs(names, rows: str) -> str:
    """Class numbers of the bases ``names`` beside each other, for the rows of ``rows``."""
    joins = " ".join(f"JOIN {n} USING (line_id)" for n in names)
    return f"SELECT line_id, r.label, {', '.join(f'{n}.prediction AS o{i}' for i, n in enumerate(names))} FROM {rows} r {joins}"


_BLEND_SEED, _FRAC = 3, 0.4


@query("blend_nb", f"""WITH {TRAIN_TEST_SQL},
      placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', line_id, '{_BLEND_SEED}'))) - 1 AS pos,
                        count(*) OVER (PARTITION BY label) AS size FROM train),
      one AS (SELECT * FROM placed WHERE pos >= floor(size * {_FRAC} + 0.5)),
      two AS (SELECT * FROM placed WHERE pos < floor(size * {_FRAC} + 0.5)),
      {bayes_sql('a', 'one', 'two', LINE_FEATURES)}, {bayes_sql('b', 'one', 'two', FEW)},
      {bayes_sql('c', 'one', 'test', LINE_FEATURES)}, {bayes_sql('d', 'one', 'test', FEW)},
      inner_ AS ({_outputs(['a', 'b'], 'two')}), outer_ AS ({_outputs(['c', 'd'], 'test')}),
      {bayes_sql('z', 'inner_', 'outer_', ['o0', 'o1'], (), '0.1')}
      SELECT line_id, label, prediction FROM z""")
def blend_nb(t):
    """Two bases on one part of the rows, a model on their class numbers on the other part."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    meta = GaussianNB(smoothing=0.1)
    est = ensemble.Blend([GaussianNB(LINE_FEATURES), GaussianNB(FEW)], meta, "line_id", frac=_FRAC, seed=_BLEND_SEED)
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


_STACK = f"""folds AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', line_id, '7'))) - 1) % 3 AS fold
                FROM train),
      held AS (SELECT unnest([0, 1, 2]) AS held),
      tr AS (SELECT * FROM folds, held WHERE fold <> held), te AS (SELECT * FROM folds, held WHERE fold = held),
      {bayes_sql('a', 'tr', 'te', LINE_FEATURES, ['held'])}, {bayes_sql('b', 'tr', 'te', FEW, ['held'])},
      {bayes_sql('c', 'train', 'test', LINE_FEATURES)}, {bayes_sql('d', 'train', 'test', FEW)},
      inner_ AS ({_outputs(['a', 'b'], 'train')}), outer_ AS ({_outputs(['c', 'd'], 'test')}),
      {bayes_sql('z', 'inner_', 'outer_', ['o0', 'o1'], (), '0.1')}"""


@query("stack_nb", f"WITH {TRAIN_TEST_SQL}, {_STACK} SELECT line_id, label, prediction FROM z")
def stack_nb(t):
    """A model on the out-of-fold class numbers of two bases, which are then fitted on all rows."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    est = ensemble.Stack(
        [GaussianNB(LINE_FEATURES), GaussianNB(FEW)], GaussianNB(smoothing=0.1), "line_id", k=3, use_proba=False, seed=7
    )
    return est.fit(train).transform(test).select("line_id", "label", "prediction")
