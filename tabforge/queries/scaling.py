"""S1-S3."""

from pyspark.sql import functions as F

from tabforge.functions.rowmath import row_normalize as normalized
from tabforge.models.scale import MinMaxBy, Standardize
from tabforge.operators.split import train_test
from tabforge.queries.registry import LINE_FEATURES, LINE_ID, LINES_SQL, lines, part_sql, query, r6


def _rounded(df, key="line_id"):
    return df.select(key, *[r6(c).alias(c) for c in LINE_FEATURES])


def _scale_sql(stats, rows="lines"):
    cells = ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM {stats})) / (SELECT stddev_pop({c}) FROM {stats}), 6) AS {c}"
        for c in LINE_FEATURES
    )
    return f"SELECT line_id, {cells} FROM {rows}"


@query("standardize", f"WITH {LINES_SQL} {_scale_sql('lines')}")
def standardize(t):
    rows = lines(t)
    return _rounded(Standardize(LINE_FEATURES).fit(rows).transform(rows))


@query(
    "standardize_train_test",
    f"""WITH {LINES_SQL},
        train AS (SELECT * FROM lines WHERE NOT ({part_sql('line_id', 11, '33333333')})),
        test AS (SELECT * FROM lines WHERE {part_sql('line_id', 11, '33333333')})
        {_scale_sql('train', 'test')}""",
)
def standardize_train_test(t):
    """Scale learnt on the training part only, applied to the other."""
    train, test = train_test(lines(t), "line_id", 0.2, seed=11)
    return _rounded(Standardize(LINE_FEATURES).fit(train).transform(test))


@query(
    "minmax_scale",
    f"WITH g AS (SELECT * FROM lineitem WHERE l_returnflag = 'A') SELECT {LINE_ID} AS line_id, "
    + ", ".join(
        f"round(({c} - (SELECT min({c}) FROM g)) / (SELECT max({c}) - min({c}) FROM g), 6) AS {c}"
        for c in LINE_FEATURES
    )
    + " FROM lineitem",
)
def minmax_scale(t):
    rows = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), "l_returnflag", *LINE_FEATURES)
    return _rounded(MinMaxBy(LINE_FEATURES, "l_returnflag", "A").fit(rows).transform(rows))


@query(
    "row_normalize",
    f"""SELECT {LINE_ID} AS line_id,
          round(CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0
                     ELSE l_discount / sqrt(l_discount * l_discount + l_tax * l_tax) END, 6) AS l_discount,
          round(CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0
                     ELSE l_tax / sqrt(l_discount * l_discount + l_tax * l_tax) END, 6) AS l_tax
        FROM lineitem""",
)
def row_normalize(t):
    cells = normalized(["l_discount", "l_tax"])
    return t.lineitem.select(F.expr(LINE_ID).alias("line_id"), *[r6(c).alias(n) for n, c in cells.items()])
