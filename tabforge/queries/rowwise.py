"""M1-M12, A1."""


from pyspark.sql import functions as F

from tabforge.functions import rowmath as M
from tabforge.functions.fixed import SHADE_WEIGHTS
from tabforge.queries.registry import LINE_ID, query, r6


def _rows(t, **features):
    return t.lineitem.select(F.expr(LINE_ID).alias("line_id"), *[r6(c).alias(n) for n, c in features.items()])


def _sql(**features):
    cells = ", ".join(f"round({e}, 6) AS {n}" for n, e in features.items())
    return f"SELECT {LINE_ID} AS line_id, {cells} FROM lineitem"


@query("row_norm", _sql(norm="sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber)"))
def row_norm(t):
    return _rows(t, norm=M.row_norm(["l_quantity", "l_linenumber"]))


@query(
    "row_mean_sum",
    f"""SELECT {LINE_ID} AS line_id,
          round((coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0)) /
            nullif(CASE WHEN l_discount = 0 THEN 0 ELSE 1 END + CASE WHEN l_tax = 0 THEN 0 ELSE 1 END, 0), 6) AS mean,
          round(l_discount + l_tax, 6) AS total
       FROM lineitem""",
)
def row_mean_sum(t):
    """Zero counts as missing here, so rows with one, two and no values occur."""
    cells = [F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")]
    return _rows(t, mean=M.row_mean(cells), total=M.row_sum(cells))


@query(
    "pair_diff",
    _sql(
        diff_l_quantity_l_linenumber="l_quantity - l_linenumber",
        sum_l_quantity_l_linenumber="l_quantity + l_linenumber",
        half_sum="(l_quantity + l_tax) / 2",
        half_diff="(l_quantity - l_tax) / 2",
    ),
)
def pair_diff(t):
    pairs = M.pair_ops([("l_quantity", "l_linenumber")], {"diff": M.pair_diff, "sum": M.pair_sum})
    return _rows(
        t, **pairs, half_sum=M.half_sum("l_quantity", "l_tax"), half_diff=M.half_diff("l_quantity", "l_tax")
    )


@query(
    "weighted_sum",
    _sql(shade="l_quantity * 0.299 + l_extendedprice * 0.587 + l_linenumber * 0.114"),
)
def weighted_sum(t):
    cols = ["l_quantity", "l_extendedprice", "l_linenumber"]
    return _rows(t, shade=M.weighted_sum(dict(zip(cols, SHADE_WEIGHTS))))


@query(
    "cos_deg",
    _sql(
        cosine="cos(radians(l_quantity))",
        shifted="cos(radians(181.65 - l_quantity))",
        sine="sin(radians(l_quantity))",
    ),
)
def cos_deg(t):
    return _rows(
        t, cosine=M.cos_deg("l_quantity"), shifted=M.cos_deg("l_quantity", 181.65), sine=M.sin_deg("l_quantity")
    )


@query(
    "bin_floor",
    f"""SELECT {LINE_ID} AS line_id, CAST(floor(l_quantity / 6) AS BIGINT) AS quantity_bin,
              CAST(floor(l_extendedprice / 200) AS BIGINT) AS price_bin,
              CAST(floor((l_quantity - 25) / 45) AS BIGINT) AS signed_bin
       FROM lineitem""",
)
def bin_floor(t):
    return t.lineitem.select(
        F.expr(LINE_ID).alias("line_id"),
        M.bin_floor("l_quantity", 6).alias("quantity_bin"),
        M.bin_floor("l_extendedprice", 200).alias("price_bin"),
        M.bin_floor(F.col("l_quantity") - 25, 45).alias("signed_bin"),
    )


@query(
    "safe_ratio",
    f"""SELECT {LINE_ID} AS line_id, round(l_extendedprice / (l_quantity + 1), 9) AS ratio,
              round(l_quantity / nullif((l_linenumber - 2.0) + 1.0, 0), 9) AS guarded
       FROM lineitem""",
)
def safe_ratio(t):
    """Nine places: cents divided by 32 end on a rounding edge at six."""
    return t.lineitem.select(
        F.expr(LINE_ID).alias("line_id"),
        F.round(M.safe_ratio("l_extendedprice", "l_quantity"), 9).alias("ratio"),
        F.round(M.safe_ratio("l_quantity", F.col("l_linenumber") - 2), 9).alias("guarded"),
    )


@query("interactions", _sql(a_b="l_quantity * l_extendedprice", a_c="l_quantity * l_discount"))
def interactions(t):
    return _rows(t, a_b=M.interact("l_quantity", "l_extendedprice"), a_c=M.interact("l_quantity", "l_discount"))


@query(
    "abs_log",
    _sql(
        distance="abs(l_quantity - 25)",
        log_price="ln(l_extendedprice)",
        log_or_null="ln(CASE WHEN l_tax > 0 THEN l_tax END)",
        root="sqrt(l_quantity)",
    ),
)
def abs_log(t):
    return _rows(
        t,
        distance=F.abs(F.col("l_quantity") - 25),
        log_price=M.log_or_null("l_extendedprice"),
        log_or_null=M.log_or_null("l_tax"),
        root=F.sqrt("l_quantity"),
    )


@query(
    "row_extreme",
    _sql(
        hi="greatest(l_quantity, CAST(l_linenumber AS DOUBLE), nullif(l_discount, 0))",
        lo="least(l_quantity, CAST(l_linenumber AS DOUBLE), nullif(l_discount, 0))",
    ),
)
def row_extreme(t):
    cells = [F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.nullif(F.col("l_discount"), F.lit(0.0))]
    return _rows(t, hi=M.row_max(cells), lo=M.row_min(cells))


@query(
    "array_affine",
    f"""SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos,
              round(CAST(embedding[i] AS DOUBLE) * {2 / 255} - 1, 6) AS x
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def array_affine(t):
    scaled = t.embeddings.select("vec_id", M.array_affine("embedding", 2 / 255, -1.0).alias("e"))
    return scaled.select("vec_id", F.posexplode("e").alias("pos", "x")).withColumn("x", r6("x"))


@query(
    "weight_columns",
    f"""SELECT {LINE_ID} AS line_id, l_quantity * 8.0 AS l_quantity, l_extendedprice AS l_extendedprice,
              round(l_discount * 400.0, 6) AS l_discount, round(l_tax * 400.0, 6) AS l_tax
       FROM lineitem""",
)
def weight_columns(t):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    done = M.weight_columns(cols, {"l_quantity": 8.0}, {"disc": 400.0, "tax": 400.0})
    return _rows(t, **done)


@query(
    "flatten_array",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(CAST(embedding[i] AS DOUBLE), 6) AS x
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def flatten_array(t):
    """Vectors are cut into rows of a small image first, then laid flat again."""
    e = F.col("embedding")
    image = F.array(*[F.slice(e, start, 16) for start in range(1, 65, 16)])
    flat = t.embeddings.select("vec_id", M.flatten_array(image).alias("e"))
    return flat.select("vec_id", F.posexplode("e").alias("pos", "x")).withColumn("x", r6(F.col("x").cast("double")))


