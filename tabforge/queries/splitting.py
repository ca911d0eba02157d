"""T1-T7."""

from tabforge.operators import split as S
from tabforge.queries.registry import part_sql, query

_HASH = "md5(concat_ws(':', {k}, '{s}'))"


@query(
    "hash_split",
    f"""SELECT o_orderkey, CASE WHEN {part_sql('o_orderkey', 1, '547ae148')} THEN 'test' ELSE 'train' END AS split
        FROM orders""",
)
def hash_split(t):
    return S.hash_split(t.orders.select("o_orderkey"), "o_orderkey", 0.33, seed=1)


@query(
    "stratified_split",
    f"""SELECT event_id, event_type,
          CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY {_HASH.format(k='event_id', s=2)}) - 1
                    < floor(count(*) OVER (PARTITION BY event_type) * 0.3 + 0.5)
               THEN 'test' ELSE 'train' END AS split
        FROM events""",
)
def stratified_split(t):
    return S.stratified_split(t.events.select("event_id", "event_type"), "event_id", "event_type", 0.3, seed=2)


@query(
    "split_report",
    f"""WITH s AS (SELECT event_type, CASE WHEN {part_sql('event_id', 2, '33333333')} THEN 'test' ELSE 'train' END
                     AS split FROM events),
             c AS (SELECT split, event_type, count(*) AS n_rows FROM s GROUP BY ALL)
        SELECT split, event_type, n_rows, n_rows / CAST(sum(n_rows) OVER (PARTITION BY split) AS DOUBLE) AS share
        FROM c""",
)
def split_report(t):
    parts = S.stratified_split(t.events.select("event_id", "event_type"), "event_id", "event_type", 0.2, 2, exact=False)
    return S.split_report(parts, "event_type")


@query("kfold_assign", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders")
def kfold_assign(t):
    return S.kfold(t.orders.select("o_orderkey"), "o_orderkey", 7, how="blocks")


@query(
    "kfold_hash",
    f"""SELECT o_orderkey,
          CAST(CAST('0x' || substr({_HASH.format(k='o_orderkey', s=5)}, 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
        FROM orders""",
)
def kfold_hash(t):
    return S.kfold(t.orders.select("o_orderkey"), "o_orderkey", 5, how="hash", seed=5)


@query(
    "stratified_kfold",
    f"""SELECT event_id, CAST((row_number() OVER (PARTITION BY event_type
          ORDER BY {_HASH.format(k='event_id', s=4)}) - 1) % 11 AS INTEGER) AS fold FROM events""",
)
def stratified_kfold(t):
    folds = S.stratified_kfold(t.events.select("event_id", "event_type"), "event_id", "event_type", 11, seed=4)
    return folds.drop("event_type")


@query(
    "shuffle_rank",
    f"SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH.format(k='o_orderkey', s=6)}) - 1 AS pos FROM orders",
)
def shuffle_rank(t):
    return S.shuffle(t.orders.select("o_orderkey"), "o_orderkey", seed=6)


@query("hash_sample", f"SELECT event_id, value FROM events WHERE {part_sql('event_id', 8, '051eb852')}")
def hash_sample(t):
    return S.hash_sample(t.events.select("event_id", "value"), "event_id", 0.02, seed=8)


@query(
    "cap_rows",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_HASH.format(k='o_orderkey', s=9)} LIMIT 1000",
)
def cap_rows(t):
    """The cap on training rows is the operator itself."""
    return S.cap_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 1000, seed=9)
