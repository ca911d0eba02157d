"""E1-E6, X1-X4."""

from pyspark.sql import functions as F

from tabforge.functions import encode as E
from tabforge.operators import encoders as EN
from tabforge.operators.split import train_test
from tabforge.queries.registry import part_sql, query

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WORDS = [
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod",
    "small", "widget",
]

PHRASES_SQL = """phrases AS (
  SELECT doc_id, [x for x in [trim(y, ' \t') for y in regexp_split_to_array(text, '[\\n\\r]|[.,\\-0-9]+')]
                  if x <> ''] AS ph
  FROM documents)"""


def _type_flags(t):
    flags = E.one_hot("p_type", TYPES[:4], "is")
    return t.part.select("p_partkey", *[c.alias(n) for n, c in flags.items()]), list(flags)


@query(
    "label_encode",
    """SELECT p_partkey, CAST(coalesce(code, -1) AS INTEGER) AS code FROM part
       LEFT JOIN (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code
                  FROM (SELECT DISTINCT nullif(p_type, 'PROMO') AS p_type FROM part) WHERE p_type IS NOT NULL)
       USING (p_type)""",
)
def label_encode(t):
    rows = t.part.select("p_partkey", F.nullif(F.col("p_type"), F.lit("PROMO")).alias("p_type"))
    return EN.label_encode(rows, "p_type", "code").drop("p_type")


@query(
    "onehot_to_index",
    f"""SELECT p_partkey, CAST(coalesce(list_position({TYPES[:4]!r}, p_type), 0) AS BIGINT) AS idx,
               p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') AS one_set
        FROM part""",
)
def onehot_to_index(t):
    """Four of six types have a flag, so rows without any occur and get 0."""
    flags, names = _type_flags(t)
    return flags.select("p_partkey", E.onehot_to_index(names).alias("idx"), E.exactly_one(names).alias("one_set"))


@query(
    "onehot_to_bitmask",
    """SELECT p_partkey, CAST(CASE p_type WHEN 'ECONOMY' THEN 8 WHEN 'LARGE' THEN 4 WHEN 'MEDIUM' THEN 2
                                    WHEN 'PROMO' THEN 1 ELSE 0 END AS BIGINT) AS mask
       FROM part""",
)
def onehot_to_bitmask(t):
    flags, names = _type_flags(t)
    return flags.select("p_partkey", E.onehot_to_bitmask(names).alias("mask"))


@query(
    "row_argmax",
    """SELECT vec_id, CAST(list_position(e, list_max(e)) - 1 AS INTEGER) AS best
       FROM (SELECT vec_id, embedding[1:4] AS e FROM embeddings)""",
)
def row_argmax(t):
    cells = t.embeddings.select("vec_id", *[F.col("embedding")[i].alias(f"p{i}") for i in range(4)])
    return cells.select("vec_id", E.row_argmax(["p0", "p1", "p2", "p3"]).alias("best"))


@query(
    "one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"pri_{p}\"" for p in PRIORITIES)
    + " FROM orders",
)
def one_hot(t):
    return t.orders.select(
        "o_orderkey", *[c.alias(n) for n, c in E.one_hot("o_orderpriority", PRIORITIES, "pri").items()]
    )


@query(
    "onehot_counts",
    " UNION ALL ".join(
        f"""SELECT 'pri_{p}' AS col, count(*) FILTER (NOT test) AS n_train, count(*) FILTER (test) AS n_test
            FROM (SELECT {part_sql("o_orderkey", 3, "4ccccccd")} AS test FROM orders WHERE o_orderpriority = '{p}')"""
        for p in PRIORITIES
    ),
)
def onehot_counts(t):
    flags = one_hot(t)
    train, test = train_test(flags, "o_orderkey", 0.3, seed=3)
    return EN.onehot_counts(train, test, [c for c in flags.columns if c != "o_orderkey"])


@query(
    "split_phrases",
    f"""WITH {PHRASES_SQL}
        SELECT doc_id, CAST(len(ph) AS INTEGER) AS n, md5(array_to_string(ph, '|')) AS digest FROM phrases""",
)
def split_phrases(t):
    ph = E.split_phrases("text")
    return t.documents.select("doc_id", F.size(ph).alias("n"), F.md5(F.array_join(ph, "|")).alias("digest"))


@query("phrase_vocab", f"WITH {PHRASES_SQL} SELECT DISTINCT unnest(ph) AS phrase FROM phrases")
def phrase_vocab(t):
    return EN.vocabulary(t.documents.select(E.split_phrases("text").alias("ph")), "ph")


@query(
    "phrase_matrix",
    "SELECT p_partkey, "
    + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER) AS has_{w}" for w in WORDS)
    + " FROM part",
)
def phrase_matrix(t):
    words = E.split_phrases("p_name", " ")
    return t.part.select("p_partkey", *[c.alias(n) for n, c in E.phrase_matrix(words, WORDS).items()])


@query(
    "phrase_pairs",
    f"WITH {PHRASES_SQL} SELECT DISTINCT doc_id, unnest(ph) AS phrase FROM phrases",
)
def phrase_pairs(t):
    return EN.phrase_pairs(t.documents.select("doc_id", E.split_phrases("text").alias("ph")), "doc_id", "ph")


@query(
    "keyword_flags",
    f"""WITH {PHRASES_SQL}
        SELECT doc_id, CAST(len([p for p in ph if contains(p, 'the')]) > 0 AS INTEGER) AS english,
               CAST(len([p for p in ph if contains(p, 'eau')]) > 0 AS INTEGER) AS french,
               CAST(len([p for p in ph if contains(p, 'ung')]) > 0 AS INTEGER) AS german
        FROM phrases""",
)
def keyword_flags(t):
    flags = E.keyword_flags("ph", {"english": "the", "french": "eau", "german": "ung"})
    phrases = t.documents.select("doc_id", E.split_phrases("text").alias("ph"))
    return phrases.select("doc_id", *[c.alias(n) for n, c in flags.items()])
