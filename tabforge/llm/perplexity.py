"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are characters (digits count as 0, any white space as a space); characters from U+0F00 up share 256 symbols. The
model has runs of up to five symbols. Its counts are gathered from all trusted documents, added up in each task before
the shuffle, and all probabilities come from joins of count tables on runs and their parts, sharded by Spark: for every
run that occurs in the corpus, seen in training or not, one row with its probability. This table is broadcast in shards
of bounded size, one pass over the texts for each shard, so texts are not shuffled for scoring. Documents whose perplexity
is above the quantile of trusted documents of their language, which the model has not seen, are rejected. Where a
language has few of these, a limit from their mean and spread takes the quantile's place if it is higher.

Cases: a null or empty text has no symbols, a null perplexity, and is kept; a null language is a language of its own; of
a language without held-out trusted documents nothing is rejected, nor of any if none has two of them, as no spread is
known, and the threshold is null; keys that repeat are trusted if any label says so; labels with null key, or in conflict
(a quality 0 beside a 1, or toxic), are not trusted; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.runtime import bounded_rows, cut_lineage

ORDER = 5
SYMBOL_BITS = 12
OWN = 0xF00  # characters below have a symbol of their own
START = 0  # before the first character
TOP = SYMBOL_BITS * (ORDER - 1)
CHUNK = 1 << 19  # characters counted or scored together
MERGED = 1 << 20  # counts of chunks that wait to be merged
SHARD_ROWS = 4_000_000  # runs in a broadcast: 64 MB
MAX_KEYS = 8_000_000  # trusted keys in a broadcast: 64 MB
HELD_OUT = 8  # one trusted document in so many is kept from the counts and sets the thresholds
MAX_LANGUAGES = 10_000
QUANTILE = 0.995
ENOUGH = 1000  # held-out documents of a language whose quantile is taken as it is
PRIOR = 10  # documents that the spread within all languages counts for
ACCURACY = 100_000  # of percentile_approx: rank error 1 / ACCURACY


def _fold() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    table[OWN:] = OWN + table[OWN:] % 256
    table[[c for c in range(0x3001) if chr(c).isspace()]] = 32
    table[ord("0") : ord("9") + 1] = ord("0")
    table[0] = 1  # a null character is not the start mark
    return table


FOLD = _fold()


def runs_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ORDER symbols that end at each character, all texts one after the other, and the texts' lengths."""
    pad = np.zeros(ORDER - 1, np.uint32)
    parts = [FOLD[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)] for t in texts]
    codes = np.concatenate([x for p in parts for x in (pad, p)]).astype(np.int64)
    lengths = np.array([len(p) for p in parts], np.int64)
    runs = codes[ORDER - 1 :].copy()
    for i in range(1, ORDER):
        runs |= codes[ORDER - 1 - i : len(codes) - i] << (SYMBOL_BITS * i)
    starts = np.cumsum(lengths + ORDER - 1) - (lengths + ORDER - 1)
    keep = np.repeat(starts, lengths) + (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths))
    return runs[keep], lengths


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of about CHUNK characters."""
    start, size, chunk = 0, 0, []
    for i, text in enumerate(texts):
        if chunk and size + len(text) > CHUNK:
            yield start, chunk
            start, size, chunk = i, 0, []
        chunk.append(text)
        size += len(text)
    if chunk:
        yield start, chunk


def _merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different runs of several counts, and their sums."""
    runs, at = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
    return runs, np.bincount(at, np.concatenate([c[1] for c in counts]), len(runs)).astype(np.int64)


def run_counts(df: DataFrame, text: str, key: str | None = None, keys=None) -> DataFrame:
    """``run`` and ``n`` over all rows, or over those whose ``key`` is in the broadcast sorted array ``keys``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        runs, sums, waiting, size = none, none, [], 0
        for batch in batches:
            if keys is not None:
                batch = batch.filter(pa.array(np.isin(batch.column(1).to_numpy(zero_copy_only=False), keys.value)))
            for _, chunk in _chunks([t or "" for t in batch.column(0).to_pylist()]):
                waiting.append(np.unique(runs_of(chunk)[0], return_counts=True))
                size += len(waiting[-1][0])
                if size > MERGED:
                    runs, sums = _merged([(runs, sums), *waiting])
                    waiting, size = [], 0
                    if len(runs) > SHARD_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(sums)], ["run", "n"])
                        runs, sums = none, none
        runs, sums = _merged([(runs, sums), *waiting])
        yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(sums)], ["run", "n"])

    columns = [f"`{text}`"] if keys is None else [f"`{text}`", f"`{key}`"]
    parts = df.select(*columns).mapInArrow(count, "run long, n long")
    return parts.groupBy("run").agg(F.sum("n").alias("n"))


def _shorter(order: int) -> Column:
    """A run without its first symbol."""
    return F.col("run").bitwiseAND(F.lit((1 << (SYMBOL_BITS * (order - 1))) - 1))


def _context() -> Column:
    """A run without its last symbol."""
    return F.shiftright("run", SYMBOL_BITS)


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ from the numbers of runs seen once to four times."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] or 0 for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [k + 1 - (k + 2) * y * b / a if a and b else 0.5 * (k + 1) for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)))]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


def probabilities(trained: DataFrame, wanted: DataFrame) -> DataFrame:
    """``run`` and ``logp`` for every run in ``wanted``, by the interpolated recursion from one symbol to ORDER.

    Counts below the highest order are continuation counts: in how many different longer runs a run ends.
    """
    counts, runs = {ORDER: trained}, {ORDER: wanted}
    for order in range(ORDER, 1, -1):
        shorter = _shorter(order).alias("run")
        counts[order - 1] = cut_lineage(counts[order].groupBy(shorter).agg(F.count(F.lit(1)).alias("n")))
        runs[order - 1] = runs[order].select(shorter).distinct()
    lower = None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counts[order])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = counts[order].groupBy(_context().alias("_context")).agg(
            F.sum("n").alias("_total"), (F.sum(discount) / F.sum("n")).alias("_free")
        )
        rows = runs[order].join(counts[order], "run", "left").withColumn("_context", _context())
        rows = rows.join(contexts, "_context", "left").withColumn("_own", (F.col("n") - discount) / F.col("_total"))
        below = F.lit(2.0**-SYMBOL_BITS)
        if lower is not None:
            rows = rows.withColumn("_shorter", _shorter(order)).join(lower, "_shorter")
            below = F.col("_below")
        p = F.coalesce("_own", F.lit(0.0)) + F.coalesce("_free", F.lit(1.0)) * below
        lower = cut_lineage(rows.select(F.col("run").alias("_shorter"), p.alias("_below")))
    return lower.select(F.col("_shorter").alias("run"), F.log("_below").cast("float").alias("logp"))


class Lookup:
    """Values by run: a table of direct places, and a search for those that share a place with another."""

    def __init__(self, runs: np.ndarray, values: np.ndarray):
        order = np.argsort(runs)
        self.runs, self.values = runs[order], values[order]
        self.shift = np.uint64(64 - max(4, (2 * max(1, len(runs))).bit_length()))
        self.place = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.place[self._slot(self.runs)] = np.arange(len(runs))

    def _slot(self, runs: np.ndarray) -> np.ndarray:
        return (runs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, runs: np.ndarray) -> np.ndarray:
        """Values, 0 for unknown runs."""
        if not len(self.runs):
            return np.zeros(len(runs))
        at = self.place[self._slot(runs)]
        other = np.flatnonzero(self.runs[at] != runs)
        at[other] = np.minimum(np.searchsorted(self.runs, runs[other]), len(self.runs) - 1)
        found = self.values[at].astype(np.float64)
        found[other[self.runs[at[other]] != runs[other]]] = 0.0
        return found


def _add_scores(df: DataFrame, shard, text: str) -> DataFrame:
    """Adds to ``_sum`` what the runs of one shard are worth, and sets ``_symbols``."""
    names = df.columns
    at = [names.index(c) for c in (text, "_sum")]
    schema = T.StructType([*df.schema.fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(*shard.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at[0]).to_pylist()]
            sums = batch.column(at[1]).to_numpy().copy()
            symbols = np.array([len(t) for t in texts], np.int64)
            for start, chunk in _chunks(texts):
                runs, lengths = runs_of(chunk)
                total = np.concatenate([[0.0], np.cumsum(lookup(runs))])
                ends = np.cumsum(lengths)
                sums[start : start + len(chunk)] += total[ends] - total[ends - lengths]
            fields = {"_sum": pa.array(sums), "_symbols": pa.array(symbols)}
            yield pa.RecordBatch.from_arrays([fields.get(n, c) for n, c in zip(names, batch.columns)], names=names)

    return df.mapInArrow(score, schema)


class QualityModel:
    """A fitted table of log probabilities, in shards."""

    def __init__(self, shards: list):
        self.shards = shards

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``n_symbols`` and ``perplexity`` of each row. One pass for each shard, no shuffle."""
        scored = df.drop("n_symbols", "perplexity").withColumn("_sum", F.lit(0.0)).withColumn("_symbols", F.lit(0).cast("long"))
        for shard in self.shards:
            scored = _add_scores(scored, shard, text)
        perplexity = F.when(F.col("_symbols") > 0, F.exp(-F.col("_sum") / F.col("_symbols")))
        scored = scored.withColumn("perplexity", F.round(perplexity, 6))
        return scored.withColumnRenamed("_symbols", "n_symbols").drop("_sum")


def trusted_keys(labels: DataFrame, key: str) -> DataFrame:
    """Keys labelled good and never bad or toxic, and whether each is held out from the counts."""
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.min("quality").alias("_good"), F.max(F.coalesce("toxic", F.lit(0))).alias("_toxic")
    )
    held = F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(HELD_OUT)) == 0
    return good.where("_good = 1 AND _toxic = 0").select("_key", held.alias("_held"))


def trusted_counts(df: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """``run`` and ``n`` over all trusted documents that are not held out.

    Whole-number keys are broadcast after they were counted, so texts stay where they are; more than MAX_KEYS of them, or
    other keys, meet the texts in a join by shuffle.
    """
    counted = cut_lineage(trusted_keys(labels, key).where("NOT _held").select("_key"))
    whole = isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType))
    if whole and counted.count() <= MAX_KEYS:
        keys = np.sort(counted.select(F.col("_key").cast("long")).toArrow()["_key"].to_numpy())
        rows = df.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("long"))
        return run_counts(rows, text, key, df.sparkSession.sparkContext.broadcast(keys))
    return run_counts(df.select(key, text).join(counted, F.col(key) == F.col("_key"), "left_semi"), text)


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> QualityModel:
    """Counts over all trusted documents that are not held out, probabilities for all runs of ``df``."""
    trained = cut_lineage(trusted_counts(df, labels, key, text))
    table = probabilities(trained, cut_lineage(run_counts(df, text).select("run")))
    table = cut_lineage(table)
    shards = max(1, -(-table.count() // SHARD_ROWS))
    context = df.sparkSession.sparkContext
    broadcasts = []
    for i in range(shards):
        part = table if shards == 1 else table.where(F.pmod(F.xxhash64("run"), F.lit(shards)) == i)
        arrow = part.toArrow()
        broadcasts.append(context.broadcast((arrow["run"].to_numpy(), arrow["logp"].to_numpy())))
    return QualityModel(broadcasts)


def student_quantile(quantile: float, freedom: float) -> float:
    """Quantile above a half of Student's distribution; the tangent of an angle whose density is a power of the cosine."""
    angles = (np.arange(1 << 18) + 0.5) * (np.pi / 2 / (1 << 18))
    shares = np.cumsum(np.cos(angles) ** (freedom - 1))
    return math.sqrt(freedom) * math.tan(angles[np.searchsorted(shares, (2 * quantile - 1) * shares[-1])])


def thresholds(scored: DataFrame, labels: DataFrame, quantile: float, key: str, lang: str) -> dict:
    """Threshold by language of the held-out trusted documents.

    Below ENOUGH documents the quantile is little more than their maximum, which an unseen document passes far too often.
    There the threshold is not below the limit for one more document that the mean and spread of logarithms give, the
    spread shrunk towards that within all languages.
    """
    held = trusted_keys(labels, key).where("_held")
    rows = scored.join(held, F.col(key) == F.col("_key"), "left_semi").where("perplexity IS NOT NULL")
    log = F.log("perplexity")
    own = rows.groupBy(F.col(lang).alias("lang")).agg(
        F.percentile_approx("perplexity", quantile, ACCURACY).alias("threshold"),
        F.count(F.lit(1)).alias("n"), F.avg(log).alias("mean"), F.var_pop(log).alias("spread"),
    )
    own = bounded_rows(own, MAX_LANGUAGES, "languages")
    freedom = sum(r["n"] - 1 for r in own)
    pooled = sum(r["n"] * r["spread"] for r in own) / freedom if freedom else 0.0
    prior, found = min(PRIOR, freedom), {}
    for r in own:
        if r["n"] >= ENOUGH:
            found[r["lang"]] = r["threshold"]
        elif freedom:
            free = r["n"] - 1 + prior
            deviation = math.sqrt((r["n"] * r["spread"] + prior * pooled) / free * (1 + 1 / r["n"]))
            limit = math.exp(min(700.0, r["mean"] + student_quantile(quantile, free) * deviation))
            found[r["lang"]] = max(r["threshold"], limit)
    return found


def classify(scored: DataFrame, limits: dict, lang: str = "lang") -> DataFrame:
    """``scored`` with ``threshold`` and ``kept``."""
    kind = scored.schema[lang].dataType.simpleString()
    table = scored.sparkSession.createDataFrame(list(limits.items()), f"_lang {kind}, threshold double")
    # A row for each language, MAX_LANGUAGES at most.
    rows = scored.drop("threshold", "kept").join(F.broadcast(table), F.col(lang).eqNullSafe(F.col("_lang")), "left")
    return rows.drop("_lang").withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def judge(
    df: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row's key, language and carried columns with ``n_symbols``, ``perplexity``, ``threshold`` and ``kept``.

    Scores without texts are written once for the thresholds. If texts are carried, they are scored again where they
    are read, which costs less than sending them through a join.
    """
    model = fit(df, labels, key, text)
    columns = list(dict.fromkeys([key, lang, *(carry or [])]))
    narrow = cut_lineage(model.score(df.select(key, lang, text), text).drop(text))
    limits = thresholds(narrow, labels, quantile, key, lang)
    if set(columns) <= {key, lang}:
        return classify(narrow, limits, lang)
    extra = [c for c in columns if c != text]
    scored = model.score(df.select(*[f"`{c}`" for c in extra], f"`{text}`"), text)
    return classify(scored if text in columns else scored.drop(text), limits, lang)
