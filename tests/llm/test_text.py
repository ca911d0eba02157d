"""Languages, tokens, quality, mixing and packing against brute force, with odd rows."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabforge.llm import langid, mixing, packing, perplexity, tokencount, vocab

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"
PARTS = [
    "a", "Zoo", " ", "  ", "\n", " \n", "\t", ".", ",", "'s", "'", "e\u0301", "T\u0308", "É", "<|endoftext|>",
    "<|startoftext|>", "<|", "\x1c", "\x85", "İ", "ΑΣ", " the", "23", "日本", "\u200b", "!!", "foo.", "Bar,", "\r\n",
    "\x00", "😀", "\u00a0", "\u3000", "½", "\u0345",
]


def odd_texts(n=3000):
    rnd = random.Random(1)
    return ["".join(rnd.choices(PARTS, k=rnd.randint(0, 14))) for _ in range(n)] + ["", " ", "lorem ipsum. " * 30_000]


def test_token_counts(spark):
    texts = [*odd_texts(), None, None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    found = {r.doc_id: tuple(r)[1:] for r in tokencount.count_tokens(df.repartition(3), WORD, 100).collect()}
    library = Tokenizer.from_file(WORD)
    want = [len(e) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert found == {i: (len((t or "").encode()), n, n > 100) for i, (t, n) in enumerate(zip(texts, want))}
    assert tokencount.count_tokens(df.limit(0), WORD, 100).collect() == []


@pytest.mark.parametrize("generation", [10, 300_000])
def test_token_memory(monkeypatch, generation):
    """Forgetting pieces and cutting long texts change nothing."""
    monkeypatch.setattr(vocab, "GENERATION", generation)
    monkeypatch.setattr(vocab, "BATCH_BYTES", 200)
    texts = odd_texts(500)
    encoded = Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)
    assert vocab.TokenCounter(WORD).counts(texts) == [len(e) for e in encoded]
    encoded = Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)
    found = vocab.TokenIds(BYTE, RANKS).ids(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [e.ids for e in encoded]


def packed_rows(spark, texts, capacity):
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int").repartition(3)
    return packing.pack(df, BYTE, RANKS, capacity).collect()


def test_packing(spark):
    texts = [(i, t) for i, t in enumerate(odd_texts(400))] + [(-1, None), (-2, "same"), (-2, "same"), (None, "no key")]
    rows = packed_rows(spark, texts, 64)
    library = Tokenizer.from_file(BYTE)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want = [(n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        times = sum(x == i for x, _ in texts)
        assert sorted(pieces[i]) == sorted(want * times)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64
    assert len(ends) <= -(-sum(r.length for r in rows) // 64) * 1.05 + 1
    assert packed_rows(spark, [], 64) == []


def brute_knapsack(prices, capacity):
    best = [0.0] * (capacity + 1)
    for size in range(1, capacity + 1):
        best[size] = max([best[size - 1]] + [prices[k] + best[size - k] for k in range(1, size + 1) if prices[k] > 0])
    return best[capacity]


def test_configurations():
    rng = np.random.default_rng(1)
    for _ in range(20):
        prices = np.concatenate([[0.0], rng.random(30) * (rng.random(30) < 0.4)])
        config = packing.best_configuration(prices, 30)
        assert config.sum() <= 30 and np.isclose(prices[config].sum(), brute_knapsack(prices, 30))


@pytest.mark.parametrize("counts", [{5: 40, 3: 60, 2: 200}, {10: 3}, {1: 1}, {6: 500, 4: 500, 7: 100, 3: 100}, {}])
def test_plans_hold_every_piece_once(counts):
    plan = packing.plan_sequences(counts, 10)
    held, fill = {}, {}
    for length, rank, often, sequence, offset in zip(*plan.values()):
        times = 1
        nxt = [r for k, r in zip(plan["length"], plan["rank"]) if k == length and r > rank]
        stop = min(nxt, default=counts[length])
        times = (stop - rank) // often
        for r in range(rank, stop):
            place = (sequence + (r - rank) % often, offset + (r - rank) // often * length)
            assert (length, r) not in held and place not in fill
            held[(length, r)] = place
            fill[place] = length
        assert times * often == stop - rank
    assert len(held) == sum(counts.values())
    used = {}
    for (s, o), length in sorted(fill.items()):
        assert used.get(s, 0) == o
        used[s] = o + length
    assert max(used.values(), default=0) <= 10
    if counts == {6: 500, 4: 500, 7: 100, 3: 100}:
        assert len(used) == 600  # no waste is needed


def rare_lengths(n, spread, top):
    rng = np.random.default_rng(3)
    return np.bincount(np.clip(600 * np.exp(rng.normal(0, spread, n)), 1, top).astype(int), minlength=2049)


@pytest.mark.parametrize("counts", [rare_lengths(1200, 0.8, 2048), rare_lengths(4000, 1.0, 2048), rare_lengths(40_000, 1.2, 1500)])
def test_program_places_nearly_all_pieces(monkeypatch, counts):
    """Lengths of few pieces enter the program too; best fit gets what is left."""
    best_fit, left = packing.best_fit, []
    monkeypatch.setattr(packing, "best_fit", lambda c, n: (left.append(int(c.sum())), best_fit(c, n))[1])
    plan = packing.plan_sequences({k: int(n) for k, n in enumerate(counts) if n}, 2048)
    sequences = (plan["sequence"] + plan["often"]).max()
    assert min(left) < 0.1 * counts.sum()
    assert -(-(counts * np.arange(2049)).sum() // 2048) <= sequences <= sum(often for _, often in best_fit(counts, 2048))


@pytest.mark.parametrize("counts, want", [({1100: 1000, 700: 800, 300: 500}, 1000), ({690: 3000, 900: 3000}, 3000), ({500: 9, 600: 90}, 33)])
def test_bound_of_the_program(counts, want):
    """Where sizes do not fill a sequence, the prices prove how many are needed, and the plan has no more."""
    dense = np.zeros(2049, np.int64)
    for length, n in counts.items():
        dense[length] = n
    bound, prices = packing.cover_prices(dense, 2048, want)
    assert prices[packing.best_configuration(prices, 2048)].sum() <= 1 + 1e-9
    assert np.isclose(bound, (prices * dense).sum()) and want - 1 < bound <= want + 1e-6
    assert sum(often for _, often in packing.cover(dense, 2048)) == want


def mix_rows():
    rnd = random.Random(4)
    rows = [(i, "w " * rnd.randint(0, 50), rnd.choice(["a", "b", "é", "hot", "hot", "hot", None]), 7) for i in range(3000)]
    return rows + [(5000, None, "nothing", 7), (5001, "tiny", "A", 7), (None, "x y", "a", 7), (7, "x y", "b", 7), (7, "x y", "b", 7)]


def water_levels(sizes, cap):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level >= cap * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: float(cap * sizes[s]) for s in over}


def test_mixing(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int").repartition(4)
    plan = mixing.plan_mix(df).collect()
    assert len(plan) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = water_levels(sizes, 3), {}
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, n in taken.items():
        assert n == pytest.approx(want[s], rel=0.15)
    again = mixing.plan_mix(df.repartition(9)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan))
    copies = mixing.mix(df, copy="nth")
    assert copies.columns == [*df.columns, "nth"]
    assert copies.count() == sum(r.copies for r in plan) == mixing.mix(df).count()
    assert mixing.mix(df.limit(0)).collect() == [] == mixing.plan_mix(df.limit(0)).collect()


def test_language_held_out(spark):
    docs = spark.read.parquet(DOCUMENTS).withColumn("held", langid.held_out("doc_id"))
    model = langid.fit(docs.where("NOT held"))
    found = langid.predict(docs.select("doc_id", "text", "lang", "held", F.lit(1).alias("score")), model).where("held")
    rows = found.collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_pieces(monkeypatch):
    """Pieces of any size give the n-grams of the whole text: letters lower-cased, one space for all else, a space around."""
    rnd = random.Random(1)
    parts = ["a", "B", " ", "  ", "1", "é", "\n", "日", "xxxxx", "İ", "ß."]
    for _ in range(200):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 20)))
        monkeypatch.setattr(langid, "PIECE", 1 << 20)
        want = sorted(langid.gram_buckets(text).tolist())
        low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
        plain = re.sub(" +", " ", f" {low} ")
        assert len(want) == (sum(c != " " for c in plain) + 2 * len(plain) - 3 if len(plain) > 1 else 0)
        for piece in (1, 2, 3, 7):
            monkeypatch.setattr(langid, "PIECE", piece)
            assert sorted(langid.gram_buckets(text).tolist()) == want


def test_language_scores(spark, monkeypatch):
    """The posterior of the best language, whether texts are scored together or one n-gram block at a time."""
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text", "lang").where("doc_id % 40 = 0").cache()
    languages, logs = langid.fit(docs)
    for size in (1 << 18, 500):
        monkeypatch.setattr(langid, "BLOCK_GRAMS", size)
        found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, (languages, logs)).collect()}
        for r in docs.collect():
            total = logs[langid.gram_buckets(r.text or "")].sum(0)
            want = 1 / np.exp(total - total.max()).sum()
            assert found[r.doc_id][0] == languages[int(total.argmax())] and abs(found[r.doc_id][1] - want) < 1e-9


def test_language_by_hand(spark):
    """Counts and scores as the formula says."""
    train = [(1, "ab ab", "x"), (2, "Ba!", "y"), (3, "zz", None), (4, None, "x"), (5, "", "y")]
    languages, logs = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert languages == ["x", "y"]
    counts = np.ones((1 << langid.BUCKET_BITS, 2))
    for _, text, lang in train:
        for b in langid.gram_buckets(text or "") if lang else ():
            counts[b, languages.index(lang)] += 1
    assert np.allclose(logs, np.log(counts / counts.sum(0)))
    rows = [(1, "ab"), (2, "BA"), (3, None), (4, "12 !?"), (5, ""), (6, "ab " * 500_000), (7, "\u00aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, (languages, logs)).collect()}
    assert [found[i][0] for i in range(1, 7)] == ["x", "y", "und", "und", "und", "x"] and found[7][0] != "und"
    assert found[3][1] == 0.0
    nothing = langid.fit(df.limit(0).withColumn("lang", F.lit("x")))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}
    assert langid.predict(df.limit(0), (languages, logs)).collect() == []


def grams(text, order):
    codes = [0] * (order - 1) + [int(perplexity.FOLD[ord(c)]) for c in text]
    return [tuple(codes[i : i + order]) for i in range(len(codes) - order + 1)]


def slow_model(texts):
    """Interpolated modified Kneser-Ney with dictionaries."""
    top = perplexity.ORDER
    counts = {top: {}}
    for t in texts:
        for g in grams(t, top):
            counts[top][g] = counts[top].get(g, 0) + 1
    for order in range(top - 1, 0, -1):
        counts[order] = {}
        for g in counts[order + 1]:
            counts[order][g[1:]] = counts[order].get(g[1:], 0) + 1
    rates = {}
    for order, c in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in range(1, 5))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [k + 1 - (k + 2) * y * b / a if a and b else (k + 1) / 2 for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)))]
        rates[order] = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]

    def p(g):
        order = len(g)
        below = p(g[1:]) if order > 1 else 2.0**-perplexity.SYMBOL_BITS
        same = {h: n for h, n in counts[order].items() if h[:-1] == g[:-1]}
        if not same:
            return below
        cut = lambda n: rates[order][min(n, 3) - 1]
        total, n = sum(same.values()), same.get(g, 0)
        return ((n - cut(n)) if n else 0) / total + sum(map(cut, same.values())) / total * below

    return p


def test_perplexity_by_hand(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log 12", "a cat  and\ta dog", "", "日本 the"]
    docs = [(i, t, "en", "x") for i, t in enumerate(texts)] + [(9, None, None, "x"), (10, "THE QUEER!! cat 99", None, "x")]
    labels = [(i, 1, 0) for i in range(40)] + [(10, 0, 0), (None, 1, 0), (1, 1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, kept string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = {r._key for r in perplexity.trusted_keys(marks, "doc_id").where("_held").collect()}
    p = slow_model([t or "" for i, t, *_ in docs if i < 10 and i not in held])
    rows = {r.doc_id: r for r in perplexity.judge(df, marks, carry=["text"]).collect()}
    assert len(rows) == len(docs)
    for i, t, *_ in docs:
        if not t:
            assert rows[i].perplexity is None and rows[i].kept
            continue
        logs = [np.log(p(g)) for g in grams(t, perplexity.ORDER)]
        assert rows[i].perplexity == pytest.approx(np.exp(-np.mean(logs)), rel=1e-4)
        assert rows[i].n_symbols == len(t)
    narrow = {r.doc_id: r.perplexity for r in perplexity.judge(df, marks).collect()}
    assert narrow == {i: r.perplexity for i, r in rows.items()}


def test_quality_shards_and_empty(spark, monkeypatch):
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text", "lang")
    labels = spark.read.parquet(DOCUMENTS.replace("documents", "labels"))
    one = {r.doc_id: r.perplexity for r in perplexity.judge(docs, labels).collect()}
    monkeypatch.setattr(perplexity, "SHARD_ROWS", 30_000)
    monkeypatch.setattr(perplexity, "MAX_KEYS", 10)
    rows = perplexity.judge(docs, labels).join(labels.groupBy("doc_id").agg(F.min("quality").alias("q")), "doc_id", "left").collect()
    assert {r.doc_id: r.perplexity for r in rows} == pytest.approx(one, rel=1e-5)
    good, bad = ([r.kept for r in rows if r.q == q] for q in (1, 0))
    assert np.mean(good) > 0.85 and np.mean(bad) < 0.2
    assert perplexity.judge(docs.limit(0), labels).collect() == []
    assert all(r.kept for r in perplexity.judge(docs.limit(20), labels.limit(0)).collect())


def test_thresholds_of_few_documents(spark):
    """Of unseen documents like the trusted ones few are rejected, however few trusted ones are held out."""
    labels = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    held = [r._key for r in perplexity.trusted_keys(labels, "doc_id").where("_held").collect()]
    rng = np.random.default_rng(8)
    sizes = {f"{n}-{i}": n for n in (1, 2, 4, 40) for i in range(30)}
    centres = {k: rng.normal(3, 1) for k in sizes}
    draw = lambda k: float(np.exp(centres[k] + 0.2 * rng.normal()))
    names = [k for k, n in sizes.items() for _ in range(n)]
    rows = [(i, k, draw(k)) for i, k in zip(held, names, strict=False)]
    assert len(rows) == len(names)
    scored = spark.createDataFrame(rows, "doc_id long, lang string, perplexity double")
    limits = perplexity.thresholds(scored, labels, 0.995, "doc_id", "lang")
    for n in (1, 2, 4, 40):
        gone = [draw(k) > limits[k] for k in sizes if sizes[k] == n for _ in range(200)]
        assert np.mean(gone) < 0.015
    unknown = spark.createDataFrame([(1, "unlabelled", 1e6), (2, "2-0", 1e6)], scored.schema)
    judged = {r.doc_id: (r.threshold is None, r.kept) for r in perplexity.classify(unknown, limits).collect()}
    assert judged == {1: (True, True), 2: (False, False)}


def test_word_counts(spark):
    texts = ["a b", "", None, " \n\t", "\x1ca\x0bb\u00a0c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(mixing.word_count("text")).collect()]
    assert found == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
