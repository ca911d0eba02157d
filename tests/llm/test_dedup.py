"""Exact, near and passage duplicates against brute force, with odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tabforge.llm import components, exactdedup, runindex, simhash

DOCS = "doc_id long, text string, lang string, kept string, size int"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def odd_docs():
    rnd = random.Random(5)
    words = [rnd.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rnd.randint(0, 30)) for _ in range(300)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for i in range(80)]
    docs += [(100 + i, docs[3][1].replace(" ", "\t \n")) for i in range(30)]  # a hot group, blanks differ
    docs += [(200, None), (201, ""), (202, "  "), (203, " "), (204, docs[4][1]), (204, docs[4][1]), (None, docs[4][1])]
    docs += [(None, "only here"), (300, "x" * 200_000), (301, "x" * 200_000), (302, "é" * 64 + "a"), (303, "é" * 64 + "b")]
    return [(i, t, None, "clash", 1) for i, t in docs]


def test_exact_marks(spark):
    docs = odd_docs()
    found = exactdedup.mark_duplicates(spark.createDataFrame(docs, DOCS).repartition(7), carry=["lang"]).collect()
    groups = {}
    for i, t, *_ in docs:
        groups.setdefault(norm(t), []).append(i)
    best = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    want = sorted(((i, best[norm(t)], len(groups[norm(t)])) for i, t, *_ in docs), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == want
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_drop(spark):
    docs = odd_docs()
    df = spark.createDataFrame(docs, DOCS).repartition(7)
    left = exactdedup.drop_duplicates(df)
    assert left.columns == df.columns
    rows = left.collect()
    assert len(rows) == len({norm(t) for _, t, *_ in docs}) == len({norm(r.text) for r in rows})
    by_text = {norm(r.text): r.doc_id for r in rows}
    assert by_text[norm(docs[3][1])] == 3 and by_text[norm(docs[4][1])] == 4 and by_text["only here"] is None


def test_exact_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exactdedup.mark_duplicates(empty).collect() == [] and exactdedup.drop_duplicates(empty).collect() == []


def slow_print(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    pieces = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, distance):
    """Smallest key reachable, by comparing all."""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprint_is_spark_hash(spark):
    text = "A b\tÇd  e\nF g"
    row = spark.sql("SELECT xxhash64('a b Çd e') AS a, xxhash64('b Çd e f') AS b, xxhash64('Çd e f g') AS c").first()
    assert slow_print(text, 4) == sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in row) > 3)
    assert simhash.fingerprint(text, 4) == slow_print(text, 4)


def test_fingerprint_pieces(monkeypatch):
    rnd = random.Random(2)
    text = " ".join(rnd.choice(["aa", "b", "ccc", "d\n", "É"]) for _ in range(500))
    want = slow_print(text, 4)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        assert simhash.fingerprint(text, 4) == want
        assert simhash.fingerprint("one  two", 4) == slow_print("one two", 4)
    for text in ("", " \n", None, "x", "a b c", "a b c d"):
        assert simhash.fingerprint(text, 4) == slow_print(text, 4)


@pytest.mark.parametrize(("distance", "width"), [(4, 2), (9, 1)])
def test_near_duplicates(spark, distance, width):
    rnd = random.Random(7)
    docs = [(d[0] if d[0] is not None else 1000 + n, *d[1:]) for n, d in enumerate(odd_docs())]
    base = rnd.choices("one two three four five six seven eight nine ten".split(), k=400)
    for i in range(60):  # a hot group of near copies, all different
        words = list(base)
        words[rnd.randrange(400)] = f"w{i}"
        docs.append((2000 + i, " ".join(words), None, "x", 1))
    docs = list({d[0]: d for d in docs}.values())
    prints = {i: slow_print(t, 4) for i, t, *_ in docs}
    want = components_of(prints, distance)
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    found = simhash.near_duplicates(df, shingle=4, distance=distance, width=width)
    assert found.columns == ["doc_id", "lang", "kept", "size", "fingerprint", "component_id"]
    rows = found.collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == want
    left = simhash.drop_near_duplicates(df, shingle=4, distance=distance, width=width)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_near_links_are_all_found(spark):
    """Random fingerprints with planted distances 0 to 6; more groups must agree than by default."""
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 2**63, 150, dtype=np.int64)]
    for p in list(prints):
        for flips in (3, 4, 5):
            prints.append(p ^ sum(1 << int(b) for b in rng.choice(63, flips, replace=False)))
    want = components_of({p: p for p in prints}, 4)
    for width in (1, 2):
        df = spark.createDataFrame([(p,) for p in prints], "fp long")
        roots = {}
        for r in simhash.classes(df, 4, width).collect():
            roots.setdefault(r.root, set()).add(r.fp)
        assert sorted(map(sorted, roots.values())) == sorted(
            sorted(p for p in set(prints) if want[p] == w) for w in set(want.values())
        )


def test_near_odd_keys(spark):
    rows = [(None, "a b"), (None, "q r s"), (5, "a b"), (5, "zz"), (4, "zz"), (6, None), (7, "")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4, distance=0).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == sorted(
        [(None, 5), (None, None), (5, 5), (5, 4), (4, 4), (6, 6), (7, 6)], key=repr
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.drop_near_duplicates(empty).collect() == []


def test_near_dedup_stage(spark):
    """The pipeline's stage keeps one document of each class of linked fingerprints, whole and with all columns."""
    docs = [(i, t) for i, t in dict((d[0], d[1]) for d in odd_docs()).items() if i is not None]
    prints = {i: slow_print(t, 4) for i, t in docs}
    want = components_of(prints, 4)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, source string").repartition(4)
    left = corpus_pipeline.without_near_copies(spark, df, "")
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted((i, t) for i, t in docs if want[i] == i)


@pytest.mark.parametrize("local", [0, 20, 500_000])
def test_components_of_paths_and_stars(spark, monkeypatch, local):
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(7000, 7000)]
    found = components.connected(spark.createDataFrame(edges * 2, "a long, b long").repartition(4))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [201, 301]
    assert components.connected(spark.createDataFrame([(1, 1)], "a long, b long")) is None


def slow_removal(docs, size):
    first = {}
    for key, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - size + 1) if key is not None else ():
            w = data[i : i + size]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1) if key is not None else ():
            if first[data[i : i + size]] < key:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rnd = random.Random(3)
    shared = ["".join(rnd.choice("abcd é") for _ in range(rnd.randint(40, 200))) for _ in range(12)]
    docs = []
    for _ in range(150):
        parts = [
            rnd.choice([rnd.choice(shared), "".join(rnd.choices("abcdefgh ", k=rnd.randint(0, 60))),
                        rnd.choice(shared)[rnd.randint(0, 30) : rnd.randint(60, 200)], "ab" * rnd.randint(1, 60)])
            for _ in range(rnd.randint(0, 6))
        ]
        docs.append((rnd.randint(0, 130), "".join(parts)))
    docs += [(None, shared[0] * 3), (5, None), (6, ""), (7, "x" * 5000), (8, "x" * 49), (9, "x" * 50), (1, "x" * 50)]
    return docs + [(300 + i, docs[3][1]) for i in range(40)] + [(300, docs[3][1])]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(runindex, "HOT_TIMES", hot)
    docs = passages()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, spans string").repartition(5)
    found = runindex.remove_repeats(df)
    assert sorted([tuple(r) for r in found.collect()], key=repr) == slow_removal(docs, 50)


def test_repeats_outputs(spark):
    docs = [(1, "q" * 10 + "0123456789" * 8), (2, "a" + "0123456789" * 8 + "b")]
    found = runindex.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True).collect()
    by = {r.doc_id: r for r in found}
    assert by[2].spans == [[1, 81]] and bytes(by[2].kept) == b"ab" and by[1].spans == []
    assert runindex.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_run_length_index_streams_all_windows():
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("ab", k=rnd.randint(50, 90))).encode() for _ in range(60)]
    texts += [texts[0][:70], texts[1]]
    keys = np.sort(np.array([rnd.randint(0, 40) for _ in texts]))
    index = runindex.RunLengthIndex(texts, keys, 50)
    assert len(index.samples) == len(index.starts) <= sum(map(len, texts)) + len(texts)
    first = {}
    for t, k in zip(texts, keys):
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], 10**9), k)
    seen = 0
    for own, start, least in index.earliest():
        for t, s, k in zip(own, start, least):
            assert first[texts[t][s : s + 50]] == k
            seen += 1
    assert seen == sum(len(t) - 49 for t in texts)
