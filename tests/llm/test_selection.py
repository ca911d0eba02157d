"""Resampling, filter audit and main text of pages against brute force, with odd rows."""

import hashlib
import html as markup
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tabforge.llm import audit, htmltext, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS, PAGES = (f"/root/testdata/sf0.01/{n}.parquet" for n in ("documents", "pages"))


def grams(text):
    words = WORD.findall((text or "").encode().lower().decode())
    runs = (" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    return len(words), Counter(zlib.crc32(r.encode()) % 10_000 for r in runs)


def drawn(rows, target, percent, least):
    """n_features, weight, score and rank of every (key, text), by the formulas."""
    counted = [(k, *grams(t)) for k, t in rows]
    s, t = sum((c for _, _, c in counted), Counter()), sum((grams(x)[1] for x in target), Counter())
    every, wanted = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (every + 10_000) / ((s[b] + 1) * (wanted + 10_000))))

    out = []
    for k, words, c in counted:
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain(b) for b, n in c.items())
        out.append([words, k, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[1:], ranks.get(id(r))) for r in out), key=str)


def odd_texts(n):
    rnd = random.Random(3)
    parts = ["a", "Zoo", " ", "\n", "é", "İ", "日本", "x" * 70, "q" * 63, "q" * 62, "-", "0", " the ", " and of ", "\x00", "_"]
    return ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("piece, known", [(1 << 18, 1 << 20), (5, 3)])
def test_windows(monkeypatch, piece, known):
    """Pieces and forgetting change nothing; words of any length are hashed right."""
    monkeypatch.setattr(resample, "PIECE_CHARS", piece)
    monkeypatch.setattr(resample, "KNOWN_STRETCHES", known)
    windows = resample.Windows()
    texts = [*odd_texts(300), None, "", "Ab " * 5000, " ", "a", "x" * 5000]
    words, counts = Counter(), Counter()
    for at, owners, found in windows.of(texts):
        words.update(at.tolist())
        counts.update(zip(owners.tolist(), found.tolist()))
    for i, text in enumerate(texts):
        assert (words[i], Counter({b: n for (t, b), n in counts.items() if t == i})) == grams(text)


def test_resample(spark):
    texts = [*odd_texts(200), None, "", "the and of " * 40_000, "zoo zoo"]
    rows = [*enumerate(texts), (7, "the and of a zoo"), (7, "the and of a zoo"), (None, "the " * 30)]
    target = ["the and of", None, "a zoo 0"]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, rank int").repartition(5)
    wanted = spark.createDataFrame([(t, 0) for t in target], "text string, doc_id int")
    found = resample.resample(df, wanted, percent=15, least_words=3).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, found.collect()), key=str) == drawn(rows, target, 15, 3)
    assert resample.resample(df.limit(0), wanted).collect() == []
    empty = resample.resample(df, wanted.limit(0), percent=15, least_words=3).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, empty.collect()), key=str) == drawn(rows, [], 15, 3)


def test_resample_ties_and_texts(spark):
    """Rows of one key and text tie; those of other keys go by score, and the drawn texts come whole."""
    df = spark.createDataFrame([(5, "word " * 25)] * 40 + [(None, "word " * 25)] * 2, "doc_id long, text string")
    ranks = [r["rank"] for r in resample.resample(df, df, percent=50).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 22))
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("one word and more " * 9).alias("text"), F.lit(1).alias("rank"))
    got = resample.drawn_documents(df, df.select("text"), percent=10)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 7)) and got.columns == ["doc_id", "text", "rank"]


def fails(text, copy):
    words = BLANK_WORD.findall(text)
    upper = sum("A" <= c <= "Z" for c in text)
    marks = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text)]
    return {f for f, bad in zip("ABCDE", [*marks, any(c in "#$%&*|" for c in text), copy]) if bad}


def audited(rows, labels):
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)
    docs = [(p or "", fails(t or "", k is not None and k > first[t or ""]), labels.get(k, (0, 0))) for k, t, p in rows]
    out = {}
    for part in {d[0] for d in docs}:
        mine, total = [d for d in docs if d[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                failing = [d for d in mine if f in d[1]]
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(bool(d[1] & set(order[: step - 1])) for d in failing),
                    sum(d[1] == {f} for d in mine),
                    sum(d[2][0] for d in gone),
                    sum(d[2][1] for d in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("slice_rows", [1 << 22, 40])
def test_audit(spark, monkeypatch, slice_rows):
    """Many slices give what one gives."""
    monkeypatch.setattr(audit, "SLICE_ROWS", slice_rows)
    rnd = random.Random(5)
    pool = ["", None, "Ab #", "x y " * 150, " ".join(map(str, range(250))), "A B C " + " ".join(map(str, range(230))), "é" * 9, "long " * 90_000]
    rows = [(rnd.randint(0, 80), rnd.choice(pool + [f"only {i}"]), rnd.choice(["de", "en", "", None])) for i in range(120)]
    rows += [(None, "x y " * 150, "de"), (None, None, "en"), (3, "Ab #", "en"), (3, "Ab #", "en")]
    labels = {k: (rnd.randint(0, 1), rnd.randint(0, 1)) for k in range(0, 80, 2)}
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, mask int").repartition(4)
    table = [(k, q, t) for k, (q, t) in labels.items()] + [(2, 0, 0), (None, 1, 1), (4, None, None)]
    marks = spark.createDataFrame(table, "doc_id long, quality int, toxic int")
    found = audit.audit(df, marks)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}
    assert found.columns[3:] == ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got == audited(rows, labels)
    assert audit.audit(df.limit(0), marks).collect() == []


def test_prepass_clears_unique_texts(spark):
    """No repeat is cleared, and of the unique texts nearly all are."""
    df = spark.read.parquet(DOCUMENTS).select("doc_id", "text", "lang")
    rows = audit.possible_repeats(audit._scanned(df, "doc_id", "text", "lang"), df.count())
    times = {r["digest"]: r["n"] for r in rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).collect()}
    marked = [(times[r["digest"]] > 1, r["_maybe"]) for r in rows.collect()]
    assert all(maybe for repeated, maybe in marked if repeated)
    assert sum(maybe for repeated, maybe in marked if not repeated) < 0.1 * sum(not repeated for repeated, _ in marked)


def article_of(page):
    """The text between the article's tags, for the regular pages of the test tables."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(b for b in (" ".join(markup.unescape(x).split()) for x in blocks) if b)


def test_main_text_of_pages(spark):
    df = spark.read.parquet(PAGES).withColumn("text", F.lit("clash"))
    found = htmltext.extract_pages(df)
    assert found.columns == ["page_id", "url", "text"]
    want = {r.page_id: article_of(r.html) for r in df.collect()}
    assert {r.page_id: r.text for r in found.collect()} == want
    assert htmltext.extract_pages(df.limit(0)).collect() == []


LONG = "This paragraph has enough words of its own to count as part of what the page is about, and then some more."
HTML = {
    "": "",
    "<p></p><!-- x -->": "",
    f"<p>{LONG}": LONG,
    f"<nav><ul><li><a>x<li><a>y<article><p>{LONG}<p>two</article><script>if(a<b){{'</p>'}}": f"{LONG}\ntwo",
    f"<body><form><div><h1>T</h1><p>{LONG}</p></div></form>": f"T\n{LONG}",
    f"<header><h1>Site</h1></header><main><article><header><h1>Own</h1><p>By me</p></header><p>{LONG}</p><p>a&nbsp;&lt;b&gt; &eacute;<br>c"
    f"</p><aside>x</aside><form><label>m</label></form></article><section class=comments><article class=comment><p>{LONG} Me too."
    "</article></section></main><footer>f</footer>": f"Own\n{LONG}\na <b> é c",
    f"<body><div id=menu><a>Home</a></div><div class='cookie-notice'><p>{LONG}</p></div><h1>Top</h1><div class=wrap><p>{LONG}</p><p>"
    f"Short.</p><p>{LONG}</p></div><div class='adBox sponsored'>{LONG}</div><div id='comments'><p>{LONG}</p></div>"
    "<div>Imprint <a href=x>and a long list of links</a></div>": f"Top\n{LONG}\nShort.\n{LONG}",
    f"<article class='post has-sidebar'><p hidden>{LONG}</p><p style='display: none'>x</p><pre>a\n  b</pre><p>{LONG}</p><ul><li>one<li>two"
    f"</ul><table><tr><td>1<td>2</table></article>": f"a b\n{LONG}\none\ntwo\n1\n2",
}


def test_main_text():
    for page, text in HTML.items():
        assert htmltext.main_text(page) == text
    assert htmltext.main_text(None) == ""
    deep = "<div>" * 3000 + f"<p>{LONG}</p>"
    assert htmltext.main_text(deep) == LONG
    assert htmltext.main_text(f"<article><p>{LONG}</p>" * 2 + "<p>end" * 20_000).count("end") == 20_000
