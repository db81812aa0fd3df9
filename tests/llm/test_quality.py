"""Counts against a plain version; the verdict on junk, on clean text and at the guards."""

import math
import re
from collections import Counter

import numpy as np

from tallyroll.llm.quality import COMMON, MIN_CHARS, MIN_COMMON_WORDS, distance, features, keep_good, quality_rules, word_limit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, r = len(words), len(repeated)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, r, n < 10 or 100 * r > 20 * n


def kind(c):
    """Class of a character, by its place in the histogram."""
    if ord(c) >= 128:
        return 6
    for place, own in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:!?'\"()-")):
        if c in own:
            return place
    return 5


def histograms(text):
    text = text or ""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    common = set(COMMON)
    return Counter(map(kind, text)), Counter(w if w in common else None for w in re.findall("[a-z\x80-\U0010ffff]+", lower))


def share_of(counts):
    total = sum(counts.values())
    return {k: n / total for k, n in counts.items()}


def divergence(p, q):
    out = 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        out += sum(x * math.log2(2 * x / (a + b)) / 2 for x in (a, b) if x > 0)
    return math.sqrt(min(max(out, 0.0), 1.0))


def mean_share(all_counts):
    shares = [share_of(c) for c in all_counts]
    return {k: sum(s.get(k, 0.0) for s in shares) / len(shares) for k in set().union(*shares)} if shares else None


def verdicts(rows):
    """For each (text, lang): whether it is kept, its distances, and how near these come to a limit."""
    both = [histograms(text) for text, _ in rows]
    by_lang = {lang: [h for h, (_, own) in zip(both, rows, strict=True) if own == lang] for lang in {lang for _, lang in rows}}
    known = {lang: (mean_share([c for c, _ in own if sum(c.values()) >= 200]), mean_share([w for _, w in own if sum(w.values()) >= 100])) for lang, own in by_lang.items()}
    out = []
    for (text, lang), (chars, words) in zip(rows, both, strict=True):
        ref_chars, ref_words = known[lang]
        n = sum(words.values())
        far_chars = divergence(share_of(chars), ref_chars) if ref_chars and sum(chars.values()) >= 200 else None
        far_words = divergence(share_of(words), ref_words) if ref_words and n else None
        limit = 0.24 if n >= 100 else min(0.31, 0.24 + 2.4 * (1 / math.sqrt(max(n, 1)) - 0.1))
        odd = far_chars is not None and (far_chars > 0.30 or (far_chars > 0.14 and far_words is not None and far_words > limit))
        near = min([1.0, *(abs(far_chars - x) for x in (0.30, 0.14) if far_chars is not None), *(abs(far_words - limit) for _ in [0] if far_words is not None)])
        out.append((not plain(text)[-1] and not odd, far_chars, far_words, near))
    return out


def check_verdicts(docs):
    """Verdict and distances of every row; returns how many were rejected by the distances."""
    rows = docs.select("doc_id", "text", "lang").collect()
    expected = {}
    for r, e in zip(rows, verdicts([(r.text, r.lang) for r in rows]), strict=True):
        expected.setdefault(r.doc_id, []).append(e)
    rejected = 0
    found = quality_rules(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        # Rows of one id have one text in these tables.
        kept, chars, words, near = expected[r.doc_id][0]
        for own, wanted in ((r.char_distance, chars), (r.word_distance, words)):
            assert (own is None) == (wanted is None) and (own is None or abs(own - wanted) < 1e-6), r
        assert near < 1e-6 or r.kept == kept, r
        rejected += not r.kept and not r.base_failed
    return rejected


def test_verdicts_by_plain_histograms(spark):
    assert check_verdicts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")) > 10


def test_verdicts_of_odd_rows(spark):
    latin, sign = "the quick brown fox and the dog of a house ", "| # ; 17 $ % "
    data = [(1, latin * 12, "en"), (2, latin * 3 + sign * 20, "en"), (3, sign * 40, "en"), (4, "é ü 中 " * 60, None), (5, None, None), (6, "", "en"),
            (7, latin.upper() * 6, "en"), (8, latin * 2, "en"), (9, "the " * 30 + sign * 9, "xx"), (10, latin * 30, None), (11, "1 2 3 4 " * 60, "en")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    check_verdicts(docs)
    check_verdicts(docs.limit(0))


def check(docs):
    rows = quality_rules(docs).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    texts = docs.collect()
    assert len(rows) == len(texts)
    for d in texts:
        for r in by_id[d.doc_id]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(d.text), d
            assert not (r.kept and r.base_failed)
    return rows


def test_whole_table(spark, sf_dir):
    rows = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert 0 < sum(r.kept for r in rows) < len(rows)


def test_odd_rows(spark):
    data = [
        (1, None, "en"), (2, "", None), (3, "a b c d e a b c d e\n\n \na b\na b", "en"), (None, "x " * 40, "xx"), (4, "é \x1c  ü z # |", "de"),
        (5, "one two three four five six seven eight nine ten", "en"), (5, "one two three four five six seven eight nine ten", "en"), (6, "w" * 100_000 + " " + "v " * 700_000, "en"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").selectExpr("*", "'x' as chars", "1 as ref_words", "2 as c0")
    check(docs)
    # A column of the name of the operator's own.
    named = docs.withColumn("_quality", docs["doc_id"])
    assert keep_good(named).columns == named.columns and keep_good(named).count() == keep_good(docs).count()
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [5, 5]
    assert quality_rules(docs.limit(0)).collect() == [] and keep_good(docs.limit(0)).collect() == []


def test_junk_goes_and_clean_text_stays(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = quality_rules(docs).join(docs.select("doc_id", "quality"), "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.6 * sum(r.quality == 0 for r in rows)


def test_documents_of_few_words_are_judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    verdict = {r.doc_id: r for r in quality_rules(docs).collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    table = docs.select("doc_id", "text").toArrow()
    got = features(table.column("text"))
    counted = dict(zip(table.column("doc_id").to_pylist(), zip(got["n_chars"], got["words"].sum(axis=1), strict=True), strict=True))
    short = [r for i, r in verdict.items() if counted[i][0] >= MIN_CHARS and counted[i][1] < MIN_COMMON_WORDS and not r.base_failed]
    junk, clean = ([r for r in short if label.get(r.doc_id) == q] for q in (0, 1))
    assert len(junk) >= 50 and len(clean) >= 300
    assert sum(not r.kept for r in junk) >= 0.8 * len(junk)
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert not verdict[315].kept and all(r.word_distance is not None for r in short if counted[r.doc_id][1])


def test_limit_follows_the_number_of_words():
    limit = word_limit(np.array([0, 1, 30, 80, 99, 100, 10_000]))
    assert (np.diff(limit) <= 0).all() and limit[4] > limit[5] == limit[6] == 0.24 and limit[0] == 0.31


def test_distance():
    p, q = np.array([[0.5, 0.5, 0.0], [1.0, 0.0, 0.0]]), np.array([[0.5, 0.5, 0.0], [0.0, 0.5, 0.5]])
    assert np.allclose(distance(p, q), [0, 1])
