"""Base columns against a plain version; detections against a plain scan by the same rules."""

import re

from tallyroll.llm.license_scan import BASE, license_scan, prefilter, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    norm = " " + " ".join(words) + " "
    found = []
    for i, (rank, label, _, pattern) in enumerate([(0, label, "", phrase) for phrase, label in BASE.items()] + list(rules())):
        for hit in re.finditer(f"(?<= ){pattern}(?= )", norm):
            first = norm.count(" ", 0, hit.start()) - 1
            found.append((first, first + hit[0].count(" ") + 1, rank, i, label))
    found.sort(key=lambda d: (d[0], -d[1], d[2], d[3]))
    stays = [d for k, d in enumerate(found) if d[2] == 0 or not any(e[2] <= d[2] and e[1] >= d[1] for e in found[:k])]
    base = [d for d in found if d[2] == 0]
    covered = {w for d in found for w in range(d[0], d[1])}
    return (
        len(words), len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None),
        ",".join(sorted({d[4] for d in base})), ",".join(sorted({d[4] for d in stays})), len(covered) / len(words) if words else 0.0,
    )


def check(docs):
    texts = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.text or ""))
    rows = sorted(license_scan(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_words))
    assert [r.doc_id for r in rows] == [t.doc_id for t in texts]
    for t, r in zip(texts, rows, strict=True):
        assert tuple(r)[1:] == plain(t.text), (t, r)
    return rows


def test_rules():
    assert len(rules()) > 200
    assert all(re.search(prefilter(), f"x, {keyword.upper()}") for _, _, keyword, _ in rules())
    for _, _, keyword, pattern in rules():
        # The keyword is necessary: the pattern's text without its options holds it.
        plain_text = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\?", "", pattern)
        assert keyword.split()[0] in plain_text or keyword in pattern, (keyword, pattern)


def test_whole_table(spark, sf_dir):
    rows = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert any(r.n_base for r in rows)


def test_odd_rows(spark):
    texts = [
        None, "", "...", "MIT License", "mit license mit license", "Licensed under the Apache License, Version 2.0 only", "x_ASL_2.0 y", "GPLv3 gplv2 or later GPL-3.0",
        "CC BY-NC-SA 4.0; Creative Commons Attribution-ShareAlike 3.0", "Copyright (c) 2020 X. All rights reserved. Provided as is", "épl 1.0 EPL-1.0 ePl 2.0", "See the LICENSE file for details.",
        "the unlicense; public domain; released into the public domain; GNU General Public License, version 2 or any later version", "LİCENSE mıt license", "MIT LICENSE " * 20_000,
    ]
    data = [(i, t, "l") for i, t in enumerate(texts)] + [(3, "MIT License", "l"), (None, "apache license", "m")]
    rows = check(spark.createDataFrame(data, "doc_id long, text string, label string").selectExpr("*", "1 as h", "2 as rule"))
    assert rows[0].labels == "" and rows[-1].base_labels == "apache"
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
