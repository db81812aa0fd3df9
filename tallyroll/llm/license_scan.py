"""Licence detection by ordered signature rules, with DataFrame functions only.

Method: a document whose lower-case text holds no keyword is done after the prefilter. The
words of the others, joined by one space, meet every rule whose own keyword they hold. Matches
become intervals of word positions (running sums over the pieces between matches, no Python).
A detection goes if it lies within one of the same or a better rank; of equal intervals the
better rank stays, then the earlier rule. Base phrases always stay.

Defined results: null or empty text gives no words, empty labels and score 0. Equal rows give
equal results. A null id is kept. Other columns of the input are not read.
"""

from __future__ import annotations

import json
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.tables import keyed

# Everything between words in the word class of the contract, on text whose A-Z are not yet
# lowered and after. (Replacing runs is linear in the text; Spark's extraction of all matches isn't.)
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"  # no word holds it
# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Families: label, names as words, versions (written with a space for the dot).
FAMILIES = [
    ("gpl", ["gnu general public license", "gnu gpl", "gplv", "gpl"], ["1", "2", "3", "1 0", "2 0", "3 0"]),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license", "lgplv", "lgpl"], ["2", "3", "2 0", "2 1", "3 0"]),
    ("agpl", ["gnu affero general public license", "affero general public license", "agplv", "agpl"], ["1", "3", "1 0", "3 0"]),
    ("gfdl", ["gnu free documentation license", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache software license", "apache license", "asl"], ["1 0", "1 1", "2", "2 0"]),
    ("mpl", ["mozilla public license", "mpl"], ["1 0", "1 1", "2", "2 0"]),
    ("epl", ["eclipse public license", "epl"], ["1 0", "2 0"]),
    ("cddl", ["common development and distribution license", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public license", "cpl"], ["1 0"]),
    ("eupl", ["european union public licence", "european union public license", "eupl"], ["1 0", "1 1", "1 2"]),
    ("osl", ["open software license", "osl"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", ["academic free license", "afl"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", ["artistic license"], ["1 0", "2 0"]),
    ("boost", ["boost software license", "bsl"], ["1 0"]),
    ("zpl", ["zope public license", "zpl"], ["1 1", "2 0", "2 1"]),
    ("python", ["python software foundation license", "psf license"], ["2", "2 0"]),
    ("php", ["php license"], ["3 0", "3 01"]),
    ("ofl", ["sil open font license", "open font license", "ofl"], ["1 0", "1 1"]),
    ("odbl", ["open database license", "odbl"], ["1 0"]),
    ("cecill", ["cecill free software license agreement", "cecill"], ["1 0", "1 1", "2 0", "2 1"]),
    ("mulan", ["mulan permissive software license", "mulan psl"], ["1 0", "2 0"]),
    ("ms-pl", ["microsoft public license", "ms pl"], []),
    ("ms-rl", ["microsoft reciprocal license", "ms rl"], []),
    ("bsd", ["bsd license", "berkeley software distribution license"], []),
    ("bsd-2-clause", ["bsd 2 clause license", "bsd 2 clause", "2 clause bsd", "simplified bsd license", "freebsd license"], []),
    ("bsd-3-clause", ["bsd 3 clause license", "bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license"], []),
    ("bsd-4-clause", ["bsd 4 clause license", "bsd 4 clause", "4 clause bsd", "original bsd license"], []),
    ("isc", ["isc license", "internet systems consortium license"], []),
    ("zlib", ["zlib license", "zlib libpng license"], []),
    ("unlicense", ["the unlicense", "unlicense org"], []),
    ("wtfpl", ["do what the fuck you want to public license", "wtfpl"], []),
    ("x11", ["x11 license", "x consortium license"], []),
    ("expat", ["expat license"], []),
    ("json", ["json license"], []),
    ("curl", ["curl license"], []),
    ("openssl", ["openssl license", "ssleay license"], []),
    ("ntp", ["ntp license"], []),
    ("postgresql", ["postgresql license", "postgresql licence"], []),
    ("vim", ["vim license"], []),
    ("beerware", ["beerware license", "beer ware license"], []),
    ("cc0", ["creative commons zero", "cc0", "cc zero"], ["1 0"]),
]
# Creative Commons: every licensed combination in words and as an identifier.
CC_PARTS = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
CC_KINDS = ["by nc sa", "by nc nd", "by sa", "by nd", "by nc", "by"]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# Notices that say something about terms without a licence's name: label, keyword, pattern.
NOTICES = [
    ("copyright", "copyright", r"copyright (?:c )?(?:by )?(?:19|20)[0-9]{2}"),
    ("all-rights-reserved", "rights reserved", r"all rights reserved"),
    ("permission-notice", "permission", r"permission is hereby granted(?: free of charge)?(?: to any person obtaining a copy)?"),
    ("permission-notice", "permission", r"permission to use copy modify and(?: or)? distribute"),
    ("redistribution", "redistribution", r"redistribution and use in source and binary forms(?: with or without modification)?"),
    ("no-warranty", "warrant", r"without warranty of any kind(?: express or implied)?"),
    ("no-warranty", "warrant", r"without warranties or conditions of any kind"),
    ("as-is", "as is", r"provided (?:by the copyright holders and contributors )?as is"),
    ("public-domain", "public domain", r"(?:released |dedicated |placed )?(?:in|into|to) the public domain"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("licensed-under", "licensed under", r"(?:this work is )?licensed under(?: the)?(?: terms of)?(?: the)?"),
    ("licensed-under", "released under", r"released under(?: the)?(?: terms of)?(?: the)?"),
    ("license-file", "license file", r"see (?:the )?license file(?: for details)?"),
]
RANKS = (1, 2, 3)  # versions and identifiers, names, notices


@cache
def rules() -> tuple[tuple[int, str, str, str], ...]:
    """Rank, label, keyword and pattern of every rule but the base phrases, in order.

    Rule for the names: with a version ("version", "v" or nothing before it, "or later" or
    "only" after it), rank 1; the bare name, rank 2.
    """
    out: list[tuple[int, str, str, str]] = []
    for label, names, versions in FAMILIES:
        for name in names:
            for version in versions:
                tail = f"{version}(?: or (?:any )?(?:later|newer)(?: version)?| only)?"
                glue = "" if name.endswith("v") else " (?:version |v )?(?:v)?"
                out.append((1, f"{label}-{version.replace(' ', '.')}", name, f"{name}{glue}{tail}"))
    for kind in CC_KINDS:
        name = " ".join(CC_PARTS[part] for part in kind.split())
        for version in CC_VERSIONS:
            label = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
            out.append((1, label, f"cc {kind} {version}", f"cc {kind} {version}"))
            out.append((1, label, f"commons {name}", f"creative commons {name} (?:license |international |unported |generic )?(?:version )?{version}"))
    for label, names, _ in FAMILIES:
        # A bare abbreviation is a rule of its own only if it can't be another word.
        out += [(2, label, name, name) for name in names if " " in name or label in ("wtfpl", "cecill", "cc0")]
    out += [(2, f"cc-{kind.replace(' ', '-')}", f"cc {kind}", f"cc {kind}") for kind in CC_KINDS]
    out += [(2, "spdx", "spdx license identifier", r"spdx license identifier [a-z0-9]+")]
    out += [(3, *notice) for notice in NOTICES]
    return tuple(out)


def prefilter() -> str:
    """A pattern that finds any keyword in raw text, at the start of a word, tried by first letters."""
    by_letter: dict[str, set[str]] = {}
    for keyword in {*BASE, *(rule[2] for rule in rules())}:
        by_letter.setdefault(keyword[0], set()).add(keyword[1:].replace(" ", RAW_GAP))
    return "(?<![A-Za-z0-9])(?i:" + "|".join(f"{letter}(?:{'|'.join(sorted(rest))})" for letter, rest in sorted(by_letter.items())) + ")"


def _rule_table() -> Column:
    """All rules as one constant array of structs."""
    every = [(0, label, phrase, phrase) for phrase, label in BASE.items()] + list(rules())
    rows = [{"rule": i, "rank": rank, "label": label, "keyword": keyword, "regex": f"(?<= ){regex}(?= )"} for i, (rank, label, keyword, regex) in enumerate(every)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rule int, rank int, label string, keyword string, regex string>>")


def _joined(column: Column, gap: str) -> Column:
    """Words with a space before each and one at the end (a lone space or two if there is none)."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(column, gap, " ")), F.lit(" "))


def _spaces(column: Column) -> Column:
    return F.length(column) - F.length(F.replace(column, F.lit(" "), F.lit("")))


def _words(column: Column) -> Column:
    return F.size(F.array_remove(F.split(column, RAW_GAP, -1), ""))


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, rule, rank, label, first, stop, lead, stays``: every match, in word positions.

    Rank 0 has the base phrases. ``lead`` is the largest end among detections that sort before
    (by start, then longer first); ``stays`` is false for detections that are suppressed.
    """
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    met = (
        keyed(docs, id_col, text_col)
        .filter(F.col("text").rlike(prefilter()))
        .dropDuplicates(["id", "h"])
        .select("id", "h", _joined(lower, LOWER_GAP).alias("norm"))
        .select("id", "h", "norm", F.explode(F.filter(_rule_table(), lambda r: F.contains(F.col("norm"), r["keyword"]))).alias("r"))
        # Text and matches in turn: every odd piece is a match.
        .select("id", "h", "r.*", F.split(F.regexp_replace("norm", F.col("r.regex"), F.lit(f"{MARK}$0{MARK}")), MARK).alias("pieces"))
        .filter(F.size("pieces") > 1)
    )
    pieces = met.select("id", "h", "rule", "rank", "label", F.posexplode("pieces").alias("i", "piece")).withColumn("gaps", _spaces(F.col("piece")))
    # The text starts with a space, so a word's position is one less than the spaces up to it.
    stop = F.sum("gaps").over(Window.partitionBy("id", "h", "rule").orderBy("i"))
    found = (
        pieces.select("id", "h", "rule", "rank", "label", "i", (stop - F.col("gaps") - 1).cast("long").alias("first"), stop.cast("long").alias("stop"))
        .filter(F.col("i") % 2 == 1)
        .drop("i")
    )
    before = Window.partitionBy("id", "h").orderBy("first", F.desc("stop"), "rank", "rule").rowsBetween(Window.unboundedPreceding, -1)
    hidden = F.lit(False)
    for rank in RANKS:
        within = F.max(F.when(F.col("rank") <= rank, F.col("stop"))).over(before) >= F.col("stop")
        hidden = hidden | ((F.col("rank") == rank) & F.coalesce(within, F.lit(False)))
    return found.withColumns({"lead": F.coalesce(F.max("stop").over(before), F.lit(0)), "stays": ~hidden})


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the share of the words that lie in some detection.
    """
    base = F.col("rank") == 0
    per_doc = (
        detections(docs, id_col, text_col)
        .groupBy("id", "h")
        .agg(
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("first"))).alias("first_word"),
            F.max(F.when(base, F.col("first"))).alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set(F.when(base | F.col("stays"), F.col("label")))), ",").alias("labels"),
            F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("first", "lead"))).alias("n_covered"),
        )
    )
    every = keyed(docs, id_col, text_col).select("doc_id", "id", "h", _words(F.col("text")).cast("long").alias("n_words"))
    return every.join(per_doc, ["id", "h"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.coalesce("n_covered", F.lit(0)) / F.col("n_words"))).otherwise(0.0).alias("score"),
    )
