"""License scan: ordered signature rules behind a keyword filter, overlaps resolved by containment and priority.

Rules are regular expressions over the normalised text: words of ASCII letters, digits and all other
characters beyond ASCII, lower-cased, with one space before and after each. A rule runs only on texts
with its keyword, which all of its matches contain. Of the detections in one text, those inside another one go, of equal ones all but
the first rule's, and of two that cross the later rule's. No row leaves its place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import whole_text

# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LICEN = "licen[cs]e"

# (label, keyword, name pattern, identifier pattern): what a license is called, and its short identifier.
FAMILIES = [
    ("mit-0", " mit 0 ", None, "mit 0"),
    ("mit", " mit ", f"mit (?:x11 )?{_LICEN}", "mit"),
    ("x11", " x11 ", f"x11 {_LICEN}", "x11"),
    ("apache-1", " apache", f"apache (?:software )?{_LICEN} (?:version |v )?1(?: [01])?", "apache 1 [01]"),
    ("apache-2", " apache", f"apache (?:software )?{_LICEN} (?:version |v )?v?2(?: 0)?", "apache 2 0"),
    ("agpl-3", "affero", f"(?:gnu )?affero (?:general )?public {_LICEN} (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?3(?: 0)?", None),
    ("agpl-3", " agpl", f"(?:gnu )?agpl (?:version |v )?v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("lgpl-3", " lesser", f"(?:gnu )?lesser (?:general )?public {_LICEN} (?:either )?(?:version |v )?v?3(?: 0)?", None),
    ("lgpl-2.1", " lesser", f"(?:gnu )?lesser (?:general )?public {_LICEN} (?:either )?(?:version |v )?v?2 1", None),
    ("lgpl-2", " library", f"(?:gnu )?library (?:general )?public {_LICEN} (?:either )?(?:version |v )?v?2(?: 0)?", None),
    ("lgpl-3", " lgpl", "(?:gnu )?lgpl (?:version |v )?v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", " lgpl", "(?:gnu )?lgpl (?:version |v )?v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("gpl-3", " general public", f"(?:gnu )?general public {_LICEN} (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?3(?: 0)?", None),
    ("gpl-2", " general public", f"(?:gnu )?general public {_LICEN} (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?2(?: 0)?", None),
    ("gpl-1", " general public", f"(?:gnu )?general public {_LICEN} (?:version |v )?v?1(?: 0)?", None),
    ("gpl-3", " gpl", "(?:gnu )?gpl ?(?:version |v )?v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", " gpl", "(?:gnu )?gpl ?(?:version |v )?v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl", " general public", f"gnu general public {_LICEN}", None),
    ("lgpl", " lesser", f"gnu lesser general public {_LICEN}", None),
    ("agpl", "affero", f"gnu affero general public {_LICEN}", None),
    ("gfdl-1.3", " free documentation", f"(?:gnu )?free documentation {_LICEN} (?:version |v )?1 3", "gfdl 1 3"),
    ("gfdl-1.2", " free documentation", f"(?:gnu )?free documentation {_LICEN} (?:version |v )?1 2", "gfdl 1 2"),
    ("gfdl", " free documentation", f"(?:gnu )?free documentation {_LICEN}", None),
    ("bsd-2-clause", " bsd", f"(?:2|two) clause bsd {_LICEN}", "bsd 2 clause"),
    ("bsd-3-clause", " bsd", f"(?:3|three) clause bsd {_LICEN}", "bsd 3 clause"),
    ("bsd-4-clause", " bsd", f"(?:4|four) clause bsd {_LICEN}", "bsd 4 clause"),
    ("bsd-3-clause", " bsd", f"(?:new|revised|modified) bsd {_LICEN}", None),
    ("bsd-2-clause", " bsd", f"(?:simplified|freebsd) bsd {_LICEN}", None),
    ("bsd-4-clause", " bsd", f"(?:original|old) bsd {_LICEN}", None),
    ("0bsd", "bsd", f"(?:zero clause bsd|0bsd) {_LICEN}", "0bsd"),
    ("bsd", " bsd", f"bsd (?:style )?{_LICEN}", None),
    ("isc", " isc ", f"isc {_LICEN}", "isc"),
    ("mpl-2", " mozilla", f"mozilla public {_LICEN} (?:version |v )?v?2(?: 0)?", None),
    ("mpl-1.1", " mozilla", f"mozilla public {_LICEN} (?:version |v )?v?1 1", None),
    ("mpl", " mozilla", f"mozilla public {_LICEN}", None),
    ("mpl-2", " mpl ", "mpl (?:version |v )?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", " mpl ", "mpl (?:version |v )?1 1", "mpl 1 1"),
    ("epl-2", " eclipse", f"eclipse public {_LICEN} (?:version |v )?v?2(?: 0)?", "epl 2 0"),
    ("epl-1", " eclipse", f"eclipse public {_LICEN} (?:version |v )?v?1(?: 0)?", "epl 1 0"),
    ("edl-1", " eclipse", f"eclipse distribution {_LICEN} (?:version |v )?v?1(?: 0)?", None),
    ("cddl-1.1", " common development", f"common development and distribution {_LICEN} (?:version |v )?1 1", "cddl 1 1"),
    ("cddl-1", " common development", f"common development and distribution {_LICEN}(?: (?:version |v )?1(?: 0)?)?", "cddl 1 0"),
    ("cpl-1", " common public", f"common public {_LICEN} (?:version |v )?1(?: 0)?", "cpl 1 0"),
    ("eupl-1.2", " european union public", f"european union public {_LICEN} (?:version |v )?1 2", "eupl 1 2"),
    ("eupl-1.1", " european union public", f"european union public {_LICEN} (?:version |v )?1 1", "eupl 1 1"),
    ("bsl-1", " boost software", f"boost software {_LICEN}(?: (?:version |v )?1(?: 0)?)?", "bsl 1 0"),
    ("artistic-2", " artistic", f"artistic {_LICEN} (?:version |v )?2(?: 0)?", "artistic 2 0"),
    ("artistic-1", " artistic", f"artistic {_LICEN} (?:version |v )?1(?: 0)?", "artistic 1 0"),
    ("zlib", " zlib", f"zlib {_LICEN}", "zlib"),
    ("libpng", " libpng", f"libpng {_LICEN}(?: version 2)?", "libpng 2 0"),
    ("python-2", " python", f"python (?:software foundation )?{_LICEN} (?:version |v )?2(?: 0)?", "psf 2 0"),
    ("python-2", " python", f"python software foundation {_LICEN}", "python 2 0"),
    ("php-3", " php", f"php {_LICEN} (?:version |v )?3 (?:0|01)", "php 3 0(?:1)?"),
    ("ruby", " ruby", f"ruby {_LICEN}", "ruby"),
    ("perl", " perl", "same terms as perl(?: itself)?", None),
    ("postgresql", " postgresql", f"postgresql {_LICEN}", "postgresql"),
    ("openssl", " openssl", f"openssl {_LICEN}", "openssl"),
    ("unlicense", "unlicen", f"the unlicen[cs]e|un{_LICEN} org", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", " what the fuck ", f"do what the fuck you want to public {_LICEN}", None),
    ("ms-pl", " microsoft public", f"microsoft public {_LICEN}", "ms pl"),
    ("ms-rl", " microsoft reciprocal", f"microsoft reciprocal {_LICEN}", "ms rl"),
    ("odbl-1", " open database", f"open database {_LICEN}(?: (?:version |v )?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1", " open data commons", f"open data commons attribution {_LICEN}(?: (?:version |v )?1(?: 0)?)?", "odc by 1 0"),
    ("pddl-1", " public domain dedication", f"public domain dedication and {_LICEN}(?: (?:version |v )?1(?: 0)?)?", "pddl 1 0"),
    ("ofl-1.1", " open font", f"(?:sil )?open font {_LICEN}(?: (?:version |v )?1 1)?", "ofl 1 1"),
    ("openrail", "openrail", f"(?:bigscience |creativeml )?openrail(?: m)?(?: {_LICEN})?", None),
    ("llama", " llama ", f"llama (?:[0-9] )+community {_LICEN}", None),
    ("elastic-2", " elastic", f"elastic {_LICEN} (?:version |v )?2(?: 0)?", "elastic 2 0"),
    ("sspl-1", " server side public", f"server side public {_LICEN}(?: (?:version |v )?1)?", "sspl 1 0"),
    ("busl-1.1", " business source", f"business source {_LICEN}(?: (?:version |v )?1 1)?", "busl 1 1"),
]

# Texts of licenses and notices by phrases that are theirs alone.
PASSAGES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "without restriction", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("isc", "permission to use copy", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", " endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2", " as is basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", " apache", "www apache org licenses license 2 0"),
    ("gpl", "free software you can", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software you can", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("gpl", " gnu org", "www gnu org licenses gpl(?: [0-9 ]+)?(?:html|txt)"),
    ("mpl-2", " mozilla", "mozilla org mpl 2 0"),
    ("mit", " opensource org", "opensource org licenses mit"),
    ("bsd-3-clause", " opensource org", "opensource org licenses bsd 3 clause"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("cc0-1", " creativecommons org", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "public domain", "(?:released|dedicated|placed|is) (?:into|to|in) the public domain"),
    ("proprietary", " all rights reserved", "all rights reserved"),
    ("proprietary", " confidential", "proprietary and confidential"),
    ("no-warranty", " warranty", "without warranty of any kind(?: express or implied)?"),
    ("no-derivatives", " derivative", "no derivative works (?:are )?(?:allowed|permitted)"),
    ("noncommercial", "commercial", "(?:for )?non ?commercial (?:use|purposes) only"),
    ("research-only", " research", "(?:for )?research (?:use|purposes) only"),
]

_VERSIONS = {"4": "4(?: 0)?", "3": "3(?: 0)?", "2.5": "2 5", "2": "2(?: 0)?", "1": "1(?: 0)?"}
_CC_PARTS = [
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by", "by", "attribution"),
]
# How a notice leads to a name; what follows is the license itself.
_LEADS = "(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?"


def _keyword(keyword: str, identifier: str) -> str:
    """The family's keyword if the identifier always contains it, else the identifier's first word."""
    literal = re.match("[a-z0-9 ]+", identifier)[0]
    always = f" {literal} " if literal == identifier else f" {literal}"
    return keyword if keyword in always else f" {literal.split()[0]} "


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keyword, pattern, confidence), the most specific first."""
    out: list[tuple[str, str, str, float]] = []
    for label, keyword, _, identifier in FAMILIES:
        if identifier:
            out.append((label, "spdx", f"spdx license identifier {identifier}", 1.0))
    for part, short, _ in _CC_PARTS:
        for version, pattern in _VERSIONS.items():
            out.append((f"cc-{part}-{version}", "spdx", f"spdx license identifier cc {short} {pattern}", 1.0))
    out.append(("cc0-1", "spdx", "spdx license identifier cc0 1 0", 1.0))
    out += [(label, keyword, pattern, 0.95) for label, keyword, pattern in PASSAGES]
    for label, keyword, name, identifier in FAMILIES:
        forms = [(name, keyword), (identifier, identifier and _keyword(keyword, identifier))]
        out += [(label, word, f"{_LEADS}(?:{form})(?: {_LICEN})?", 0.98) for form, word in forms if form]
    for part, short, long in _CC_PARTS:
        for version, pattern in _VERSIONS.items():
            out.append((f"cc-{part}-{version}", " cc ", f"(?:{_LEADS}(?:a )?)?cc {short} {pattern}(?: international| unported)?", 0.97))
            out.append((f"cc-{part}-{version}", " creative commons", f"(?:{_LEADS}(?:a )?)?creative commons {long} {pattern}(?: international| unported)?(?: public)?(?: {_LICEN})?", 0.97))
    out += [(label, keyword, name, 0.9) for label, keyword, name, _ in FAMILIES if name]
    out += [(f"cc-{part}", " cc ", f"cc {short}", 0.85) for part, short, _ in _CC_PARTS]
    out += [(f"cc-{part}", " creative commons", f"creative commons {long}(?: {_LICEN})?", 0.85) for part, _, long in _CC_PARTS]
    out += [("cc0-1", " cc0 ", "cc0(?: 1 0)?(?: universal)?", 0.9), ("cc", " creative commons", f"creative commons {_LICEN}", 0.6)]
    return [(i, label, keyword, rf"(?<= )(?:{pattern})(?= )", score) for i, (label, keyword, pattern, score) in enumerate(out)]


# Whatever a rule matches has one of these, so a text without any of them is passed over.
GATES = [
    "licen", " under ", " gpl", "lgpl", "agpl", " cc ", " cc0 ", "creative", "apache", " bsd", " mpl ", "public domain", "spdx", "wtfpl", "openrail",
    "perl", "warranty", "confidential", "rights reserved", "derivative", "commercial", "research", "permission", "restriction",
    "redistribution", "endorse", "free software", "gnu org", "mozilla", "opensource org",
]


def normalised(text: Column) -> Column:
    """The words of a text, lower-cased, with one space before and after each."""
    words = F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _SEPARATORS, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(norm: Column, rule: Column) -> Column:
    """struct(start, -end, priority, label, score) of a rule's matches, in words."""
    between = F.split(norm, rule["pattern"], -1)
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
    step = lambda acc, i: F.struct(
        (acc["at"] + _spaces(F.get(between, i)) - 1 + _spaces(F.get(found, i)) + 1).alias("at"),
        F.concat(
            acc["spans"],
            F.array(
                F.struct(
                    (acc["at"] + _spaces(F.get(between, i)) - 1).alias("start"),
                    (-(acc["at"] + _spaces(F.get(between, i)) + _spaces(F.get(found, i)))).alias("neg_end"),
                    rule["priority"].alias("priority"), rule["label"].alias("label"), rule["score"].alias("score"),
                )
            ),
        ).alias("spans"),
    )
    none = F.array().cast("array<struct<start:int,neg_end:int,priority:int,label:string,score:double>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    count = F.size(found)
    return F.when(count > 0, F.aggregate(F.sequence(F.lit(0), count - 1), begin, step, lambda acc: acc["spans"])).otherwise(none)


def _resolved(detections: Column) -> Column:
    """Those that stay: sorted by start, longest first, then by priority."""

    def step(kept: Column, d: Column) -> Column:
        last = F.element_at(kept, -1)
        return (
            F.when(F.size(kept) == 0, F.array(d))
            .when(d["neg_end"] >= last["neg_end"], kept)
            .when(d["start"] >= -last["neg_end"], F.concat(kept, F.array(d)))
            .when(d["priority"] < last["priority"], F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(d)))
            .otherwise(kept)
        )

    none = F.array().cast("array<struct<start:int,neg_end:int,priority:int,label:string,score:double>>")
    return F.aggregate(F.sort_array(detections), none, step)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Base columns count the places of PHRASES; `detections` has start, end (in words, end exclusive),
    label, rule and score of what stays. Score is the best of them, 0.9 for a base phrase, else 0.
    Null text counts as empty: no words, no labels, score 0. Repeated rows give repeated results.
    """
    table = rules()
    keywords = sorted({keyword for _, _, keyword, _, _ in table})
    rule_table = F.array(
        *[
            F.struct(F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(k).alias("keyword"), F.lit(r).alias("pattern"), F.lit(s).alias("score"))
            for p, label, k, r, s in table
        ]
    )
    base = "(?<= )(?:" + "|".join(PHRASES) + ")(?= )"
    norm = F.col("_norm")
    gate = norm.contains(GATES[0])
    for word in GATES[1:]:
        gate = gate | norm.contains(word)
    none = F.array().cast("array<struct<start:int,neg_end:int,priority:int,label:string,score:double>>")
    present = F.filter(F.array(*map(F.lit, keywords)), lambda k: norm.contains(k))
    active = F.filter(rule_table, lambda r: F.array_contains(F.col("_keywords"), r["keyword"]))
    rows = (
        docs.select(F.col(id_col).cast("bigint").alias("_id"), normalised(whole_text(text_col)).alias("_norm"))
        .withColumn("_gate", gate)
        .withColumn("_keywords", F.when(F.col("_gate"), present).otherwise(F.array().cast("array<string>")))
        .withColumn("_base", F.when(F.col("_gate"), F.regexp_count(norm, F.lit(base))).otherwise(F.lit(0)))
        .withColumn(
            "_found",
            F.when(F.size("_keywords") > 0, _resolved(F.flatten(F.transform(active, lambda r: _detections(norm, r))))).otherwise(none),
        )
    )
    n_words = _spaces(norm) - 1
    parts, found = F.split(norm, base, -1), F.regexp_extract_all(norm, F.lit(base), F.lit(0))
    some = F.col("_base") > 0
    base_labels = F.when(
        some, F.array_sort(F.array_compact(F.array(*[F.when(norm.contains(f" {p} "), F.lit(label)) for p, label in PHRASES.items()])))
    ).otherwise(F.array().cast("array<string>"))
    labelled = rows.withColumn("_labels", base_labels)
    every = F.array_sort(F.array_union("_labels", F.transform("_found", lambda d: d["label"])))
    best = F.array_max(F.transform("_found", lambda d: d["score"]))
    return labelled.select(
        F.col("_id").alias(id_col), n_words.cast("bigint").alias("n_words"), F.col("_base").cast("bigint").alias("n_base"),
        F.when(some, _spaces(F.get(parts, F.lit(0))) - 1).cast("bigint").alias("first_word"),
        F.when(some, n_words - (_spaces(F.element_at(parts, -1)) - 1) - (_spaces(F.element_at(found, -1)) + 1)).cast("bigint").alias("last_word"),
        F.array_join("_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(some, F.lit(0.9)).otherwise(F.lit(0.0))).alias("score"),
        F.transform(
            "_found",
            lambda d: F.struct(d["start"].alias("start"), (-d["neg_end"]).alias("end"), d["label"].alias("label"), d["priority"].alias("rule"), d["score"].alias("score")),
        ).alias("detections"),
    )
