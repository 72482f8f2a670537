"""License scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

The rules see a text as its words in lower case, one blank before, between and after them: names and identifiers of
licenses in tags, grants, labels and running text, and sentences of license texts and file headers. A rule's regex is
tried only where one of its keywords occurs. A detection goes if it lies within another one of the same or a better tier.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import bound, lower_ascii, match_spans

#: Not a word: ASCII other than digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: label, keywords (|: any of them) without one of which no name matches, regex of its identifier in tags, regex of its names.
LICENSES = (
    ("mit", "mit lic", "mit", "(?:the )?mit licen[sc]e"),
    ("mit-0", "mit no", "mit 0", "mit no attribution"),
    ("apache-1", "apache", "apache 1 1", "apache (?:software )?licen[sc]e (?:version |v)?1(?: [01])?"),
    ("apache-2", "apache|asl 2 0|al2 0", "apache 2(?: 0)?", "apache (?:software )?licen[sc]e (?:version |v)?2(?: 0)?|asl 2 0|al2 0"),
    ("gpl-1", "gpl", "gpl 1 0(?: only| or later)?", "gpl ?v?1(?: 0)?"),
    ("gpl-2", "gpl", "gpl 2 0(?: only| or later)?", "(?:gnu )?gpl (?:version )?v?2(?: 0)?|gplv2"),
    ("gpl-2", "general public", "gpl2", "(?:gnu )?general public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("gpl-3", "gpl", "gpl 3 0(?: only| or later)?", "(?:gnu )?gpl (?:version )?v?3(?: 0)?|gplv3"),
    ("gpl-3", "general public", "gpl3", "(?:gnu )?general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("gpl", "general public", "gpl", "gnu general public licen[sc]e"),
    ("lgpl-2", "lgpl", "lgpl 2 [01](?: only| or later)?", "lgpl (?:version )?v?2(?: [01])?|lgplv2"),
    ("lgpl-3", "lgpl", "lgpl 3 0(?: only| or later)?", "lgpl (?:version )?v?3(?: 0)?|lgplv3"),
    ("lgpl", "public licen", "lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e(?: (?:version |v)?[23](?: [01])?)?"),
    ("agpl-3", "agpl", "agpl 3 0(?: only| or later)?", "agpl (?:version )?v?3(?: 0)?|agplv3"),
    ("agpl", "affero", "agpl", "(?:gnu )?affero general public licen[sc]e(?: (?:version |v)?3(?: 0)?)?"),
    ("bsd-2", "bsd", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3", "bsd", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?"),
    ("bsd-4", "bsd", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?"),
    ("bsd-0", "bsd", "0bsd", "zero clause bsd(?: licen[sc]e)?"),
    ("bsd", "bsd", "bsd", "bsd (?:style )?licen[sc]e"),
    ("isc", "isc lic", "isc", "isc licen[sc]e"),
    ("mpl-1", "mozilla public", "mpl 1 [01]", "mozilla public licen[sc]e (?:version |v)?1(?: [01])?"),
    ("mpl-2", "mozilla public", "mpl 2 0", "mozilla public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("epl-1", "eclipse public", "epl 1 0", "eclipse public licen[sc]e (?:version |v)?1(?: 0)?"),
    ("epl-2", "eclipse public", "epl 2 0", "eclipse public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("cddl-1", "common development", "cddl 1 [01]", "common development and distribution licen[sc]e"),
    ("cpl-1", "common public", "cpl 1 0", "common public licen[sc]e"),
    ("artistic-1", "artistic lic", "artistic 1 0", "artistic licen[sc]e(?: 1(?: 0)?)?"),
    ("artistic-2", "artistic lic", "artistic 2 0", "artistic licen[sc]e (?:version )?2(?: 0)?"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("boost-1", "boost software", "bsl 1 0", "boost software licen[sc]e(?: (?:version )?1 0)?"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql", "postgresql licen[sc]e"),
    ("python-2", "python software", "python 2 0", "python software foundation licen[sc]e(?: version 2)?"),
    ("php-3", "php", "php 3 01", "php licen[sc]e(?: version 3(?: 01)?)?"),
    ("ofl-1", "open font", "ofl 1 [01]", "(?:sil )?open font licen[sc]e(?: version 1 [01])?"),
    ("eupl-1", "european union", "eupl 1 [012]", "european union public licen[sc]e"),
    ("odbl-1", "open data", "odbl 1 0", "open data commons open database licen[sc]e|open database licen[sc]e"),
    ("gfdl", "free documentation", "gfdl 1 [0-9](?: only| or later)?", "gnu free documentation licen[sc]e"),
    ("cc0", "cc0", "cc0 1 0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc by", "cc by [1-4] [05]", "cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by sa", "cc by sa [1-4] [05]", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd", "cc by nd [1-4] [05]", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc", "cc by nc [1-4] [05]", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa [1-4] [05]", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd [1-4] [05]", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative commons", "cc by", "creative commons attribution(?: [1-4] [05])?(?: international)?(?: licen[sc]e)?"),
    ("cc-by-sa", "creative commons", "cc by sa", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative commons", "cc by nd", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc", "creative commons", "cc by nc", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative commons", "cc by nc sa", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "creative commons", "cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("public-domain", "public domain", "public domain", "(?:dedicated to|released into|in) the public domain"),
    ("proprietary", "all rights", "proprietary", "all rights reserved"),
)

#: label, keyword, regex: sentences of license texts, headers of files and addresses of licenses.
NOTICES = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge(?: to any person obtaining a copy of this software)?"),
    ("boost-1", "permission is hereby granted", "permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation"),
    ("isc", "is hereby granted", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-0", "is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("postgresql", "is hereby granted", "for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "is hereby granted", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and without fee)? is hereby granted"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "neither the name", "neither the names? of [a-z0-9 ]{1,80} nor the names of (?:its|their|any) contributors"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such"),
    ("apache-2", "file except in compliance", "you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2", "apache org", "apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-1", "apache software", "this product includes software developed by the apache software foundation"),
    ("gpl-2", "general public", "gnu general public licen[sc]e (?:version 2 )?as published by the free software foundation either version 2"),
    ("gpl-2", "general public", "gnu general public licen[sc]e version 2 as published by the free software foundation"),
    ("gpl-3", "general public", "gnu general public licen[sc]e (?:version 3 )?as published by the free software foundation either version 3"),
    ("gpl-2", "general public", "gnu general public licen[sc]e version 2 june 1991"),
    ("gpl-3", "general public", "gnu general public licen[sc]e version 3 29 june 2007"),
    ("lgpl-2", "general public", "gnu (?:lesser|library) general public licen[sc]e as published by the free software foundation either version 2(?: 1)?"),
    ("lgpl-3", "general public", "gnu lesser general public licen[sc]e as published by the free software foundation either version 3"),
    ("agpl-3", "affero", "gnu affero general public licen[sc]e as published by the free software foundation either version 3"),
    ("gpl", "gnu org", "gnu org licen[sc]es gpl"),
    ("gpl-2", "gnu org", "gnu org licen[sc]es(?: old licen[sc]es)? gpl 2 0"),
    ("gpl-3", "gnu org", "gnu org licen[sc]es gpl 3 0"),
    ("lgpl", "gnu org", "gnu org licen[sc]es lgpl"),
    ("agpl", "gnu org", "gnu org licen[sc]es agpl"),
    ("gfdl", "gnu org", "gnu org licen[sc]es fdl"),
    ("mpl-2", "mozilla public", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("mpl-2", "mozilla org", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1", "mozilla public", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("epl-1", "eclipse org", "eclipse org legal epl v10"),
    ("epl-2", "eclipse org", "eclipse org legal epl (?:2 0|v20)"),
    ("epl-2", "eclipse public", "made available under the terms of the eclipse public licen[sc]e v ?2 0"),
    ("boost-1", "boost org", "boost org license 1 0"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "what the", "do what the f[a-z]+ you want to(?: public licen[sc]e)?"),
    ("cc0", "possible under law", "to the extent possible under law [a-z0-9 ]{1,80} waived all copyright and related or neighbou?ring rights"),
    ("cc0", "publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons", "creativecommons org licen[sc]es by(?: [1-4] [05])?"),
    ("cc-by-sa", "creativecommons", "creativecommons org licen[sc]es by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "creativecommons", "creativecommons org licen[sc]es by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "creativecommons", "creativecommons org licen[sc]es by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licen[sc]es by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licen[sc]es by nc nd(?: [1-4] [05])?"),
    ("ofl-1", "scripts sil org", "scripts sil org ofl"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "confidential", "proprietary and confidential|confidential and proprietary"),
)

#: tier (0 is best), weight for the score, regex around {tag}, {name}, {any} (either) or {plain} (a name or, of most licenses, an identifier with a version).
SHAPES = (
    (0, 1.0, "(?:spdx (?:license identifier )?|(?<= spdx (?:license identifier )?[a-z0-9 ]{{0,80}}(?:or|and) ))(?:{tag})"),
    (0, 0.95, "(?:licensed|released|distributed|published|available|provided|made available) under (?:a |an )?(?:the )?(?:terms of (?:the )?)?(?:{any})(?: licen[sc]e)?"),
    (1, 0.8, "(?:licen[sc]e|licensed|copying|terms of use) (?:is |of |the |under )?(?:{name})|licen[sc]es? (?:name |id |type |identifier |is |the )?(?:{tag})"),
    (1, 0.7, "(?:{name}) (?:applies|terms|agreement|text|notice)"),
    (2, 0.6, "(?:{plain})"),
)

#: Identifiers that are no sign of a license in running text.
COMMON = ("mit-0", "python-2", "php-3", "artistic-1", "artistic-2", "apache-1")

#: Every match of a rule and every base phrase contains one of these; only texts with one are looked at.
STEMS = (
    "licen", "spdx", " under ", "asl 2 0", "al2 0", "gpl", "bsd", "mit no attribution", "wtfpl", "cc0", "cc by", "creative commons", "public domain",
    "all rights reserved", "apache 2", "apache software", "mpl ", "epl ", "cddl ", "cpl 1", "bsl 1", "ofl", "eupl", "odbl", "gfdl",
    "is hereby granted", "redistribution and use", "neither the name", "advertising materials", "altered source versions",
    "unencumbered", "what the", "possible under law", "publicdomain", "unauthorized copying", "proprietary",
)


def _literal(tag: str) -> str:
    """What every match of an identifier begins with, and the blank before it."""
    return " " + re.split(r"[(\[?|]", tag)[0]


def signature_rules() -> list[tuple[int, int, float, str, tuple[str, ...], str]]:
    """(order, tier, weight, label, keywords, regex): every notice, and every license in every shape."""
    rules = []

    def add(tier: int, weight: float, label: str, keywords: tuple[str, ...], regex: str) -> None:
        rules.append((len(rules), tier, weight, label, keywords, f"(?<= )(?:{regex})(?= )"))

    for label, keyword, regex in NOTICES:
        add(0, 0.9, label, (keyword,), regex)
    for tier, weight, shape in SHAPES:
        for label, keyword, tag, name in LICENSES:
            bare = re.search("[0-9]", tag) and label not in COMMON
            kinds = {"any": f"{name}|{tag}", "plain": f"{name}|{tag}" if bare else name}
            named = tuple(keyword.split("|")) if "{name}" in shape or "{any}" in shape or "{plain}" in shape else ()
            tagged = (_literal(tag),) if "{tag}" in shape or "{any}" in shape or ("{plain}" in shape and bare) else ()
            add(tier, weight, label, named + tagged, shape.format(tag=tag, name=name, **kinds))
    return rules


def _detections(words: Column) -> Column:
    """All detections of all rules: start and end in characters, tier, weight, label."""
    given = signature_rules()
    fields = ("rule", "tier", "weight", "label", "keywords", "regex")
    value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, tuple) else F.lit(v)
    rules = F.array(*(F.struct(*(value(v).alias(k) for k, v in zip(fields, r))) for r in given))
    keywords = F.array(*(F.lit(k) for k in sorted({k for r in given for k in r[4]})))
    present = F.filter(keywords, lambda k: F.contains(words, k))
    tried = bound(present, lambda some: F.filter(rules, lambda r: F.arrays_overlap(r["keywords"], some)))

    def found(r: Column) -> Column:
        return F.transform(
            match_spans(words, r["regex"]),
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("minus_end"), r["tier"].alias("tier"), r["rule"].alias("rule"),
                r["weight"].alias("weight"), r["label"].alias("label"),
            ),
        )

    return F.sort_array(F.flatten(F.transform(tried, found)))


def _uncontained(sorted_detections: Column) -> Column:
    """Those not within a detection of the same or a better tier. In order of start, longer ones first, it is enough
    to know the largest end so far per tier."""
    tiers = range(3)
    zero = F.struct(*(F.lit(-1).alias(f"t{k}") for k in tiers), F.array().cast("array<struct<label:string,weight:double>>").alias("kept"))

    def step(acc, d):
        end = -d["minus_end"]
        inside = F.lit(False)
        for k in tiers:
            inside = inside | ((d["tier"] >= k) & (acc[f"t{k}"] >= end))
        ends = [F.when(d["tier"] == k, F.greatest(acc[f"t{k}"], end)).otherwise(acc[f"t{k}"]).alias(f"t{k}") for k in tiers]
        one = F.array(F.struct(d["label"].alias("label"), d["weight"].alias("weight")))
        return F.struct(*ends, F.when(inside, acc["kept"]).otherwise(F.array_distinct(F.concat(acc["kept"], one))).alias("kept"))

    return F.aggregate(sorted_detections, zero, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters and non-ASCII characters, in lower case. n_base counts the places of the BASE
    phrases, first_word and last_word are their smallest and largest start, null without any. The labels
    are distinct, sorted and comma-joined; ``labels`` has those of the rules too. ``score`` is the largest weight
    of a detection that stands, 0 without any. Null and empty texts have no words; an empty table gives an empty one. Texts of any
    length are scanned whole, repeated rows each. Other columns are not looked at, whatever their names.
    """
    plain = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), BETWEEN, " "))
    rows = docs.select(F.col(id_col).alias("doc_id"), plain.alias("_p"))
    p = F.col("_p")
    # all letters in lower case are enough to look for stems; the rules see ASCII letters alone changed
    rows = rows.select("doc_id", "_p", F.concat(F.lit(" "), F.lower(p), F.lit(" ")).alias("_l"))
    look = F.lit(False)
    for stem in STEMS:
        look = look | F.contains("_l", F.lit(stem))
    words = F.when(look, F.concat(F.lit(" "), lower_ascii(p), F.lit(" ")))
    counted = F.when(p == "", 0).otherwise(F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) + 1)
    rows = rows.select("doc_id", counted.cast("long").alias("n_words"), words.alias("_w"))
    w = F.col("_w")
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    found = [
        F.when(F.contains(w, F.lit(f" {phrase} ")), F.transform(match_spans(w, f"(?<= ){phrase}(?= )"), lambda s: s["start"]))
        for phrase, _ in BASE
    ]
    none = F.array().cast("array<int>")
    rows = rows.select(
        "doc_id", "n_words", "_w", *(F.coalesce(f, none).alias(f"_b{i}") for i, f in enumerate(found)),
        F.when(w.isNotNull(), bound(_detections(w), _uncontained)).alias("_kept"),
    )
    places = F.concat(*(F.col(f"_b{i}") for i in range(len(BASE))))
    base = F.array_compact(F.array(*(F.when(F.size(f"_b{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(BASE))))
    kept = F.coalesce("_kept", F.array().cast("array<struct<label:string,weight:double>>"))
    at = lambda c: (blanks(F.substr(w, F.lit(1), c)) - 1).cast("long")
    return rows.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        at(F.array_min(places)).alias("first_word"),
        at(F.array_max(places)).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform(kept, lambda k: k["label"]))), ",").alias("labels"),
        F.coalesce(F.greatest(F.array_max(F.transform(kept, lambda k: k["weight"])), F.when(F.size(base) > 0, 1.0)), F.lit(0.0)).alias("score"),
    )
