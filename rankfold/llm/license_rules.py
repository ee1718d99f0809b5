"""License detection by ordered signature rules.

A rule is a pattern over a text's plain words (A-Z lowered runs of letters, digits and
non-ASCII characters) written around one keyword, ``left @keyword right``. The keyword is the
prefilter: only rules of keywords that occur in a text are tried, and only around their
occurrences, in a stretch of ``REACH`` words to either side (no pattern is longer). A match
is an interval of words. An interval inside another one is suppressed if the other's rule
has a higher priority, or the same priority and a longer interval; the base phrases are
never suppressed. Rules come from license families and forms of mention, plus signature
sentences; ``rules()`` lists them.

Nulls: a null text is an empty text, without words and labels. Rows with the same text share
one detection and each get their row. Two matches of one interval and priority both stay. Texts
may be of any length. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.llm.common import let, plain_words, written

REACH = 16
SPAN = 4096
BASE_PRIORITY = 100

# Fixed values: (keyword, left, right, label); places where these words stand consecutively.
BASE = [
    ("license", "under the mit ", "", "mit"),
    ("license", "apache ", " version 2", "apache-2"),
    ("cc", "", " by nc", "cc-by-nc"),
]

# Label of a family, its name before the word license, versions by label suffix.
FAMILIES = [
    ("mit", "(?:mit|expat|x11)", {}),
    ("apache", "apache(?: software)?", {"1.1": "1 1", "2": "2(?: 0)?"}),
    ("bsd", "bsd(?: style)?", {}),
    ("bsd-2", "(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", {}),
    ("bsd-3", "(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", {}),
    ("bsd-4", "(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)", {}),
    ("gpl", "(?:gnu )?(?:general public|gpl)", {"1": "1(?: 0)?", "2": "2(?: 0)?", "3": "3(?: 0)?"}),
    ("lgpl", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)", {"2": "2(?: 0)?", "2.1": "2 1", "3": "3(?: 0)?"}),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", {"1": "1(?: 0)?", "3": "3(?: 0)?"}),
    ("fdl", "(?:gnu )?(?:free documentation|fdl|gfdl)", {"1.1": "1 1", "1.2": "1 2", "1.3": "1 3"}),
    ("mpl", "(?:mozilla public|mpl)", {"1": "1(?: 0)?", "1.1": "1 1", "2": "2(?: 0)?"}),
    ("epl", "(?:eclipse public|epl)", {"1": "1(?: 0)?", "2": "2(?: 0)?"}),
    ("cddl", "(?:common development and distribution|cddl)", {"1": "1(?: 0)?", "1.1": "1 1"}),
    ("cpl", "(?:common public|cpl)", {"1": "1(?: 0)?"}),
    ("eupl", "(?:european union public|eupl)", {"1.1": "1 1", "1.2": "1 2"}),
    ("isc", "isc", {}),
    ("zlib", "zlib(?: libpng)?", {}),
    ("artistic", "artistic", {"1": "1(?: 0)?", "2": "2(?: 0)?"}),
    ("boost", "boost software", {"1": "1(?: 0)?"}),
    ("ofl", "(?:sil )?(?:open font|ofl)", {"1": "1(?: 0)?", "1.1": "1 1"}),
    ("afl", "(?:academic free|afl)", {"2.1": "2 1", "3": "3(?: 0)?"}),
    ("osl", "(?:open software|osl)", {"2.1": "2 1", "3": "3(?: 0)?"}),
    ("psf", "(?:python software foundation|python|psf)", {"2": "2(?: 0)?"}),
    ("php", "php", {"3": "3(?: 0)?", "3.01": "3 01"}),
    ("ms-pl", "(?:microsoft public|ms pl)", {}),
    ("ms-rl", "(?:microsoft reciprocal|ms rl)", {}),
    ("odbl", "(?:open database|odc open database|odbl)", {"1": "1(?: 0)?"}),
    ("cecill", "cecill(?: [bc])?", {"2": "2(?: 0)?", "2.1": "2 1"}),
    ("vim", "vim", {}),
    ("postgresql", "postgresql", {}),
    ("openssl", "openssl", {}),
]

# Forms of mention around "<family> license": text before it, priority, weight.
GRANT = "(?:licensed|released|distributed|published|provided|available|redistributed|used) under "
FORMS = [
    (GRANT + "(?:the )?(?:terms of (?:the )?)?", 80, 0.95),
    ("(?:covered|governed) by (?:the )?(?:terms of (?:the )?)?", 75, 0.9),
    ("(?:see|read) the (?:file )?", 50, 0.7),
    ("", 40, 0.6),
]
CC_PARTS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# Signature sentences (keyword, left, right, label, priority, weight).
SIGNATURES = [
    ("permission", "", " is hereby granted free of charge to any person obtaining a copy", "mit", 90, 1.0),
    ("permission", "", " to use copy modify and or distribute this software for any purpose", "isc", 90, 1.0),
    ("redistribution", "", " and use in source and binary forms with or without modification", "bsd", 90, 1.0),
    ("warranty", "without any ", " (?:without even the implied warranty|implied or express)", "disclaimer", 30, 0.4),
    ("copyright", "", " (?:c )?(?:19|20)[0-9]{2}", "copyright-notice", 30, 0.4),
    ("rights", "all ", " reserved", "all-rights-reserved", 30, 0.5),
    ("domain", "(?:in|into|to) the public ", "", "public-domain", 70, 0.8),
    ("domain", "public ", " dedication", "public-domain", 70, 0.8),
    ("zero", "(?:creative commons |cc )", "(?: universal)?", "cc0", 70, 0.9),
    ("wtfpl", "", "", "wtfpl", 60, 0.8),
    ("unlicense", "", "", "unlicense", 60, 0.8),
    ("proprietary", "", " and confidential", "proprietary", 70, 0.9),
    ("copyleft", "", "", "copyleft", 20, 0.3),
    ("foundation", "published by the free software ", "", "gpl", 70, 0.8),
    ("permission", "", " to use copy modify and distribute this software and its documentation", "hpnd", 90, 1.0),
    ("permission", "", " is granted to anyone to use this software for any purpose", "zlib", 90, 0.9),
    ("notice", "the above copyright ", " and this permission notice (?:shall|appear)", "mit", 60, 0.7),
    ("redistributions", "", " of source code must retain the above copyright notice", "bsd", 85, 0.9),
    ("redistributions", "", " in binary form must reproduce the above copyright notice", "bsd", 85, 0.9),
    ("endorse", "may be used to ", " or promote products derived from this software", "bsd-3", 88, 0.95),
    ("advertising", "all ", " materials mentioning features or use of this software", "bsd-4", 88, 0.95),
    ("freebsd", "provided by the ", " project as is", "bsd-2", 70, 0.8),
    ("authors", "in no event will the ", " be held liable for any damages", "zlib", 80, 0.9),
    ("altered", "", " source versions must be plainly marked as such", "zlib", 85, 1.0),
    ("misrepresented", "origin of this software must not be ", "", "zlib", 85, 1.0),
    ("warranty", "the software is provided as is without ", " of any kind", "disclaimer", 30, 0.4),
    ("warranties", "basis without ", " or conditions of any kind", "disclaimer", 30, 0.4),
    ("merchantability", "(?:implied )?warrant(?:y|ies) of ", "", "disclaimer", 25, 0.3),
    ("compliance", "you may not use this file except in ", " with the license", "apache-2", 85, 0.9),
    ("licenses", "apache org ", " license 2 0", "apache-2", 85, 1.0),
    ("redistribute", "is free software you can ", " it and or modify it", "gpl", 70, 0.8),
    ("library", "this ", " is free software you can redistribute it", "lgpl", 75, 0.85),
    ("license", "gnu general public ", " as published by the free software foundation (?:either )?version 1", "gpl-1", 92, 1.0),
    ("license", "gnu general public ", " as published by the free software foundation (?:either )?version 2", "gpl-2", 92, 1.0),
    ("license", "gnu general public ", " as published by the free software foundation (?:either )?version 3", "gpl-3", 92, 1.0),
    ("license", "gnu (?:lesser|library) general public ", " as published by the free software foundation (?:either )?version 2", "lgpl-2", 93, 1.0),
    ("license", "gnu (?:lesser|library) general public ", " as published by the free software foundation (?:either )?version 2 1", "lgpl-2.1", 94, 1.0),
    ("license", "gnu (?:lesser|library) general public ", " as published by the free software foundation (?:either )?version 3", "lgpl-3", 93, 1.0),
    ("license", "gnu affero general public ", " as published by the free software foundation (?:either )?version 3", "agpl-3", 94, 1.0),
    ("mozilla", "source code form is subject to the terms of the ", " public", "mpl-2", 90, 1.0),
    ("mozilla", "contents of this file are subject to the ", " public", "mpl-1.1", 90, 0.9),
    ("eclipse", "made available under the terms of the ", " public", "epl", 85, 0.9),
    ("development", "subject to the terms of the common ", " and distribution", "cddl", 85, 0.9),
    ("unencumbered", "free and ", " software released into the public domain", "unlicense", 90, 1.0),
    ("fuck", "do what the ", " you want to", "wtfpl", 90, 1.0),
    ("waived", "", " all copyright and related or neighboring rights", "cc0", 85, 0.95),
    ("whatever", "as long as you retain this notice you can do ", " you want with this stuff", "beerware", 90, 1.0),
    ("beerware", "", "", "beerware", 60, 0.8),
    ("evil", "used for good not ", "", "json", 90, 1.0),
    ("ssleay", "", "", "openssl", 50, 0.6),
    ("unauthorized", "", " (?:copying|use|reproduction|distribution) of this (?:file|software|document)", "proprietary", 80, 0.9),
    ("confidential", "", " and proprietary", "proprietary", 70, 0.9),
    ("trade", "contains ", " secrets", "proprietary", 60, 0.7),
    ("sharealike", "attribution (?:noncommercial )?", "", "cc-by-sa", 40, 0.6),
    ("dual", "", " licensed under", "dual-license", 30, 0.5),
    ("gplv1", "", "", "gpl-1", 60, 0.9),
    ("gplv2", "", "", "gpl-2", 60, 0.9),
    ("gpl2", "", "", "gpl-2", 60, 0.9),
    ("gplv3", "", "", "gpl-3", 60, 0.9),
    ("gpl3", "", "", "gpl-3", 60, 0.9),
    ("lgplv2", "", "", "lgpl-2", 60, 0.9),
    ("lgplv2", "", " 1", "lgpl-2.1", 61, 0.9),
    ("lgplv3", "", "", "lgpl-3", 60, 0.9),
    ("lgpl3", "", "", "lgpl-3", 60, 0.9),
    ("agplv3", "", "", "agpl-3", 60, 0.9),
    ("agpl3", "", "", "agpl-3", 60, 0.9),
    ("asl2", "", "", "apache-2", 60, 0.8),
    ("apache2", "", "", "apache-2", 60, 0.8),
    ("cc0", "", "(?: 1 0)?", "cc0", 60, 0.9),
    ("0bsd", "", "", "bsd-0", 60, 0.9),
    ("bsl", "", " 1 0", "boost-1", 60, 0.8),
    ("gpl", "", "(?: version)? 1(?: 0)?(?: (?:only|or later))?", "gpl-1", 62, 0.8),
    ("gpl", "", "(?: version| v)? 2(?: 0)?(?: (?:only|or later))?", "gpl-2", 62, 0.9),
    ("gpl", "", " v2", "gpl-2", 62, 0.9),
    ("gpl", "", "(?: version| v)? 3(?: 0)?(?: (?:only|or later))?", "gpl-3", 62, 0.9),
    ("gpl", "", " v3", "gpl-3", 62, 0.9),
    ("gpl", "under the (?:terms of the )?(?:gnu )?", "", "gpl", 58, 0.8),
    ("lgpl", "", "(?: version| v)? 2(?: 0)?(?: (?:only|or later))?", "lgpl-2", 62, 0.9),
    ("lgpl", "", "(?: version| v)? 2 1(?: (?:only|or later))?", "lgpl-2.1", 63, 0.9),
    ("lgpl", "", " v2(?: 1)?", "lgpl-2.1", 62, 0.8),
    ("lgpl", "", "(?: version| v)? 3(?: 0)?(?: (?:only|or later))?", "lgpl-3", 62, 0.9),
    ("lgpl", "", " v3", "lgpl-3", 62, 0.9),
    ("lgpl", "under the (?:terms of the )?(?:gnu )?", "", "lgpl", 58, 0.8),
    ("agpl", "", "(?: version| v)? 3(?: 0)?(?: (?:only|or later))?", "agpl-3", 62, 0.9),
    ("agpl", "under the (?:terms of the )?(?:gnu )?", "", "agpl", 58, 0.8),
    ("mpl", "", "(?: version| v)? 1 1", "mpl-1.1", 62, 0.9),
    ("mpl", "", "(?: version| v)? 2 0", "mpl-2", 62, 0.9),
    ("epl", "", "(?: version| v)? 1 0", "epl-1", 62, 0.9),
    ("epl", "", "(?: version| v)? 2 0", "epl-2", 62, 0.9),
    ("eupl", "", "(?: version| v)? 1 2", "eupl-1.2", 62, 0.9),
    ("cddl", "", "(?: version| v)? 1 (?:0|1)", "cddl-1", 62, 0.9),
    ("ofl", "", "(?: version| v)? 1 1", "ofl-1.1", 62, 0.9),
    ("bsd", "", " 2 clause", "bsd-2", 62, 0.9),
    ("bsd", "", " 3 clause", "bsd-3", 62, 0.9),
    ("bsd", "", " 4 clause", "bsd-4", 62, 0.9),
    ("bsd", "under (?:the |a )", "", "bsd", 55, 0.7),
    ("apache", "(?:under |the )", " (?:version |v)?2(?: 0)?", "apache-2", 62, 0.8),
    ("license", "", " mit", "mit", 55, 0.8),
    ("license", "", " isc", "isc", 55, 0.8),
    ("license", "", " apache(?: license)? 2(?: 0)?", "apache-2", 57, 0.8),
    ("license", "", " bsd", "bsd", 55, 0.7),
    ("license", "", " bsd 2 clause", "bsd-2", 57, 0.8),
    ("license", "", " bsd 3 clause", "bsd-3", 57, 0.8),
    ("license", "", " gpl", "gpl", 55, 0.7),
    ("license", "", " lgpl", "lgpl", 55, 0.7),
    ("license", "", " agpl", "agpl", 55, 0.7),
    ("license", "", " zlib", "zlib", 55, 0.8),
    ("license", "", " unlicense", "unlicense", 55, 0.8),
    ("license", "", " wtfpl", "wtfpl", 55, 0.8),
    ("license", "", " cc0", "cc0", 55, 0.8),
    ("license", "", " proprietary", "proprietary", 55, 0.7),
    ("license", "", " (?:commercial|closed source)", "proprietary", 50, 0.6),
    ("license", "public domain ", "", "public-domain", 60, 0.7),
    ("license", "the un ", "", "unlicense", 60, 0.6),
]


def rules() -> list[tuple[str, str, str, str, int, float]]:
    """(keyword, pattern, label, form, priority, weight) of every rule, base phrases first."""
    out = [(k, f"{left}@{k}{right}", label, "base", BASE_PRIORITY, 1.0) for k, left, right, label in BASE]
    for label, name, versions in FAMILIES:
        for word in ("license", "licence"):
            for i, (before, priority, weight) in enumerate(FORMS):
                out.append((word, f"{before}{name} @{word}", label, f"form{i}", priority, weight))
                for suffix, v in versions.items():
                    out.append((word, f"{before}{name} @{word}(?: version| v)? {v}(?: or (?:any )?later(?: version)?)?",
                                f"{label}-{suffix}", f"form{i}-version", priority + 5, min(1.0, weight + 0.05)))
        out.append(("spdx", f"@spdx license identifier {name}", label, "spdx", 90, 1.0))
        for suffix, v in versions.items():
            out.append(("spdx", f"@spdx license identifier {name} {v}(?: (?:only|or later))?", f"{label}-{suffix}", "spdx-version", 95, 1.0))
    for part in CC_PARTS:
        label = "cc-" + part.replace(" ", "-")
        out.append(("cc", f"@cc {part}", label, "cc", 60 + len(part), 0.9))
        for v in CC_VERSIONS:
            out.append(("cc", f"@cc {part} {v}", f"{label}-{v.replace(' ', '.')}", "cc-version", 75 + len(part), 1.0))
    long = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?"}
    for part in CC_PARTS:
        words = " ".join(long[p] for p in part.split())
        out.append(("commons", f"creative @commons {words}", "cc-" + part.replace(" ", "-"), "cc-name", 60 + len(part), 0.9))
    return out + [(k, f"{left}@{k}{right}", label, "signature", p, w) for k, left, right, label, p, w in SIGNATURES]


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as a small fixed table, built from literals."""
    kind = "array<struct<keyword:string,pattern:string,label:string,form:string,priority:int,weight:double>>"
    rows = F.array(*[F.struct(*[F.lit(x) for x in r]) for r in rules()]).cast(kind)
    return spark.range(1).select(F.explode(rows).alias("r")).select(
        "r.keyword", F.concat(F.lit("(?<= )"), "r.pattern", F.lit("(?= )")).alias("pattern"),
        "r.label", "r.form", "r.priority", "r.weight")


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words and, around every keyword, its position and stretch."""
    keywords = sorted({r[0] for r in rules()})

    def stretches(w):
        def one(i):
            left = F.slice(w, F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH)))
            return F.struct(i.alias("at"), F.get(w, i).alias("keyword"), F.concat(
                F.lit(" "), F.array_join(left, " "), F.when(i > 0, F.lit(" ")).otherwise(F.lit("")), F.lit("@"),
                F.array_join(F.slice(w, i + 1, F.lit(REACH + 1)), " "), F.lit(" ")).alias("stretch"))

        found = F.filter(F.transform(w, lambda x, i: F.when(x.isin(keywords), i)), lambda i: i.isNotNull())
        return F.struct(F.size(w).cast("long").alias("n_words"), F.transform(found, one).alias("places"))

    # 128 bits: copies of a text share its detection, different texts must not
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_hash"),
                       let(plain_words(F.col("text")), stretches).alias("m")).select("doc_id", "text_hash", "m.*")


def detections(found: DataFrame) -> DataFrame:
    """One row per match in a different text: text_hash, start, end, label, form, priority, weight,
    kept.

    Copies of a text are reduced to one before the shuffle, and places are dealt by all their
    columns, so the places of one long text are tried in as many tasks as those of many. Blocks of
    ``SPAN`` words are searched for containing matches on their own, each with the matches
    that start in the ``2 * REACH`` words before it."""
    places = (found.filter(F.size("places") > 0).select("text_hash", F.explode("places").alias("p"))
              .select("text_hash", "p.*").distinct())
    # few bytes but hundreds of patterns each: a fixed number of partitions, which AQE leaves as it is
    places = places.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text_hash", "at")
    tried = places.join(F.broadcast(rule_table(found.sparkSession)), "keyword")  # a fixed table
    hit = F.regexp_substr("stretch", F.col("pattern"))
    before, after = F.substring_index("hit", "@", 1), F.substring_index("hit", "@", -1)
    spaces = lambda c: F.length(c) - F.length(F.translate(c, " ", ""))
    out = tried.withColumn("hit", hit).filter("hit IS NOT NULL").select(
        "text_hash", (F.col("at") - spaces(before)).cast("long").alias("start"),
        (F.col("at") + 1 + spaces(after)).cast("long").alias("end"), "label", "form", "priority", "weight").distinct()
    own = F.floor(F.col("start") / SPAN)
    blocks = F.when(F.col("start") % SPAN >= SPAN - 2 * REACH, F.array(own, own + 1)).otherwise(F.array(own))
    near = Window.partitionBy("text_hash", "block").orderBy("start").rangeBetween(-2 * REACH, 0)
    size = F.col("end") - F.col("start")
    over = F.exists("others", lambda o: (o["start"] <= F.col("start")) & (o["end"] >= F.col("end")) & (
        (o["priority"] > F.col("priority")) | ((o["priority"] == F.col("priority")) & (o["end"] - o["start"] > size))))
    return (out.withColumn("block", F.explode(blocks))
            .withColumn("others", F.collect_list(F.struct("start", "end", "priority")).over(near))
            .filter(F.col("block") == own).withColumn("kept", (F.col("form") == "base") | ~over).drop("others", "block"))


def licenses(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score (the
    largest weight of a kept match) and n_matches (kept ones)."""
    found = written(mentions(docs), "license-mentions")
    base = F.col("form") == "base"
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_text = detections(found).groupBy("text_hash").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), names(F.when(base, F.col("label"))).alias("base_labels"),
        names(F.when(F.col("kept"), F.col("label"))).alias("labels"), F.max(F.when(F.col("kept"), F.col("weight"))).alias("score"),
        F.count(F.when(F.col("kept"), 1)).alias("n_matches"))
    out = found.select("doc_id", "text_hash", "n_words").join(per_text, "text_hash", "left")
    zero, none = F.lit(0).cast("long"), F.lit("")
    return out.select("doc_id", "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_matches", zero).alias("n_matches"))
