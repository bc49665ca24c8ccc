"""License detection by ordered signature rules, in DataFrame functions alone.

A text is normalised to its lower-cased words, one space between them. Rules
are (label, keyword, pattern, tier): a text is a candidate if it holds any
keyword, and a rule's pattern runs on a candidate only if its keyword, which
every match of the pattern holds, stands in it. Every match is an interval of characters. Detections of a text are put
in order of start, longest first; one that lies inside an earlier detection of
the same or a stronger tier is suppressed, so the most specific statement wins
(tier 1: license statements and identifiers, 2: names, 3: hints). Three base
phrases are counted by word position and never suppressed.

Null and empty texts have no words, no labels and score 0. Repeated rows and
null ids give a row each. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareflow.llm.common import kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Fixed values of the contract: phrase and label.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# label, words of its SPDX id, pattern of its name
NAMES = [
    ("mit", "mit", r"(mit|expat|x11) licen[sc]e"),
    ("mit-0", "mit 0", r"mit no attribution( licen[sc]e)?"),
    ("apache-1.1", "apache 1 1", r"apache (software )?licen[sc]e (version |v)?1 1"),
    ("apache-2.0", "apache 2 0", r"apache (software )?licen[sc]e (version |v ?)?2( 0)?"),
    ("bsd-1-clause", "bsd 1 clause", r"bsd 1 clause( licen[sc]e)?"),
    ("bsd-2-clause", "bsd 2 clause", r"((simplified|freebsd) bsd licen[sc]e|bsd (2|two) clause( licen[sc]e)?|(2|two) clause bsd licen[sc]e)"),
    ("bsd-3-clause", "bsd 3 clause", r"((new|revised|modified) bsd licen[sc]e|bsd (3|three) clause( licen[sc]e)?|(3|three) clause bsd licen[sc]e)"),
    ("bsd-4-clause", "bsd 4 clause", r"((original|old) bsd licen[sc]e|bsd (4|four) clause( licen[sc]e)?|(4|four) clause bsd licen[sc]e)"),
    ("0bsd", "0bsd", r"(zero clause bsd( licen[sc]e)?|0bsd licen[sc]e)"),
    ("mpl-1.0", "mpl 1 0", r"mozilla public licen[sc]e (version |v)?1 0"),
    ("mpl-1.1", "mpl 1 1", r"mozilla public licen[sc]e (version |v)?1 1"),
    ("mpl-2.0", "mpl 2 0", r"mozilla public licen[sc]e (version |v)?2 0"),
    ("epl-1.0", "epl 1 0", r"eclipse public licen[sc]e (version |v)?1 0"),
    ("epl-2.0", "epl 2 0", r"eclipse public licen[sc]e (version |v)?2 0"),
    ("edl-1.0", "bsd eclipse", r"eclipse distribution licen[sc]e( version| v)? 1 0"),
    ("cddl-1.0", "cddl 1 0", r"common development and distribution licen[sc]e( version 1 0| v1 0)?"),
    ("cddl-1.1", "cddl 1 1", r"common development and distribution licen[sc]e (version |v)1 1"),
    ("cpl-1.0", "cpl 1 0", r"common public licen[sc]e( version 1 0)?"),
    ("ipl-1.0", "ipl 1 0", r"ibm public licen[sc]e( version 1 0)?"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib( libpng)? licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("bsl-1.0", "bsl 1 0", r"boost software licen[sc]e( version 1 0)?"),
    ("busl-1.1", "busl 1 1", r"business source licen[sc]e( version)?( 1 1)?"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "wtfpl", r"do what the f\w+ you want to public licen[sc]e"),
    ("artistic-1.0", "artistic 1 0", r"artistic licen[sc]e (version )?1 0"),
    ("artistic-2.0", "artistic 2 0", r"artistic licen[sc]e (version )?2 0"),
    ("perl", "artistic 1 0 perl", r"same terms as perl itself"),
    ("python-2.0", "python 2 0", r"python (software foundation )?licen[sc]e( version 2)?"),
    ("cnri-python", "cnri python", r"cnri (open source )?licen[sc]e( agreement)?"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("php-3.01", "php 3 01", r"php licen[sc]e( version 3 01)?"),
    ("zend-2.0", "zend 2 0", r"zend engine licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("ssleay", "ssleay", r"ssleay licen[sc]e"),
    ("curl", "curl", r"curl licen[sc]e"),
    ("ncsa", "ncsa", r"(university of illinois )?ncsa (open source )?licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("ofl-1.0", "ofl 1 0", r"sil open font licen[sc]e (version )?1 0"),
    ("ofl-1.1", "ofl 1 1", r"(sil )?open font licen[sc]e( version)?( 1 1)?"),
    ("osl-3.0", "osl 3 0", r"open software licen[sc]e( version)?( 3 0)?"),
    ("afl-3.0", "afl 3 0", r"academic free licen[sc]e( version)?( 3 0)?"),
    ("eupl-1.1", "eupl 1 1", r"european union public licen[sc]e (version |v )?1 1"),
    ("eupl-1.2", "eupl 1 2", r"european union public licen[sc]e (version |v )?1 2"),
    ("cecill-2.1", "cecill 2 1", r"cecill( free software)? licen[sc]e( agreement)?"),
    ("ms-pl", "ms pl", r"microsoft public licen[sc]e"),
    ("ms-rl", "ms rl", r"microsoft reciprocal licen[sc]e"),
    ("sspl-1.0", "sspl 1 0", r"server side public licen[sc]e"),
    ("elastic-2.0", "elastic 2 0", r"elastic licen[sc]e( 2 0)?"),
    ("apsl-2.0", "apsl 2 0", r"apple public source licen[sc]e"),
    ("npl-1.1", "npl 1 1", r"netscape public licen[sc]e"),
    ("qpl-1.0", "qpl 1 0", r"q public licen[sc]e"),
    ("upl-1.0", "upl 1 0", r"universal permissive licen[sc]e"),
    ("vsl-1.0", "vsl 1 0", r"vovida software licen[sc]e"),
    ("w3c", "w3c", r"w3c (software|document)( notice and)? licen[sc]e"),
    ("zpl-2.1", "zpl 2 1", r"zope public licen[sc]e"),
    ("odbl-1.0", "odbl 1 0", r"open database licen[sc]e"),
    ("odc-by-1.0", "odc by 1 0", r"open data commons attribution licen[sc]e"),
    ("pddl-1.0", "pddl 1 0", r"public domain dedication and licen[sc]e"),
    ("cdla-permissive-2.0", "cdla permissive 2 0", r"community data licen[sc]e agreement permissive"),
    ("cdla-sharing-1.0", "cdla sharing 1 0", r"community data licen[sc]e agreement sharing"),
    ("gfdl-1.3", "gfdl 1 3", r"(gnu )?free documentation licen[sc]e"),
    ("ogl-uk-3.0", "ogl uk 3 0", r"open government licen[sc]e"),
    ("openrail-m", "openrail m", r"(open)?rail m? ?licen[sc]e"),
    ("cc0-1.0", "cc0 1 0", r"cc0( 1 0)?( universal)?"),
]

# label, keyword, pattern: whole statements that name no license
STATEMENTS = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "permission to use copy modify and", r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote products", r"neither the name of .{1,120}? may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "you may not use this file except", r"you may not use this file except in compliance with the license"),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented"),
    ("bsl-1.0", "to any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("unlicense", "released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("gpl", "redistribute it and or modify", r"you can redistribute it and or modify it under the terms of"),
    ("gpl", "free software foundation", r"published by the free software foundation"),
    ("mpl-2.0", "mozilla public license", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("wtfpl", "do what the", r"you just do what the f\w+ you want to"),
    ("postgresql", "without a written agreement", r"without fee and without a written agreement is hereby granted"),
    ("cc0-1.0", "creative commons", r"creative commons zero( 1 0)?( universal)?"),
    ("public-domain", "public domain", r"(dedicated|placed|released|put)( in| to| into)( the)? public domain"),
]

# label, keyword, pattern: hints
HINTS = [
    ("copyright", "copyright", r"copyright( c| ©)? (19|20)\d\d"),
    ("copyright", "copyright", r"(19|20)\d\d( by)? .{1,40}? copyright"),
    ("copyright", "copyright", r"copyrighted (material|work|content)"),
    ("copyright", "copyright", r"protected by copyright( laws?)?"),
    ("copyright", "copyright", r"copyright (holders?|owners?|notice)"),
    ("proprietary", "confidential", r"(proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "proprietary", r"proprietary licen[sc]e"),
    ("proprietary", "unauthorized", r"unauthorized (copying|reproduction|use|distribution)"),
    ("proprietary", "end user licen", r"end user licen[sc]e agreement"),
    ("no-redistribution", "redistribut", r"(may|must) not( be)? redistribut\w+"),
    ("no-redistribution", "written", r"without( the)?( prior| express)? written (permission|consent)"),
    ("noncommercial", "commercial", r"(for )?non ?commercial (use|purposes)( only)?"),
    ("noncommercial", "personal use", r"personal use only"),
    ("warranty", "warrant", r"without warranty of any kind"),
    ("warranty", "warrant", r"without warranties or conditions of any kind"),
    ("warranty", "warrant", r"as is without( any)?( express or implied)? warranty"),
    ("public-domain", "public domain", r"(in the )?public domain"),
    ("copyleft", "copyleft", r"copyleft( licen[sc]e)?"),
    ("open-source", "open source licen", r"open source licen[sc]e"),
    ("license", "license file", r"see( the)? license file"),
    ("license", "licen", r"under the terms of( the)? .{1,60}? licen[sc]e"),
    ("license", "licen", r"licen[sc]ed under"),
    ("license", "licen", r"released under( the)? .{1,40}? licen[sc]e"),
    ("license", "spdx", r"spdx licen[sc]e identifier"),
    ("reserved", "rights reserved", r"(some|no) rights reserved"),
]


def _word(label: str) -> str:
    return label.replace("-", " ").replace(".", " ")


def rules() -> list[tuple[str, str, str, int, float]]:
    """label, keyword, pattern, tier, weight; several hundred, most specific first."""
    out = []
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        long = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(ative|atives|s)", "nc": "non ?commercial"}
        name = " ".join(long[x] for x in kind.split("-"))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            out.append((f"cc-{kind}-{version}", "cc by", f"cc {_word(kind)}( licen[sc]e)?( version| v)? {_word(version)}", 1, 1.0))
            out.append((f"cc-{kind}-{version}", "creative commons", f"creative commons {name} {_word(version)}( international| unported| generic)?", 1, 1.0))
        out.append((f"cc-{kind}", "cc by", f"cc {_word(kind)}", 2, 0.8))
        out.append((f"cc-{kind}", "creative commons", f"creative commons {name}", 2, 0.8))
    for short, name, versions in (("gpl", "general public licen[sc]e", ("1.0", "2.0", "3.0")), ("lgpl", "(lesser|library) general public licen[sc]e", ("2.0", "2.1", "3.0")),
                                  ("agpl", "affero general public licen[sc]e", ("1.0", "3.0"))):
        for v in versions:
            number = _word(v).replace(" 0", "( 0)?")
            for tail, after in (("-or-later", r" or( \(?at your option\)?)?( any)? later( version)?"), ("-only", " only"), ("", "")):
                out.append((f"{short}-{v}{tail}", "general public licen", f"(gnu )?{name}( version| v)? ?{number}{after}", 1, 1.0))
                out.append((f"{short}-{v}{tail}", "gpl", f"(gnu )?{short} ?(version |v ?)?{number}{after}", 1, 1.0))
        out.append((short, "general public licen", f"(gnu )?{name}", 2, 0.8))
    for label, spdx, name in NAMES:
        key = "bsd" if "bsd" in name else "licen" if "licen" in name else spdx.split()[0]
        if label == "perl":
            key = "perl itself"
        if label == "mit-0":                 # the license word is optional
            key = "no attribution"
        out.append((label, "spdx", f"spdx licen[sc]e identifier {spdx}", 1, 1.0))
        out.append((label, key, f"(licen[sc]ed|released|distributed|available|provided) under( the)?( terms of( the)?)? {name}", 1, 1.0))
        out.append((label, key, name, 2, 0.8))
    out += [(label, key, pattern, 1, 1.0) for label, key, pattern in STATEMENTS]
    out += [(label, key, pattern, 3, 0.4) for label, key, pattern in HINTS]
    return out


def stems() -> list[str]:
    """The keywords that hold no other keyword: a text without any of them fires no rule."""
    keys = sorted({key for _, key, _, _, _ in rules()})
    return [k for k in keys if not any(o != k and o in k for o in keys)]


def normalised(text_col: str):
    """The lower-cased words of a text, each with a space before it, and one after the last."""
    flat = F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), NOT_WORD, " ")
    flat = F.trim(flat)
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _spaces(c):
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _base(x) -> dict:
    """Counts and places of the base phrases in a normalised text."""
    n, first, last, labels = [], [], [], []
    for phrase, label in PHRASES:
        held = F.contains(x, F.lit(f" {phrase} "))
        at = F.locate(f" {phrase} ", x)
        back = F.length(x) - (F.locate(f" {phrase} "[::-1], F.reverse(x)) - 1) - len(phrase) - 2
        n.append(F.when(held, F.regexp_count(x, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        first.append(F.when(held, _spaces(F.substring(x, F.lit(1), at)) - 1))
        last.append(F.when(held, _spaces(F.substring(x, F.lit(1), back + 1)) - 1))
        labels.append(F.when(held, F.lit(label)))
    return {"n_words": F.greatest(_spaces(x) - 1, F.lit(0)).cast("long"), "n_base": sum(n[1:], n[0]).cast("long"),
            "first_word": F.least(*first).cast("long"), "last_word": F.greatest(*last).cast("long"), "base_labels": F.concat_ws(",", *labels)}


def detections(texts: DataFrame) -> DataFrame:
    """Surviving detections of rows (row, x): row, label, tier, weight, lo, hi (characters of the normalised text)."""
    table = F.expr("array(" + ", ".join(
        f"named_struct('rule', {i}, 'label', '{label}', 'key', '{key}', 'pattern', r'(?<= )(?:{pattern})(?= )', 'tier', {tier}, 'weight', {weight}D)"
        for i, (label, key, pattern, tier, weight) in enumerate(rules())) + ")")
    fired = texts.select("row", "x", F.explode(F.filter(table, lambda r: F.contains(F.col("x"), r["key"]))).alias("r"))
    found = fired.select("row", "r", F.expr("regexp_extract_all(x, r.pattern, 0)").alias("hits"), F.expr("split(x, r.pattern, -1)").alias("gaps"))
    found = found.where(F.size("hits") > 0).select("row", "r", F.posexplode(F.arrays_zip("hits", "gaps")).alias("i", "m")).where("m.hits IS NOT NULL")
    order = Window.partitionBy("row", "r.rule").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    hi = F.sum(F.length("m.gaps") + F.length("m.hits")).over(upto)
    spans = found.select("row", "r.rule", "r.label", "r.tier", "r.weight", hi.alias("hi"), F.length("m.hits").alias("n")).withColumn("lo", F.col("hi") - F.col("n"))
    before = (Window.partitionBy("row").orderBy("lo", F.desc("hi"), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1))
    covers = [F.max(F.when(F.col("tier") <= t, F.col("hi"))).over(before) for t in (1, 2, 3)]
    cover = F.when(F.col("tier") == 1, covers[0]).when(F.col("tier") == 2, covers[1]).otherwise(covers[2])
    return spans.withColumn("cover", cover).where("cover IS NULL OR cover < hi").select("row", "label", "tier", "weight", "lo", "hi")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("x"))
    candidate = reduce(or_, (F.contains(F.col("x"), F.lit(k)) for k in stems()))
    base = kept(rows.select("row", "doc_id", F.when(candidate, F.col("x")).alias("x"), *[c.alias(n) for n, c in _base(F.col("x")).items()]), "license-base")
    found = detections(base.where("x IS NOT NULL").select("row", "x"))
    each = found.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("weight").alias("weight"))     # at most a label per rule
    both = F.array_union(F.when(F.col("base_labels") == "", F.array().cast("array<string>")).otherwise(F.split("base_labels", ",")),
                         F.coalesce("own", F.array().cast("array<string>")))
    score = F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.6).otherwise(0.0))
    return base.drop("x").join(each, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.sort_array(F.array_distinct(both)), ",").alias("labels"), score.cast("double").alias("score"))
