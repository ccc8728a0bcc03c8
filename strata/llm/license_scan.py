"""License scan: ordered signature rules, resolved by priority and interval containment.

All of it is DataFrame expressions. A text
passes the keyword prefilter if it contains one of a few stems; of others only the words are
counted. A text that passes is normalised to lower-case words; each word that is a rule's keyword is a *place*. The words from a place on (at most
``CONTEXT``) are matched against the rules of that keyword, in order; the first rule that
matches claims the words it covers. A detection inside an earlier, wider one of at least its
priority is suppressed. Base phrases are counted at every place, suppressed or not.

Nothing is shuffled: a document's places and detections are arrays in its own row, and a
detection is held against those that start at most ``CONTEXT`` words before it only.

Defined cases: a null text counts as empty; every row gives one row, repeated and null ids
too; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 24

#: The contract's phrases and labels, fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_LATER = r" or (?:at your option )?(?:any )?later(?: versions?)?"
_UNDER = r"(?: is)? under(?: the)?(?: terms of(?: the)?)?"

#: Families with numbered versions: (label, name as a pattern, versions as words).
_FAMILIES = [
    ("gpl", r"gnu general public licen[sc]e|gnu gpl|gpl", ["1 0", "2 0", "3 0"]),
    ("lgpl", r"gnu lesser general public licen[sc]e|gnu library general public licen[sc]e|gnu lgpl|lgpl", ["2 0", "2 1", "3 0"]),
    ("agpl", r"gnu affero general public licen[sc]e|affero general public licen[sc]e|gnu agpl|agpl", ["1 0", "3 0"]),
    ("gfdl", r"gnu free documentation licen[sc]e|gfdl", ["1 1", "1 2", "1 3"]),
    ("apache", r"apache software licen[sc]e|apache licen[sc]e", ["1 0", "1 1", "2 0"]),
    ("mpl", r"mozilla public licen[sc]e|mpl", ["1 0", "1 1", "2 0"]),
    ("epl", r"eclipse public licen[sc]e|epl", ["1 0", "2 0"]),
    ("cddl", r"common development and distribution licen[sc]e|cddl", ["1 0", "1 1"]),
    ("eupl", r"european union public licen[sc]e|eupl", ["1 0", "1 1", "1 2"]),
    ("artistic", r"artistic licen[sc]e", ["1 0", "2 0"]),
    ("bsl", r"boost software licen[sc]e|bsl", ["1 0"]),
    ("osl", r"open software licen[sc]e|osl", ["1 0", "2 1", "3 0"]),
    ("afl", r"academic free licen[sc]e|afl", ["2 1", "3 0"]),
    ("ofl", r"sil open font licen[sc]e|open font licen[sc]e|ofl", ["1 0", "1 1"]),
    ("ms-pl", r"microsoft public licen[sc]e", []),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", []),
    ("cpl", r"common public licen[sc]e", ["1 0"]),
    ("psf", r"python software foundation licen[sc]e|psf licen[sc]e", ["2 0"]),
    ("php", r"php licen[sc]e", ["3 0", "3 01"]),
    ("zpl", r"zope public licen[sc]e", ["2 0", "2 1"]),
    ("lppl", r"latex project public licen[sc]e|lppl", ["1 0", "1 3", "1 3c"]),
    ("odbl", r"open database licen[sc]e|odbl", ["1 0"]),
    ("odc-by", r"open data commons attribution licen[sc]e", ["1 0"]),
    ("mit", r"mit licen[sc]e|expat licen[sc]e|x11 licen[sc]e", []),
    ("isc", r"isc licen[sc]e", []),
    ("zlib", r"zlib licen[sc]e|zlib libpng licen[sc]e", []),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e|wtfpl", ["2 0"]),
    ("unlicense", r"the unlicense|unlicense", []),
    ("postgresql", r"postgresql licen[sc]e", []),
    ("openssl", r"openssl licen[sc]e", []),
]
#: Families whose grants name later versions too.
_WITH_LATER = ("gpl", "lgpl", "agpl", "gfdl")
_CC_PARTS = ["by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by"]
_CC_NAMES = {
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc": "attribution non ?commercial",
    "by nd": "attribution no ?deriv(?:ative)?s",
    "by sa": "attribution share ?alike",
    "by": "attribution",
}
_CC_VERSIONS = ["4 0", "3 0", "2 5", "2 0", "1 0"]
#: Signatures written by hand, sentences of licence texts and names without versions: (label, keyword, pattern).
_PHRASES = [
    ("bsd-2-clause", "bsd", r"bsd 2 clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause(?: licen[sc]e)?"),
    ("0bsd", "0bsd", r"0bsd"),
    ("bsd", "bsd", r"bsd licen[sc]e"),
    ("bsd-2-clause", "2", r"2 clause bsd(?: licen[sc]e)?"),
    ("bsd-3-clause", "3", r"3 clause bsd(?: licen[sc]e)?"),
    ("bsd-2-clause", "simplified", r"simplified bsd(?: licen[sc]e)?"),
    ("bsd-3-clause", "new", r"new bsd(?: licen[sc]e)?"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms"),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("gpl", "this", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2.0-or-later", "gplv2", r"gplv2 or later"),
    ("gpl-3.0-or-later", "gplv3", r"gplv3 or later"),
    ("gpl-2.0", "gplv2", r"gplv2"),
    ("gpl-3.0", "gplv3", r"gplv3"),
    ("lgpl-2.1", "lgplv2", r"lgplv2 1"),
    ("lgpl-2.0", "lgplv2", r"lgplv2"),
    ("lgpl-3.0", "lgplv3", r"lgplv3"),
    ("agpl-3.0", "agplv3", r"agplv3"),
    ("apache-2.0", "asl", r"asl 2 0"),
    ("gnu-2.0-or-later", "either", r"either version 2 of the licen[sc]e or at your option any later version"),
    ("gnu-2.1-or-later", "either", r"either version 2 1 of the licen[sc]e or at your option any later version"),
    ("gnu-3.0-or-later", "either", r"either version 3 of the licen[sc]e or at your option any later version"),
    ("gfdl", "permission", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer)?"),
    ("bsd-3-clause", "neither", r"neither the name (?:of )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("mit", "copyright", r"copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsl-1.0", "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("postgresql", "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("hpnd", "permission", r"permission to use copy modify distribute and sell this software and its documentation for any purpose"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "origin", r"origin of this software must not be misrepresented"),
    ("apache-2.0", "file", r"file except in compliance with the licen[sc]e"),
    ("apache-2.0", "distributed", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", "https", r"https www apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-2.0", "http", r"http www apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-1.1", "product", r"product includes software developed by the apache software foundation"),
    ("openssl", "product", r"product includes software developed by the openssl project"),
    ("mpl-2.0", "source", r"source code form is subject to the terms of the mozilla public licen[sc]e(?: v ?2 0)?"),
    ("mpl-1.1", "contents", r"contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("epl-2.0", "accompanying", r"accompanying materials are made available under the terms of the eclipse public licen[sc]e v ?(?:ersion )?2 0"),
    ("epl-1.0", "accompanying", r"accompanying materials are made available under the terms of the eclipse public licen[sc]e v ?(?:ersion )?1 0"),
    ("ofl-1.1", "font", r"font software is licensed under the sil open font licen[sc]e version 1 1"),
    ("unlicense", "free", r"free and unencumbered software released into the public domain"),
    ("cc0", "waived", r"waived all copyright and related or neighbou?ring rights"),
    ("perl", "same", r"same terms as perl(?: itself)?"),
    ("ijg", "independent", r"independent jpeg group s(?: [^ ]+)? software"),
    ("ncsa", "university", r"university of illinois(?: ncsa)? open source licen[sc]e"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e"),
    ("mulan-psl", "mulan", r"mulan permissive software licen[sc]e"),
    ("blueoak", "blue", r"blue oak model licen[sc]e"),
    ("w3c", "w3c", r"w3c software(?: notice and)?(?: document)? licen[sc]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e"),
    ("qpl", "q", r"q public licen[sc]e"),
    ("rpl", "reciprocal", r"reciprocal public licen[sc]e"),
    ("ipl", "ibm", r"ibm public licen[sc]e"),
    ("spl", "sun", r"sun public licen[sc]e"),
    ("apsl", "apple", r"apple public source licen[sc]e"),
    ("nposl", "non", r"non profit open software licen[sc]e"),
    ("cecill", "cecill", r"cecill (?:free software )?licen[sc]e"),
    ("etalab", "licence", r"licence ouverte"),
    ("ogl-uk", "open", r"open government licen[sc]e"),
    ("pddl", "public", r"public domain dedication and licen[sc]e"),
    ("cdla-permissive", "community", r"community data licen[sc]e agreement permissive"),
    ("cdla-sharing", "community", r"community data licen[sc]e agreement sharing"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("curl", "curl", r"curl licen[sc]e"),
    ("beerware", "beer", r"beer ?ware licen[sc]e"),
    ("elastic", "elastic", r"elastic licen[sc]e"),
    ("sspl", "server", r"server side public licen[sc]e"),
    ("busl", "business", r"business source licen[sc]e"),
    ("commons-clause", "commons", r"commons clause(?: licen[sc]e)? condition"),
    ("polyform", "polyform", r"polyform (?:[^ ]+ ){1,2}licen[sc]e"),
    ("llama", "llama", r"llama (?:[0-9]{1,2} ){0,2}community licen[sc]e"),
    ("openrail", "open", r"open rail(?: m)? licen[sc]e"),
    ("rail", "responsible", r"responsible ai licen[sc]e"),
    ("eula", "end", r"end user licen[sc]e agreement"),
    ("commercial", "commercial", r"commercial licen[sc]e"),
    ("non-commercial", "licensed", r"licensed for non ?commercial use(?: only)?"),
    ("non-commercial", "license", r"licen[sc]e for non ?commercial use(?: only)?"),
    ("warranty-disclaimer", "without", r"without warranty of any kind(?: express or implied)?"),
    ("warranty-disclaimer", "without", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "cc", r"cc zero"),
    ("cc0", "creative", r"creative commons zero"),
    ("public-domain", "public", r"public domain dedication"),
    ("public-domain", "dedicated", r"dedicated to the public domain"),
    ("public-domain", "released", r"released (?:in)?to the public domain"),
    ("all-rights-reserved", "all", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "confidential", r"confidential and proprietary"),
    ("spdx", "spdx", r"spdx license identifier(?: [^ ]+){1,4}"),
    ("license-file", "see", r"see (?:the )?licen[sc]e(?: file)?(?: for details)?"),
    ("unknown-license", "licensed", r"licensed under(?: the)?(?: [^ ]+){0,6}? licen[sc]e"),
    ("unknown-license", "license", r"licen[sc]e agreement"),
]


def _numbered(versions: list[str]) -> list[tuple[str, str]]:
    """(label suffix, pattern) of version numbers: "2 0" is also written 2, v2, v2.0 or version 2. Such short forms
    come after versions with a minor number, whose first word they would take."""
    short = {v: v.removesuffix(" 0") for v in versions}
    ordered = sorted(versions, key=lambda v: short[v] != v)
    return [("-" + v.replace(" ", "."), r"(?: version)? (?:v ?)?" + short[v] + ("(?: 0)?(?! [0-9](?: |$))" if short[v] != v else "")) for v in ordered]


def rules() -> list[dict]:
    """Signature rules in their order: keyword, pattern over normalised words, label, confidence.

    Longer forms come first: grant with version, name with version, grant with name, name. A rule that reads a
    version names it in its label: ``gpl-2.0``, ``gpl-2.0-or-later``, ``cc-by-4.0``.
    """
    found: list[tuple[int, dict]] = []

    def add(tier: int, label: str, keyword: str, pattern: str, confidence: float) -> None:
        found.append((tier, {"label": label, "keyword": keyword, "pattern": pattern, "confidence": confidence}))

    for label, names, versions in _FAMILIES:
        numbered = _numbered(versions)
        if label in _WITH_LATER:
            numbered = [(v + "-or-later", p + _LATER) for v, p in numbered] + numbered
        for name in names.split("|"):
            keyword = name.split(" ")[0]
            for version, pattern in numbered:
                add(2, label + version, keyword, f"{name}{pattern}", 0.95)
            add(4, label, keyword, name, 0.9)
        any_name = f"(?:{names})"
        for verb in ("licensed", "released", "distributed", "available"):
            for version, pattern in numbered:
                add(1, label + version, verb, f"{verb}{_UNDER} {any_name}{pattern}", 1.0)
            add(3, label, verb, f"{verb}{_UNDER} {any_name}", 0.95)
    for parts, version in product(_CC_PARTS, _CC_VERSIONS):
        label = f"cc-{parts.replace(' ', '-')}-{version.replace(' ', '.')}"
        add(2, label, "cc", f"cc {parts} {version.replace(' ', ' ?')}", 0.95)
        add(2, label, "creative", f"creative commons {_CC_NAMES[parts]}(?: licen[sc]e)? {version}", 0.95)
        add(1, label, "licensed", f"licensed{_UNDER}(?: a)? (?:cc {parts}|creative commons {_CC_NAMES[parts]}) {version}", 1.0)
    for parts in _CC_PARTS:
        label = f"cc-{parts.replace(' ', '-')}"
        add(4, label, "cc", f"cc {parts}", 0.9)
        add(4, label, "creative", f"creative commons {_CC_NAMES[parts]}", 0.9)
    weak = ("unknown-license", "license-file", "copyright", "all-rights-reserved", "warranty-disclaimer", "commercial")
    for label, keyword, pattern in _PHRASES:
        add(6 if label in ("unknown-license", "license-file") else 5, label, keyword, pattern, 0.5 if label in weak else 0.85)
    return [r | {"tier": tier} for tier, r in sorted(found, key=lambda x: x[0])]


#: The keyword prefilter: every rule's match and every base phrase holds one of these, in words
#: with one space around each.
STEMS = ("licen", "gpl", "gfdl", "cddl", "eupl", "lppl", "odbl", "wtfpl", "spdx", "bsd", " creative ", " public ",
         " rights ", "copyright", "confidential", "redistribution", " permission ",
         " advertising materials ", " endorse or promote ", " misrepresented ", " perl ", " jpeg ", " commons clause ", " warrant", " openssl ", " apache software ",
         " cc ", " cc0 ", " mpl ", " epl ", " bsl ", " osl ", " afl ", " ofl ", " asl ")
_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _table() -> Column:
    """keyword -> its rules in order, as a constant map."""
    by: dict[str, list[str]] = {}
    for r in rules():
        by.setdefault(r["keyword"], []).append(
            f"named_struct('p', '^(?:{r['pattern']})(?= |$)', 'label', '{r['label']}', 'tier', {r['tier']}, "
            f"'score', {r['confidence']}D)")
    return F.expr("map(" + ", ".join(f"'{k}', array({', '.join(v)})" for k, v in by.items()) + ")")


def detections(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__words`` (count), ``__base`` (struct of start, label) and ``__found`` (kept
    detections: struct of start, end, label, tier, score), both ordered by start."""
    table = _table()
    keywords = sorted({r["keyword"] for r in rules()})
    spaced = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(F.col(text), F.lit("")), F.lit(" ")), _SEPARATORS, " ")
    passes = F.lit(False)
    for stem in reversed(STEMS):
        passes = F.contains(F.col("__lower"), F.lit(stem)) | passes
    words = F.col("__list")
    kw = F.array(*[F.lit(k) for k in keywords])

    def context(p: Column) -> Column:
        return F.array_join(F.slice(words, p + 1, F.lit(CONTEXT)), " ")

    def first_match(p: Column, ctx: Column) -> Column:
        tried = F.filter(F.element_at(table, F.get(words, p)), lambda r: F.rlike(ctx, r["p"]))
        rule = F.get(tried, F.lit(0))
        matched = F.regexp_substr(ctx, rule["p"])
        n = F.size(F.split(matched, " "))
        return F.when(rule.isNotNull(), F.struct(
            p.alias("start"), (p + n).alias("end"), rule["label"].alias("label"),
            rule["tier"].alias("tier"), rule["score"].alias("score")))

    base_first = sorted({p.split(" ")[0] for p in BASE})

    def base_label(p: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            parts = phrase.split(" ")
            same = F.lit(True)
            for i, w in enumerate(parts):
                same = same & (F.get(words, p + i) == w)
            out = F.when(same, F.lit(label)).otherwise(out)
        return out

    df = docs.withColumn("__spaced", spaced)
    df = df.withColumn("__lower", F.lower("__spaced"))
    df = df.withColumn("__words", (F.length("__spaced") - F.length(F.replace("__spaced", F.lit(" "), F.lit(""))) - 1).cast("long"))
    listed = F.split(F.trim(F.translate("__spaced", _UPPER, _UPPER.lower())), " ")
    df = df.withColumn("__list", F.when(passes, listed).otherwise(F.array().cast("array<string>")))
    df = df.drop("__lower", "__spaced")
    numbered = F.transform(words, lambda w, i: F.when(w.isin(keywords) | w.isin(base_first), i))
    df = df.withColumn("__places", F.filter(numbered, lambda p: p.isNotNull()))
    df = df.withColumn("__base", F.filter(
        F.transform("__places", lambda p: F.struct(p.alias("start"), base_label(p).alias("label"))),
        lambda x: x["label"].isNotNull()))
    matched = F.transform(F.filter("__places", lambda p: F.array_contains(kw, F.get(words, p))),
                          lambda p: first_match(p, context(p)))
    df = df.withColumn("__all", F.filter(matched, lambda x: x.isNotNull()))
    all_ = F.col("__all")
    near = lambda i: F.slice(all_, F.greatest(i + 1 - CONTEXT, F.lit(1)), F.least(i, F.lit(CONTEXT)))
    df = df.withColumn("__found", F.filter(all_, lambda x, i: ~F.exists(
        near(i), lambda y: (y["end"] >= x["end"]) & (y["start"] <= x["start"]) & (y["tier"] <= x["tier"]))))
    return df.drop("__list", "__places", "__all")


def scan(docs: DataFrame) -> DataFrame:
    """Contract of ``op4``: base places and the labels of all kept detections, per document."""
    found = detections(docs.select("doc_id", "text"))
    starts = F.transform("__base", lambda x: x["start"].cast("long"))
    base = F.array_sort(F.array_distinct(F.transform("__base", lambda x: x["label"])))
    own = F.transform("__found", lambda x: x["label"])
    return found.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        F.size("__base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("__found", lambda x: x["score"])), F.lit(0.0)),
                   F.when(F.size("__base") > 0, F.lit(0.9)).otherwise(F.lit(0.0))).cast("double").alias("score"),
        F.transform("__found", lambda x: F.struct(x["start"], x["end"], x["label"])).alias("detections"),
    )
