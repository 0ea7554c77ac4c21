"""License scans by ordered signature rules, in DataFrame operations only.

A rule has a keyword (a literal that stands in every match), a regex over the
lower-cased line, a label and a priority (1 is the most specific).  Texts and
then lines without any keyword are skipped; on the others the rules whose
keyword stands in the line are run.  A detection that lies inside another of
the same line is suppressed if the other's priority is better, or equal with
a longer interval; equal intervals go to the better priority and then to the
earlier rule.

The rule table is built from license families: each family states its name,
short name, keyword and versions, and a few signature forms are written once
for all families.  Everything runs inside the document's own row: there is no
shuffle, so no key can be hot.

Defined results: a null text is empty; an empty text has no words, labels or
places and score 0; repeated rows are scanned each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# License families (label, full name, short name, versions).
FAMILIES = [
    ("gpl", "gnu general public licen[sc]e", "gpl", "1.0 2.0 3.0"),
    ("lgpl", "gnu (?:lesser|library) general public licen[sc]e", "lgpl", "2.0 2.1 3.0"),
    ("agpl", "(?:gnu )?affero general public licen[sc]e", "agpl", "1.0 3.0"),
    ("gfdl", "gnu free documentation licen[sc]e", "gfdl", "1.1 1.2 1.3"),
    ("apache", "apache (?:software )?licen[sc]e", "apache", "1.0 1.1 2.0"),
    ("mpl", "mozilla public licen[sc]e", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public licen[sc]e", "epl", "1.0 2.0"),
    ("cddl", "common development and distribution licen[sc]e", "cddl", "1.0 1.1"),
    ("cpl", "common public licen[sc]e", "cpl", "1.0"),
    ("eupl", "european union public licen[sc]e", "eupl", "1.0 1.1 1.2"),
    ("osl", "open software licen[sc]e", "osl", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "academic free licen[sc]e", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic licen[sc]e", "artistic", "1.0 2.0"),
    ("zpl", "zope public licen[sc]e", "zpl", "1.1 2.0 2.1"),
    ("lppl", "latex project public licen[sc]e", "lppl", "1.0 1.1 1.2 1.3"),
    ("ofl", "sil open font licen[sc]e", "ofl", "1.0 1.1"),
    ("cecill", "cecill (?:free software )?licen[sc]e", "cecill", "1.0 1.1 2.0 2.1"),
    ("php", "php licen[sc]e", "php", "3.0 3.01"),
    ("psf", "python software foundation licen[sc]e", "psf", "2.0"),
    ("ms-pl", "microsoft public licen[sc]e", "ms-pl", "1.0"),
    ("bsl", "boost software licen[sc]e", "bsl", "1.0"),
    ("odbl", "open (?:data commons open )?database licen[sc]e", "odbl", "1.0"),
    ("upl", "universal permissive licen[sc]e", "upl", "1.0"),
    ("ecl", "educational community licen[sc]e", "ecl", "1.0 2.0"),
    ("rpl", "reciprocal public licen[sc]e", "rpl", "1.1 1.5"),
    ("sspl", "server side public licen[sc]e", "sspl", "1.0"),
    ("qpl", "q public licen[sc]e", "qpl", "1.0"),
    ("apsl", "apple public source licen[sc]e", "apsl", "1.0 1.1 1.2 2.0"),
]
# Creative Commons elements (code, words) and versions.
CC_KINDS = [
    ("by", "attribution"), ("by-sa", "attribution[- ]share[- ]?alike"), ("by-nc", "attribution[- ]non[- ]?commercial"),
    ("by-nd", "attribution[- ]no[- ]?deriv(?:ative)?s(?: works)?"),
    ("by-nc-sa", "attribution[- ]non[- ]?commercial[- ]share[- ]?alike"),
    ("by-nc-nd", "attribution[- ]non[- ]?commercial[- ]no[- ]?deriv(?:ative)?s(?: works)?"),
]
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0".split()
# Single signatures (label, keyword, priority, regex).
SINGLES = [
    ("mit", "mit", 3, r"\bmit(?:/x11)? licen[sc]e\b"),
    ("mit", "expat", 3, r"\bexpat licen[sc]e\b"),
    ("mit", "spdx", 1, r"spdx-license-identifier:\s*mit\b"),
    ("mit", "opensource.org", 2, r"opensource\.org/licenses/mit\b"),
    ("mit", "free of charge", 2, r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "as is", 4, r"the software is provided [\"'“]?as is[\"'”]?, without warranty of any kind"),
    ("bsd", "bsd", 4, r"\bbsd(?:[- ]style)? licen[sc]e\b"),
    ("bsd-2", "bsd", 3, r"\b(?:2|two)[- ]clause bsd\b|\bbsd[- ](?:2|two)[- ]clause\b|\bsimplified bsd\b"),
    ("bsd-3", "bsd", 3, r"\b(?:3|three)[- ]clause bsd\b|\bbsd[- ](?:3|three)[- ]clause\b|\bnew bsd\b|\bmodified bsd\b"),
    ("bsd-4", "bsd", 3, r"\b(?:4|four)[- ]clause bsd\b|\bbsd[- ](?:4|four)[- ]clause\b|\boriginal bsd\b"),
    ("bsd-0", "bsd", 3, r"\b0bsd\b|\bzero[- ]clause bsd\b"),
    ("bsd", "redistribution", 2, r"redistribution and use in source and binary forms"),
    ("bsd-3", "endorse", 3, r"neither the name of .{1,120} nor the names of its contributors may be used to endorse"),
    ("isc", "isc", 3, r"\bisc licen[sc]e\b"),
    ("isc", "permission to use", 2, r"permission to use, copy, modify,? and/?(?:or)? distribute this software for any purpose"),
    ("unlicense", "unlicense", 3, r"\bthe unlicense\b|\bunlicense\.org\b"),
    ("unlicense", "public domain", 2, r"free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", 4, r"\b(?:in|into|to) the public domain\b"),
    ("wtfpl", "do what the", 3, r"do what the f\S+ you want to public licen[sc]e"),
    ("zlib", "zlib", 3, r"\bzlib(?:/libpng)? licen[sc]e\b"),
    ("zlib", "as-is", 2, r"this software is provided 'as-is', without any express or implied warranty"),
    ("cc0", "cc0", 3, r"\bcc0(?:[- ]1\.0)?\b"),
    ("cc0", "publicdomain", 2, r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc", "creative commons", 5, r"\bcreative commons licen[sc]e\b"),
    ("proprietary", "all rights reserved", 5, r"\ball rights reserved\b"),
    ("proprietary", "proprietary", 4, r"\bproprietary (?:and confidential|licen[sc]e)\b"),
    ("proprietary", "confidential", 4, r"\bunauthori[sz]ed copying .{1,80} strictly prohibited\b"),
    ("proprietary", "licen", 4, r"\bend[- ]user licen[sc]e agreement\b"),
    ("commercial", "licen", 4, r"\bcommercial licen[sc]e\b"),
    ("copyright", "copyright", 6, r"\bcopyright (?:\(c\)|©)? ?(?:19|20)\d\d\b"),
    ("copyright", "©", 6, r"© ?(?:19|20)\d\d\b"),
    ("other-license", "licen", 7, r"\blicen[sc]ed under [^.\n]{1,80}"),
    ("other-license", "licen", 7, r"\breleased under the [^.\n]{1,60} licen[sc]e\b"),
]
# Confidence of one detection, by priority 1-7.
CONFIDENCE = [0.99, 0.97, 0.9, 0.75, 0.6, 0.4, 0.5]

# The base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _family_rules():
    """Signature forms of versioned families, from the most specific on."""
    for label, name, short, versions in FAMILIES:
        for version in versions.split():
            major, minor = version.split(".")
            number = rf"{major}(?:\.{minor})?" if minor == "0" else rf"{major}\.{minor}"
            tag = f"{label}-{version}"
            exact = rf"{short}[-_ ]?v?{major}\.{minor}"
            yield tag, "spdx", 1, rf"spdx-license-identifier:\s*{short}-{number}(?:-only|-or-later|\+)?(?![\d.]*\d)"
            yield tag, f"{short}-{version}", 2, rf"licen[sc]es?(?:/old-licenses)?/{short}-{major}\.{minor}\b"
            yield tag, "licen", 3, rf"{name}(?:,? ?\(?(?:{short})?\)?,?)? ?(?:version |ver\.? |v\.? ?)?{number}(?![\d.]*\d)"
            yield tag, short, 4, rf"\b{exact}\b"
        yield label, "licen", 5, rf"\b{name}\b"


def _creative_commons_rules():
    for code, words in CC_KINDS:
        for version in CC_VERSIONS:
            v = version.replace(".", r"\.")
            yield f"cc-{code}-{version}", f"licenses/{code}/", 2, rf"creativecommons\.org/licenses/{code}/{v}"
            yield f"cc-{code}-{version}", f"cc {code}", 3, rf"\bcc {code}[- ]{v}"
            yield f"cc-{code}-{version}", f"cc-{code}", 3, rf"\bcc-{code}[- ]{v}"
            yield f"cc-{code}-{version}", "creative commons", 3, rf"creative commons {words}(?: licen[sc]e)?,? ?(?:version |v)?{v}"
        yield f"cc-{code}", "creative commons", 4, rf"creative commons {words}"


def rules() -> list[tuple[str, str, int, str]]:
    """(label, keyword, priority, regex), in the order of the rules."""
    found = [*_family_rules(), *_creative_commons_rules(), *SINGLES]
    return sorted(found, key=lambda r: r[2])


def _gates(table) -> list[str]:
    """Keywords without those that contain another: if none of them stands
    in a text, none of the others does."""
    words = {r[1] for r in table}
    return sorted(w for w in words if not any(v in w for v in words if v != w))


def _any_of(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def _rule_array(table) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(word).alias("word"), F.lit(priority).alias("priority"), F.lit(pattern).alias("pattern"))
                     for i, (label, word, priority, pattern) in enumerate(table)])


def _matches(line: Column, at: Column, rule: Column) -> Column:
    """All matches of a rule in a line, with their places (from the lengths
    of the pieces between the matches)."""
    found = F.regexp_extract_all(line, rule["pattern"], F.lit(0))
    between = F.split(line, rule["pattern"])
    pairs = F.zip_with(found, between, lambda m, b: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")))
    first = F.struct(F.lit(0).alias("place"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def add(s, p):
        start = s["place"] + p["gap"]
        return F.struct((start + p["size"]).alias("place"), F.concat(s["out"], F.array(F.struct(start.alias("start"), (start + p["size"]).alias("end")))).alias("out"))

    spans = F.aggregate(F.filter(pairs, lambda p: p["size"].isNotNull()), first, add)["out"]
    return F.transform(spans, lambda s: F.struct(at.alias("line"), s["start"].alias("start"), s["end"].alias("end"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["rule"].alias("rule")))


def _suppressed(d: Column, e: Column) -> Column:
    """Whether ``e`` of the same line suppresses ``d``."""
    inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
    longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
    better = e["priority"] < d["priority"]
    level = e["priority"] == d["priority"]
    return inside & (better | (level & (longer | (e["rule"] < d["rule"]))))


def scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the document's own columns), ``n_words``, ``places``
    (start, label of the base phrases), ``detections`` (line, start, end,
    priority, label, rule: what the rules find, after suppression) and
    ``score``: the confidence that the text states a license."""
    table = rules()
    gates = _gates(table)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.lower(text).alias("low"))
    phrases = [p for p, _ in BASE]
    own = own.select("row", "n_words", F.when(_any_of(F.col("low"), gates), F.col("low")).alias("low"), F.contains("low", F.lit("license")).alias("based"))
    words = F.when(F.col("based"), F.split(F.trim(F.regexp_replace("low", NOT_WORD, " ")), " "))
    lines = F.transform(F.split("low", "\n"), lambda s, i: F.struct(i.alias("at"), s.alias("line")))
    own = own.select("row", "n_words", words.alias("words"), F.filter(lines, lambda s: _any_of(s["line"], gates)).alias("lines"), _rule_array(table).alias("rules"))

    def place(i):
        found = F.lit(None).cast("string")
        for phrase, label in BASE:
            parts = phrase.split(" ")
            same = F.lit(True)
            for k, part in enumerate(parts):
                same = same & F.coalesce(F.get("words", i + k) == part, F.lit(False))
            found = F.when(same, F.lit(label)).otherwise(found)
        return F.struct(i.cast("long").alias("start"), found.alias("label"))

    assert len({p.split(" ")[0] for p in phrases}) == len(phrases)  # one label per place
    places = F.filter(F.transform(F.sequence(F.lit(0), F.size("words") - 1), place), lambda p: p["label"].isNotNull())

    def of_line(s):
        runs = F.filter("rules", lambda r: F.contains(s["line"], r["word"]) & F.rlike(s["line"], r["pattern"]))
        return F.flatten(F.transform(runs, lambda r: _matches(s["line"], s["at"], r)))

    empty_places = F.array().cast("array<struct<start:bigint,label:string>>")
    kind = "array<struct<line:int,start:int,end:int,priority:int,label:string,rule:int>>"
    own = own.select("row", "n_words", F.coalesce(places, empty_places).alias("places"), F.transform("lines", of_line).alias("by_line"))
    # line by line: the comparisons grow with a line's detections, not with the text's
    left = F.transform("by_line", lambda found: F.filter(found, lambda d: ~F.exists(found, lambda e: _suppressed(d, e))))
    own = own.select("row", "n_words", "places", F.coalesce(F.flatten(left), F.array().cast(kind)).alias("detections"))
    sure = F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.lit(1))
    levels = F.array(*[F.lit(1.0 - c) for c in CONFIDENCE])
    doubt = F.aggregate("detections", F.lit(1.0), lambda s, d: s * F.element_at(levels, d["priority"]))
    doubt = F.when(F.size("places") > 0, F.least(doubt, F.lit(1.0) - sure)).otherwise(doubt)
    return own.select("row", "n_words", "places", "detections", (F.lit(1.0) - doubt).alias("score"))
