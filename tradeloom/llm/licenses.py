"""License detection by ordered signature rules, in DataFrame functions only.

A keyword anywhere in the raw text lets a document into the scan. Its text then
becomes lower-case words with single spaces, each rule is tried only where its
own keyword occurs, and overlapping detections are settled by position: one that
lies inside another of the same or a stronger form is dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import let

# Fixed by the contract: phrases and their labels. Word characters are those outside these ranges.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# (label, keyword, name as it is written out, SPDX identifier), over words with single spaces. Each spelling
# of a name holds the keyword; "licen" stands for a name without one.
_V = r"(?: v| version)? ?"
NAMES = (
    ("mit", "licen", r"(?:mit|expat|mit x11|x11)", r"mit"),
    ("mit-0", "licen", r"mit (?:no attribution|0)", r"mit 0"),
    ("apache-1", "apache", rf"apache(?: software)?(?: licen[sc]e)?{_V}1(?: [01])?", r"apache 1 [01]"),
    ("apache-2", "apache", rf"apache(?: software)?(?: licen[sc]e)?{_V}2(?: 0)?", r"apache 2 0"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", r"apache"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd)", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", r"bsd 4 clause"),
    ("bsd-0-clause", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)", r"0bsd"),
    ("bsd", "bsd", r"bsd(?: style)?", r"bsd"),
    ("isc", "licen", r"(?:isc|internet systems consortium)", r"isc"),
    ("gpl-1", "gnu", rf"gnu (?:general public|gpl)(?: licen[sc]e)?{_V}1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gnu", rf"gnu (?:general public|gpl)(?: licen[sc]e)?{_V}2(?: 0)?", r"gpl 2 0(?: only)?"),
    ("gpl-2-or-later", "gnu", rf"gnu general public licen[sc]e{_V}2(?: 0)? or (?:any )?later", r"gpl 2 0 or later"),
    ("gpl-3", "gnu", rf"gnu (?:general public|gpl)(?: licen[sc]e)?{_V}3(?: 0)?", r"gpl 3 0(?: only)?"),
    ("gpl-3-or-later", "gnu", rf"gnu general public licen[sc]e{_V}3(?: 0)? or (?:any )?later", r"gpl 3 0 or later"),
    ("gpl", "general", r"(?:gnu )?general public", r"gpl"),
    ("lgpl-2", "general", rf"(?:gnu )?(?:lesser|library) general public licen[sc]e{_V}2(?: [01])?", r"lgpl 2 [01](?: only| or later)?"),
    ("lgpl-3", "lesser", rf"(?:gnu )?lesser general public licen[sc]e{_V}3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", "general", r"(?:gnu )?(?:lesser|library) general public", r"lgpl"),
    ("agpl-3", "affero", rf"(?:gnu )?affero general public licen[sc]e{_V}3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public", r"agpl"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation", r"gfdl 1 [123](?: only| or later)?"),
    ("mpl-1", "mozilla", rf"mozilla public licen[sc]e{_V}1(?: [01])?", r"mpl 1 [01]"),
    ("mpl-2", "mozilla", rf"mozilla public licen[sc]e{_V}2(?: 0)?", r"mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public", r"mpl"),
    ("epl-1", "eclipse", rf"eclipse public licen[sc]e{_V}1(?: 0)?", r"epl 1 0"),
    ("epl-2", "eclipse", rf"eclipse public licen[sc]e{_V}2(?: 0)?", r"epl 2 0"),
    ("edl-1", "eclipse", r"eclipse distribution", r"edl 1 0"),
    ("cddl", "licen", r"common development and distribution", r"cddl 1 [01]"),
    ("cpl-1", "licen", r"common public", r"cpl 1 0"),
    ("eupl", "licen", rf"european union public licen[sc]e{_V}(?:1 [012])?", r"eupl 1 [012]"),
    ("osl-3", "licen", r"open software", r"osl 3 0"),
    ("afl-3", "licen", r"academic free", r"afl 3 0"),
    ("artistic-1", "artistic", rf"artistic licen[sc]e{_V}1(?: 0)?", r"artistic 1 0"),
    ("artistic-2", "artistic", rf"artistic licen[sc]e{_V}2(?: 0)?", r"artistic 2 0"),
    ("artistic", "artistic", r"artistic", r"artistic"),
    ("bsl-1", "boost", rf"boost software licen[sc]e{_V}(?:1(?: 0)?)?", r"bsl 1 0"),
    ("busl-1", "business", r"business source", r"busl 1 1"),
    ("sspl-1", "licen", r"server side public", r"sspl 1 0"),
    ("elastic-2", "elastic", r"elastic", r"elastic 2 0"),
    ("zlib", "zlib", r"(?:zlib|zlib libpng)", r"zlib"),
    ("libpng", "libpng", r"libpng", r"libpng"),
    ("openssl", "openssl", r"openssl", r"openssl"),
    ("python-2", "licen", r"(?:python software foundation|psf|python)", r"(?:python|psf) 2 0"),
    ("php-3", "licen", r"php", r"php 3 01?"),
    ("ruby", "licen", r"ruby", r"ruby"),
    ("w3c", "licen", r"w3c(?: software)?", r"w3c"),
    ("ncsa", "licen", r"(?:university of illinois ncsa|ncsa)(?: open source)?", r"ncsa"),
    ("postgresql", "licen", r"postgresql", r"postgresql"),
    ("unlicense", "unlicen", r"unlicense", r"unlicense"),
    ("wtfpl", "fuck", r"do what the fuck you want to public", r"wtfpl"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("odbl", "licen", r"open (?:data commons open )?database", r"odbl 1 0"),
    ("pddl", "licen", r"(?:open data commons )?public domain dedication", r"pddl 1 0"),
    ("ofl", "licen", r"(?:sil )?open font", r"ofl 1 [01]"),
    ("ms-pl", "licen", r"microsoft public", r"ms pl"),
    ("ms-rl", "licen", r"microsoft reciprocal", r"ms rl"),
    ("ecl-2", "licen", r"educational community", r"ecl 2 0"),
    ("openrail", "licen", r"(?:creativeml open rail m|openrail(?: m)?|open rail m)", r"openrail"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc0", "commons", r"creative commons zero", r"cc0 1 0"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?", r"cc by [1-4] [05]"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?", r"cc by sa [1-4] [05]"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?", r"cc by nd [1-4] [05]"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?", r"cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?", r"cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?", r"cc by nc nd [1-4] [05]"),
    ("cc-by", "commons", r"creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?", r"cc by [1-4] [05]"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?", r"cc by sa [1-4] [05]"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?", r"cc by nc [1-4] [05]"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported)?", r"cc by nd [1-4] [05]"),
)

# (strength from 1 on, confidence, what stands around a name). Names that only
# mean a license beside that word are not matched alone.
_GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|redistributed|covered|used)"
FORMS = (
    (1, 1.0, r"spdx license identifier {spdx}"),
    (2, 0.95, _GRANT + r" under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: licen[sc]e)?"),
    (2, 0.9, r"under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name} licen[sc]e"),
    (3, 0.8, r"(?:the )?{name} licen[sc]e"),
    (3, 0.6, r"(?:the )?{name}"),
)
_ALONE = ("general", "lesser", "affero", "mozilla", "cc", "commons", "cc0", "wtfpl", "fuck", "gnu", "unlicen")
# Names of these keywords end in a version or "license" of their own.
_WHOLE = ("apache",)
_TIERS = 3

# Statements without a license name.
STATEMENTS = (
    ("proprietary", "reserved", 2, 0.7, r"all rights reserved"),
    ("proprietary", "proprietary", 2, 0.8, r"proprietary and confidential"),
    ("proprietary", "permission", 2, 0.7, r"may not be (?:copied|reproduced|distributed) without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
    ("mit", "permission", 2, 0.9, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", 2, 0.9, r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", 2, 0.9, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "warranty", 2, 0.8, r"provided as is without any express or implied warranty"),
    ("public-domain", "domain", 2, 0.8, r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "domain", 3, 0.6, r"this (?:work|text|document) is (?:in|part of) the public domain"),
    ("unlicense", "domain", 2, 0.9, r"free and unencumbered software released into the public domain"),
)


@cache
def rules() -> tuple[tuple[str, str, int, float, str], ...]:
    """(label, keyword, strength, confidence, regex) of every rule, in order."""
    out = list(STATEMENTS)
    for strength, confidence, form in FORMS:
        for label, keyword, name, spdx in NAMES:
            if form.endswith("{name}") and keyword not in (*_ALONE, *_WHOLE):
                continue
            # An identifier stands for its license wherever it follows the tag.
            gate = "spdx" if "{spdx}" in form else keyword
            # A grant need not say "license".
            gate = "under" if gate == "licen" and not form.endswith(" licen[sc]e") else gate
            out.append((label, gate, strength, confidence, form.format(name=name, spdx=spdx)))
    return tuple(dict.fromkeys(out))


# Each rule's regex needs one of: a keyword of these, "general" with "public", the word cc or cc0, or a grant.
_OPENING = ("spdx", "apache", "commons", "mozilla", "gpl", "wtfpl", "fuck", "reserved", "permission",
            "redistribution", "warranty", "domain", "proprietary", "licen")
_CC = rf"(?i)(?<!{_WORD})cc0?(?!{_WORD})"


def _speaks(text: Column) -> Column:
    """May a lower-case raw text match a rule? Plain searches, as every text takes them."""
    gate = F.contains(text, F.lit(_OPENING[0]))
    for word in _OPENING[1:]:
        gate = gate | F.contains(text, F.lit(word))
    gate = gate | (F.contains(text, F.lit("general")) & F.contains(text, F.lit("public")))
    gate = gate | (F.contains(text, F.lit("cc")) & F.regexp_like(text, F.lit(_CC)))
    return gate | (F.contains(text, F.lit("under")) & F.regexp_like(text, F.lit(f"{_GRANT}{_BETWEEN}under")))


def _bounded(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


# Around a match; no word holds them.
_OPEN, _CLOSE = "\x01", "\x02"


def _places(words: Column, regex: Column) -> Column:
    """(first, stop) word numbers of all matches of ``regex``, in time linear in
    the words: matches get marks, and marked words are read by their index."""
    def numbers(tokens: Column, test: Callable[[Column], Column], shift: int) -> Column:
        marked = F.transform(tokens, lambda w, i: F.when(test(w), (i - shift).cast("int")))
        return F.filter(marked, lambda i: i.isNotNull())

    def places(tokens: Column) -> Column:
        # An empty token lies before the first word.
        firsts = numbers(tokens, lambda w: F.startswith(w, F.lit(_OPEN)), 1)
        stops = numbers(tokens, lambda w: F.endswith(w, F.lit(_CLOSE)), 0)
        return F.zip_with(firsts, stops, lambda a, b: F.struct(a.alias("first"), b.alias("stop")))

    def read(marked: Column) -> Column:
        return F.when(F.contains(marked, F.lit(_OPEN)), let(F.split(marked, " ", -1), places)).otherwise(
            F.array().cast("array<struct<first:int,stop:int>>"))

    return let(F.regexp_replace(words, regex, F.lit(f"{_OPEN}$0{_CLOSE}")), read)


_DETECTION = "label:string,strength:int,confidence:double,first:int,stop:int"


def detections(words: Column, by_keyword: bool = True) -> Column:
    """All rule matches of normalised words, strongest form first within a place,
    without those that lie inside one of the same or a stronger form."""
    table = F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("keyword"), F.lit(c).alias("strength"),
                 F.lit(d).alias("confidence"), F.lit(_bounded(e)).alias("regex"))
        for a, b, c, d, e in rules()
    ])
    gated = F.filter(table, lambda r: F.contains(words, r["keyword"])) if by_keyword else table
    found = F.flatten(F.transform(gated, lambda r: F.transform(
        _places(words, r["regex"]), lambda p: F.struct(
            p["first"].alias("first"), (-p["stop"]).alias("back"), r["strength"].alias("strength"),
            r["label"].alias("label"), r["confidence"].alias("confidence")))))
    return let(F.array_sort(found), _settled)


def _settled(found: Column) -> Column:
    """Sorted detections without those inside an earlier one of the same or a
    stronger form.

    In order of start, longest first, a detection is inside an earlier one if
    it ends no later than the farthest end so far of its form or a stronger
    one. The list is cut into runs of about the square root of its length, so
    that no growing list is copied once per detection.
    """
    zero = F.array(*[F.lit(-1)] * _TIERS)

    def farther(ends: Column, d: Column) -> Column:
        return F.transform(ends, lambda e, i: F.when(
            i + 1 >= d["strength"], F.greatest(e, -d["back"])).otherwise(e))

    def step(acc: Column, d: Column) -> Column:
        stop = -d["back"]
        row = F.struct(d["label"].alias("label"), d["strength"].alias("strength"),
                       d["confidence"].alias("confidence"), d["first"].alias("first"), stop.alias("stop"))
        return F.struct(
            farther(acc["ends"], d).alias("ends"),
            F.when(F.element_at(acc["ends"], d["strength"]) >= stop, acc["kept"]).otherwise(
                F.array_append(acc["kept"], row)).alias("kept"))

    def settled(runs: Column) -> Column:
        reach = F.transform(runs, lambda run: F.aggregate(run, zero, farther))
        # The farthest ends before each run; one more entry than there are runs.
        before = F.aggregate(reach, F.array(zero), lambda acc, r: F.array_append(
            acc, F.zip_with(F.element_at(acc, -1), r, lambda a, b: F.greatest(a, b))))
        none = F.array().cast(f"array<struct<{_DETECTION}>>")
        return let(before, lambda ends: F.flatten(F.transform(runs, lambda run, i: F.aggregate(
            run, F.struct(ends[i].alias("ends"), none.alias("kept")), step, lambda acc: acc["kept"]))))

    def cut(size: Column) -> Column:
        starts = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found), size)).otherwise(
            F.array().cast("array<int>"))
        return let(F.transform(starts, lambda at: F.slice(found, at, size)), settled)

    return let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(found)))).cast("int"), cut)


def normalised(text: Column) -> Column:
    """Lower-case (A-Z) words with a space before, between and after them."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    parted = F.regexp_replace(text, _BETWEEN, " ")
    return F.concat(F.lit(" "), F.trim(F.translate(parted, upper, upper.lower())), F.lit(" "))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections) per document.

    ``n_base`` counts all places of the contract's phrases and ``first_word``
    and ``last_word`` are the smallest and largest word number where one
    starts, NULL without any. ``labels`` has the labels of those and of the
    detections that are left; ``score`` is the greatest confidence among them,
    1 for a phrase, 0 without any. NULL texts count as empty; each row is
    scanned by itself, so repeated rows and rows without doc_id are like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<struct<{_DETECTION}>>")
    place = "array<struct<label:string,first:int>>"

    def base(words: Column) -> Column:
        def of(phrase: str, label: str) -> Column:
            return F.transform(_places(words, F.lit(_bounded(phrase))), lambda p: F.struct(
                F.lit(label).alias("label"), p["first"].alias("first")))

        return F.concat(*[of(*entry) for entry in BASE.items()]).cast(place)

    def both(words: Column) -> Column:
        return F.struct(base(words).alias("base"), detections(words).alias("more"))

    found = F.when(let(F.lower(text), _speaks), let(normalised(text), both)).otherwise(
        F.struct(F.array().cast(place).alias("base"), none.alias("more")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_count(text, F.lit(f"{_WORD}+")).cast("long").alias("n_words"), found.alias("found"))
    starts = F.col("found.base.first")
    base_labels = F.array_distinct(F.col("found.base.label"))
    every = F.array_union(base_labels, F.col("found.more.label"))
    confidence = F.coalesce(F.array_max(F.col("found.more.confidence")), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(confidence).alias("score"),
        F.col("found.more").alias("detections"),
    )


def labels(docs: DataFrame) -> DataFrame:
    """``scan`` without the detections, with the same rows for NULL and empty
    texts, repeated rows and an empty table."""
    return scan(docs).drop("detections")
