"""Operator 9: license scans by ordered signature rules, in DataFrame functions only.

A text becomes its words (ASCII letters and digits, non-ASCII characters; A-Z
lower-cased) with single spaces between them. Signature rules are regular
expressions over such texts, written out per license family and form and expanded
over variants and versions to a few hundred. A document is looked at only if one
pattern of all keywords finds one of them; a rule runs only where its own keyword
stands. Every match is an interval of words. A match inside the interval of a
match of a rule of higher priority is suppressed; the labels of the others remain.
The base phrases are rules too, whose places are all counted and whose labels stay.

``score`` is the confidence of the strongest remaining rule (0 without any).

Everything is done within a row: no join, no shuffle.

Edge cases: null or empty text has no words, empty labels, null positions and
score 0. Ties in priority leave both labels. Repeated rows and null ids are each
scanned. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text

#: Fixed: the base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    label: str
    keyword: str       # a word, or the beginning of one, that every match contains
    pattern: str       # over words with single spaces; the ends are bound to word ends
    priority: int      # the higher wins where one match lies in another


def _version(v: str) -> str:
    """A version as it may be written: '2.0' matches 'v2', '2', '2 0', 'version 2 0'."""
    major, _, minor = v.partition(".")
    tail = "(?: 0)?" if minor in ("", "0") else f" {minor}"
    return f"(?:version |v )?v?{major}{tail}"


def signature_rules() -> list[Rule]:
    """All rules, in order of falling priority."""
    rules: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, priority: int) -> None:
        rules.append(Rule(label, keyword, pattern, priority))

    # Creative Commons: each variant and version by tag, short name, full name and address
    parts = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ativework)?s?"}
    for variant in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        tag = variant.replace("-", " ")
        full = " ".join(parts[p] for p in variant.split("-"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            dotted = v.replace(".", " ")
            add(f"cc-{variant}-{v}", "spdx", f"spdx license identifier cc {tag} {dotted}", 95)
            add(f"cc-{variant}-{v}", "creativecommons", f"creativecommons org licenses {tag} {dotted}", 90)
            add(f"cc-{variant}-{v}", "creative", f"creative commons {full}(?: international| generic| unported)? {dotted}", 85)
            add(f"cc-{variant}-{v}", "cc", f"cc {tag} {dotted}", 80)
        add(f"cc-{variant}", "creative", f"creative commons {full}", 45)
        add(f"cc-{variant}", "cc", f"cc {tag}", 40)
    add("cc0-1.0", "cc0", "cc0(?: 1 0)?", 60)
    add("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0", 90)

    # GNU licenses: each version by tag, short name, full name and address
    gnu = {"gpl": "(?:gnu )?general public licen[sc]e", "lgpl": "(?:gnu )?(?:lesser|library) general public licen[sc]e",
           "agpl": "(?:gnu )?affero general public licen[sc]e"}
    versions = {"gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0")}
    for name, full in gnu.items():
        for v in versions[name]:
            dotted = v.replace(".", " ")
            for kind in ("only", "or later"):
                add(f"{name}-{v}-{kind.replace(' ', '-')}", "spdx", f"spdx license identifier {name} {dotted} {kind}", 97)
            add(f"{name}-{v}", "spdx", f"spdx license identifier {name} {dotted}", 95)
            add(f"{name}-{v}-or-later", "general", f"{full} {_version(v)}(?: of the license)? or(?: at your option)? any later version", 88)
            add(f"{name}-{v}", "general", f"{full} {_version(v)}", 82)
            add(f"{name}-{v}", name, f"{name} ?{_version(v)}", 80)
            add(f"{name}-{v}", "gnu", f"gnu org licenses {name} {dotted}", 84)
        add(name, "general", full, {"gpl": 40}.get(name, 46))
        add(name, name, name, 35)

    # families with numbered versions
    numbered = {
        "apache": ("apache", "apache(?: software)?(?: foundation)?(?: licen[sc]e)?", ("1.0", "1.1", "2.0")),
        "mpl": ("mozilla", "mozilla public licen[sc]e", ("1.0", "1.1", "2.0")),
        "epl": ("eclipse", "eclipse public licen[sc]e", ("1.0", "2.0")),
        "cddl": ("common", "common development and distribution licen[sc]e", ("1.0", "1.1")),
        "cpl": ("common", "common public licen[sc]e", ("1.0",)),
        "eupl": ("european", "european union public licen[sc]e", ("1.0", "1.1", "1.2")),
        "artistic": ("artistic", "artistic licen[sc]e", ("1.0", "2.0")),
        "afl": ("academic", "academic free licen[sc]e", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        "osl": ("open", "open software licen[sc]e", ("1.0", "1.1", "2.0", "2.1", "3.0")),
        "ofl": ("sil", "sil open font licen[sc]e", ("1.0", "1.1")),
        "bsl": ("boost", "boost software licen[sc]e", ("1.0",)),
        "odbl": ("open", "open (?:data commons open )?database licen[sc]e", ("1.0",)),
        "psf": ("python", "python software foundation licen[sc]e", ("2.0",)),
        "upl": ("universal", "universal permissive licen[sc]e", ("1.0",)),
        "mulan": ("mulan", "mulan (?:psl|permissive software licen[sc]e)", ("1.0", "2.0")),
    }
    for name, (keyword, full, known) in numbered.items():
        for v in known:
            dotted = v.replace(".", " ")
            add(f"{name}-{v}", "spdx", f"spdx license identifier {name} {dotted}", 95)
            add(f"{name}-{v}", keyword, f"{full} {_version(v)}", 82)
            add(f"{name}-{v}", name, f"{name} {dotted}", 70)
        if name != "apache":
            add(name, keyword, full, 45)
    add("apache", "apache", "apache(?: software)? licen[sc]e", 45)
    add("apache-2.0", "apache", "www apache org licenses license 2 0", 90)

    # BSD by clauses
    for n, word in ((0, "zero"), (1, "one"), (2, "two"), (3, "three"), (4, "four")):
        add(f"bsd-{n}-clause", "spdx", f"spdx license identifier bsd {n} clause", 95)
        add(f"bsd-{n}-clause", "bsd", f"bsd (?:{n}|{word}) clause(?: licen[sc]e)?", 82)
        add(f"bsd-{n}-clause", "bsd", f"(?:{n}|{word}) clause bsd(?: licen[sc]e)?", 82)
    nick = {"bsd-2-clause": "(?:simplified|freebsd)", "bsd-3-clause": "(?:new|modified|revised)", "bsd-4-clause": "(?:original|old)"}
    for label, names in nick.items():
        add(label, "bsd", f"{names} bsd licen[sc]e", 80)
    add("bsd", "bsd", "bsd licen[sc]e", 45)
    add("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 60)
    add("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software", 65)

    # licenses without versions: tag, name, sentence
    for label, keyword, name in (
            ("mit", "mit", "mit licen[sc]e"), ("isc", "isc", "isc licen[sc]e"), ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
            ("unlicense", "unlicense", "(?:the )?unlicense"), ("wtfpl", "wtfpl", "wtfpl"), ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
            ("x11", "x11", "x11 licen[sc]e"), ("beerware", "beer", "beer ?ware licen[sc]e"), ("postgresql", "postgresql", "postgresql licen[sc]e"),
            ("openssl", "openssl", "openssl licen[sc]e"), ("php", "php", "php licen[sc]e"), ("ruby", "ruby", "ruby licen[sc]e"),
            ("vim", "vim", "vim licen[sc]e"), ("curl", "curl", "curl licen[sc]e"), ("tcl", "tcl", "tcl tk licen[sc]e"),
            ("ms-pl", "microsoft", "microsoft public licen[sc]e"), ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e")):
        add(label, keyword, name, 50)
        add(label, "spdx", f"spdx license identifier {label.replace('-', ' ')}", 95)
        add(label, "licensed", f"licensed under (?:the )?(?:terms of the )?{name}", 75)
    add("mit", "licensed", "(?:licensed|released|distributed) under (?:the )?mit", 60)
    add("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 65)
    add("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 65)
    add("wtfpl", "what", "do what the fuck you want to public licen[sc]e", 75)
    add("public-domain", "domain", "(?:in|into|to) the public domain", 50)
    add("proprietary", "proprietary", "proprietary and confidential", 50)
    add("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)", 45)
    add("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})?", 30)
    add("see-license", "license", "see (?:the )?licen[sc]e(?: file)?(?: for details)?", 20)
    return sorted(rules, key=lambda r: (-r.priority, r.label, r.pattern))


RULES = signature_rules()


def numbered(flat: Column) -> Column:
    """Every word of a text with single spaces, followed by ``#`` and its number: matches then know their place."""
    return F.array_join(F.transform(F.split(flat, " "), lambda w, i: F.concat(w, F.lit("#"), i.cast("string"))), " ")


def _bound(pattern: str) -> str:
    """A pattern of words as one over numbered words."""
    return f"(?<![^ ])(?:{pattern.replace(' ', '(?:#[0-9]++ )')})#[0-9]++(?![^ ])"


def _place(hit: Column) -> Column:
    """[start, stop) in words of a match in a numbered text."""
    start = F.substring_index(F.substring_index(hit, " ", 1), "#", -1).cast("int")
    return F.struct(start.alias("start"), (F.substring_index(hit, "#", -1).cast("int") + 1).alias("stop"))


#: The priorities in use, highest first.
PRIORITIES = sorted({r.priority for r in RULES}, reverse=True)
BLOCK = 256


def unsuppressed(found: Column) -> Column:
    """The matches that no match of a higher priority contains, by one sweep in the order of their starts.

    The sweep knows, for each priority, how far a match of that or a higher one has reached. It keeps
    its verdicts in blocks, as an array that grows by one element copies itself each time.
    """
    ranked = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["stop"]).alias("minus"), F.array_position(F.lit(PRIORITIES), d["priority"]).alias("rank"),
        d["label"].alias("label"), d["priority"].alias("priority"))))
    in_blocks = lambda r: F.transform(F.sequence(F.lit(0), F.floor((F.size(r) - 1) / BLOCK).cast("int")),
                                      lambda k: F.slice(r, k * BLOCK + 1, BLOCK))

    def sweep(acc: Column, d: Column) -> Column:
        stop = -d["minus"]
        inside = F.coalesce(F.get(acc["reach"], (d["rank"] - 2).cast("int")) >= stop, F.lit(False))
        return F.struct(
            F.transform(acc["reach"], lambda r, j: F.when(j >= d["rank"] - 1, F.greatest(r, stop)).otherwise(r)).alias("reach"),
            F.concat(acc["stays"], F.array(~inside)).alias("stays"))

    def block(acc: Column, part: Column) -> Column:
        start = F.struct(acc["reach"].alias("reach"), F.array().cast("array<boolean>").alias("stays"))
        return F.aggregate(part, start, sweep, lambda r: F.struct(
            r["reach"].alias("reach"), F.concat(acc["stays"], F.array(r["stays"])).alias("stays")))
    start = F.struct(F.array_repeat(F.lit(-1), len(PRIORITIES)).alias("reach"), F.array().cast("array<array<boolean>>").alias("stays"))
    # bound as the element of an array each, as a lambda would work out the expression again for every element
    bound = lambda name, value, body: F.transform(F.array(F.struct(value.alias(name))), lambda b: body(b[name]))[0]
    kept = bound("ranked", ranked, lambda r: bound("blocks", in_blocks(r), lambda b: F.flatten(F.zip_with(
        b, F.aggregate(b, start, block, lambda acc: acc["stays"]),
        lambda part, stays: F.filter(part, lambda d, i: F.get(stays, i))))))
    return F.when(F.size(found) == 0, found).otherwise(F.transform(kept, lambda d: F.struct(
        d["label"].alias("label"), d["start"].alias("start"), (-d["minus"]).alias("stop"), d["priority"].alias("priority"))))


def _rule_array(rules: list[Rule]) -> Column:
    return F.array(*(F.struct(F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                              F.lit(_bound(r.pattern)).alias("pattern"), F.lit(r.priority).alias("priority"))
                     for r in rules))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, base, found) of every row: arrays of (label, start, stop[, priority]) in words.

    ``found`` holds the matches of the signature rules that were not suppressed.
    """
    texts = id_and_text(docs, id_col, text_col)
    base = [Rule(label, max(phrase.split(), key=len), phrase, 0) for phrase, label in BASE_PHRASES.items()]
    # the longest keyword at a place; it stands for the shorter ones it begins with
    keywords = sorted({r.keyword for r in [*RULES, *base]}, key=lambda k: (-len(k), k))
    gate = f"(?i)(?<!{WORD})(?:{'|'.join(keywords)})"
    count = F.regexp_count("text", F.lit(WORD + "++"))
    flat = F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    rows = texts.select("doc_id", F.coalesce(count, F.lit(0)).cast("long").alias("n_words"),
                        F.transform(F.array_distinct(F.regexp_extract_all("text", F.lit(gate), F.lit(0))),
                                    lambda h: F.translate(h, UPPER, LOWER)).alias("hits"), "text")
    rows = rows.select("doc_id", "n_words", "hits", F.when(F.size("hits") > 0, flat).alias("flat"))
    rows = rows.select("doc_id", "n_words", "hits", numbered(F.col("flat")).alias("flat"))

    def matches(rules: list[Rule]) -> Column:
        gated = F.filter(_rule_array(rules), lambda r: F.exists("hits", lambda h: F.startswith(h, r["keyword"])))
        return F.flatten(F.transform(gated, lambda r: F.transform(
            F.transform(F.regexp_extract_all("flat", r["pattern"], F.lit(0)), _place),
            lambda p: F.struct(r["label"].alias("label"), p["start"].alias("start"), p["stop"].alias("stop"),
                               r["priority"].alias("priority")))))
    none = F.array().cast("array<struct<label:string,start:int,stop:int,priority:int>>")
    rows = rows.select("doc_id", "n_words", F.coalesce(matches(base), none).alias("base"),
                       F.coalesce(matches(RULES), none).alias("all"))
    return rows.select("doc_id", "n_words", "base", unsuppressed(F.col("all")).alias("found"))


def license_labels(scan: DataFrame) -> DataFrame:
    """The digest of a scan: counts, first and last base word, labels and score."""
    starts = F.transform("base", lambda d: d["start"])
    base_labels = F.transform("base", lambda d: d["label"])
    labels = F.concat(base_labels, F.transform("found", lambda d: d["label"]))
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    best = F.array_max(F.transform("found", lambda d: d["priority"]))
    based = F.when(F.size("base") > 0, F.lit(0.4)).otherwise(F.lit(0.0))
    return scan.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"),
        F.greatest(based, F.coalesce(best / F.lit(100.0), F.lit(0.0))).alias("score"))
