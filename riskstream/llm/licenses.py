"""License scan by ordered signature rules.

Text is reduced to lower-case words joined by single spaces, so a rule is a regular expression over
words and a place is a word number. A rule runs only on a text whose words contain its keywords, and
any rule only on a text that can match some rule (``_gate``). Detections are then put in order of
start (longer first, better priority first); one that lies inside an interval of the same or a
better priority is suppressed. What is left gives the labels.

The rules are written per license (``LICENSES``) and per form: identifier tag, grant, full name,
address, short identifier. Everything runs in one pass over each row, with built-in functions only;
nothing is shuffled.

Defined cases: a null text is empty and has no words; without base places ``first_word`` and
``last_word`` are null, without labels the label strings are empty and the score is 0; repeated
rows are judged one by one; an empty table gives an empty result; extra columns are kept unless
they have the name of a result column, which then wins.
"""

from __future__ import annotations

import functools
import operator
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.text import ascii_lower, whole

#: What is not a letter, a digit or beyond ASCII parts words.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that always count, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


class License(NamedTuple):
    """Label, full name, identifier as in a tag, address, over words."""

    label: str
    name: str
    short: str
    address: str = ""


_L = r"licen[cs]e"
_GNU = r"(?:gnu )?"
_V = r"(?: version| v| ver)? ?"


def _cc(kind: str, long: str, version: str) -> License:
    digits = version.replace(".", " ")
    return License(
        f"cc-{kind}-{version}",
        rf"creative commons {long}{_V}{digits}",
        rf"cc {' '.join(kind.split('-'))} {digits}",
        rf"creativecommons org licenses {' '.join(kind.split('-'))} {digits}",
    )


def _gnu(label: str, prefix: str, short: str, version: str, path: str) -> License:
    major, minor = version.split(".")
    digits = major if minor == "0" else f"{major} {minor}"
    optional = "(?: 0)?" if minor == "0" else ""
    return License(
        f"{label}-{version}",
        rf"{_GNU}{prefix}public {_L}{_V}{digits}{optional}",
        rf"{short}(?: version| v)? ?v?{digits}{optional}",
        rf"gnu org (?:licenses|copyleft) (?:old licenses )?{path} {digits}{optional}",
    )


#: One entry per license; the order breaks ties between equal places.
LICENSES: list[License] = [
    *(_cc("by-nc-sa", "attribution non ?commercial share ?alike", v) for v in ("4.0", "3.0", "2.0")),
    *(_cc("by-nc-nd", "attribution non ?commercial no ?deriv[a-z]*", v) for v in ("4.0", "3.0")),
    *(_cc("by-nc", "attribution non ?commercial", v) for v in ("4.0", "3.0", "2.0")),
    *(_cc("by-sa", "attribution share ?alike", v) for v in ("4.0", "3.0", "2.5", "2.0")),
    *(_cc("by-nd", "attribution no ?deriv[a-z]*", v) for v in ("4.0", "3.0")),
    *(_cc("by", "attribution", v) for v in ("4.0", "3.0", "2.5", "2.0")),
    License("cc0-1.0", rf"creative commons (?:cc0|zero){_V}1 0", "cc0(?: 1 0)?",
            "creativecommons org publicdomain zero 1 0"),
    _gnu("agpl", "affero general ", "agpl", "3.0", "agpl"),
    *(_gnu("lgpl", "(?:lesser|library) general ", "lgpl", v, "lgpl") for v in ("3.0", "2.1", "2.0")),
    *(_gnu("gpl", "general ", "gpl", v, "gpl") for v in ("3.0", "2.0", "1.0")),
    License("gfdl-1.3", rf"{_GNU}free documentation {_L}{_V}1 3", "gfdl 1 3",
            "gnu org licenses fdl 1 3"),
    License("gfdl-1.2", rf"{_GNU}free documentation {_L}{_V}1 2", "gfdl 1 2"),
    License("apache-2.0", rf"apache (?:software )?{_L}{_V}2(?: 0)?", "apache v?2(?: 0)?",
            "apache org licenses license 2 0"),
    License("apache-1.1", rf"apache (?:software )?{_L}{_V}1 1", "apache v?1 1",
            "apache org licenses license 1 1"),
    License("apache-1.0", rf"apache (?:software )?{_L}{_V}1 0", "apache v?1 0"),
    License("mit-0", rf"mit no attribution(?: {_L})?", "mit 0"),
    License("mit", rf"(?:the )?mit {_L}|mit x11 {_L}|expat {_L}", "mit",
            "opensource org licen[cs]es? mit"),
    License("bsd-4-clause", rf"original bsd {_L}|bsd 4 clause {_L}|4 clause bsd {_L}",
            "bsd 4 clause"),
    License("bsd-3-clause", rf"(?:new |modified )bsd {_L}|bsd 3 clause {_L}|3 clause bsd {_L}",
            "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    License("bsd-2-clause", rf"simplified bsd {_L}|freebsd {_L}|bsd 2 clause {_L}|2 clause bsd {_L}",
            "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    License("0bsd", rf"zero clause bsd {_L}|0 clause bsd {_L}|bsd zero clause {_L}", "0bsd"),
    License("mpl-2.0", rf"mozilla public {_L}{_V}2(?: 0)?", "(?:mozilla )?mpl 2 0",
            "mozilla org mpl 2 0"),
    License("mpl-1.1", rf"mozilla public {_L}{_V}1 1", "(?:mozilla )?mpl 1 1",
            "mozilla org mpl mpl 1 1"),
    License("epl-2.0", rf"eclipse public {_L}{_V}2(?: 0)?", "(?:eclipse )?epl 2 0",
            "eclipse org legal epl 2 0"),
    License("epl-1.0", rf"eclipse public {_L}{_V}1(?: 0)?", "(?:eclipse )?epl 1 0",
            "eclipse org legal epl v10"),
    License("cddl-1.1", rf"common development and distribution {_L} cddl{_V}1 1",
            "cddl 1 1"),
    License("cddl-1.0", rf"common development and distribution {_L} cddl{_V}1 0",
            "cddl 1 0"),
    License("cpl-1.0", rf"common public {_L}{_V}1 0", "(?:common public )?cpl 1 0"),
    License("artistic-2.0", rf"artistic {_L}{_V}2(?: 0)?", "artistic 2 0"),
    License("artistic-1.0", rf"artistic {_L}{_V}1(?: 0)?", "artistic 1 0"),
    License("bsl-1.0", rf"boost software {_L}{_V}1 0", "(?:boost )?bsl 1 0",
            "boost org license 1 0"),
    License("busl-1.1", rf"business source {_L}{_V}1 1",
            "(?:business source )?busl 1 1"),
    License("isc", rf"(?:the )?isc {_L}", "isc"),
    License("zlib", rf"zlib(?: libpng)? {_L}", "zlib", "zlib net zlib license"),
    License("unlicense", "this is free and unencumbered software.{0,40}unlicense",
            "(?:the )?unlicense", "unlicense org"),
    License("wtfpl", rf"do what the fuck you want to public {_L}.{{0,10}}wtfpl", "wtfpl"),
    License("odbl-1.0", rf"open database {_L}{_V}(?:1 0)?", "(?:open database )?odbl(?: 1 0)?"),
    License("odc-by-1.0", rf"open data commons attribution {_L}",
            "(?:open data commons|odc) by 1 0"),
    License("ofl-1.1", rf"(?:sil )?open font {_L}{_V}1 1", "(?:open font )?ofl 1 1"),
    License("eupl-1.2", rf"european union public {_L}.{{0,10}}eupl{_V}1 2", "eupl 1 2"),
    License("eupl-1.1", rf"european union public {_L}.{{0,10}}eupl{_V}1 1", "eupl 1 1"),
    License("ms-pl", rf"microsoft public {_L}", "(?:microsoft )?ms pl"),
    License("ms-rl", rf"microsoft reciprocal {_L}", "(?:microsoft )?ms rl"),
    License("psf-2.0", rf"python software foundation {_L}{_V}(?:2(?: 0)?)?", "python 2 0"),
    License("psf-2.0", rf"psf {_L}{_V}(?:2(?: 0)?)?", "psf 2 0"),
    License("php-3.01", rf"(?:the )?php {_L}{_V}3 01", "php 3 01", "php net license 3 01"),
    License("ruby", rf"(?:the )?ruby {_L}", "ruby"),
    License("postgresql", rf"postgresql {_L}", "postgresql"),
    License("openssl", rf"openssl {_L}", "openssl"),
    License("ncsa", rf"(?:university of illinois )?ncsa open source {_L}", "ncsa"),
    License("upl-1.0", rf"universal permissive {_L}{_V}1 0",
            "(?:universal permissive )?upl 1 0"),
    License("sspl-1.0", rf"server side public {_L}{_V}1?", "(?:server side public )?sspl(?: 1 0)?"),
    License("elastic-2.0", rf"elastic {_L}{_V}2(?: 0)?", "elastic 2 0"),
    License("osl-3.0", rf"open software {_L}{_V}3(?: 0)?", "(?:open software )?osl 3 0"),
    License("afl-3.0", rf"academic free {_L}{_V}3(?: 0)?",
            "(?:academic free )?afl 3 0"),
    License("openrail-m", rf"(?:creative ml |bigscience )?openrail m {_L}",
            "(?:creativeml )?openrail m"),
    License("gpl", rf"{_GNU}general public {_L}", "gnu gpl"),
    License("lgpl", rf"{_GNU}lesser general public {_L}", "gnu lgpl"),
    License("apache", rf"apache (?:software )?{_L}", "apache license"),
    License("bsd", rf"(?:the )?bsd {_L}", "bsd license"),
    License("creative-commons", rf"creative commons (?:[a-z]+ )?{_L}",
            "creative commons"),
    License("public-domain", "(?:released|placed|dedicated) (?:in)?to the public"
            " domain", "public domain dedication"),
    License("proprietary", "copyright .{0,60}all rights reserved",
            "all rights reserved"),
]

_GRANTED = (
    r"(?:licensed|released|distributed|published|(?:made )?available|provided|covered)(?: to you)?"
)
_TERMS = r"(?: the)?(?: terms of)?(?: the| an| a)? "
#: Second keywords of the grants; such a rule also needs ``_GRANTED`` before it.
_BY = (" under ", " by ")


class Rule(NamedTuple):
    """Both keywords must occur; priority 1 is the best; ``sure`` is the label's confidence.

    The keyword is a part of the pattern that every match contains; the second one is ``spdx``, one
    of ``_BY`` or empty.
    """

    keyword: str
    second: str
    pattern: str
    label: str
    priority: int
    sure: float


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def rules() -> list[Rule]:
    """All signature rules in order."""
    made = []
    for x in LICENSES:
        in_name, in_short = _plain_part(x.name), _plain_part(x.short)
        tag = rf"spdx {_L} identifier {x.short}"
        made.append(Rule(in_short, "spdx", _bounded(tag), x.label, 1, 1.0))
        for by in _BY:
            grant = f"{_GRANTED}{by.rstrip()}{_TERMS}"
            made.append(Rule(in_name, by, _bounded(f"{grant}(?:{x.name})"), x.label, 2, 0.95))
            made.append(Rule(in_short, by, _bounded(f"{grant}(?:{x.short})"), x.label, 2, 0.95))
        if x.address:
            made.append(Rule(_plain_part(x.address), "", _bounded(x.address), x.label, 2, 0.95))
        made.append(Rule(in_name, "", _bounded(x.name), x.label, 3, 0.8))
        if " " in x.short or "gpl" in x.short:
            made.append(Rule(in_short, "", _bounded(x.short), x.label, 4, 0.6))
    return made


def _gate() -> Column:
    """Whether any rule can match: a tag, the start of a grant, or a keyword of another rule."""
    words = {r.keyword for r in rules() if not r.second}
    words = {"spdx"} | {w for w in words if not any(v in w for v in words if v != w)}
    has = functools.reduce(operator.or_, (F.contains("_norm", F.lit(w)) for w in sorted(words)))
    return has | F.rlike("_norm", F.lit(f" {_GRANTED}(?:{'|'.join(_BY)})"))


def _plain_part(pattern: str) -> str:
    """The longest piece that every match contains."""
    fixed = re.sub(r"\((?:[^()]|\([^()]*\))*\)[?]?", "\n", pattern.replace(_L, "licen\ne"))
    if "|" in fixed:
        return next(w for w in ("bsd", "licen") if all(w in p for p in fixed.split("|")))
    pieces = re.split(r"\n|[a-z0-9 ]\?|\[[^]]*\]\*?|\.\{[^}]*\}", fixed)
    pieces = [piece.strip() for piece in pieces if re.fullmatch(r"[a-z0-9 ]+", piece.strip())]
    return max(pieces, key=len, default="")


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``RESULT`` and ``detections`` (start, end, label)."""
    docs = docs.drop(*RESULT, "detections", "_norm", "_scanned", "_found", "_base")
    words = F.trim(_ascii_lower(F.regexp_replace(whole("text"), _GAP, " ")))
    spaced = docs.withColumn("_norm", F.concat(F.lit(" "), words, F.lit(" ")))
    spaced = spaced.withColumns(
        {
            "n_words": F.when(F.col("_norm") == "  ", 0)
            .otherwise(_n_spaces(F.col("_norm")) - 1)
            .cast("bigint"),
            "_scanned": _gate(),
        }
    )
    found = F.flatten(
        F.transform(
            _applying(),
            lambda r: F.transform(
                _places(F.col("_norm"), r["pattern"]),
                lambda p: F.struct(
                    p["start"].alias("start"),
                    (-p["end"]).alias("minus_end"),
                    r["priority"].alias("priority"),
                    r["label"].alias("label"),
                    r["sure"].alias("sure"),
                ),
            ),
        )
    )
    base = F.flatten(
        F.array(*(_base_places(phrase, label) for phrase, label in BASE.items()))
    )
    scanned = spaced.withColumns(
        {
            "_found": F.when(F.col("_scanned"), F.sort_array(found)).otherwise(
                F.array().cast(_FOUND)
            ),
            "_base": F.when(F.contains("_norm", F.lit(" license ")), base).otherwise(
                F.array().cast(_BASE)
            ),
        }
    ).drop("_norm", "_scanned")
    kept = scanned.withColumn("detections", _unsuppressed(F.col("_found"))).drop("_found")
    starts = F.transform("_base", lambda b: b["start"].cast("bigint"))
    base_labels = F.transform("_base", lambda b: b["label"])
    all_labels = F.concat(base_labels, F.transform("detections", lambda d: d["label"]))
    sure = F.concat(
        F.array(F.lit(0.0)),
        F.transform("_base", lambda b: F.lit(0.8)),
        F.transform("detections", lambda d: d["sure"]),
    )
    return kept.withColumns(
        {
            "n_base": F.size("_base").cast("bigint"),
            "first_word": F.array_min(starts),
            "last_word": F.array_max(starts),
            "base_labels": F.array_join(F.array_sort(F.array_distinct(base_labels)), ","),
            "labels": F.array_join(F.array_sort(F.array_distinct(all_labels)), ","),
            "score": F.array_max(sure),
        }
    ).drop("_base")


_RULE = (
    "array<struct<keyword:string,pattern:string,label:string,priority:int,sure:double>>"
)
_FOUND = "array<struct<start:int,minus_end:int,priority:int,label:string,sure:double>>"
_BASE = "array<struct<start:int,label:string>>"


def _applying() -> Column:
    """The rules both of whose keywords occur; a second keyword is looked for once for all."""
    groups: dict[str, list[Rule]] = {}
    for r in rules():
        groups.setdefault(r.second, []).append(r)
    parts = []
    for second, members in groups.items():
        table = F.array(
            *(
                F.struct(
                    F.lit(r.keyword).alias("keyword"),
                    F.lit(r.pattern).alias("pattern"),
                    F.lit(r.label).alias("label"),
                    F.lit(r.priority).alias("priority"),
                    F.lit(r.sure).alias("sure"),
                )
                for r in members
            )
        )
        some = F.filter(table, lambda r: F.contains(F.col("_norm"), r["keyword"]))
        if second in _BY:
            has = F.rlike("_norm", F.lit(f" {_GRANTED}{second}"))
        else:
            has = F.contains("_norm", F.lit(second))
        parts.append(F.when(has, some).otherwise(F.array().cast(_RULE)))
    return F.concat(*parts)


def _ascii_lower(text: Column) -> Column:
    """``ascii_lower``, faster on a text of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        ascii_lower(text)
    )


def _base_places(phrase: str, label: str) -> Column:
    return F.transform(
        _places(F.col("_norm"), F.lit(_bounded(phrase))),
        lambda p: F.struct(p["start"].alias("start"), F.lit(label).alias("label")),
    )


def _n_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(norm: Column, pattern: Column) -> Column:
    """Word intervals of all matches, end exclusive, by running over the text between them."""
    between = F.transform(F.split(norm, pattern), _n_spaces)
    inside = F.transform(F.regexp_extract_all(norm, pattern, F.lit(0)), _n_spaces)
    start = F.struct(
        F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")
    )
    walked = F.aggregate(
        F.arrays_zip(between.alias("gap"), inside.alias("in")),
        start,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(x["in"], F.lit(0))).alias("at"),
            F.when(x["in"].isNull(), acc["out"])
            .otherwise(
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["in"] + 1).alias("end"),
                        )
                    ),
                )
            )
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return walked


def _unsuppressed(found: Column) -> Column:
    """Detections not inside an interval of the same or a better priority.

    In order of start, an interval holds a later one if it ends no earlier; so the furthest end
    per priority is all that has to be kept.
    """
    start = F.struct(
        F.lit(-1).alias("p1"),
        F.lit(-1).alias("p2"),
        F.lit(-1).alias("p3"),
        F.lit(-1).alias("p4"),
        F.array().cast("array<struct<start:int,end:int,label:string,sure:double>>").alias("out"),
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        furthest = F.greatest(
            acc["p1"],
            *(F.when(d["priority"] >= k, acc[f"p{k}"]).otherwise(-1) for k in (2, 3, 4)),
        )
        kept = F.struct(
            d["start"].alias("start"), end.alias("end"), d["label"].alias("label"),
            d["sure"].alias("sure"),
        )
        return F.struct(
            *(
                F.when(d["priority"] == k, F.greatest(acc[f"p{k}"], end))
                .otherwise(acc[f"p{k}"])
                .alias(f"p{k}")
                for k in (1, 2, 3, 4)
            ),
            F.when(furthest >= end, acc["out"])
            .otherwise(F.concat(acc["out"], F.array(kept)))
            .alias("out"),
        )

    return F.aggregate(found, start, step, lambda acc: acc["out"])
