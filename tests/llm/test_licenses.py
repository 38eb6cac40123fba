import re

from riskstream.llm import licenses
from tests.llm.helpers import docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in at]
    return (len(words), len(at), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in at})))


def check(df):
    rows = licenses.scan(df).collect()
    for r in rows:
        got = tuple(r[c] for c in licenses.RESULT[:5])
        assert got == base(r["text"]), (r["text"], got)
    return rows


def test_base_places_against_brute_force(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


CASES = {
    "Released under the MIT License. mit-license MIT  LICENSE mit licenses": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "GNU General Public License version 3, or GPL-3.0": "gpl,gpl-3.0",
    "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa-4.0",
    "Mozilla Public License, v2.0": "mpl-2.0",
    "Copyright 2020 A. B. All rights reserved.": "proprietary",
    "MİT License mit lıcense Émit license": "",
    "the general public likes a license": "",
    "": "",
}


def test_labels_and_suppression(spark):
    rows = check(docs(spark, [*CASES, None, "mit license " * 3000], extra=True))
    labels = {r["text"]: r["labels"] for r in rows}
    for text, expected in CASES.items():
        assert labels[text] == expected, (text, labels[text])
    by_text = {r["text"]: r for r in rows}
    assert by_text[None]["score"] == 0.0 and by_text[None]["n_words"] == 0
    assert by_text["mit license " * 3000]["n_base"] == 3000
    # the longer, better rule swallows the names inside it
    apache = by_text["Licensed under the Apache License, Version 2.0."]["detections"]
    assert [(d["start"], d["end"], d["label"]) for d in apache] == [(0, 8, "apache-2.0")]


def test_hundreds_of_rules_with_keywords_their_matches_contain():
    made = licenses.rules()
    assert len(made) >= 300
    samples = [re.sub(r"\W+", " ", t.lower()).strip() for t in CASES]
    for rule in made:
        for text in samples:
            if re.search(rule.pattern, f" {text} "):
                assert rule.keyword in text and rule.second in text


def test_keywords_stand_in_the_plainest_match_of_each_rule():
    def plain(pattern):
        pattern = pattern.replace("(?<= )", "").replace("(?= )", "").replace("licen[cs]e", "license")
        pattern = re.sub(r"\[a-z\]\*|\.\{\d+,\d+\}", " ", pattern)
        last = None
        while last != pattern:
            last = pattern
            pattern = re.sub(r"\((?:\?:)?[^()]*\)\?", "", pattern)
            pattern = re.sub(r"\((?:\?:)?([^()|]*)[^()]*\)", r"\1", pattern)
        return re.sub(r" +", " ", re.sub(r"(.)\?", "", pattern.split("|")[0]))

    for rule in licenses.rules():
        assert rule.keyword in plain(rule.pattern) + " ", (rule, plain(rule.pattern))


def labels_of(spark, texts):
    return {r["text"]: r["labels"].split(",") for r in check(docs(spark, texts))}


def test_no_text_that_a_rule_matches_is_skipped(spark):
    cases = {
        "This file is available under CDDL 1.0": "cddl-1.0",
        "Released under EUPL 1.2": "eupl-1.2",
        "released under the WTFPL": "wtfpl",
        "GFDL 1.3": "gfdl-1.3",
        "released under Apache 2.0": "apache-2.0",
        "released under the BSD 3-Clause": "bsd-3-clause",
        "made available to you by the\nISC, see": "isc",
        "covered by Apache 2.0": "apache-2.0",
        "released into the public\ndomain": "public-domain",
        "creative\ncommons attribution 4.0": "cc-by-4.0",
        "all rights\nreserved": "proprietary",
        "CC\nBY-SA 4.0": "cc-by-sa-4.0",
    }
    got = labels_of(spark, list(cases))
    for text, label in cases.items():
        assert label in got[text], (text, got[text])


#: The identifiers of the SPDX list for the labels whose identifier is not the label itself.
SPDX = {
    "apache-2.0": "Apache-2.0", "odbl-1.0": "ODbL-1.0", "odc-by-1.0": "ODC-By-1.0",
    "postgresql": "PostgreSQL", "openssl": "OpenSSL", "ruby": "Ruby", "psf-2.0": "PSF-2.0",
    "php-3.01": "PHP-3.01", "artistic-2.0": "Artistic-2.0", "zlib": "Zlib", "openrail-m": "OpenRAIL-M",
}
#: Families and phrases, which the list does not have.
NO_TAG = {"gpl", "lgpl", "apache", "bsd", "creative-commons", "public-domain", "proprietary"}


def test_a_tag_and_a_short_grant_of_every_license(spark):
    wanted = {}
    for label in {x.label for x in licenses.LICENSES} - NO_TAG:
        name = SPDX.get(label, label.upper())
        wanted[f"// SPDX-License-Identifier: {name}\n"] = label
        wanted[f"It is licensed under {name}."] = label
    wanted["SPDX-License-Identifier: Python-2.0"] = "psf-2.0"
    got = labels_of(spark, list(wanted))
    assert {t: got[t] for t in wanted if got[t] != [wanted[t]]} == {}
