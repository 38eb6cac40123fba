r"""Personal data by weak supervision.

``candidates`` finds spans: four base kinds with fixed patterns and checks, and looser kinds of the
method's own. Each candidate carries the votes of ``LABELERS`` (yes 1, no -1, silent 0): format,
check digits, gazetteer, words before it, misleading words before it, and what it is glued to.

``reliabilities`` estimates by expectation-maximisation, from how often each pattern of votes
occurs in all documents, how often each labeler says yes and no on true and on false spans of a
kind, and the share of true spans per kind. The table of vote patterns has at most kinds x length classes x
3^labelers rows, whatever the input, so it is fetched once and the rounds run in numpy.

``train`` then fits the span classifier, a logistic regression, to the estimated probabilities as
soft labels. It sees no votes but what the span is: its kind and length, its shape and the shape's
trigrams, the words and characters around it, hashed to ``BUCKETS`` numbers; so it also tells apart
spans on which the labelers agree. Equal spans are counted before they are fetched, and a kind with
more than ``SAMPLE`` different ones is thinned to about that many by hash (a bound on training
alone: votes are counted, and spans scored, over all rows).

``find`` returns base spans always, and spans of the other kinds if the classifier gives them at
least ``LEAST`` and they touch no base span. All work on text is in built-in functions, row by row.

Patterns use possessive repeats and are bound to run starts, so no text makes them backtrack or
recurse; they match what the plain patterns match.

Defined cases: a null text is empty; a document without spans has counts 0, the digest of the
empty string and an empty ``spans``; repeated rows are scanned one by one; without any candidate
the classifier knows nothing and adds nothing; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.text import whole
from riskstream.session import written

#: In the order of results.
BASE = ("email", "ip", "card", "phone")
KINDS = (
    *BASE, "phone_local", "ssn", "iban", "name", "card_like", "ip_like", "email_spelled", "birth"
)
LABELERS = ("format", "check", "gazetteer", "context", "misleading", "border")
LEAST = 0.5
ROUNDS = 12
#: Shares of the votes -1, 0, 1 on false and on true spans before anything is counted, and their weight.
START = ((0.4, 0.1), (0.5, 0.5), (0.1, 0.4))
TRUST = 4
#: Numbers that features are hashed to, and different spans of a kind that the classifier learns from.
BUCKETS = 8192
SAMPLE = 4000
STEPS = 300
_LENGTHS = (8, 14, 18)

#: Titles and names begin with A-Z, which the pattern for names tests first.
#: Given names that are frequent where the four languages are spoken (fixed values).
GIVEN = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel"
    " Matthew Anthony Mark Steven Andrew Paul Joshua Kevin Brian George Edward Mary Patricia"
    " Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley"
    " Emily Donna Michelle Carol Amanda Melissa Laura Hans Peter Wolfgang Klaus Jürgen Dieter"
    " Manfred Uwe Günter Horst Bernd Rainer Stefan Andreas Markus Matthias Ursula Petra Sabine"
    " Monika Renate Karin Helga Brigitte Ingrid Gisela Heike Anja Katrin Jean Pierre Michel Philippe"
    " Alain Bernard Nicolas Laurent Julien François Jacques Marie Nathalie Isabelle Sylvie Catherine"
    " Françoise Monique Valérie Céline Juan José Antonio Manuel Francisco Javier Carlos Miguel"
    " Alejandro Rafael Pedro Luis Carmen María Pilar Dolores Josefa Ana Cristina Lucía Marta Elena"
).split()
#: Forms of address (fixed values).
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Sr Sra Monsieur Madame Mme Mlle".split()
#: Top-level domains (fixed values).
DOMAINS = "com org net edu gov io co de fr es uk us eu info biz ch at it nl be pl ru cn jp".split()
#: Words that announce personal data (fixed values).
CONTEXT = (
    "phone tel telephone telefon téléphone teléfono call mobile handy email e-mail mail mailto"
    " courriel correo contact kontakt contacto card visa karte carte tarjeta ip host address"
    " adresse dirección iban konto compte cuenta ssn social name nombre nom write reach"
).split()
#: Words that announce a date of birth (fixed values).
BIRTH = "born birth birthday birthdate dob geboren geburtstag geburtsdatum née né naissance nacido nacida nacimiento".split()
#: Words that announce other numbers (fixed values).
MISLEADING = (
    "version v release build order invoice isbn page chapter section figure table id no nr ref"
    " bestellung rechnung seite commande facture pedido factura página build"
).split()

_W = "[A-Za-z0-9._%+-]"
#: Pattern, what the text must contain for it to run.
_PATTERNS = {
    "email": (
        rf"(?:\G|(?<!{_W})){_W}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]\\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9](?:[\\x20-]?[0-9]){12}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "\\+[0-9]"),
    "phone_local": (
        r"(?<![0-9+)] )(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
        r"(?![0-9.-])",
        "[0-9]{3}[ .-][0-9]{4}",
    ),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-[0-9]{2}-"),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
    ),
    "name": (
        rf"(?=[A-Z])(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? \p{{Lu}}\p{{Ll}}++"
        rf"|(?:{'|'.join(GIVEN)}) \p{{Lu}}\p{{Ll}}++)",
        rf"(?=[A-Z])(?<!\p{{L}})(?:{'|'.join(TITLES + GIVEN)})\.? \p{{Lu}}",
    ),
    "email_spelled": (
        rf"(?<!{_W}){_W}++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++"
        r"(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]++)++",
        r"[\[(](?:at|AT)[\])]",
    ),
    "birth": (
        r"(?<![0-9./-])[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}(?![0-9])(?![./-][0-9])",
        r"[./-](?:19|20)[0-9]{2}",
    ),
}

_SPAN = (
    "array<struct<kind:int,start:int,end:int,length:int,"
    + ",".join(f"{name}:int" for name in LABELERS)
    + ",features:array<int>>>"
)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the check digit fits; every second digit from the right is doubled."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _parts_fit(hit: Column) -> Column:
    """Four numbers of at most 255, whatever zeros stand before them."""

    def fits(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).cast("int") <= 255)

    return F.forall(F.split(hit, r"\."), fits)


def _words_before(before: Column, words: tuple | list) -> Column:
    """Whether one of the words stands in the last 40 characters."""
    return F.rlike(F.right(before, F.lit(40)), F.lit(rf"(?i)(?<!\p{{L}})(?:{'|'.join(words)})(?!\p{{L}})"))


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, F.lit(1))
    return (vote.when(no, F.lit(-1)) if no is not None else vote).otherwise(F.lit(0))


def _votes(kind: str, hit: Column, before: Column, after: Column) -> dict[str, Column]:
    """The labelers' votes on one span."""
    digits = _digits(hit)
    n = F.length(digits)
    silent = F.lit(0)
    strict = {
        "email": F.rlike(hit, F.lit(r"^[A-Za-z0-9][^@]*@[A-Za-z0-9].*\.[A-Za-z]{2,}$")),
        "ip": ~F.rlike(hit, F.lit(r"(?:^|\.)0[0-9]")),
        "card": n >= 15,
        "phone": F.rlike(hit, F.lit(r"^\+[0-9]{1,3}[ (.-]")),
        "phone_local": F.rlike(hit, F.lit(r"^\(")),
        "ssn": ~F.rlike(hit, F.lit("^(?:000|666|9)|-00-|-0000$")),
        "iban": F.rlike(hit, F.lit("^(?:DE|FR|ES|GB|IT|NL|AT|CH|BE|PT)")),
        "name": F.rlike(hit, F.lit(rf"^(?:{'|'.join(TITLES)})\.? ")),
        "card_like": F.rlike(hit, F.lit(r"[ -]")),
        "ip_like": F.lit(False),
        "email_spelled": F.rlike(hit, F.lit(r"(?:\.|[\])] ?)[A-Za-z]{2,}$")),
        "birth": F.rlike(
            hit, F.lit(r"^(?:0?[1-9]|[12][0-9]|3[01]).(?:0?[1-9]|[12][0-9]|3[01]).(?:19|200|201)")
        ),
    }[kind]
    check = {
        "card": F.lit(1),
        "card_like": F.lit(-1),
        "ip": F.lit(1),
        "ip_like": F.lit(-1),
        "phone": _vote(n.between(10, 13), n < 10),
        "phone_local": _vote(~F.rlike(digits, F.lit("^[01]")), F.rlike(digits, F.lit("^[01]"))),
    }.get(kind, silent)
    top = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1))
    gazetteer = {
        "email": _vote(top.isin(DOMAINS), ~top.isin(DOMAINS)),
        "email_spelled": _vote(top.isin(DOMAINS), ~top.isin(DOMAINS)),
        "name": _vote(F.rlike(hit, F.lit(rf"(?:{'|'.join(GIVEN)})(?!\p{{Ll}})"))),
        "phone": _vote(F.rlike(digits, F.lit("^(?:1|33|34|39|4[0-9]|7|8[16]|9[01])"))),
        "card": _vote(F.rlike(digits, F.lit("^(?:4|5[1-5]|3[47]|6011|2[2-7])"))),
        "card_like": _vote(F.rlike(digits, F.lit("^(?:4|5[1-5]|3[47]|6011|2[2-7])"))),
    }.get(kind, silent)
    glued = F.rlike(F.right(before, F.lit(1)), F.lit(r"[\p{L}\p{N}_]")) | F.rlike(
        F.left(after, F.lit(1)), F.lit(r"[\p{L}\p{N}_]")
    )
    announced = _words_before(before, BIRTH if kind == "birth" else CONTEXT)
    # A well-formed date says nothing: most are not of birth.
    well_formed, apart = (F.lit(False),) * 2 if kind == "birth" else (strict, ~glued)
    return {
        "format": _vote(well_formed, ~strict),
        "check": check,
        "gazetteer": gazetteer,
        # A date is personal only where something says so.
        "context": _vote(announced, ~announced if kind == "birth" else None),
        "misleading": F.when(_words_before(before, MISLEADING), F.lit(-1)).otherwise(silent),
        "border": _vote(apart, glued),
    }


def _features(kind: str, hit: Column, before: Column, after: Column, length: Column) -> Column:
    """What the classifier sees of a span: hashed, distinct, in order."""
    shape = hit
    for run, sign in (("[0-9]", "9"), (r"\p{Lu}", "A"), (r"\p{Ll}", "a")):
        shape = F.regexp_replace(shape, run, sign)
    near, far = F.lower(F.right(before, F.lit(40))), F.lower(F.left(after, F.lit(40)))

    def grams(shape: Column) -> Column:
        signs = F.split(shape, "")
        n = F.size(signs)
        joined = F.transform(
            F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
            lambda i: F.concat_ws("", F.get(signs, i), F.get(signs, i + 1), F.get(signs, i + 2)),
        )
        return F.array_distinct(joined)

    runs = F.regexp_replace(F.regexp_replace(shape, "9++", "9"), "a++", "a")
    named = {
        f"k {kind}": F.lit(""),
        f"l {kind}": length.cast("string"),
        f"s {kind}": runs,
        "b": F.regexp_extract(near, r"(\p{L}++)[^\p{L}]*+$", 1),
        "bb": F.regexp_extract(near, r"(\p{L}++)[^\p{L}]++\p{L}++[^\p{L}]*+$", 1),
        "a": F.regexp_extract(far, r"^[^\p{L}]*+(\p{L}++)", 1),
        f"cb {kind}": F.regexp_replace(F.right(before, F.lit(1)), r"[\p{L}\p{N}]", "x"),
        f"ca {kind}": F.regexp_replace(F.left(after, F.lit(1)), r"[\p{L}\p{N}]", "x"),
    }
    texts = F.concat(
        F.array(*(F.concat_ws(" ", F.lit(name), value) for name, value in named.items())),
        F.transform(grams(shape), lambda g: F.concat(F.lit(f"t {kind} "), g)),
    )
    hashed = F.transform(texts, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
    return F.sort_array(F.array_distinct(hashed))


def _spans(text: Column, pattern: str, keep: dict[str, Column | object]) -> Column:
    """Spans of one pattern with their votes. ``keep`` gives, per kind, a test of the match."""
    pieces = F.split(text, pattern)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(
        pieces.alias("before"),
        hits.alias("hit"),
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1))).alias("after"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def span(kind: str, x: Column, begin: Column) -> Column:
        n = F.length(x["hit"])
        after = F.coalesce(x["after"], F.lit(""))
        votes = _votes(kind, x["hit"], x["before"], after)
        length = sum((F.when(n > bound, 1).otherwise(0) for bound in _LENGTHS), F.lit(0))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            begin.alias("start"),
            (begin + n).alias("end"),
            length.alias("length"),
            *(votes[name].cast("int").alias(name) for name in LABELERS),
            _features(kind, x["hit"], x["before"], after, length).alias("features"),
        )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["before"])
        found = None
        for kind, test in keep.items():
            ok = x["hit"].isNotNull() & test(x["hit"])
            one = F.array(span(kind, x, begin))
            found = F.when(ok, one) if found is None else found.when(ok, one)
        return F.struct(
            (begin + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.coalesce(F.concat(acc["out"], found), acc["out"]).alias("out"),
        )

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: all candidates with their votes, one row per document."""
    text = F.col("_text")

    def always(_: Column) -> Column:
        return F.lit(True)

    def n_digits(low: int, high: int):
        return lambda hit: F.length(_digits(hit)).between(low, high)

    tests = {
        "email": {"email": always},
        "ip": {"ip": _parts_fit, "ip_like": always},
        "card": {
            "card": lambda hit: n_digits(13, 19)(hit) & _luhn(_digits(hit)),
            "card_like": n_digits(13, 19),
        },
        "phone": {"phone": n_digits(9, 15)},
        "phone_local": {"phone_local": always},
        "ssn": {"ssn": always},
        "iban": {"iban": n_digits(10, 32)},
        "name": {"name": always},
        "email_spelled": {"email_spelled": always},
        "birth": {"birth": always},
    }
    found = [
        F.when(F.rlike(text, F.lit(gate)), _spans(text, pattern, tests[name])).otherwise(
            F.array().cast(_SPAN)
        )
        for name, (pattern, gate) in _PATTERNS.items()
    ]
    # One gate for all kinds: most texts hold neither digits nor a sign nor a title.
    any_gate = F.rlike(text, F.lit("[0-9@]"))
    for kind in ("name", "email_spelled"):
        any_gate = any_gate | F.rlike(text, F.lit(_PATTERNS[kind][1]))
    return docs.select("doc_id", whole("text").alias("_text")).select(
        "doc_id",
        F.when(any_gate, F.concat(*found)).otherwise(F.array().cast(_SPAN)).alias("spans"),
    )


def distinct_spans(found: DataFrame) -> DataFrame:
    """How often each kind, length class, set of votes and set of features occurs."""
    columns = ("kind", "length", *LABELERS, "features")
    return (
        found.select(F.explode("spans").alias("s"))
        .groupBy(*(F.col(f"s.{name}").alias(name) for name in columns))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def patterns(spans: DataFrame) -> DataFrame:
    """How often each kind, length class and set of votes occurs; bounded, whatever the input."""
    return spans.groupBy("kind", "length", *LABELERS).agg(F.sum("n").alias("n"))


def _log_odds(kind, votes, speaks: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log odds of a true span: its kind's prior and one weight per labeler and vote."""
    weights = np.log(speaks[..., 1] / speaks[..., 0])
    said = weights[kind[:, None], np.arange(len(LABELERS)), votes + 1].sum(axis=1)
    return np.log(prior[kind] / (1 - prior[kind])) + said


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _pattern(row) -> tuple[int, ...]:
    return (row["kind"], row["length"], *(row[name] for name in LABELERS))


def _columns(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.array([r["kind"] for r in rows], dtype=np.int64)
    votes = np.array([[r[name] for name in LABELERS] for r in rows], dtype=np.int64)
    n = np.array([r["n"] for r in rows], dtype=np.float64)
    return kind, votes.reshape(len(rows), len(LABELERS)), n


def reliabilities(rows: list, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """From counted vote patterns: the share of each vote (-1, 0, 1) of each labeler on false and on
    true spans, as an array by kind, labeler, vote, truth; and per kind the share of true spans.

    The start takes a labeler that speaks to be right in four of five cases; later rounds count this
    as ``TRUST`` spans. Each kind has shares of its own: a labeler that cannot speak on one kind
    would otherwise make its silence there look like a sign of truth.
    """
    # In one order, so that reruns add up alike.
    kind, votes, n = _columns(sorted(rows, key=_pattern))
    start = np.tile(np.array(START), (len(KINDS), len(LABELERS), 1, 1))
    speaks, prior = start, np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        true = _chance(_log_odds(kind, votes, speaks, prior))
        counts = TRUST * start
        for truth, weight in enumerate((n * (1 - true), n * true)):
            for i in range(len(LABELERS)):
                np.add.at(counts[:, i, :, truth], (kind, votes[:, i] + 1), weight)
        speaks = counts / counts.sum(axis=2, keepdims=True)
        yes, every = np.bincount(kind, n * true, len(KINDS)), np.bincount(kind, n, len(KINDS))
        prior = (yes + 1) / (every + 2)
    return speaks, prior


def sample(spans: DataFrame, sizes: dict[int, int], bound: int = SAMPLE) -> list:
    """Of each kind its different spans, thinned by hash to about ``bound``, with their weight."""
    share = F.lit(1.0)
    for kind, size in sizes.items():
        if size > bound:
            share = F.when(F.col("kind") == kind, bound / size).otherwise(share)
    key = F.xxhash64("kind", "length", *LABELERS, "features")
    drawn = F.pmod(key, F.lit(1 << 40)) < share * (1 << 40)
    # Twice the bound is out of reach of the thinning; the limit states it.
    kept = spans.where(drawn).withColumn("n", F.col("n") / share)
    found = kept.limit(2 * bound * len(KINDS)).collect()
    return sorted(found, key=lambda r: (r["features"], _pattern(r)))


def train(rows: list, speaks: np.ndarray, prior: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights of the span classifier, the last one for what all spans share.

    Logistic regression on the estimated truth of each span, by steps of fixed size scaled per
    weight, with a small pull to zero. A kind counts the same however frequent it is.
    """
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    kind, votes, n = _columns(rows)
    true = _chance(_log_odds(kind, votes, speaks, prior))
    share = n / np.bincount(kind, n, len(KINDS))[kind] / len(set(kind.tolist()))
    owner = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
    feature = np.concatenate([np.array(r["features"], dtype=np.int64) for r in rows])
    seen = np.zeros(BUCKETS + 1)
    for _ in range(steps):
        odds = weights[-1] + np.bincount(owner, weights[feature], len(rows))
        off = share * (_chance(odds) - true)
        slope = np.append(np.bincount(feature, off[owner], BUCKETS), off.sum()) + 1e-5 * weights
        seen += slope**2
        weights -= 0.1 * slope / np.sqrt(seen + 1e-8)
    return weights


def find(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, base, added``: spans as (kind, start, end, score), each list by kind, then start."""
    found = written(candidates(docs), "pii-candidates")
    spans = written(distinct_spans(found), "pii-spans")
    sizes = dict(spans.groupBy("kind").count().collect())
    weights = train(sample(spans, sizes), *reliabilities(patterns(spans).collect()))
    # One literal array, made once per plan.
    table = F.split(F.lit(",".join(map(repr, weights.tolist()))), ",").cast("array<double>")

    def score(s: Column) -> Column:
        odds = F.aggregate(
            s["features"], F.get(table, F.lit(BUCKETS)), lambda a, i: a + F.get(table, i)
        )
        return 1 / (1 + F.exp(-odds))

    scored = found.withColumn(
        "spans",
        F.sort_array(
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["kind"].alias("kind"),
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    score(s).alias("score"),
                ),
            )
        ),
    )
    is_base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    extra = F.filter("spans", lambda s: (s["kind"] >= len(BASE)) & (s["score"] >= least))
    return (
        scored.withColumns({"base": is_base, "_extra": extra})
        .withColumn(
            "added",
            F.filter(
                "_extra",
                lambda s: ~F.exists(
                    "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
                ),
            ),
        )
        .select("doc_id", "base", "added")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def digests(found: DataFrame) -> DataFrame:
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )
