"""Personal data by weak supervision, in DataFrame functions only.

Patterns find the base spans (email, ip, card, phone); these always stay. Further candidates are national numbers, bank
accounts, birth dates, local phone numbers, spelt-out addresses and names. Labelers vote for, against or not at all on
every candidate, on every base span and on every match that failed its check: two read the string (its format by
pattern and checksum; the characters beside it, which only speak against), one a gazetteer (given names, places and months,
countries, role names; it votes against names it doesn't know), three the context (cue words before it, words that speak against it, a base span close by). Expectation-
maximisation over the counts of vote patterns estimates how reliable each labeler is in either class; the posteriors are the
soft labels of a naive Bayes classifier over votes and surface features, which decides about the candidates.

The texts are read once: spans, candidates and votes are written per document, without texts. What the driver gets are
counts of vote patterns (at most kinds x 3^labelers) and sums by feature value, over all documents. Reading a text costs
time in proportion to its length: patterns are possessive or anchored, places come from the lengths of the pieces between
matches, and contexts from those pieces.

Defined results: a null text is an empty one and has no spans; repeated rows and rows without key have a row each, alike.
Offsets are code points, ends exclusive. A candidate that overlaps a base span is none. Context reaches ``LEFT`` code points back, to
the previous candidate at most. An empty table is fitted to the priors alone and gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.plans.session import materialize

BASE = ("email", "ip", "card", "phone")
FOUND = ("national", "account", "birth", "local", "spelt", "name")
KINDS = BASE + FOUND

# The base patterns. Written so that a match can't be found by backing off, which the plain forms can't either.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Whole chains of 16 to 19 digits, and whole phone numbers of 8 to 15; longer and shorter ones fail their check.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9](?:[\x20().-]*+[0-9]){7,14}+(?![\x20().-]*+[0-9])"

_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_TITLE = "(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sra?|Mme)"
#: Formats of the candidates; the first that fits at a place is taken.
FORMATS = {
    "spelt": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{{1,63}}+(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[A-Za-z0-9-]{{1,63}}+){{1,4}}",
    "account": rf"{_EDGE}[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?{_END}",
    "national": rf"{_EDGE}(?<![.-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}(?!-)",
    "birth": r"(?<![\p{L}\p{N}./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![./-]?[\p{L}\p{N}])",
    "local": rf"(?<![\p{{L}}\p{{N}}+().-])(?:\([0-9]{{2,5}}\)\x20?|0[0-9]{{1,4}}[\x20/-])[0-9]{{3,4}}[\x20.-]?[0-9]{{3,5}}{_END}(?!-)",
    "name": rf"{_EDGE}(?:{_TITLE}\.?\x20)?\p{{Lu}}\p{{Ll}}{{1,20}}(?:\x20(?!{_TITLE}\b)\p{{Lu}}\p{{Ll}}{{1,20}}){{1,2}}{_END}",
}
CANDIDATE = "|".join(f"(?:{FORMATS[k]})" for k in ("spelt", "account", "national", "birth", "local", "name"))

# Gazetteers: bounded parameters.
GIVEN = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas "
    "Sarah Charles Karen Anna Peter Paul Maria Hans Klaus Ursula Petra Jean Pierre Marie Sophie Luc Claire Juan Carlos Ana Lucia "
    "Pedro Carmen Emma Olivia Noah Liam Lukas Laura Julia Daniel Martin Alice Bob Eva"
).split()
PLACES = (
    "January February March April June July August September October November December Monday Tuesday Wednesday Thursday Friday "
    "Saturday Sunday New York United States Kingdom Los Angeles San North South East West Street Road Avenue University The Chapter"
).split()
COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LT LU LV MT NL NO PL PT RO SE SI SK".split()
ROLES = "info noreply no-reply support admin contact sales help webmaster postmaster".split()

CUES = {
    "email": r"(?i)e-?mail|contact|write to|reach", "ip": r"(?i)\bip\b|address|login|client", "card": r"(?i)card|visa|master|credit|payment",
    "phone": r"(?i)phone|tel\b|tel[.:]|call|mobile|fax|cell", "national": r"(?i)ssn|social security|national|tax|\bid\b",
    "account": r"(?i)iban|account|bank|konto", "birth": r"(?i)born|birth|dob|geboren|né|naci", "local": r"(?i)phone|tel\b|tel[.:]|call|mobile|fax|cell",
    "spelt": r"(?i)mail|contact|write|reach", "name": r"(?i)\bname|contact|signed|dear|regards|sincerely|patient|customer|\bmr|\bmrs|\bdr",
}
AGAINST = r"(?i)version|page|chapter|section|figure|table|isbn|issn|order|article|model|serial|release|published|updated|https?:|\bv$|[#$/\\=_]$"
LEFT, RIGHT, CLOSE = 48, 16, 96

#: What a labeler may vote besides nothing. Where one has both votes, silence means that it doesn't apply and tells nothing.
LABELERS = {"format": (-1, 1), "surroundings": (-1,), "gazetteer": (-1, 1), "cue": (1,), "against": (-1,), "neighbour": (1,)}
#: Pseudo-counts of right votes, wrong votes and silence in either class; a vote counts for its own side by ``LEAST_ODDS`` at least.
RIGHT_VOTES, WRONG_VOTES, SILENT, LEAST_ODDS = 16.0, 2.0, 10.0, 0.7
ROUNDS, SMOOTH, REPORT = 50, 5.0, 0.9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    """All matches as ``array<struct<start, end, s, left, right>>`` in code points.

    The pieces between the matches give the places. Their lengths are added up in blocks, so that many matches cost
    little more than few.
    """
    block = 64
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def placed(found: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda pieces: with_pieces(found, pieces))

    def with_pieces(found: Column, pieces: Column) -> Column:
        steps = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
        return let(steps, lambda steps: with_steps(found, pieces, steps))

    def with_steps(found: Column, pieces: Column, steps: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda k: total(F.slice(steps, k * block + 1, F.lit(block))))
        before = let(sums, lambda sums: F.transform(blocks, lambda k: total(F.slice(sums, F.lit(1), k))))

        def one(before: Column) -> Column:
            def at(m: Column, i: Column) -> Column:
                k = F.floor(i / block).cast("int")
                start = F.get(before, k) + total(F.slice(steps, k * block + 1, i % block)) + F.length(F.get(pieces, i))
                return let(
                    start,
                    lambda s: F.struct(
                        s.alias("start"), (s + F.length(m)).alias("end"), m.alias("s"),
                        F.right(F.get(pieces, i), F.lit(LEFT)).alias("left"), F.left(F.get(pieces, i + 1), F.lit(RIGHT)).alias("right"),
                    ),
                )

            return F.transform(found, at)

        return let(before, one)

    none = F.array().cast("array<struct<start:int,end:int,s:string,left:string,right:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.try_cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits_of(s)), ""), weigh), F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def address(s: Column) -> Column:
    """Whether all parts of a dotted number are 255 at most."""

    def small(part: Column) -> Column:
        p = F.ltrim(part, F.lit("0"))
        return F.when(F.length(p) > 3, False).otherwise(F.coalesce(F.try_to_number(F.concat(F.lit("0"), p), F.lit("9999")) <= 255, F.lit(False)))

    return F.forall(F.split(s, r"\."), small)


def account(s: Column) -> Column:
    """Whether an account number passes its check: moved around and read as digits, 1 modulo 97."""
    plain = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(c == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, F.lit(1))
    return (out.when(no, F.lit(-1)) if no is not None else out).otherwise(F.lit(0))


def _kind(s: Column) -> Column:
    """The kind of a candidate, by the formats in their order."""
    return (
        F.when(s.rlike(r"[\[(]\x20?dot"), "spelt").when(s.rlike("^[A-Z]{2}[0-9]{2}"), "account").when(s.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "national")
        .when(s.rlike("^[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "birth").when(s.rlike(r"^[(0]"), "local").otherwise("name")
    )


def _format(kind: Column, s: Column, valid: Column) -> Column:
    """The format labeler: base matches by their checks, candidates by ranges and checksums."""
    n = F.length(digits_of(s))
    day = F.regexp_extract(s, r"^([0-9]{1,2})[./-]", 1)
    month = F.regexp_extract(s, r"^[0-9]{1,2}[./-]([0-9]{1,2})|-([0-9]{2})-", 1)
    date_ok = F.when(day == "", s.rlike("-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$")).otherwise(
        day.try_cast("int").between(1, 31) & month.try_cast("int").between(1, 12)
    )
    good = (
        F.when(kind.isin(*BASE), valid).when(kind == "national", ~s.rlike("^(000|666|9)|-00-|-0000$")).when(kind == "account", account(s))
        .when(kind == "birth", date_ok).when(kind == "local", n.between(7, 12)).when(kind == "spelt", F.lit(True))
    )
    # A sound date or a plausible number alone says little; an unsound one says no.
    weak = kind.isin("birth", "local")
    titled = s.rlike(rf"^{_TITLE}\b")
    # A word said twice is no name.
    return F.when(kind == "name", _vote(titled, s.rlike(r"(?:^|\x20)(\p{L}+)\x20\1(?:\x20|$)"))).otherwise(_vote(good & ~weak, ~good))


def _gazetteer(kind: Column, s: Column) -> Column:
    words = F.split(s, " ")
    one_of = lambda names: F.exists(words, lambda w: w.isin(*names))
    return (
        F.when(kind == "name", _vote(one_of(GIVEN) & ~one_of(PLACES), F.lit(True)))
        .when(kind == "account", _vote(F.substring(s, 1, 2).isin(*COUNTRIES), ~F.substring(s, 1, 2).isin(*COUNTRIES)))
        .when(kind == "email", _vote(F.lit(False), F.substring_index(s, "@", 1).isin(*ROLES))).otherwise(0)
    )


def _cue(kind: Column, left: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for k, cue in CUES.items():
        out = out.when(kind == k, _vote(left.rlike(cue)))
    return out.otherwise(0)


def _edge(c: Column) -> Column:
    """The class of a neighbouring character."""
    return (
        F.when(c == "", "none").when(c.rlike(r"[\p{L}\p{N}]"), "word").when(c.rlike(r"\s"), "space").when(c.rlike(r"[.,;:!?]"), "stop")
        .when(c.rlike(r"[()\[\]<>\"']"), "bracket").otherwise("sign")
    )


def labelled(kind: Column, m: Column, valid: Column, near: Column, reported: bool) -> Column:
    """A match with its votes and surface features."""
    s, left, right = m["s"], m["left"], m["right"]
    before, after = _edge(F.right(left, F.lit(1))), _edge(F.left(right, F.lit(1)))
    votes = {
        "format": _format(kind, s, valid),
        "surroundings": F.when(before.isin("word", "sign") | after.isin("word"), -1).otherwise(0),
        "gazetteer": _gazetteer(kind, s),
        "cue": _cue(kind, left),
        "against": F.when(left.rlike(AGAINST), -1).otherwise(0),
        "neighbour": _vote(near),
    }
    surface = {
        "before": before, "after": after, "length": F.concat_ws(":", kind, F.least(F.floor(F.length(s) / 4), F.lit(8)).cast("string")),
        "digits": F.concat_ws(":", kind, F.least(F.floor(F.length(digits_of(s)) / 4), F.lit(6)).cast("string")),
    }
    return F.struct(
        m["start"].alias("start"), m["end"].alias("end"), kind.alias("kind"), F.lit(reported).alias("open"),
        *[v.cast("int").alias(k) for k, v in votes.items()], *[v.alias(f"f_{k}") for k, v in surface.items()],
    )


SURFACE = ("f_before", "f_after", "f_length", "f_digits")


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, base, seen)`` per document: the base spans by kind, and every match with its votes."""
    t = F.coalesce(F.col("t"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,s:string,left:string,right:string>>")
    has = lambda part, found: F.when(t.contains(part), found).otherwise(none)
    digit = lambda found: F.when(t.rlike("[0-9]"), found).otherwise(none)
    raw = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t")).select(
        "key", has("@", matches(t, EMAIL)).alias("email"), digit(matches(t, IP)).alias("ips"), digit(matches(t, CARD)).alias("cards"),
        has("+", matches(t, PHONE)).alias("phone"), matches(t, CANDIDATE).alias("more"),
    )
    # Written here, without the texts: what follows reads the matches several times over.
    raw = materialize(raw, "matches")
    base = raw.select(
        "key", "email", "phone", "ips", "cards", "more",
        F.filter("ips", lambda m: address(m["s"])).alias("ip"), F.filter("cards", lambda m: luhn(m["s"])).alias("card"),
    ).withColumn("all", F.concat("email", "ip", "card", "phone"))
    meets = lambda m, b, gap: (b["start"] < m["end"] + gap) & (b["end"] + gap > m["start"])
    close = lambda m: F.exists("all", lambda b: meets(m, b, CLOSE) & (b["start"] != m["start"]))
    free = F.filter("more", lambda m: ~F.exists("all", lambda b: meets(m, b, 0)))
    yes, no = F.lit(True), F.lit(False)
    own = lambda name, kind: F.transform(name, lambda m: labelled(F.lit(kind), m, yes, close(m), False))
    failed = lambda name, kind, test: F.transform(
        F.filter(name, lambda m: ~test(m["s"])), lambda m: labelled(F.lit(kind), m, no, close(m), False)
    )
    seen = F.concat(
        own("email", "email"), own("ip", "ip"), own("card", "card"), own("phone", "phone"), failed("ips", "ip", address), failed("cards", "card", luhn),
        F.transform(free, lambda m: let(_kind(m["s"]), lambda k: labelled(k, m, no, close(m), True))),
    )
    place = lambda name: F.transform(name, lambda m: F.struct(m["start"], m["end"]))
    spans = F.struct(*[place(k).alias(k) for k in BASE])
    return materialize(base.select("key", spans.alias("base"), seen.alias("seen")), "votes")


@dataclass(frozen=True)
class Model:
    """Estimated reliabilities ``P(vote | class)`` by labeler, and the classifier's log odds by feature and value."""

    reliability: Mapping[str, Mapping[int, tuple[float, float]]]
    prior: Mapping[str, float]
    odds: Mapping[str, Mapping[object, float]]


def _start(name: str) -> dict[int, list[float]]:
    """Pseudo-counts of a labeler's votes in the two classes, personal data first."""
    counts = {v: [RIGHT_VOTES, WRONG_VOTES] if v > 0 else [WRONG_VOTES, RIGHT_VOTES] for v in LABELERS[name]}
    return counts if len(counts) > 1 else counts | {0: [SILENT, SILENT]}


def _shares(counts: dict[int, list[float]]) -> dict[int, tuple[float, float]]:
    """``P(vote | class)``; no labeler is taken to mean the contrary of its vote."""
    sums = [sum(c[i] for c in counts.values()) for i in (0, 1)]
    out = {v: (c[0] / sums[0], c[1] / sums[1]) for v, c in counts.items()}
    most = math.exp(-LEAST_ODDS)
    for v, (a, b) in out.items():
        if v:
            out[v] = (a, min(b, a * most)) if v > 0 else (min(a, b * most), b)
    return out


def estimate(patterns: Sequence[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS):
    """Expectation-maximisation over counted vote patterns ``(kind, votes, n)``.

    Labelers are independent given the class. Returns ``(reliability, prior by kind, posterior by pattern)``. It starts
    from the pseudo-counts, which also keep the classes from changing places.
    """
    kinds = sorted({k for k, _, _ in patterns})
    rel = {name: _shares(_start(name)) for name in LABELERS}
    prior = dict.fromkeys(kinds, 0.5)
    post: dict[tuple[str, tuple[int, ...]], float] = {}
    for _ in range(rounds):
        for kind, votes, _ in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for name, v in zip(LABELERS, votes, strict=True):
                if v in rel[name]:
                    odds += math.log(rel[name][v][0] / rel[name][v][1])
            post[kind, votes] = 1 / (1 + math.exp(max(-700, min(700, -odds))))
        for j, name in enumerate(LABELERS):
            counts = _start(name)
            for kind, votes, n in patterns:
                if votes[j] in counts:
                    counts[votes[j]][0] += n * post[kind, votes]
                    counts[votes[j]][1] += n * (1 - post[kind, votes])
            rel[name] = _shares(counts)
        for kind in kinds:
            mine = [(post[k, v], n) for k, v, n in patterns if k == kind]
            prior[kind] = (SMOOTH + sum(p * n for p, n in mine)) / (2 * SMOOTH + sum(n for _, n in mine))
    return rel, prior, post


def fit(votes: DataFrame) -> Model:
    """Reliabilities by EM over all matches, then the classifier on its posteriors."""
    rows = votes.select(F.explode("seen").alias("m")).select("m.*")
    counted = materialize(rows.groupBy("kind", *LABELERS, *SURFACE).agg(F.count("*").alias("n")), "patterns")
    patterns = [
        (r.kind, tuple(r[name] for name in LABELERS), r.n)
        for r in counted.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).orderBy("kind", *LABELERS).collect()
    ]  # at most kinds x 3 ^ labelers rows
    rel, prior, post = estimate(patterns)
    odds: dict[str, dict[object, float]] = {name: {v: math.log(a / b) for v, (a, b) in rel[name].items()} for name in LABELERS}
    odds["kind"] = {k: math.log(p / (1 - p)) for k, p in prior.items()}
    if post:
        soft = counted.sparkSession.createDataFrame([(k, *v, p) for (k, v), p in post.items()], f"kind string, {', '.join(f'{n} int' for n in LABELERS)}, p double")
        known = counted.join(F.broadcast(soft), ["kind", *LABELERS])  # as many rows as the patterns
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in SURFACE]))
        sums = known.select("n", "p", pairs.alias("x")).groupBy("x.f", "x.v").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
        got = sums.collect()  # the values of a handful of coarse features, lengths and digits within their kind
        for f in SURFACE:
            odds[f] = {}
            for group in sorted({r.v.partition(":")[0] if ":" in r.v else "" for r in got if r.f == f}):
                mine = [r for r in got if r.f == f and (r.v.partition(":")[0] if ":" in r.v else "") == group]
                yes, no = (sum(c) + SMOOTH * len(mine) for c in ([r.yes for r in mine], [r.no for r in mine]))
                odds[f] |= {r.v: math.log((r.yes + SMOOTH) / yes) - math.log((r.no + SMOOTH) / no) for r in sorted(mine, key=lambda r: r.v)}
    return Model(rel, prior, odds)


def probability(m: Column, model: Model) -> Column:
    """The classifier's probability that a match is personal data."""
    score = F.lit(0.0)
    for f, values in model.odds.items():
        part = F.when(F.lit(False), 0.0)
        for v, w in values.items():
            part = part.when(m[f] == F.lit(v), float(w))
        score = score + part.otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def spans(votes: DataFrame, model: Model, report: float = REPORT) -> DataFrame:
    """``(key, base, found)``: base spans as a struct of arrays, and the candidates the classifier takes, as ``(kind, start, end, p)``."""
    judged = F.transform(
        F.filter("seen", lambda m: m["open"]), lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), probability(m, model).alias("p"))
    )
    return votes.select("key", "base", F.filter(judged, lambda m: m["p"] >= report).alias("found"))


def listed(kinds: Sequence[str]) -> Column:
    """The spans of some kinds as ``kind:start:end`` in their order, comma-joined."""
    text = lambda kind, m: F.concat_ws(":", kind, m["start"].cast("string"), m["end"].cast("string"))

    def of(k: str) -> Column:
        if k in BASE:
            return F.transform(f"base.{k}", lambda m: text(F.lit(k), m))
        return F.transform(F.filter("found", lambda m: m["kind"] == k), lambda m: text(m["kind"], m))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def personal(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, base, found)`` of every document, by a model fitted to the same documents."""
    votes = scanned(docs, key, text)
    return spans(votes, fit(votes))
