"""Personal data: fixed patterns, and spans added by weak supervision.

Base spans follow four patterns with checks and always stand. Further candidates (addresses
with an at sign, groups of digits, long keys) get votes: each labeller says yes, no or
nothing from a pattern, a gazetteer of cue words or the characters around. How often each
combination of votes occurs, over all documents, is a table with a bounded number of rows
(three votes to the power of the labellers). Expectation-maximisation on it estimates how
reliable each labeller is and how probable each combination is personal data. Those
probabilities are the soft labels of the final span classifier, a naive Bayes model over the
span's own features, which also decides where all labellers keep silent. A candidate that
overlaps no base span is added when its probability is at least one half.

Positions are code points from 0, ends exclusive. Patterns are written so that matching
needs no recursion and no second look at a run of characters: they find what the plain
patterns find, also in very long texts.

Definitions for odd input: a null text is an empty one and has no spans. Rows are judged one
by one; repeated rows count as often as they occur when the votes are counted. Null ids and
other columns do not matter; ``redacted`` keeps the columns, whatever their names. An empty
table gives an empty result.

DataFrame functions only; the driver works on the table of vote combinations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetime.functions.values import let
from placetime.llm.common import every
from placetime.session import checkpointed

BASE = ["email", "ip", "card", "phone"]
ADDED = ["handle", "number", "key"]
KINDS = BASE + ADDED

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = (
    rf"(?:(?<![{_LOCAL}])[{_LOCAL}]*+@[A-Za-z0-9][A-Za-z0-9.-]*+"
    r"|(?<![A-Za-z0-9])[A-Za-z0-9]{24,}+"
    r"|(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().:/-]{0,2}+[0-9])++)"
)
LEFT = 24  # characters before a candidate that cue words are looked for in
CUES = ["mail", "contact", "tel", "phone", "call", "fax", "mobile", "card", "visa", "iban", "account", "address", "token", "secret", "password", "key", "login", "user", "ssn", "ip"]
ANTICUES = ["version", "figure", "fig", "page", "table", "chapter", "section", "isbn", "issn", "doi", "price", "usd", "eur", "year", "vol", "no"]
ROUNDS = 50




def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]++", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).try_cast("int")
        return F.when(i % 2 == 1, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i))
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(False)


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of all matches."""
    def placed(matches: Column) -> Column:
        def walk(gaps: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

            def step(a: Column, i: Column) -> Column:
                s = a["at"] + F.length(F.get(gaps, i))
                m = F.get(matches, i)
                return let(F.struct(s.alias("s"), (s + F.length(m)).alias("e"), m.alias("m")), lambda x: F.struct(x["e"].alias("at"), F.array_append(a["out"], x).alias("out")))

            return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, step)["out"]

        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), walk)).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda d: (F.length(d) <= 3) & (F.coalesce(d.try_cast("int"), F.lit(0)) <= 255)))
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))
    return F.length(_digits(m)).between(10, 15)


def base_spans(text: Column) -> Column:
    """Array of (s, k, e) in order; k is the place of the kind in KINDS."""
    needs = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.contains("."), "card": F.lit(True)}
    nothing = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def of_kind(k: int, kind: str) -> Column:
        valid = F.filter(_spans(text, PATTERNS[kind]), lambda x: _valid(kind, x["m"]))
        return F.when(needs[kind], F.transform(valid, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))).otherwise(nothing)

    found = [of_kind(k, kind) for k, kind in enumerate(BASE)]
    return F.when(text.rlike("[0-9@]"), F.array_sort(F.concat(*found))).otherwise(nothing)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "1").when(no, "0").otherwise("-")


def _labels(m: Column, left: Column, right: Column) -> Column:
    """(k, votes, features) of a candidate, or null where it is none."""
    kind = F.when(m.contains("@"), 0).when(m.rlike("^[+(]?[0-9](?:[^A-Za-z]*+)$"), 1).otherwise(2)

    def of(x: Column) -> Column:
        k, n, low = x["k"], F.length(x["d"]), x["left"]
        number, key = k == 1, k == 2
        words = F.array_remove(F.split(low, "[^a-z]+"), "")
        parts = F.size(F.split(m, r"\."))
        votes = F.concat(
            _vote((k == 0) & m.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"), (k == 0) & ~m.rlike(r"@[A-Za-z0-9-]+\.")),  # pattern: address
            _vote(number & m.rlike(r"^[+(]") & n.between(9, 15), number & ((n < 7) | (n > 19))),  # pattern: telephone
            _vote(number & m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), number & (parts > 1) & (parts != 4)),  # pattern: four parts
            _vote(number & n.between(13, 19) & _luhn(x["d"]), number & n.between(13, 19) & m.rlike("[.:/]")),  # pattern: check digit
            _vote(number & m.rlike(r"^[0-9]{4}(?:[\x20-]?[0-9]{4}){3}$"), F.lit(False)),  # pattern: card layout
            _vote(key & m.rlike("^[0-9a-f]+$") & F.length(m).isin(32, 40, 64), key & ~m.rlike("[0-9]")),  # pattern: key in hexadecimal digits
            _vote(F.lit(False), number & m.rlike(r"^(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?:[^0-9]|$)|:")),  # pattern: date or time
            _vote(F.exists(words, lambda w: w.isin(CUES)), F.exists(words, lambda w: w.isin(ANTICUES))),  # gazetteer: cue words
            _vote(low.rlike(r"[=:]\s*[\"']?$"), low.rlike(r"[$€£#]\s*$") | x["right"].rlike(r"^\s?[%€£$]")),  # context: assignment, or an amount
            _vote(F.lit(False), number & (m.rlike(r"(?:^|[^0-9])0*+$|([0-9])(?:[^0-9]?\1){6}") | x["d"].contains("123456789"))),  # context: filler digits
        )
        size = F.when(key | (k == 0), F.least(F.floor(F.length(m) / 8), F.lit(8))).otherwise(F.least(n, F.lit(20)).cast("long"))
        layout = F.when(m.rlike(r"^\+"), "+").when(m.rlike(r"^\("), "(").when(m.contains("."), ".").when(m.rlike("[:/]"), ":").when(m.contains("-"), "-").when(m.contains(" "), "s").otherwise("")
        features = F.array(
            F.concat(F.lit("size"), k.cast("string"), F.lit(":"), size.cast("string")), F.concat(F.lit("layout"), k.cast("string"), F.lit(":"), layout),
            F.concat(F.lit("before:"), F.when(low.rlike(r"[a-z]\s$"), "word").when(low == "", "start").when(low.rlike(r"\n$"), "line").when(low.rlike(r"[=:]\s*[\"']?$"), "assign").otherwise("other")),
            F.concat(F.lit("hex"), k.cast("string"), F.lit(":"), (key & m.rlike("^[0-9a-f]+$") & m.rlike("[0-9]")).cast("string")),
        )
        return F.when(number & (n < 7), None).when(key & ~(m.rlike("[0-9]") & m.rlike("[A-Za-z]")), None).otherwise(F.struct((k + len(BASE)).alias("k"), votes.alias("votes"), features.alias("features")))

    return let(F.struct(kind.alias("k"), _digits(m).alias("d"), F.lower(left).alias("left"), right.alias("right")), of)


_CANDIDATES = "array<struct<s:int,k:int,e:int,votes:string,features:array<string>>>"


def candidates(text: Column, base: Column) -> Column:
    """Candidates that overlap no base span, with their votes and features."""
    def labelled(x: Column) -> Column:
        left = F.substring(text, F.greatest(x["s"] - LEFT + 1, F.lit(1)), F.least(x["s"], F.lit(LEFT)))
        right = F.substring(text, x["e"] + 1, F.lit(2))
        return let(_labels(x["m"], left, right), lambda y: F.when(y.isNotNull(), F.struct(x["s"].alias("s"), y["k"].alias("k"), x["e"].alias("e"), y["votes"].alias("votes"), y["features"].alias("features"))))

    free = F.filter(_spans(text, CANDIDATE), lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return F.when(text.rlike("[0-9@]|[A-Za-z0-9]{24}"), F.array_compact(F.transform(free, labelled))).otherwise(F.array().cast(_CANDIDATES))


def found(text: Column | str) -> Column:
    """Struct of base spans and candidates of a text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return let(text, lambda t: let(base_spans(t), lambda b: F.struct(b.alias("base"), candidates(t, b).alias("more"))))


@dataclass(frozen=True)
class Model:
    """Reliabilities of the labellers, and log odds of the span classifier."""

    prior: float
    #: for each labeller the probabilities of the votes 1, 0 and - given yes and given no
    reliability: tuple[tuple[dict[str, float], dict[str, float]], ...]
    bias: float
    weights: dict[str, float]

    def probable(self, candidate: Column) -> Column:
        """The classifier's probability is one half or more."""
        weights = {k: v for k, v in self.weights.items()}
        if not weights:
            return F.lit(self.bias >= 0)
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        return F.aggregate(candidate["features"], F.lit(self.bias), lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0))) >= 0


def expectation_maximisation(counts: dict[str, int], rounds: int = ROUNDS) -> tuple[float, list, dict[str, float]]:
    """Prior, reliabilities and the posterior of each combination of votes."""
    width = len(next(iter(counts), ""))
    yes = [{"1": 0.6, "0": 0.1, "-": 0.3}] * width
    no = [{"1": 0.1, "0": 0.6, "-": 0.3}] * width
    prior, post = 0.5, {}
    for _ in range(rounds):
        for votes in counts:
            a = math.log(prior) + sum(math.log(yes[i][v]) for i, v in enumerate(votes) if v != "-")
            b = math.log(1 - prior) + sum(math.log(no[i][v]) for i, v in enumerate(votes) if v != "-")
            post[votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, b - a))))
        mass = sum(n * post[v] for v, n in counts.items())
        total = sum(counts.values())
        prior = min(max((mass + 1) / (total + 2), 0.01), 0.99)

        def share(i: int, of_yes: bool) -> dict[str, float]:
            # a labeller is believed to be better than chance: pseudo-counts on its side
            sums = {"1": 4.0 if of_yes else 1.0, "0": 1.0 if of_yes else 4.0}
            for votes, n in counts.items():
                if votes[i] != "-":
                    sums[votes[i]] += n * (post[votes] if of_yes else 1 - post[votes])
            whole = sum(sums.values())
            return {v: x / whole for v, x in sums.items()} | {"-": 1.0}

        yes, no = [share(i, True) for i in range(width)], [share(i, False) for i in range(width)]
    return prior, list(zip(yes, no, strict=True)), post


def fit(spans: DataFrame) -> Model:
    """Model from the column ``more`` of candidates of all documents.

    Two tables come to the driver: vote combinations, at most three to the power of the
    labellers, and their numbers per feature, a fixed set of values.
    """
    each = spans.select(F.explode("more").alias("c")).select("c.votes", "c.features")
    counts = {r.votes: r.n for r in each.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model(0.5, (), -1.0, {})
    prior, reliability, post = expectation_maximisation(counts)
    rows = each.select("votes", F.explode("features").alias("feature")).groupBy("votes", "feature").agg(F.count("*").alias("n")).collect()
    yes, no = sum(n * post[v] for v, n in counts.items()), sum(n * (1 - post[v]) for v, n in counts.items())
    sums: dict[str, list[float]] = {}
    for r in rows:
        own = sums.setdefault(r.feature, [0.0, 0.0])
        own[0] += r.n * post[r.votes]
        own[1] += r.n * (1 - post[r.votes])
    weights = {f: math.log((a + 1) / (yes + 2)) - math.log((b + 1) / (no + 2)) for f, (a, b) in sums.items()}
    return Model(prior, tuple(reliability), math.log((yes + 1) / (no + 1)), weights)


def all_spans(spans: Column, model: Model) -> Column:
    """Base spans and the candidates that the model takes, in order, as (s, k, e)."""
    taken = F.transform(F.filter(spans["more"], lambda c: model.probable(c)), lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))
    return F.array_sort(F.concat(spans["base"], taken))


def written(spans: Column) -> Column:
    """``kind:start:end``, joined with commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def detected(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans by kind, a digest of them, and all spans, for every row."""
    spans = checkpointed(docs.select("doc_id", found("text").alias("f")).select("doc_id", "f.base", "f.more"))
    model = fit(spans)
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return spans.select(
        "doc_id", *[count(k) for k in range(len(BASE))],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(all_spans(F.struct("base", "more"), model)).alias("spans"),
    )


def without(text: Column, spans: Column) -> Column:
    """The text with each span, or each stretch of overlapping spans, replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, x["s"] - a["at"])
        return F.when(x["s"] >= a["at"], F.struct(x["e"].alias("at"), F.concat(a["out"], F.array(gap, F.get(names, x["k"]))).alias("out"))).otherwise(F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out")))

    def end(a: Column) -> Column:
        return F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(F.aggregate(spans, start, step), end)).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in text replaced and n_chars, where there is one, counted anew."""
    model = fit(checkpointed(docs.select(found("text")["more"].alias("more"))))
    own = let(F.col("text"), lambda t: let(let(found(t), lambda f: all_spans(f, model)), lambda spans: without(t, spans)))
    changed = docs.withColumn("text", F.when(F.col("text").isNotNull(), own))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return changed.select(*every(docs))
