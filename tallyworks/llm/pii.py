"""Personal data by base patterns and by weak supervision over further candidates.

Base spans (email, ip, card, phone) are matched exactly. Further candidates come from broad patterns over the text
with the base spans blanked: key-like strings, digit groups, names after a title, spelled-out addresses. Labelers vote on
each candidate: formats (regex), word lists over what stands before it (gazetteer), and its surroundings and shape (context).
Expectation-maximisation over the vote patterns estimates how far each labeler is to be trusted and gives each pattern a
posterior; these train the final span classifier, a logistic regression over votes and shape, which decides.

Everything is DataFrame functions. A match's place follows from splitting the text at the pattern: the lengths of
what lies between and of the matches add up to it. Patterns are anchored and possessive where that changes nothing, so that long
runs cost linear time and no recursion.

Edge cases: null and empty texts have no spans; places are code points, end exclusive; repeated rows get the same spans; without any
candidate nothing is added; input columns named like an output column are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import let, quoted, table, with_new, written
from tallyworks.llm.weak import estimate

#: kind: (pattern, what a text must contain for it to match at all)
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CANDIDATE = (
    r"(?<![A-Za-z0-9_])[A-Za-z0-9_+/=-]{16,}+|(?<![0-9A-Za-z])[0-9](?:[\x20.-]?[0-9]){6,}+(?![A-Za-z0-9])"
    r"|\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?+\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?+"
    r"|(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++\x20?[\[(]dot[\])]\x20?[A-Za-z]{2,}+"
)
HAS_CANDIDATE = r"[A-Za-z0-9_+/=-]{16}|[0-9](?:[\x20.-]?[0-9]){6}|\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b|[\[(]at[\])]"
KNOWN_FORMAT = (
    r"^(?:A(?:KI|SI)A[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk[-_][A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_=-]{16,}|xox[abpr]-.{10,}"
    r"|(?=.*[a-f])(?=.*[0-9])[0-9a-f]{16,}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|\p{Lu}\p{Ll}+\.? \p{Lu}.*|.*[\[(]at[\])].*)$"
)
ASSIGNED = r"^[A-Za-z_-]{2,24}=+[A-Za-z0-9+/_-]{8,}={0,2}$"
#: Words before a span that speak for and against personal data (fixed values).
FOR = r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|key|ssn|social security|iban|account|konto|tel|phone|mobile|call|fax|mail|contact)\W{0,6}$"
AGAINST = r"(?i)(?:isbn|issn|doi|version|page|chapter|vol|fig|table|section|year|line|https?:/|www|id)\W{0,4}$"
CONTEXT = 32  # characters before a candidate that are looked at
LABELERS = ("l_format", "l_before", "l_assigned", "l_shape", "l_plain")
START = (0.5, 0.85, 0.85)
STEPS = 15
KINDS = ("name", "address", "secret", "number")
SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def running(lengths: Column, width: int = 256, join=lambda a, x: a + x) -> Column:
    """Running totals (or what else ``join`` makes of two) of an array of ints, in two levels so that long arrays stay cheap."""
    add = lambda part: F.aggregate(part, F.lit(0), join)

    def totals(x: Column) -> Column:
        heads = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / width).cast("int")), lambda k: add(F.slice(x, k * width + 1, F.lit(width))))

        def with_heads(h: Column) -> Column:
            bases = F.transform(h, lambda _, k: add(F.slice(h, F.lit(1), k)))
            return let(bases, lambda b: F.transform(x, lambda _, i: join(F.get(b, F.floor(i / width).cast("int")), add(
                F.slice(x, i - i % width + 1, i % width + 1)))))

        return let(heads, with_heads)

    return let(lengths, totals)


def placed(gaps: str, found: str) -> Column:
    """(start, end, text, before) of each match, from the text split at the matches and the matches."""

    def build(between: Column, ends: Column) -> Column:
        return F.transform(ends, lambda e, i: F.struct(
            (e - F.length(F.get(F.col(found), i))).alias("start"), e.alias("end"), F.get(F.col(found), i).alias("text"),
            F.right(F.get(between, i), F.lit(CONTEXT)).alias("before")))

    between = F.slice(F.col(gaps), F.lit(1), F.size(found))
    ends = let(F.zip_with(between, F.col(found), lambda a, b: F.length(a) + F.length(b)), lambda x: running(x))
    some = let(ends, lambda e: build(F.col(gaps), e))
    none = F.array().cast("array<struct<start:int,end:int,text:string,before:string>>")
    return F.when(F.size(found) > 0, some).otherwise(none)


def matched(df: DataFrame, name: str, text: Column, pattern: str, needs: str) -> DataFrame:
    """Adds ``{name}_gaps`` and ``{name}_found``; texts that cannot match are not split."""
    can = F.contains(text, F.lit(needs)) if needs == "@" else text.rlike(needs)
    df = with_new(df, {f"{name}_can": can})
    can = F.col(f"{name}_can")
    return with_new(df, {
        f"{name}_found": F.when(can, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
        f"{name}_gaps": F.when(can, F.split(text, pattern, -1)).otherwise(F.array(text)),
    }).drop(f"{name}_can")


def luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        twice = d * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def masked(df: DataFrame, name: str, kind: str, filler) -> Column:
    """The text with the passing matches replaced by ``filler(match)``."""
    parts = F.transform(F.col(f"{name}_gaps"), lambda g, i: F.concat(g, F.coalesce(
        let(F.get(F.col(f"{name}_found"), i), lambda m: F.when(m.isNotNull() & passes(kind, m), filler(m)).otherwise(m)), F.lit(""))))
    return F.when(F.size(f"{name}_found") > 0, F.array_join(parts, "")).otherwise(F.get(F.col(f"{name}_gaps"), 0))


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_base``: (start, end, kind, order) of the base spans, by start and kind."""
    text = F.col("_text")
    for kind, (pattern, needs) in BASE.items():
        docs = matched(docs, f"_{kind}", text, pattern, needs)
    docs = with_new(docs, {"_base": F.sort_array(F.concat(*[passing(f"_{kind}", kind) for kind in BASE]))})
    return docs.drop(*[f"_{k}_{x}" for k in BASE for x in ("gaps", "found")])


def votes(c: Column) -> Column:
    """The labelers' votes and the shape of one candidate."""
    text, before = c["text"], c["before"]
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    length = F.length(text)
    both = (digits * 5 >= length) & text.rlike("[A-Za-z]")
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"), text.alias("text"),
        F.when(text.rlike(r"^\p{Lu}\p{Ll}+\.? \p{Lu}"), "name").when(text.rlike(r"[\[(]at[\])]"), "address")
        .when(text.rlike(r"[A-Za-z]"), "secret").otherwise("number").alias("kind"),
        F.when(text.rlike(KNOWN_FORMAT), 1).when(text.rlike("^[A-Za-z_+/=-]+$"), -1).otherwise(0).alias("l_format"),
        F.when(before.rlike(FOR), 1).when(before.rlike(AGAINST), -1).otherwise(0).alias("l_before"),
        F.when(text.rlike(ASSIGNED) | before.rlike(r"[=:]\s*[\"']?$"), 1).otherwise(0).alias("l_assigned"),
        F.when(both & (length >= 16), 1).when((digits == 0) & ~text.contains(" ") & ~text.rlike(r"[\[(]at[\])]"), -1).otherwise(0).alias("l_shape"),
        F.when(text.rlike(r"^(?:[0-9]{1,4}[.-]){2}[0-9]{1,4}$|^[0-9. ]+$|^[a-z]+(?:[-_/][a-z]+)*$|^[=_+/-]+$|^([A-Za-z0-9])\1+$"), -1).otherwise(0).alias("l_plain"),
        F.least(F.floor(length / 8), F.lit(6)).cast("int").alias("size"),
        F.floor(4 * digits / length).cast("int").alias("share"),
    )


def passing(name: str, kind: str) -> Column:
    """(start, order, end, kind) of the passing matches of a base kind."""
    good = F.filter(placed(f"{name}_gaps", f"{name}_found"), lambda s: passes(kind, s["text"]))
    return F.transform(good, lambda s: F.struct(
        s["start"].alias("start"), F.lit(list(BASE).index(kind)).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def candidates(docs: DataFrame, bared: bool = False) -> DataFrame:
    """Adds ``_more``: the candidates with their votes, from the text with base spans blanked.

    ``bared`` adds ``_bared`` too: the base spans of the text as it is blanked kind by kind. Among them are those that
    only blanking bares, as a card number whose last digit group went on into an ip address.
    """
    docs = with_new(docs, {"_left": F.col("_text")} | ({"_bared": F.array().cast(SPANS)} if bared else {}))
    for kind, (pattern, needs) in BASE.items():
        docs = matched(docs, "_b", F.col("_left"), pattern, needs)
        if bared:
            docs = with_new(docs, {"_bared": F.concat("_bared", passing("_b", kind))})
        docs = with_new(docs, {"_left": masked(docs, "_b", kind, lambda m: F.repeat(F.lit("\n"), F.length(m)))}).drop("_b_gaps", "_b_found")
    if bared:  # cards and phones may have held digits of an address
        docs = matched(docs, "_b", F.col("_left"), *BASE["ip"])
        docs = with_new(docs, {"_bared": F.concat("_bared", passing("_b", "ip"))}).drop("_b_gaps", "_b_found")
    docs = matched(docs, "_c", F.col("_left"), CANDIDATE, HAS_CANDIDATE)
    return with_new(docs, {"_more": F.transform(placed("_c_gaps", "_c_found"), votes)}).drop("_left", "_c_gaps", "_c_found")


def features(c) -> dict[str, Column]:
    """Inputs of the span classifier by name; ``c(name)`` gives a candidate's field."""
    found = {"one": F.lit(1.0)}
    for name in LABELERS:
        found[f"{name}_for"] = (c(name) > 0).cast("double")
        found[f"{name}_against"] = (c(name) < 0).cast("double")
    found |= {f"kind_{k}": (c("kind") == k).cast("double") for k in KINDS}
    return found | {"size_share": c("size") / 6, "digit_share": c("share") / 4}


def weighted(weights: dict[str, float], inputs: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + w * inputs[name]
    return 1 / (1 + F.exp(-total))


def train(marked: DataFrame) -> dict[str, float]:
    """Weights of the span classifier from the candidates in ``_more``.

    Candidates are counted by votes and shape: the table that is trained on has at most 3^5 * 4 * 7 * 5 rows, and each
    step is one aggregate over it.
    """
    keys = [*LABELERS, "kind", "size", "share"]
    each = marked.select(F.explode("_more").alias("c")).select(*[F.col(f"c.{k}").alias(k) for k in keys])
    shapes = written(each.groupBy(*keys).agg(F.count("*").cast("double").alias("n")), "span-shapes")
    trust = estimate(shapes, list(LABELERS), *START, rounds=8)
    names = list(features(F.col))
    shapes = written(shapes.select("n", trust.posterior().alias("target"), *[x.alias(k) for k, x in features(F.col).items()]), "span-features")
    # a prior that agrees with the votes: known formats and named contexts speak for, plain shapes against
    weights = dict.fromkeys(names, 0.0) | {"l_format_for": 2.0, "l_before_for": 1.0, "l_format_against": -2.0,
                                           "l_plain_against": -2.0, "l_before_against": -1.0}
    seen = dict.fromkeys(names, 1e-6)
    for _ in range(STEPS):
        missed = shapes.select("n", *names, ((F.col("target") - weighted(weights, {k: F.col(k) for k in names})) * F.col("n")).alias("miss"))
        sums = missed.agg(F.sum("n").alias("n"), *[F.sum(F.col("miss") * F.col(k)).alias(k) for k in names]).first()
        if not sums["n"]:
            break
        for name in names:
            slope = sums[name] / sums["n"]
            seen[name] += slope * slope
            weights[name] += 0.5 * slope / math.sqrt(seen[name])
    return weights


def judged(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """Written ``keep`` columns with ``_base`` and ``_more``, and the classifier's weights."""
    needed = docs.select(*[F.col(quoted(c)) for c in keep], F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    marked = written(candidates(base_spans(needed)).drop("_text"), "spans")
    return marked, train(marked)


def taken(weights: dict[str, float], c: Column) -> Column:
    """Whether the classifier takes a candidate (a struct as of ``votes``)."""
    return weighted(weights, features(lambda name: c[name])) >= 0.5


def more_spans(weights: dict[str, float]) -> Column:
    """(start, order, end, kind) of the candidates in ``_more`` that the classifier takes."""
    return F.transform(F.filter(F.col("_more"), lambda c: taken(weights, c)), lambda c: F.struct(
        c["start"].alias("start"), F.lit(len(BASE)).alias("order"), c["end"].alias("end"), c["kind"].alias("kind")))


def find_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``base`` and ``spans``: arrays of (start, order, end, kind), sorted."""
    marked, weights = judged(docs, keep)
    return with_new(marked, {"base": F.col("_base"), "spans": F.sort_array(F.concat("_base", more_spans(weights)))}).drop("_base", "_more")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def cut_out(text: Column, spans: Column, width: int = 256) -> Column:
    """``text`` with its sorted ``spans`` replaced by their kinds in square brackets.

    Spans that overlap are one, of the kind that starts first. The gaps are taken from pieces of the text of ``width`` spans
    each, so that texts with many spans stay cheap.
    """

    def piece(whole: Column, some: Column) -> Column:
        first, last = F.get(some, 0)["at"], F.element_at(some, -1)["start"]
        return let(F.substring(whole, first + 1, last - first), lambda p: F.array_join(F.transform(some, lambda h: F.concat(
            F.substring(p, h["at"] - first + 1, h["start"] - h["at"]), F.lit("["), h["kind"], F.lit("]"))), ""))

    def joined(whole: Column, heads: Column, end: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(heads) - 1) / width).cast("int"))
        pieces = F.transform(starts, lambda k: let(F.slice(heads, k * width + 1, F.lit(width)), lambda some: piece(whole, some)))
        return F.concat(F.array_join(pieces, ""), F.substring(whole, end + 1, F.length(whole)))

    def merged(whole: Column, s: Column, ends: Column) -> Column:
        each = F.transform(s, lambda x, i: F.struct(
            F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("at"), x["start"].alias("start"), x["kind"].alias("kind")))
        return let(F.filter(each, lambda x: x["start"] >= x["at"]), lambda heads: joined(whole, heads, F.element_at(ends, -1)))

    def cut(whole: Column, s: Column) -> Column:
        ends = running(F.transform(s, lambda x: x["end"]), join=lambda a, x: F.greatest(a, x))
        return F.when(F.size(s) > 0, let(ends, lambda e: merged(whole, s, e))).otherwise(whole)

    return let(text, lambda t: let(spans, lambda s: cut(t, s)))


def without_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in square brackets; texts without one stay as they are.

    The text is cut at the spans of ``find_spans``, and at base spans that only come to light when others are blanked. The
    classifier is trained on the same documents.
    """
    _, weights = judged(docs.select("text"), [])
    out = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    out = candidates(base_spans(out), bared=True)
    out = with_new(out, {"_spans": F.sort_array(F.concat("_base", "_bared", more_spans(weights)))})
    out = with_new(out, {"_left": F.when(F.size("_spans") > 0, cut_out(F.col("_text"), F.col("_spans"))).otherwise(F.col("_row")["text"])})
    return out.select(*[(F.col("_left") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and all spans of all documents."""
    found = find_spans(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
