"""Quality rules as weak supervision: rules vote or abstain, and a posterior decides.

Each rule votes 1 (sound), -1 (junk) or 0 (abstains) on signals of the whole text. Expectation-maximisation
estimates how often each rule's vote is right in sound and in junk documents, and a document is kept if its posterior
probability of being sound is at least one half (and the fixed base rules hold).

Everything is DataFrame functions: signals are array expressions over the words, computed in one pass and written
once; the estimate uses the counts of vote patterns (see ``weak``). Repeated five-word windows are compared by
64-bit hashes.

Edge cases: null, empty and wordless texts have no words and fail the base rules; a null id or other column changes nothing; repeated rows get
the same result; input columns named like an output column are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import GAP_CHARS, let, quoted, table, with_new, words, written
from tallyworks.llm.weak import Votes, estimate

GRAM = 5
SYMBOLS = "[#*$%&|<>]"
#: Frequent words of the corpus languages (fixed values).
COMMON = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or that the they this to was were which will with "
    "au aux ce dans de des du elle en est et il je la le les mais ne ou par pas pour que qui sur un une "
    "al como con del el es lo los las más me no para pero por se si su una y "
    "auf aus bei das dem den der die ein eine er es für ich im ist mit nicht sich sie sind und von war zu"
).split()
#: Start of the estimate: share of sound documents, and how often a vote is right in sound and in junk ones.
START = (0.85, 0.95, 0.5)
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("v_symbols", "v_capitals", "v_word_length", "v_variety", "v_lines", "v_windows", "v_length", "v_common")


def repeat_words(w: Column) -> Column:
    """Words inside windows of ``GRAM`` words that occur twice or more in the array ``w``."""

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        again = let(ordered, lambda s: F.filter(
            s, lambda e, k: e["x"].eqNullSafe(F.get(s, k - 1)["x"]) | e["x"].eqNullSafe(F.get(s, k + 1)["x"])))
        places = F.sort_array(F.transform(again, lambda e: e["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(F.lit(GRAM), F.coalesce(F.get(p, k + 1) - v, F.lit(GRAM)))), F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(GRAM)]))
    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(w) > GRAM, counted).otherwise(0)


def signals(docs: DataFrame) -> DataFrame:
    """``docs`` with the signals; ``_upper``, ``_lines``, ``_kinds`` and ``_common`` serve the rules."""
    text, w = F.coalesce(F.col("text"), F.lit("")), F.col("_words")
    found = with_new(docs, {"_words": words(F.col("text"))})
    found = with_new(found, {"_held": F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "")})
    return with_new(found, {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_held") - F.size(F.array_distinct("_held"))).cast("long"),
        "n_repeat_words": repeat_words(w).cast("long"),
        "_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "_lines": F.size("_held"),
        "_kinds": F.size(F.array_distinct(w)),
        "_common": F.size(F.filter(w, lambda x: x.isin(COMMON))),
    }).drop("_words", "_held")


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def voted(df: DataFrame) -> DataFrame:
    """Adds one vote column a rule and ``base_failed``; ratios are taken as products, so no division by zero."""
    n, chars = F.col("n_words"), F.col("word_chars")
    kinds, lines, repeated = F.col("_kinds"), F.col("_lines"), F.col("n_repeat_words")
    votes = {
        "v_symbols": vote(F.col("n_symbols") > 0.1 * n, F.col("n_symbols") <= 0.02 * n),
        "v_capitals": vote(F.col("_upper") > 0.3 * chars, F.col("_upper") <= 0.15 * chars),
        "v_word_length": vote((chars > 7.5 * n) | (chars < 3 * n), (chars > 3.8 * n) & (chars < 6.5 * n)),
        "v_variety": vote((n >= 50) & (kinds < 0.15 * n), (n < 50) | (kinds > 0.3 * n)),
        "v_lines": vote((lines >= 4) & (F.col("n_dup_lines") > 0.3 * lines), (lines >= 3) & (F.col("n_dup_lines") <= 0.05 * lines)),
        "v_windows": vote(repeated > 0.15 * n, repeated <= 0.02 * n),
        "v_length": vote(n < 15, n >= 40),
        "v_common": vote((n >= 30) & (F.col("_common") < 0.04 * n), F.col("_common") > 0.1 * n),
    }
    return with_new(df, {**votes, "base_failed": (n < 10) | (100 * repeated > 20 * n)})


def model_of(marked: DataFrame) -> Votes:
    """How far each rule can be trusted, from the counts of vote patterns."""
    patterns = written(marked.groupBy(*RULES).agg(F.count("*").cast("double").alias("n")), "quality-votes")
    return estimate(patterns, list(RULES), *START)


def verdict(marked: DataFrame, model: Votes) -> DataFrame:
    judged = with_new(marked, {"posterior": model.posterior()})
    return with_new(judged, {"kept": ~F.col("base_failed") & (F.col("posterior") >= 0.5)})


def scored(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with signals, votes, base_failed, posterior and kept."""
    needed = docs.select(*{c: F.col(quoted(c)) for c in [*keep, "text"]}.values())
    marked = voted(signals(needed))
    if "text" not in keep:
        marked = marked.drop("text")
    marked = written(marked, "quality")
    return verdict(marked, model_of(marked)).drop("_upper", "_lines", "_kinds", "_common")


def keep_sound(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept. Signals are computed twice, so that no second copy of the texts is written."""
    model = model_of(voted(signals(docs.select("text"))))
    held = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), "text")
    # the place in the task keeps Spark from pulling the filter, and with it copies of every signal, below the signals
    marked = with_new(signals(held), {"_at": F.monotonically_increasing_id()})
    kept = verdict(voted(marked), model).filter("kept AND _at >= 0")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals, base rules and verdict of all documents."""
    return scored(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *SIGNALS, "base_failed", "kept", "posterior")
