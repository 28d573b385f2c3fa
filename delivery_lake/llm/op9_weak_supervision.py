"""Quality rules by weak supervision, in DataFrame functions only.

Each rule looks at one measure of a document and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation over the counts of vote patterns estimates, without labels, the share of good
documents and how often each rule is right on good and on bad documents. The posterior probability that
a document is good replaces the demand that all rules pass.

The measures are taken per row: no text is shuffled or sent to Python. Repeated 3-word windows are
found by sorting, within the row, the windows' hashes with their places packed into one number; windows
with equal hashes are compared word by word, so a collision counts nothing. EM runs over the pattern
counts (at most 3 to the number of rules, whatever the data), one small aggregation per step.

A null text has no words: it votes like an empty one and fails. Rows with equal texts get equal
verdicts. A null doc_id is kept. Extra columns are ignored. An empty table gives an empty result."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import doc_texts, written

#: White space that separates words, as a pattern.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Steps of expectation-maximisation, and pseudo-counts of the accuracies (right, wrong).
STEPS = 30
#: Where it begins: share of good documents; how often a rule is right on good and on bad documents (a
#: good document hardly ever breaks a rule, a bad one breaks the few for its kind of fault).
SHARE, FIRST = 0.8, (0.98, 0.3)
PRIOR = (8.0, 2.0)
#: Posterior from which a document is kept.
KEEP = 0.5


#: Hash of the window at i (only selects what is compared by words).
HASH = "xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))"


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts the rules look at, for every row."""
    text = doc_texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    split = text.select("doc_id", "text", F.filter(F.split("text", SPACE), lambda x: x != "").alias("w"),
                        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    counted = split.select(
        "doc_id", "w", F.size("w").alias("n"), F.length(F.bin(F.size("w").cast("long"))).alias("bits"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[!?]")).cast("long").alias("n_marks"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # A window's hash, without its upper bits, above the place of its first word.
    sorted_ = counted.withColumn("packed", F.expr(f"""
        CASE WHEN n < 3 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, n - 3),
            i -> ({HASH} << bits) | i)) END"""))
    place = "cast(get(packed, {k}) & ((1L << bits) - 1) AS int)"
    words = " AND ".join(f"get(w, {place.format(k='k')} + {i}) = get(w, {place.format(k='k - 1')} + {i})" for i in range(3))
    # Neighbours with one hash; few, as a rule.
    paired = sorted_.withColumn("same", F.expr("""
        CASE WHEN size(packed) < 2 THEN cast(array() AS array<int>) ELSE filter(sequence(1, size(packed) - 1),
            k -> shiftright(get(packed, k), bits) = shiftright(get(packed, k - 1), bits)) END"""))
    # If neighbours with one hash have different words, hashes collide, and equal windows may not be
    # neighbours: such a text's windows are sorted by their words instead.
    spelled = "sort_array(transform(sequence(0, n - 3), i -> struct(get(w, i) AS a, get(w, i + 1) AS b, get(w, i + 2) AS c, i AS i)))"
    equal = "(get(x, {a}).a = get(x, {b}).a AND get(x, {a}).b = get(x, {b}).b AND get(x, {a}).c = get(x, {b}).c)"
    by_words = f"""aggregate(array({spelled}), cast(array() AS array<int>), (none, x) -> transform(
        filter(sequence(0, size(x) - 1), k -> (k > 0 AND {equal.format(a='k', b='k - 1')}) OR (k < size(x) - 1 AND {equal.format(a='k', b='k + 1')})),
        k -> get(x, k).i))"""
    repeated = paired.withColumn("places", F.expr(f"""
        CASE WHEN exists(same, k -> NOT ({words})) THEN sort_array({by_words})
        ELSE sort_array(array_distinct(flatten(transform(same, k -> array({place.format(k='k - 1')}, {place.format(k='k')}))))) END"""))
    return repeated.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_upper", "n_marks", "n_distinct", "n_lines", "n_dup_lines",
        F.expr("""aggregate(places, named_struct('words', 0L, 'end', 0),
            (a, p) -> named_struct('words', a.words + p + 3 - greatest(a.end, p), 'end', p + 3), a -> a.words)""").alias("n_repeat_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules: what each votes on the measures of a document. Each kind of fault has two rules that
    look at it differently, so that their agreement shows up in the vote patterns."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    length = F.col("word_chars") / n
    symbols, symbol_chars = F.col("n_symbols") / n, F.col("n_symbols") / chars
    upper, marks = F.col("n_upper") / chars, F.col("n_marks") / n
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    repeats, distinct = F.col("n_repeat_words") / n, F.col("n_distinct") / n
    return {
        "v_words": _vote(F.col("n_words") < 50, F.col("n_words") >= 80),
        "v_word_length": _vote((length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        "v_symbols": _vote(symbols > 0.1, symbols < 0.03),
        "v_symbol_chars": _vote(symbol_chars > 0.02, symbol_chars < 0.005),
        "v_upper": _vote(upper > 0.4, upper < 0.15),
        "v_marks": _vote(marks > 0.3, marks < 0.1),
        "v_lines": _vote(lines > 0.2, (lines < 0.05) & (F.col("n_lines") > 2)),
        "v_line_count": _vote(F.col("n_dup_lines") >= 4, F.col("n_dup_lines") == 0),
        "v_repeats": _vote(repeats > 0.2, repeats < 0.1),
        "v_distinct": _vote(distinct < 0.25, distinct > 0.45),
    }


def posterior(rules: list[str], model: dict) -> Column:
    """Probability of a good document from its votes."""
    odds = F.lit(math.log(model["share"] / (1 - model["share"])))
    for r in rules:
        right_good, right_bad = model[r]
        odds += F.when(F.col(r) == 1, math.log(right_good / (1 - right_bad))).when(F.col(r) == -1, math.log((1 - right_good) / right_bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, rules: list[str], steps: int = STEPS) -> dict:
    """Share of good documents and, per rule, the accuracies of its votes on good and bad documents,
    from the counts of the vote patterns (columns ``rules`` and ``count``)."""
    model: dict = {"share": SHARE} | {r: FIRST for r in rules}
    right, wrong = PRIOR
    sums = [F.sum("count").alias("all"), F.sum(F.col("count") * F.col("p")).alias("good")]
    for r in rules:
        for v, side in ((1, "up"), (-1, "down")):
            mine = F.when(F.col(r) == v, F.col("count")).otherwise(0)
            sums += [F.sum(mine * F.col("p")).alias(f"{r}_{side}_good"), F.sum(mine * (1 - F.col("p"))).alias(f"{r}_{side}_bad")]
    for _ in range(steps):
        s = patterns.withColumn("p", posterior(rules, model)).agg(*sums).first()
        if not s["all"]:
            return model
        new: dict = {"share": (s["good"] + 1) / (s["all"] + 2)}
        for r in rules:
            new[r] = ((s[f"{r}_up_good"] + right) / (s[f"{r}_up_good"] + s[f"{r}_down_good"] + right + wrong),
                      (s[f"{r}_down_bad"] + right) / (s[f"{r}_up_bad"] + s[f"{r}_down_bad"] + right + wrong))
        change = max(abs(new["share"] - model["share"]), *(abs(a - b) for r in rules for a, b in zip(new[r], model[r])))
        model = new
        if change < 1e-6:
            break
    return model


def judge(docs: DataFrame) -> DataFrame:
    """Measures, votes and ``posterior`` of every row."""
    rules = votes()
    voted = written(measures(docs).withColumns(rules), "votes")
    patterns = written(voted.groupBy(*rules).count(), "patterns")
    return voted.withColumn("posterior", posterior(list(rules), estimate(patterns, list(rules))))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              failed.alias("base_failed"), (~failed & (F.col("posterior") >= KEEP)).alias("kept"), "posterior")
