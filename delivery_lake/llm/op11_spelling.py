"""Spelling variants by asymmetric q-chunks.

The words of a corpus are counted, and frequent ones that differ by one edit (a code point inserted,
deleted or replaced) are found by an asymmetric signature. The shorter word of a pair (of two equally
long ones the smaller) contributes two disjoint chunks, its first half and its rest; the other word
contributes the positional grams of the chunks' sizes. One edit lies in one chunk at most, so the other
one is preserved in the longer word, where it is moved by one place at most: a first chunk not at all, a
second one by the difference of the lengths. So of all positional grams only those within this shift are
made: for each possible length of a chunk word one gram a chunk, joined on (length of the chunk word,
which chunk, gram). The join's condition verifies a candidate by its edit distance, so candidates are
never rows of their own; a hot gram's partition is split by Spark (adaptive skew join).

A word's form is its most frequent near word, where that is so much more frequent that the word is likely
a misspelling of it; following forms leads to the root. As each form is several times as frequent as its
word, chains are short; pointers are doubled, so the rounds are the logarithm of a chain's length.

Nothing is capped. Texts are not shuffled: words are counted in each task before they are.

A null or empty text has no words; a null doc_id is taken as empty in the hash that deletes code points.
Repeated rows count as often as they occur. Ties of frequency go to the word that is smaller in
code-point order. Extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import written

#: Contract values: runs of letters, one in DAMAGE of them loses a code point, least code points and
#: occurrences of a word, how many times as frequent as a word its form is.
RUN = "[a-zÀ-ÿ]+"
DAMAGE = 199
LEAST_CHARS, LEAST_COUNT, FACTOR = 6, 5, 5


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """``doc_id`` (text), ``run`` for every run of at least ``least`` letters, A-Z in lower case."""
    lower = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                        F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    return found.where(F.length("run") >= least)


def damaged(doc_id: str, run: str, one_in: int = DAMAGE) -> Column:
    """The run, without one code point where the hash of document and run says so."""
    h = F.crc32(F.concat(F.col(doc_id), F.lit(":"), F.col(run)))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(F.col(run), F.lit(1), at), F.substring(F.col(run), at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(one_in)) == 0, cut).otherwise(F.col(run))


def frequent_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, one_in: int = DAMAGE) -> DataFrame:
    """``word, n`` for the words of enough code points and occurrences."""
    words = runs(docs, least_chars).select(damaged("doc_id", "run", one_in).alias("word"))
    return words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _signature(size: Column, part: int, gram: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), F.lit(part).alias("part"), gram.alias("gram"))


def chunks(words: DataFrame) -> DataFrame:
    """``size, part, gram, word, n``: the two disjoint chunks of every word."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(_signature(size, 1, F.substring(F.col("word"), F.lit(1), half)),
                   _signature(size, 2, F.substring(F.col("word"), half + 1, size - half)))
    return words.select(F.explode(both).alias("s"), "word", "n").select("s.*", "word", "n")


def grams(words: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``size, part, gram, word, n``: the positional grams that chunks of words as long, or shorter by one,
    can have moved to (``size``: length of the chunk word)."""
    length = F.length("word")

    def of(size: Column) -> list[Column]:
        half = F.floor(size / 2).cast("int")
        return [_signature(size, 1, F.substring(F.col("word"), F.lit(1), half)),
                _signature(size, 2, F.substring(F.col("word"), length - (size - half) + 1, size - half))]

    every = words.select(F.explode(F.array(*of(length), *of(length - 1))).alias("s"), "word", "n").select("s.*", "word", "n")
    return every.where(F.col("size") >= least_chars)


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``a, a_n, b, b_n``: every two words that differ by one edit, once."""
    left = chunks(words).withColumnsRenamed({"word": "a", "n": "a_n"})
    right = grams(words, least_chars).withColumnsRenamed({"word": "b", "n": "b_n"})
    longer = (F.length("b") > F.length("a")) | (F.col("a") < F.col("b"))
    same = (left["size"] == right["size"]) & (left["part"] == right["part"]) & (left["gram"] == right["gram"])
    found = left.join(right, same & longer & (F.levenshtein("a", "b", 1) == 1))
    return found.select("a", "a_n", "b", "b_n").distinct()


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form`` links without a cycle: the last word that forms lead to."""
    at = written(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not at.where("moved").isEmpty()
        at = at.select("word", "root")
        if not moved:
            return at


def spelling_groups(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, factor: int = FACTOR,
                    one_in: int = DAMAGE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word."""
    words = written(frequent_words(docs, least_chars, least_count, one_in), "words")
    pairs = written(near_words(words, least_chars), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    # The most frequent near word; of those as frequent the least.
    best = F.min(F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    far = -F.col("best.rank") >= factor * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", F.when(far, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(far, -F.col("best.rank")).alias("form_n")), "forms")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    return spelling_groups(docs)
