"""Search-phrase segmentation (the ``split_words`` table function).

The original used a dictionary word segmenter in finest-grain mode, one phrase per call.
Here segmentation is a native column expression so it runs inside whole-stage codegen
on every executor:

* runs of letters and digits of any script but Han become one lower-case word each;
* runs of Han characters become overlapping bigrams (a single character stays a word),
  the finest-grain fallback for text without a dictionary; ``dictionary_words`` segments them by a
  dictionary table instead.

Empty or NULL text yields no word, so an inner lateral join drops the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns of the segmenter.
WORD_PATTERN = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"
HAN_RUN_PATTERN = r"\p{IsHan}+"


def _han_bigrams(run: Column) -> Column:
    n = F.length(run)
    return F.when(n <= 1, F.array(run)).otherwise(
        F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(run, i, 2)))


def keyword_tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of words of ``text`` (letters/digits words, then Han bigrams)."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.coalesce(c, F.lit(""))
    words = F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), 0)
    han = F.flatten(F.transform(F.regexp_extract_all(c, F.lit(HAN_RUN_PATTERN), 0), _han_bigrams))
    return F.concat(words, han)


LONGEST_WORD = 8        # characters of a dictionary word; longer entries are never found
_COVERED = "\u0000"


def dictionary_words(terms: DataFrame, dictionary: DataFrame, key: list[str], text: str = "full_word", word: str = "word",
                     longest: int = LONGEST_WORD) -> DataFrame:
    """(key..., word): finest-grain segmentation of a phrase, its Han runs by the words of ``dictionary``.

    Of a Han run come all dictionary words in it, at every place and of every length, and each stretch that no
    word covers, as one word; letters and digits become words as in ``keyword_tokens``.  A word comes as often
    as it occurs.  ``key`` names columns that tell the phrases apart.

    Every piece of a run of up to ``longest`` characters is looked up by a join, which Spark broadcasts below its
    own threshold; the hits of a run then come together (one run of one phrase, so a small group).  The
    dictionary may hold repeated, empty or null words.
    """
    known = dictionary.select(F.col(word).alias("__word")).where("__word <> ''").distinct()
    phrases = terms.select(*key, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    plain = phrases.select(*key, F.explode(F.regexp_extract_all(F.lower("__text"), F.lit(WORD_PATTERN), 0)).alias("word"))
    runs = phrases.select(*key, F.posexplode(F.regexp_extract_all("__text", F.lit(HAN_RUN_PATTERN), 0)).alias("__no", "__run"))
    n = F.length("__run")
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), n - i + 1)),
        lambda k: F.struct(i.alias("at"), F.substring(F.col("__run"), i, k).alias("word")))))
    none = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("word"))      # keeps a run without a hit
    looked = (runs.select("*", F.explode(F.concat(pieces, F.array(none))).alias("__p"))
              .select(*key, "__no", "__run", "__p.at", "__p.word").join(known, F.col("word") == F.col("__word"), "left")
              .where((F.col("at") == 0) | F.col("__word").isNotNull()))
    hit = F.when(F.col("at") > 0, F.struct("at", "word"))
    found = looked.groupBy(*key, "__no", "__run").agg(F.collect_list(hit).alias("__hits"))
    rest = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        F.exists("__hits", lambda h: (h["at"] <= i) & (i < h["at"] + F.length(h["word"]))), F.lit(_COVERED))
        .otherwise(F.substring(F.col("__run"), i, F.lit(1)))), "")
    words = F.concat(F.transform("__hits", lambda h: h["word"]), F.regexp_extract_all(rest, F.lit(f"[^{_COVERED}]+"), F.lit(0)))
    return plain.unionByName(found.select(*key, F.explode(words).alias("word")))


# The same segmentation as SQL text (for the SQL table function); ``{t}`` is the input.
TOKENS_SQL = (
    "concat(regexp_extract_all(lower(coalesce({t}, '')), '[\\\\p{{L}}\\\\p{{M}}\\\\p{{N}}&&[^\\\\p{{IsHan}}]]+', 0), "
    "flatten(transform(regexp_extract_all(coalesce({t}, ''), '\\\\p{{IsHan}}+', 0), "
    "r -> CASE WHEN length(r) <= 1 THEN array(r) "
    "ELSE transform(sequence(1, length(r) - 1), i -> substring(r, i, 2)) END)))"
)


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    """SQL surface: ``SELECT word FROM t, LATERAL split_words(full_word)``.

    A temporary SQL table function over native expressions (no Python worker), so SQL
    jobs get the same codegen'd tokenizer as :func:`keyword_tokens`.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (word STRING) "
              f"RETURN SELECT explode({TOKENS_SQL.format(t='text')}) AS word")
