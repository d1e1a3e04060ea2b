"""Tokenisers as native column expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A segment ends after ". " or at a line break; the break itself is dropped.
SEGMENT = r"([^\n]*?\. |[^\n]+)"
# Letters, digits and underscore of any script; \w is ASCII-only on the JVM.
WORD = r"([\p{L}\p{N}_]{2,})"
WORD_OR_MARK = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"
CHARACTER = r"(?s)(.)"


def _all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def segments(text: Column) -> Column:
    """Sentences and lines, in order, without empty ones."""
    return _all_matches(text, SEGMENT)


def words(text: Column) -> Column:
    """Lower-cased words of two or more characters."""
    return _all_matches(F.lower(text), WORD)


def words_and_marks(text: Column) -> Column:
    """Words of any length and single punctuation marks, case kept."""
    return _all_matches(text, WORD_OR_MARK)


def characters(text: Column) -> Column:
    """One token per character."""
    return _all_matches(text, CHARACTER)


TOKENIZERS = {"word": words, "mark": words_and_marks, "char": characters}


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams of ``low`` to ``high`` tokens, shorter ones first.

    Each order is the previous one zipped with the tokens shifted by one, so a
    gram is built once and no slice is taken per position. ``tokens`` should be
    a plain column: it is used several times.
    """
    if not 1 <= low <= high:
        raise ValueError("need 1 <= low <= high")
    size = F.size(tokens)
    grams = tokens
    parts = [grams] if low == 1 else []
    for n in range(2, high + 1):
        length = F.greatest(size - (n - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), length),
            F.slice(tokens, F.lit(n), length),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        if n >= low:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it.

    The value is what a sum over nothing starts with: unlike the elements of a
    transformed array, neither it nor the result is copied.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def counted(items: Column) -> Column:
    """Each different item of an array with its number: array of (term, tf).

    Equal items stand together once the array is sorted, so a number is the distance
    between the ends of two runs. ``sort_array`` compares the values as they are;
    ``array_sort`` would run an expression for every comparison.
    """

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(ordered))
        last = F.filter(places, lambda i: ~F.get(ordered, i - 1).eqNullSafe(F.get(ordered, i)))
        return let(last, lambda ends: F.transform(ends, lambda e, k: F.struct(
            F.get(ordered, e - 1).alias("term"),
            (e - F.coalesce(F.get(ends, k - 1), F.lit(0))).cast("long").alias("tf"),
        )))

    return let(items, lambda held: F.when(F.size(held) > 0, let(F.sort_array(held), runs)))


def each(
    df: DataFrame, keys: list[str], items: Column, name: str, position: str | None = None
) -> DataFrame:
    """One row per array element, with its position when asked.

    The outer form is used because a plain explode adds a filter on the array's
    size below it, which computes an expensive array expression once more.
    """
    rows = df.select(*keys, F.posexplode_outer(items).alias("_pos", name))
    if position is None:
        kept = rows.drop("_pos")
    else:
        kept = rows.withColumn(position, F.col("_pos").cast("long")).drop("_pos")
    return kept.where(F.col(name).isNotNull())
