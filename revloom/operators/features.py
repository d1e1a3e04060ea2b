"""Term counts, vocabularies and scaling as long tables (id, term, tf)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions import text as tx
from revloom.operators import ordered
from revloom.session import spread, written

# Terms that hold more than 1 / HOT_SHARE of all rows are handled apart.
HOT_SHARE = 10_000


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether two rows have one key (reads only the keys; a null key counts as one).

    Counts are combined per task first. This runs a job while the query is built.
    """
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def term_counts(
    df: DataFrame,
    id_col: str,
    text: str,
    low: int = 1,
    high: int = 1,
    keep: list[str] | None = None,
    tokenizer: str = "word",
) -> DataFrame:
    """(id, keep..., term, tf) for every term of every document.

    ``keep`` are columns that depend on the id alone (label, split, shard). Terms are
    counted inside their row, so neither texts nor n-grams are shuffled. Only where ids
    repeat are the counts of their rows added up.
    """
    keys = [id_col, *(keep or [])]
    rows = spread(df.select(*keys, text), id_col)
    tokens = rows.select(*keys, tx.TOKENIZERS[tokenizer](F.col(text)).alias("_tokens"))
    grams = F.col("_tokens") if high == 1 else tx.let(F.col("_tokens"), lambda t: tx.ngrams(t, low, high))
    # The outer form, as in ``each``.
    counts = tokens.select(*keys, F.inline_outer(tx.counted(grams))).where(F.col("term").isNotNull())
    if not has_repeats(df, id_col):
        return counts
    return counts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def vocabulary(tf: DataFrame) -> DataFrame:
    """(term, tf, df): occurrences and documents of each term.

    Counts are combined per task before the shuffle, so frequent terms are cheap.
    """
    return tf.groupBy("term").agg(
        F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df")
    )


def fit_vocabulary(tf: DataFrame) -> DataFrame:
    """The vocabulary as a written table, for repeated use."""
    return written(vocabulary(tf), "vocabulary")


def indexed_vocabulary(tf: DataFrame, block_rows: int = ordered.BLOCK_ROWS) -> DataFrame:
    """The vocabulary with ``term_index``, the rank in code-point order from 0.

    It is written first: ranking reads it several times.
    """
    ranked = ordered.rank(fit_vocabulary(tf), [], ["term"], "_rank", block_rows, narrow=True)
    return ranked.withColumn("term_index", F.col("_rank") - 1).drop("_rank")


def look_up(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    values: list[str],
    salt_by: str,
    stored: bool = False,
) -> DataFrame:
    """Left join of (document, term) rows with a table of terms.

    The most frequent terms are in nearly every document, so a plain join on the
    term sends a large share of all rows to one task. Terms that carry more than
    1 / HOT_SHARE of the table's total weight number fewer than HOT_SHARE, which
    bounds what is broadcast. Their rows are answered in place and spread over
    all tasks by document for the second join, which finds the other terms.

    The table is read several times: pass one that is written. With ``stored`` so are
    the rows: those with frequent terms, which are most, are then not shuffled at all.
    """
    total = table.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * HOT_SHARE > total
    hot = table.where(is_hot).select(*keys, F.struct(*values).alias("_hot"))
    rest = table.where(~is_hot).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*values).alias("_rest")
    )
    if stored:
        return _look_up_apart(rows, hot, rest, keys, values)
    near = rows.join(F.broadcast(hot), keys, "left")
    salt = F.pmod(F.xxhash64(salt_by), F.lit(1 << 16)).cast("string")
    salted = F.concat("term", F.lit("\0"), salt)
    match = F.when(F.col("_hot").isNull(), F.col("term")).otherwise(salted)
    near = near.withColumn("_match", match)
    on = near["_match"] == rest["_key_term"]
    for key in keys:
        if key != "term":
            on = on & (near[key] == rest[f"_key_{key}"])
    found = F.coalesce("_hot", "_rest")
    return near.join(rest, on, "left").select(
        *[near[c] for c in rows.columns],
        *[found[v].alias(v) for v in values],
        found.isNotNull().alias("_found"),
    )


def _look_up_apart(rows: DataFrame, hot: DataFrame, rest: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``look_up`` of written rows: only those that ``hot`` does not answer are shuffled."""
    of_hot = F.broadcast(hot)
    answered = rows.join(of_hot, keys).withColumnRenamed("_hot", "_value")
    others = rows.join(of_hot, keys, "left_anti")
    on = [others[k] == rest[f"_key_{k}"] for k in keys]
    looked = others.join(rest, on, "left").select(*[others[c] for c in rows.columns], F.col("_rest").alias("_value"))
    every = answered.select(*rows.columns, "_value").unionByName(looked)
    return every.select(*rows.columns, *[F.col("_value")[v].alias(v) for v in values], F.col("_value").isNotNull().alias("_found"))


def restrict(tf: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """Counts of the vocabulary's terms only; ``vocab`` as from ``fit_vocabulary``."""
    known = look_up(tf, vocab, ["term"], "df", ["df"], id_col)
    return known.where("_found").select(*tf.columns)


def with_all_documents(tf: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Add a row (id, null, 0) for every document without any term."""
    return (
        docs.select(id_col)
        .join(tf, id_col, "left")
        .select(id_col, "term", F.coalesce("tf", F.lit(0)).alias("tf"))
    )


def fit_scale(
    tf: DataFrame, docs: DataFrame, by: list[str] | None = None, fit_on: Column | None = None
) -> DataFrame:
    """(by..., term, std, df), written: the population standard deviation of each term's count
    over all documents, those without the term included as zeros.

    ``by`` fits separately, e.g. per shard; ``fit_on``, a condition on columns that both
    tables have, on part of the documents, e.g. the training part. Only terms that vary
    are listed. Moments (number, mean, sum of squared distances) are merged from task to
    task, and at the end with those of the zeros, so no digits are lost as they are in
    the difference of two large sums.
    """
    by = by or []
    if fit_on is not None:
        tf, docs = tf.where(fit_on), docs.where(fit_on)
    moments = tf.groupBy(*by, "term").agg(
        F.avg("tf").alias("_mean"), F.var_pop("tf").alias("_var"), F.count(F.lit(1)).alias("df")
    )
    if by:
        sizes = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        moments, n = moments.join(sizes, by), F.col("_n")
    else:
        n = docs.agg(F.count(F.lit(1))).scalar()
    share = F.col("df") / n
    variance = share * F.col("_var") + share * (1 - share) * F.col("_mean") * F.col("_mean")
    stds = moments.select(*by, "term", F.sqrt(variance).alias("std"), "df")
    return written(stds.where(F.col("std") > 0), "scale")


def scale(
    tf: DataFrame, stds: DataFrame, id_col: str, by: list[str] | None = None, stored: bool = False
) -> DataFrame:
    """Add ``tf_scaled`` = tf / std; a term that does not vary stays as it is.
    ``stored`` says that ``tf`` is a written table."""
    known = look_up(tf, stds, [*(by or []), "term"], "df", ["std"], id_col, stored)
    scaled = F.col("tf") / F.coalesce("std", F.lit(1.0))
    return known.withColumn("tf_scaled", scaled).drop("std", "_found")


def profile(docs: DataFrame, tf: DataFrame, label: str, split: str) -> DataFrame:
    """One row: documents, positives, set sizes, vocabulary size and matrix cells."""
    vocab = vocabulary(tf).agg(
        F.struct(
            F.count(F.lit(1)).alias("terms"),
            F.sum("df").alias("nonzero"),
            F.sum("tf").alias("tokens"),
        )
    )
    return (
        docs.agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum(label).alias("positives"),
            F.count_if(F.col(split) == "train").alias("train_docs"),
            F.count_if(F.col(split) == "test").alias("test_docs"),
        )
        .withColumn("_terms", vocab.scalar())
        .select("docs", "positives", "train_docs", "test_docs", "_terms.*")
    )
