"""Mixing of sources to target weights, measured in tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.encode import encode_corpus
from freshet.operators.series import running_total
from freshet.session import cut

SEED = 20_240_613


def source_name(c: Column) -> Column:
    """Sources that differ in case or outer blanks only are one."""
    return F.lower(F.trim(c))


def repetition_rates(sources: DataFrame, total: DataFrame) -> DataFrame:
    """sources(source, target_share, max_repeats, tokens) with rate: how often each document of a source is used, for a mix of total(total) tokens, one row.

    A source gets target_share * total tokens; where its cap holds it below that, what is missing goes to the others in proportion to
    their shares. So there is one level such that a source gets level * target_share tokens or, if that is less, all that its cap allows.
    In the order of the level at which sources reach their caps, the first one that doesn't reach its own tells the level; running sums are
    made in Spark, over any number of sources. If all sources are at their caps, the mix is smaller than total.
    """
    most = F.col("max_repeats") * F.col("tokens").cast("double")
    free = sources.filter("tokens > 0 AND target_share > 0 AND max_repeats > 0").withColumn("_most", most).withColumn("_full", F.col("_most") / F.col("target_share"))
    run = running_total(free, ["_full", "source"], F.col("_most"), "_held", "_all_most")
    run = running_total(run, ["_full", "source"], F.col("target_share"), "_earlier", "_shares")
    level = F.expr("try_divide(greatest(total - _held, 0D), _shares - _earlier)")
    at = run.crossJoin(F.broadcast(total)).withColumn("_level", level).filter("_level < _full").agg(F.min_by("_level", F.struct("_full", "source")).alias("_level"))  # one row
    rate = F.when((F.col("tokens") > 0) & (F.col("target_share") > 0), F.least(F.col("max_repeats").cast("double"), F.coalesce(F.col("_level") * F.col("target_share") / F.col("tokens"), F.col("max_repeats").cast("double"))))
    return sources.crossJoin(F.broadcast(at)).withColumn("rate", F.greatest(F.coalesce(rate, F.lit(0.0)), F.lit(0.0))).drop("_level")


class Mix:
    """The parts of one mix: documents with their number of copies, and the shares reached."""

    def __init__(self, documents: DataFrame, report: DataFrame):
        self.documents, self.report = documents, report


def mix_sources(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    total_tokens: int | None = None,
    seed: int = SEED,
    **tokenizer,
) -> Mix:
    """Mix docs to targets(source, target_share, max_repeats).

    total_tokens is the size of the mix, by default as many tokens as the listed sources hold. The tokens of every
    document of a listed source are counted once and summed by source (partial sums come before the shuffle). With the
    source's rate r, a document is used floor(r) times, and once more if its hash with the seed, taken as a number
    in [0, 1), is below r - floor(r); so it is never used more often than max_repeats.

    documents: key, source, n_tokens, copies (only those used). report, a row for each listed source: source, target_share,
    max_repeats, n_docs, tokens, rate, docs_used, mixed_tokens, actual_share.
    The defined cases: null sources and unlisted ones take no part; null and empty texts have 0 tokens and are used at their
    source's rate; of a source listed twice the shares add up and the least max_repeats holds; null shares and caps count as 0;
    a listed source without tokens has rate 0; equal rows of docs are used as one row is; an empty table gives no documents.
    """
    t = targets.filter(F.col("source").isNotNull()).groupBy(source_name(F.col("source")).alias("source")).agg(
        F.coalesce(F.sum("target_share"), F.lit(0.0)).cast("double").alias("target_share"), F.coalesce(F.min("max_repeats"), F.lit(0)).cast("int").alias("max_repeats")
    )
    d = docs.select(F.col(key).alias("_id"), source_name(F.col(source)).alias("_source"), F.col(text).alias("_text"))
    d = d.join(t.select(F.col("source").alias("_source")), "_source", "left_semi")
    counted = cut(encode_corpus(d, "_id", "_text", count_only=True, keep=("_source",), **tokenizer))  # a few bytes a document; texts are encoded once

    sums = counted.groupBy(F.col("_source").alias("source")).agg(F.count("*").alias("n_docs"), F.sum("n").alias("tokens"))
    s = cut(t.join(sums, "source", "left").fillna(0, ["n_docs", "tokens"]))
    total = s.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double").alias("total")) if total_tokens is None else docs.sparkSession.range(1).select(F.lit(float(total_tokens)).alias("total"))
    rated = cut(repetition_rates(s, total))

    coin = F.pmod(F.xxhash64(F.lit(seed), F.col("_id")), F.lit(1 << 53)).cast("double") / float(1 << 53)
    used = (
        counted.join(rated.select(F.col("source").alias("_source"), "rate"), "_source")
        .withColumn("copies", (F.floor("rate") + (coin < F.col("rate") - F.floor("rate")).cast("bigint")).cast("bigint"))
        .filter("copies > 0")
        .select(F.col("_id").alias(key), F.col("_source").alias("source"), F.col("n").alias("n_tokens"), "copies")
    )
    done = used.groupBy("source").agg(F.count("*").alias("docs_used"), F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"))
    r = rated.join(done, "source", "left").fillna(0, ["docs_used", "mixed_tokens"])
    whole = r.agg(F.sum("mixed_tokens").alias("_all"))
    r = r.crossJoin(F.broadcast(whole)).withColumn("actual_share", F.coalesce(F.expr("try_divide(mixed_tokens, _all)"), F.lit(0.0))).drop("_all")  # one row
    return Mix(used, r)


def expand_copies(mixed: DataFrame) -> DataFrame:
    """One row for each copy: the columns of Mix.documents with copy (1, 2, ...) in place of copies."""
    return mixed.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies")
