"""Word counts and the merging of partial counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import tokens


def word_count(corpus: DataFrame, column: str = "value") -> DataFrame:
    """(word, count) over whole texts; case and punctuation are kept.

    Words are counted within each map task first, so a frequent word costs one
    shuffled row per task.
    """
    words = corpus.select(F.explode(tokens(F.col(column))).alias("word")).where("word <> ''")
    return words.groupBy("word").count()


def merge_counts(partials: DataFrame, column: str = "value") -> DataFrame:
    """Add up ``word<TAB>count`` lines; a line of any other form fails the job."""
    line = F.col(column)
    part = F.split(line, "\t")
    number = F.when(F.size(part) == 2, F.try_element_at(part, F.lit(2)).try_cast("bigint"))
    checked = F.when(number.isNotNull(), number).otherwise(_bad_line(line).cast("bigint"))
    return (
        partials.select(F.element_at(part, 1).alias("word"), checked.alias("n"))
        .groupBy("word")
        .agg(F.sum("n").alias("count"))
    )


def as_tsv(counts: DataFrame) -> DataFrame:
    """One ``word<TAB>count`` string per row, in a column named ``value``."""
    return counts.select(F.concat_ws("\t", "word", F.col("count").cast("string")).alias("value"))


def _bad_line(line: Column) -> Column:
    shown = F.coalesce(line, F.lit(""))
    return F.raise_error(F.concat(F.lit("not a word<TAB>count line: "), shown))
