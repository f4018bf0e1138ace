"""Text files to word counts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratalake.operators.wordcount import as_tsv, merge_counts, word_count
from stratalake.sources.landing import read_lines
from stratalake.sources.sinks import require_distinct, write_lines


def count_words(spark: SparkSession, texts: str, output: str) -> None:
    """Count the words of all text files and write ``word<TAB>count`` lines."""
    require_distinct(texts, output)
    write_lines(as_tsv(word_count(read_lines(spark, texts))), output)


def merge_word_counts(spark: SparkSession, partials: str, output: str) -> None:
    """Merge files of ``word<TAB>count`` lines into one set of counts."""
    require_distinct(partials, output)
    write_lines(as_tsv(merge_counts(read_lines(spark, partials))), output)
