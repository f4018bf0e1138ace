"""Word counts and merging."""

import random
from collections import Counter

import pytest

from stratalake.operators.wordcount import as_tsv, merge_counts, word_count
from stratalake.plans.count_words import count_words, merge_word_counts

SPACES = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
NOT_SPACES = "\u200b\u180e\ufeff"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def counts(df):
    return {r.word: r["count"] for r in df.collect()}


def test_case_and_punctuation_are_kept(spark):
    assert counts(word_count(lines(spark, "  a  A a, ", "a"))) == {"a": 2, "A": 1, "a,": 1}


def test_blank_and_missing_lines_give_nothing(spark):
    assert counts(word_count(lines(spark, "", "  \t ", None))) == {}
    assert counts(word_count(lines(spark))) == {}


def test_tokens_agree_with_python_split(spark):
    rng = random.Random(4)
    alphabet = "abcdefgh\u00e9\u00df.-" + NOT_SPACES + SPACES
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    expected = Counter(word for text in texts for word in text.split())
    assert counts(word_count(lines(spark, *texts))) == expected


def test_one_word_holding_most_of_the_text(spark):
    df = lines(spark, *(["the " * 50 + f"w{i}" for i in range(200)])).repartition(8)
    assert counts(word_count(df))["the"] == 10000


def test_merge(spark):
    assert counts(merge_counts(lines(spark, "x\t2", "x\t3", "y\t1"))) == {"x": 5, "y": 1}
    assert counts(merge_counts(lines(spark))) == {}


@pytest.mark.parametrize("bad", ["x", "x\t1\t2", "x\tmany", "x\t", ""])
def test_merge_refuses_other_lines(spark, bad):
    with pytest.raises(Exception, match="not a word<TAB>count line"):
        merge_counts(lines(spark, "x\t2", bad)).collect()


def test_merging_any_split_equals_the_whole(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(30)) for _ in range(90)]
    whole = counts(word_count(lines(spark, *texts)))
    cut = rng.randrange(1, 89)
    parts = [word_count(lines(spark, *part)) for part in (texts[:cut], texts[cut:])]
    assert counts(merge_counts(as_tsv(parts[0]).union(as_tsv(parts[1])))) == whole


def test_files_in_files_out(spark, path, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("b a\n\nb c\n")
    (tmp_path / "in" / "b.txt").write_text("b")
    count_words(spark, path("in"), path("out"))
    got = {r.value for r in spark.read.text(path("out")).collect()}
    assert got == {"a\t1", "b\t3", "c\t1"}
    merge_word_counts(spark, path("out"), path("merged"))
    assert {r.value for r in spark.read.text(path("merged")).collect()} == got
    with pytest.raises(ValueError, match="same path"):
        count_words(spark, path("in"), path("in"))
