"""Shuffles of the word reports."""

from newstide.operators.words import word_context, word_profile


def test_context_of_words_takes_one_shuffle_after_the_counts(spark):
    rows = spark.createDataFrame(
        [("1-2025-08-10", "sport", ("POSITIVE",), ["ab", "cd"]), ("1-2025-08-10", "arts", ("NEGATIVE",), ["ab"])],
        "sample string, topic string, sentiment struct<label:string>, nouns array<string>",
    )
    out = word_context(word_profile(rows))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 2
    got = {(r.word, r.kind, r.label): (r.n, r.percentage) for r in out.collect()}
    assert got[("ab", "topic", "sport")] == (1, 50) and got[("ab", "sentiment", "negative")] == (1, 50) and got[("cd", "topic", "sport")] == (1, 100)
