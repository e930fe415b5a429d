"""The summariser of a run."""

from newstide.operators.models import Models, classify, topic_lexicon


def test_classify_summarises_each_text_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def summariser():
        def summarise(text, longest, shortest):
            with open(log, "a") as f:
                f.write(text.split()[0] + "\n")
            return "sport " + text[:20]

        return summarise

    rows = spark.createDataFrame([(i, f"t{i} " + "word " * 60) for i in range(6)] + [(9, "short sport")], "article_id long, text string")
    polarity = spark.createDataFrame([("sport", 1.0)], "word string, polarity double")
    got = classify(rows, topic_lexicon(spark, ["sport"]), polarity, Models(summariser=summariser)).collect()
    assert len(got) == 7 and {r.topic for r in got} == {"sport"} and {r.sentiment.label for r in got} == {"POSITIVE"}
    assert sorted(open(log).read().split()) == [f"t{i}" for i in range(6)]
