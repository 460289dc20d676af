from millrace.plans.words import longest_words, most_used_word, tokens, word_counts


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_words_of_a_line(spark):
    rows = tokens(lines(spark, "Rain fell on the 12 roofs. Nobody slept! Who could?"))
    assert [r.token for r in rows.collect()] == [
        "Rain", "fell", "on", "the", "12", "roofs", "Nobody", "slept", "Who", "could",
    ]


def test_lines_without_words(spark):
    assert tokens(lines(spark, "", "?? -- ;; %% (+) [=] {~} !")).count() == 0


def test_words_keep_apostrophes_and_accents(spark):
    assert {r.token for r in tokens(lines(spark, "don't café naïve_1 déjà-vu")).collect()} == {
        "don't", "café", "naïve_1", "déjà", "vu",
    }


def test_longest_words_are_distinct_and_ordered(spark):
    rows = longest_words(lines(spark, "Bear dear bear", "word DEAR a", "cold"), 3).collect()
    assert [(r.word, r.length) for r in rows] == [("bear", 4), ("cold", 4), ("dear", 4)]


def test_longest_words_with_fewer_words_than_asked_for(spark):
    assert [r.word for r in longest_words(lines(spark, "one three"), 30).collect()] == ["three", "one"]


def test_most_used_word_takes_the_greatest_of_equals(spark):
    row = most_used_word(lines(spark, "a b A", "b c")).first()
    assert (row.word, row.occurrences) == ("b", 2)


def test_counts_ignore_case(spark):
    assert {r.word: r.occurrences for r in word_counts(lines(spark, "It it IT is")).collect()} == {"it": 3, "is": 1}


def test_top_words_need_no_full_sort(spark, plan):
    text = plan(longest_words(lines(spark, "a"), 5))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
