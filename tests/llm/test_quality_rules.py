"""Line-first cleaning; its SQL counterpart is compared with all queries."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telesift.llm import quality_rules
from tests.llm.cases import AWKWARD, docs, prose


def plain_repeats(text: str) -> int:
    words = text.split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(covered)


def test_awkward_rows_all_come_back(spark):
    frame = docs(spark, kept="mine", N_WORDS=7, lang="en")
    got = quality_rules.line_first(frame)
    assert got.columns == ["doc_id", "text", "lang", *quality_rules.RESULT_COLUMNS]
    rows = got.collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in rows}
    for key in (1, 2, 3):
        assert (by_id[key]["n_words"], by_id[key]["word_chars"], by_id[key]["base_failed"], by_id[key]["kept"]) == (0, 0, True, False)
    assert by_id[1]["cleaned_text"] is None
    assert by_id[4]["kept"] and by_id[7]["kept"] and by_id[7]["n_words"] == 30_000
    assert by_id[12]["n_repeat_words"] == 300 and not by_id[12]["kept"]


def test_empty_table(spark):
    assert quality_rules.line_first(docs(spark, [])).count() == 0
    assert quality_rules.drop_rejected(docs(spark, [], lang="en")).columns == ["doc_id", "text", "lang"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c\n d".split(" ")), max_size=60), min_size=1, max_size=6))
def test_repeated_words_against_plain_python(spark, texts):
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    got = {r[0]: r[1] for r in quality_rules.line_first(docs(spark, rows)).select("doc_id", "n_repeat_words").collect()}
    assert got == {i: plain_repeats(text) for i, text in rows}


def test_each_rule_removes_its_lines(spark):
    good = prose(3, 48)
    lines = [good, "a | b | c | d | e", "what### is&&& this*** here%%%", "Home page", "We use cookies on this site to serve you.", "", good + " again."]
    row = quality_rules.line_first(docs(spark, [(1, "\n".join(lines))])).first()
    assert row["cleaned_text"].split("\n") == [good, "", good + " again."]
    assert (row["n_punctuation_lines"], row["n_navigation_lines"], row["n_boilerplate_lines"]) == (1, 2, 1)


def test_a_whole_text_in_one_line_is_not_lost_to_a_few_words(spark):
    text = prose(9, 2400)
    ends = ["She ate a cookie.", "We use cookies. Read more, sign in to subscribe to our newsletter.", "a - b - c - d.", "a sign indicating rain", "one | two | three | four."]
    rows = [(i, f"{text} {end}") for i, end in enumerate(ends)] + [(90, prose(8, 30) + " She saw a sign in the window and ate a cookie.")]
    for row in quality_rules.line_first(docs(spark, rows)).collect():
        assert row["kept"] and row["lost_share"] == 0 and row["cleaned_text"] == row["text"]


def test_phrases_are_whole_words(spark):
    good = prose(3, 48)
    lines = ["Please log into the sea of logins", "A sign indicating rain", "Sign in to go on.", "Log in", "Sign up!", "Newsletter: every week, once", "No cookies were left on the plate that day."]
    row = quality_rules.line_first(docs(spark, [(1, "\n".join([good, *lines]))])).first()
    assert row["cleaned_text"].split("\n")[1:] == [lines[0], lines[1], lines[6]]


def test_a_text_that_loses_too_much_is_rejected(spark):
    noise = " ".join(f"word{i}###" for i in range(100))
    rows = [(1, prose(5, 200) + "\n" + noise[:300]), (2, prose(6, 40) + "\n" + noise)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.line_first(docs(spark, rows)).collect()}
    assert got == {1: True, 2: False}


def test_drop_rejected_follows_the_cleaned_text(spark):
    frame = docs(spark, [(1, prose(5, 60) + "\nAll rights reserved.")]).withColumn("n_chars", F.length("text").cast("long"))
    row = quality_rules.drop_rejected(frame).first()
    assert row["text"] == prose(5, 60) and row["n_chars"] == len(row["text"])


def test_no_python_and_no_shuffle(spark):
    plan = quality_rules.line_first(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
