import math
from collections import Counter

from pyspark.sql import functions as F

from newstide.functions.tokens import abbreviated, content_words
from newstide.operators import sentences as steps

TEXT = "Acme Inc. reported gains. Dr. Who of Corp. Ltd. left! Then (he said) \"no.\" The U.S. fleet\n\nA new line etc."


def split(spark, text, known=()):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(steps.sentences(F.col("text"), list(known))).first()[0]


def test_known_abbreviations_end_no_sentence(spark):
    known = ["inc", "dr", "corp", "ltd", "u.s", "etc"]
    assert split(spark, TEXT, known) == [
        "Acme Inc. reported gains.", "Dr. Who of Corp. Ltd. left!", 'Then (he said) "no."', "The U.S. fleet", "A new line etc.",
    ]
    assert split(spark, TEXT)[:2] == ["Acme Inc.", "reported gains."]


def test_whole_words_only_and_any_case(spark):
    assert split(spark, "They zinc. It INC. is inc.x so.", ["inc"]) == ["They zinc.", "It INC. is inc.x so."]
    assert split(spark, "a.b. c a+b. c", ["a.b", "a+b"]) == ["a.b. c a+b. c"]


def test_empty_texts(spark):
    assert split(spark, "") == [] and split(spark, " \n\n ") == [] and split(spark, None) is None
    assert split(spark, "...") == ["..."]


def test_tokens_of_abbreviations_keep_their_period_and_go(spark):
    frame = spark.createDataFrame([("Acme Inc. reported gains.",)], "text string")
    plain, informed = frame.select(content_words(F.col("text")), content_words(F.col("text"), abbreviations=["inc"])).first()
    assert plain == ["acme", "inc", "reported", "gains"] and informed == ["acme", "reported", "gains"]
    assert frame.select(abbreviated(F.col("text"), [])).first()[0] == "Acme Inc. reported gains."


def corpus():
    words = "river market stock report company price of the a on rose fell".split()
    lines = []
    for i in range(300):
        own = [words[(i * 7 + k * k) % len(words)] for k in range(9)]
        if i % 3 == 0:
            own.insert(4, "corp.")
        if i % 5 == 0:
            own.insert(2, "U.S.")
        lines.append(" ".join(own) + ".")
    return [(i, line) for i, line in enumerate(lines)]


def test_scores_by_hand(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, "123 ... !")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    n, k = Counter(), Counter()
    for _, text in corpus():
        for word in text.split():
            bare = (word[:-1] if word.endswith(".") else word).lower()
            n[bare] += 1
            k[bare] += word.endswith(".")
    share = sum(k.values()) / sum(n.values())
    want = {}
    for t in k:
        if k[t]:
            w, o, letters = k[t], n[t] - k[t], len(t.replace(".", ""))
            ratio = -2 * (w * math.log(share) + o * math.log(1 - share) - w * math.log(0.99) - o * math.log(0.01))
            want[t] = ratio * math.exp(-letters) * (len(t) - letters + 1) * letters**-o
    found = {r.type: r.score for r in steps.scores(steps.type_counts(frame)).collect()}
    assert found.keys() == want.keys() and all(math.isclose(found[t], want[t], rel_tol=1e-9, abs_tol=1e-12) for t in want)
    assert {r.type for r in steps.abbreviations(frame).collect()} == {"corp", "u.s"}


def test_learned_stored_and_applied(spark, tmp_path):
    frame = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    steps.save_abbreviations(steps.abbreviations(frame), str(tmp_path / "a"))
    known = steps.load_abbreviations(spark, str(tmp_path / "a"))
    assert known == ["corp", "u.s"]
    counts = frame.select(F.size(steps.sentences(F.col("text"), known)).alias("n")).distinct().collect()
    assert [r.n for r in counts] == [1]
    steps.save_abbreviations(steps.abbreviations(frame), str(tmp_path / "b"), most=1)
    assert len(steps.load_abbreviations(spark, str(tmp_path / "b"))) == 1


def test_a_corpus_without_words_or_with_periods_only(spark):
    for rows in ([], [(1, None)], [(1, "a. b. c.")]):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert steps.abbreviations(frame).count() in (0, 3)
