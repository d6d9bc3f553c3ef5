import html as standard_html
import random
import time

import duckdb
import pyarrow as pa
import pytest
from porter_by_hand import stem as stem_by_hand
from pyspark.sql import functions as F

from newstide.functions import html, porter, tokens
from newstide.plans.oracles import word_list


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("I can't stop. Prices fell 5.3% in the U.S. today", ["ca", "stop", "prices", "fell", "today"]),
        ("well-known https://x.y/z shares", ["shares"]),
        ("été à Paris", ["été", "à", "paris"]),
        ("", []),
        ("the of and", []),
        ("rise, rise and rise", ["rise", "rise", "rise"]),
        ("1,000 shares,worth 20", ["shares", "worth", "20"]),
        ("He said \"stop.\" It's Apple's (new) plan...then", ["said", "stop", "apple", "new", "plan"]),
        ("We cannot cannot gonna go", ["gon", "na", "go"]),
        ("edge.%%% star.*** amp&&& stop&mid", ["star", "amp", "stop", "mid"]),
        ("the dogs' tails", ["dogs", "tails"]),
        ("good--bad", ["good", "bad"]),
    ],
)
def test_content_words(spark, text, expected):
    assert one(spark, text, tokens.content_words) == expected


def test_runs_of_marks_and_anything_else_part_words_as_the_rules_say(spark):
    """The rules rewrite a text one after the other, in the SQL the queries are held against."""
    draw = random.Random(1)
    marks = ["a", "bc", "profit", "x", "5", "42", "'", "-", ",", ":", ".", ". ", " ", "''", "--", ";", '"', "(", ")", "n't", "can't", "'s", "_", "é", "*"]
    rows = ["".join(draw.choice(marks) for _ in range(draw.randint(1, 14))) for _ in range(3000)]
    shapes = ("%s profit rose", "%sprofit rose", "profit%srose 5", "a %s5 b", "x.%sprofit y", "profit.%s")
    rows += [shape % (m * n) for n in [1, 2, *range(15, 22), 40, 41] for m in "-',:" for shape in shapes]
    rows = list(enumerate(rows))
    db = duckdb.connect()
    db.execute("create table documents(doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", rows)
    want = dict(db.execute(f"select doc_id, {word_list('text')} from documents").fetchall())
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.w for r in frame.select("doc_id", tokens.content_words(F.col("text")).alias("w")).collect()}
    assert [(t, got[i], want[i]) for i, t in rows if got[i] != want[i]] == []


def test_token_counts_need_no_shuffle(spark):
    frame = spark.createDataFrame([(["b", "a", "b", "b"],), ([],)], "t array<string>")
    out = frame.select(tokens.token_counts(F.col("t")).alias("c"))
    assert [tuple(map(tuple, r.c)) for r in out.collect()] == [(("a", 1), ("b", 3)), ()]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


# Pairs published with the algorithm.
PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electrical": "electr", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "activate": "activ",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "dying": "die", "news": "news", "geology": "geolog", "enjoy": "enjoy", "died": "die", "by": "by",
}


def test_stem_published_pairs(spark):
    frame = spark.createDataFrame(list(PAIRS.items()), "w string, expected string")
    wrong = frame.withColumn("got", porter.stem(F.col("w"))).filter("got <> expected").collect()
    assert wrong == []


def test_stem_equals_plain_rules_on_many_words(spark):
    rng = random.Random(7)
    endings = list(porter.STEP_2) + list(porter.STEP_3) + porter.STEP_4 + [
        "s", "es", "ies", "ied", "ed", "eed", "ing", "sses", "y", "e", "ll", "logi", "ationalli", "",
    ]
    words = list(porter.IRREGULAR)
    for _ in range(6000):
        base = "".join(rng.choice("aeiouybcdlstwxzé1") for _ in range(rng.randint(0, 6)))
        words.append(base + rng.choice(endings))
    frame = spark.createDataFrame([(w, stem_by_hand(w)) for w in words if w], "w string, expected string")
    wrong = frame.withColumn("got", porter.stem(F.col("w"))).filter("got <> expected").collect()
    assert wrong == []


def test_stems_of_arrays_keep_nulls_order_and_repeats(spark):
    rows = [(1, ["running", "cats", "running"]), (2, None), (3, []), (4, [None, "ponies", "é"]), (5, ["cats"])]
    frame = spark.createDataFrame(rows * 3, "i int, w array<string>").coalesce(1)
    got = frame.where("i <> 5").select("i", porter.stem_words(F.col("w")).alias("s"), F.get("w", F.lit(0))).collect()
    want = {1: ["run", "cat", "run"], 2: None, 3: [], 4: [None, "poni", "é"]}
    assert len(got) == 12 and all(r.s == want[r.i] for r in got)


def test_each_word_of_a_batch_is_stemmed_once(monkeypatch):
    calls, own = [], porter.stemmed
    monkeypatch.setattr(porter, "stemmed", lambda w: calls.append(w) or own(w))
    monkeypatch.setattr(porter, "_STEMS", porter._Stems())
    words = pa.array([["falling", "cats"] * 50, ["falling"]] * 20)
    assert porter.stem_words.func(words).to_pylist() == [["fall", "cat"] * 50, ["fall"]] * 20
    assert sorted(calls) == ["cats", "falling"]


def article(body):
    return f'<html><script>var t="</p><p>no";</script><div class="x caas-body y">{body}</div><p>out</p></html>'


@pytest.mark.parametrize(
    "page, expected",
    [
        (article("<p>One <b>two</b></p><p class=z>Three</p>"), "One two\nThree\n"),
        (article("<div><p>In</p></div><p>After</p>"), "In\nAfter\n"),
        (article("<p>a<p>b</p>c"), "abc\nb\n"),  # an unclosed paragraph holds the next one
        (article("<pre>x</pre></p><p>y"), "y\n"),
        (article("<p>A &amp; B &lt;b&gt; &#233;&#x20AC; &nope; &amp;amp; &amp</p>"), "A & B <b> é€ &nope; &amp; &\n"),
        (article("<!-- <p>gone</p> --><p></p>"), "\n"),
        ('<div class="caas-body-more"><p>x</p></div>', ""),
        ("<p>no container</p>", ""),
        ("", ""),
        (None, None),
    ],
)
def test_article_text(spark, page, expected):
    assert one(spark, page, html.article_text) == expected


def test_article_text_other_container(spark):
    page = "<article><h1>T</h1><p>x</p></article><article><p>second</p></article>"
    assert one(spark, page, lambda c: html.article_text(c, "article", None)) == "x\n"


def test_character_references_are_those_of_html(spark):
    """Names with and without semicolon, numbers of control codes, and what is none."""
    draw = random.Random(2)
    pieces = (
        "&amp; &amp &copy 2024|&#146;|&#x80;|&AMP;|&Eacute;|&para;|&frac14;|&iexcl;|&alpha;|&notit;|&notin;|&ampx|&#0;|"
        "&#xD800;|&#99999999999999;|&#x110000;|&#13;|&#11;|&#xFFFE;|&#64976;|&|& |&;|&#;|&#x;|&unknown;|x| |&lt;p&gt;|"
        "&&amp;|&#65|&#x41 |&NotEqualTilde;|&fjlig;|&CounterClockwiseContourIntegral;|&#00065;|&#128512;"
    ).split("|")
    rows = list(enumerate("".join(draw.choice(pieces) for _ in range(draw.randint(1, 6))) for _ in range(800)))
    frame = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: r.u for r in frame.select("i", html.unescape(F.col("t")).alias("u")).collect()}
    assert [(t, got[i]) for i, t in rows if got[i] != standard_html.unescape(t)] == []


def test_many_paragraphs_take_linear_time(spark):
    def seconds(n):
        page = '<div class="caas-body">' + "".join(f"<p>para {i} &amp; text</p>" for i in range(n)) + "</div>"
        frame = spark.createDataFrame([(page,)], "h string").select(html.article_text(F.col("h")).alias("t"))
        start = time.perf_counter()
        text = frame.first().t
        assert text.count("\n") == n and text.startswith("para 0 & text\n")
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) < 2 * seconds(16_000) + 2
