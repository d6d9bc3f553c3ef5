import random
import re
import time

import pytest
from llm_cases import LONG, ROWS, documents, empty

from newstide.llm import entities, queries, surrogates
from newstide.llm.entities import mentions, rendered, stand_in

KEY = b"a key of the tests"


def found(text):
    return [(m.kind, text[m.start : m.end]) for m in mentions(text)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("write to Ann.Lee99@mail7.example.com.", [("email", "Ann.Lee99@mail7.example.com")]),
        ("call +1 (974) 555-3436 or (974) 555-3436", [("phone", "+1 (974) 555-3436"), ("phone", "(974) 555-3436")]),
        ("974-555-3436, +49 30 1234567", [("phone", "974-555-3436"), ("phone", "+49 30 1234567")]),
        ("+33 1 23 45 67 89 or 1-800-555-0199.", [("phone", "+33 1 23 45 67 89"), ("phone", "1-800-555-0199")]),
        ("card 4111 1111 1111 1111 and 9807915762804490.", [("card", "4111 1111 1111 1111"), ("card", "9807915762804490")]),
        ("97.51.17.173 10.0.0.5, not 1.2.3 or 1.2.3.4.5 or 300.1.1.1", [("ipv4", "97.51.17.173"), ("ipv4", "10.0.0.5")]),
        ("2001:0db8:85a3:0000:0000:8a2e:0370:7334", [("ipv6", "2001:0db8:85a3:0000:0000:8a2e:0370:7334")]),
        ('token = "1eb9c654e721b4f812088970e66a6345cee33dd6" x', [("secret", "1eb9c654e721b4f812088970e66a6345cee33dd6")]),
        ('TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!', [("secret", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B")]),
        ("password: hunter22 but the secret: happiness", [("secret", "hunter22")]),
        ("123-45-6789", [("ssn", "123-45-6789")]),
        ("DE89 3704 0044 0532 0130 00, not DE89 3704 0044 0532 0130 01", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("Mr. John Smith met Mary Jones.", [("given_m", "John"), ("surname", "Smith"), ("given_f", "Mary"), ("surname", "Jones")]),
        ("Frau Weber und Herr Klaus Meier", [("surname", "Weber"), ("given_m", "Klaus"), ("surname", "Meier")]),
        ("My name is Xenia Quill. Dear Mr. Brook, the river named after him.", [("given_f", "Xenia"), ("surname", "Quill"), ("surname", "Brook")]),
        ("Иван Петров", [("given_m", "Иван"), ("surname", "Петров")]),
        ("In. The of 2024-01-02 at 12:30, version 2.0, 3.14159 or 1,000,000; a@b; @x; Page 12-14.", []),
        ("He met the Queen. Anna. The end.", []),
        ("Mrs. Mary Smith called. Then Smith said Mary agreed, in Smith's house; a smith.",
         [("given_f", "Mary"), ("surname", "Smith"), ("surname", "Smith"), ("given_f", "Mary"), ("surname", "Smith")]),
        ("John F. Kennedy spoke.", [("given_m", "John"), ("initial", "F"), ("surname", "Kennedy")]),
        ("Mr. J. R. Tolkien on Monday", [("initial", "J"), ("initial", "R"), ("surname", "Tolkien")]),
        ("Mary Jane Watson", [("given_f", "Mary"), ("given_f", "Jane"), ("surname", "Watson")]),
        ("2001:db8::1, fe80::a1/64 and 2001:DB8:0::2.", [("ipv6", "2001:db8::1"), ("ipv6", "fe80::a1"), ("ipv6", "2001:DB8:0::2")]),
        ("a man named Xenia B. Quill", [("given_f", "Xenia"), ("initial", "B"), ("surname", "Quill")]),
        ("called Blue Velvet, named New Haven. Dear Sir Madam, Dear Reader Friends,", []),
        ("Grace Period, Victoria Station, Mark Square, April May", []),
        ("a[1::2], a[100:200], std::face, abc::def, Face::Dead", []),
        ("order 9807915762804490, card no. 9807915762804490", [("card", "9807915762804490")]),
    ],
)
def test_mentions(text, expected):
    assert found(text) == expected


def shape(text):
    return re.sub("[0-9]", "9", re.sub("[a-zа-я]", "a", re.sub("[A-ZА-Я]", "A", text)))


def test_stand_ins_keep_type_format_and_validity():
    for text in ("+1 (974) 555-3436", "974.555.3436", "4111 1111 1111 1111", "9807 9157 6280 4490", "123-45-6789",
                 "1eb9c654e721b4f812088970e66a6345cee33dd6", "DE89 3704 0044 0532 0130 00"):
        text = f"token = {text}" if len(text) == 40 else text
        [m] = mentions(text)
        own = text[m.start : m.end]
        put = rendered(own, m.kind, stand_in(m.kind, m.normal, KEY))
        assert put != own and [(k) for k, _ in found(text.replace(own, put))] == [m.kind]
        if m.kind != "secret":
            assert shape(put) == shape(own)
        if m.kind == "card":
            digits = lambda t: re.sub(r"\D", "", t)
            assert entities._luhn(digits(put)) == entities._luhn(digits(own)) and put[0] == own[0]
    assert stand_in("ipv4", "10.1.2.3", KEY).startswith("10.") and stand_in("ipv4", "192.168.1.1", KEY).startswith("192.168.")
    email = stand_in("email", "ann.lee99@mail7.firm.org", KEY)
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d\d@[a-z]{4}\d\.example\.org", email)


def test_names_keep_gender_script_and_case():
    for (script, gender), names in entities.GIVEN.items():
        made = [stand_in(f"given_{gender}", n.lower(), KEY) for n in names]
        assert sorted(made) == sorted(n.lower() for n in names) and all(a != n.lower() for a, n in zip(made, names))
    for name in ("Smith", "Петров", "Παπαδόπουλος"):
        assert entities.script_of(stand_in("surname", name.lower(), KEY)) == entities.script_of(name)
    assert rendered("SMITH", "surname", "vasom") == "VASOM" and rendered("Smith", "surname", "vasom") == "Vasom"
    assert stand_in("surname", "smith", KEY) != stand_in("surname", "smith", b"another")


def test_addresses_keep_network_and_notation():
    private = [f"192.168.{i // 256}.{i % 256}" for i in range(1 << 16)]
    made = [stand_in("ipv4", a, KEY) for a in private[::16]]
    assert len(set(made)) == len(made) and all(m.startswith("192.168.") and m != a for m, a in zip(made, private[::16]))
    assert stand_in("ipv4", "172.20.1.1", KEY).startswith("172.") and 16 <= int(stand_in("ipv4", "172.20.1.1", KEY).split(".")[1]) < 32
    forms = ["2001:db8::1", "2001:0db8:0:0:0:0:0:1", "2001:0DB8::0001"]
    put = [surrogates._replaced(f"at {f} now", KEY, {})[0][3:-4] for f in forms]
    assert len({entities.IPv6Address(p) for p in put}) == 1 and put[0] not in forms
    assert [[len(g) for g in p.split(":")] for p in put] == [[len(g) for g in f.split(":")] for f in forms]


PRIVATE = [  # a text, words that must go, words that must stay
    ("Mrs. Mary Smith called. Then Smith said Mary agreed.", "Mary Smith", "Mrs called Then said agreed"),
    ("John F. Kennedy spoke. KENNEDY left with Kennedy's hat.", "John Kennedy KENNEDY", "spoke left with hat"),
    ("Mary Jane Watson lives at 2001:db8::1 or 192.168.0.1", "Mary Jane Watson db8", "lives at or 192 168"),
    ("Dear Petra Quill, the song called Blue Velvet is by Quill.", "Petra Quill", "Dear song called Blue Velvet is by"),
    ("My name is Ana-Lena O'Neill; O'Neill it is.", "Ana O'Neill Neill", "My name is it"),
]


def test_names_go_wherever_they_stand(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(PRIVATE)]
    out = {r.doc_id: r.text for r in surrogates.surrogates(documents(spark, rows), KEY).collect()}
    for i, (_, gone, stays) in enumerate(PRIVATE):
        words = re.findall(r"[\w']+", out[i])
        assert not set(gone.split()) & set(words) and set(stays.split()) <= set(words), out[i]


def test_a_crowded_pool_settles(spark):
    """More than half of all addresses of a private network, and secrets of one format."""
    rows = [(i, f"from 192.168.{i // 256}.{i % 256} with password: a{i % 10}b{i // 10 % 10}c{i // 100 % 10}") for i in range(40_000)]
    out = surrogates.surrogates(documents(spark, rows), KEY).collect()
    made = [[s.stand_in for s in r._spans if s.kind == "ipv4"][0] for r in out]
    assert len(out) == 40_000 == len(set(made))


def test_formats_with_hardly_a_free_value_settle(spark):
    """All numbers of a format, an address that is the only one of its format, all 15 of another, secrets without letters or digits."""
    rows = [(i, f"call +4 9 {i // 100:02d} {i % 100:02d}") for i in range(10_000)]
    rows += [(20_000 + i, f"from 0000::{i:x}") for i in range(16)] + [(20_016, "from 00:00:00:00:00:00:00:00")]
    rows += [(30_000 + i, 'password: "' + "*" * i + '"') for i in range(6, 26)]
    rows += [(40_000 + i, f'password: "{i}-----"') for i in range(10)]
    out = {r.doc_id: r for r in surrogates.surrogates(documents(spark, rows), KEY).collect()}
    made = {i: r._spans[0].stand_in for i, r in out.items() if len(r._spans) == 1}
    assert len(made) == len(rows)
    numbers = [made[i] for i in range(10_000)]
    assert len(set(numbers)) == 10_000 and all(re.fullmatch(r"\+4 9 \d\d \d\d", m) for m in numbers)
    assert made[20_000] == "0000::0" and made[20_016] == "00:00:00:00:00:00:00:00"
    assert {made[20_000 + i].lower() for i in range(1, 16)} == {f"0000::{i:x}" for i in range(1, 16)}
    masks = [made[30_000 + i] for i in range(6, 26)]
    assert len(set(masks)) == 20 and not any(set(m) == {"*"} for m in masks) and not any(map(str.isalnum, "".join(masks)))
    short = [made[40_000 + i] for i in range(10)]
    assert len(set(short)) == 10 and not set(short) & {f"{i}-----" for i in range(10)}


def test_closed_formats_keep_values_apart():
    ipv6 = lambda text: entities.IPv6Address(text).packed.hex(":", 2)
    formats = [("phone", [f"1{i:05d}" for i in range(100_000)][::7]), ("ipv6", [ipv6(f"{i:x}::1") for i in range(256, 4096)])]
    formats += [("ssn", [f"{i:09d}" for i in range(0, 10**9, 10**5)]), ("ipv4", [f"{i % 10}.{i // 10}.2.3" for i in range(2000)])]
    for kind, values in formats:
        made = [stand_in(kind, v, KEY, entities.CLOSED) for v in values]
        assert len(set(made)) == len(values) and all(a != b for a, b in zip(made, values))
        assert {entities.pool(kind, m) for m in made} == {entities.pool(kind, values[0])}


def test_odd_letters_and_notations_stop_nothing():
    assert found("Mr. \u03a2. Smith") == [] and found("Mr. Σ. Smith") == [("initial", "Σ"), ("surname", "Smith")]
    for text in ("0000:0:0:0:0:ffff:102:304", "0000::ffff:102:304"):
        new, _ = surrogates._replaced(text, KEY, {})
        assert [m.kind for m in mentions(new)] == ["ipv6"] and len(new) == len(text) and new != text


def test_a_cluster_without_a_key_makes_one(spark, sf_dir):
    """The query gives a whole result there, with stand-ins that the key for trials does not give, and the same again in one run."""
    trial = {r.doc_id: r.text for r in queries.op2_surrogates(spark, sf_dir).collect()}
    master = spark.conf.get("spark.master")
    spark.conf.set("spark.master", "spark://elsewhere:7077")
    try:
        own = {r.doc_id: r.text for r in queries.op2_surrogates(spark, sf_dir).collect()}
        again = {r.doc_id: r.text for r in queries.op2_surrogates(spark, sf_dir).collect()}
    finally:
        spark.conf.set("spark.master", master)
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert own == again and own.keys() == trial.keys() == given.keys()
    private = [i for i, text in given.items() if mentions(text or "")]
    assert private and all(own[i] != given[i] and own[i] != trial[i] for i in private)


def test_a_cluster_needs_a_key_of_its_own(spark):
    class Conf:
        def __init__(self, **own):
            self.own = own

        def get(self, name, default=None):
            return self.own.get(name, default)

    class Session:
        conf = Conf(**{"spark.master": "yarn"})

    with pytest.raises(ValueError):
        queries.surrogate_key(Session)
    Session.conf = Conf(**{"spark.master": "yarn", "newstide.surrogate.key": "own"})
    assert queries.surrogate_key(Session) == b"own"
    assert queries.surrogate_key(spark)


def test_no_pattern_takes_quadratic_time():
    start = time.perf_counter()
    for piece in ["a", "a-", "a@", "1", "1.", "A ", "+1 ", "token=", "ab12", "AB12 ", "12-", "1234 ", "1:", "Aa ", "'", "a.b@c.", "(123) "]:
        mentions(piece * (200_000 // len(piece)))
    assert time.perf_counter() - start < 20


def test_tables(spark):
    rows = [
        *ROWS,
        (20, "Call Mr. John Smith, +1 (974) 555-3436, mail js@firm.com."),
        (21, "Smith's number is 974-555-3436; JS@FIRM.COM or js@firm.com. Mrs. Smith called."),
        (22, LONG + " mail js@firm.com " + LONG),
        (None, "js@firm.com"),
    ]
    docs = documents(spark, rows)
    out = surrogates.surrogates(docs, KEY)
    assert out.columns == [*docs.columns, "_spans"]
    result = out.collect()
    by_id = {r.doc_id: r for r in result if r.doc_id and r.doc_id >= 20}
    assert sorted((r.doc_id or 0, r.text or "") for r in result if not r._spans) == sorted((i or 0, t or "") for i, t in ROWS)
    assert sum(r.text is None for r in result) == 2 and all((r._spans is None) == (r.text is None) for r in result)
    spans = {i: [(s.kind, s.stand_in) for s in r._spans] for i, r in by_id.items()}
    email, phone, surname = dict(spans[20])["email"], dict(spans[20])["phone"], dict(spans[20])["surname"]
    first, *others = spans[21]
    assert first == ("surname", surname)
    assert others == [("phone", f"{phone[4:7]}-{phone[9:]}"), ("email", email.upper()), ("email", email), ("surname", surname)]
    assert spans[22] == [("email", email)] and len(by_id[22].text) == len(rows[-2][1]) - 11 + len(email)
    for r in result:
        assert all(r.text[s.start : s.end] == s.stand_in for s in r._spans or ())
        assert not re.search("firm|555-3436|Mr. John Smith", r.text or "")
    assert surrogates.surrogates(empty(spark), KEY).collect() == []


def test_clashes_are_resolved_over_the_whole_table(spark):
    """Thousands of surnames in a space where first stand-ins do clash, and some that occur themselves."""
    draw = random.Random(6)
    names = {"".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(3)) for _ in range(1500)}
    names = sorted(names | {stand_in("surname", n, KEY) for n in sorted(names)[:40]})
    assert len({stand_in("surname", n, KEY) for n in names}) < len(names)
    rows = [(i, f"Then Mr. {n.capitalize()} spoke to Mrs. {names[i - 1].capitalize()} again.") for i, n in enumerate(names)]
    found = {r.doc_id: [s.stand_in for s in r._spans] for r in surrogates.surrogates(documents(spark, rows), KEY).collect()}
    made = [found[i][0] for i in range(len(names))]
    assert len(set(made)) == len(names) and not {m.lower() for m in made} & set(names)
    assert all(found[i][1] == made[i - 1] for i in range(len(names)))


def test_query_leaves_nothing_and_touches_nothing_else(spark, sf_dir):
    rows = queries.op2_surrogates(spark, sf_dir.replace("0.001", "0.01")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").collect()}
    entity, made = {}, {}
    for r in rows:
        named = mentions(texts[r.doc_id])
        assert len(named) == r.n_entities == len(r.entities) and (named or r.text == texts[r.doc_id])
        between, at, rest, place = [], 0, [], 0
        for m, s in zip(named, r.entities):
            between.append(texts[r.doc_id][at : m.start])
            rest.append(r.text[place : s.start])
            at, place = m.end, s.end
            assert m.normal not in r.text.lower()
            entity.setdefault((m.kind, m.normal), set()).add(s.stand_in.lower())
            made.setdefault(s.stand_in.lower(), set()).add(m.normal)
        assert [*between, texts[r.doc_id][at:]] == [*rest, r.text[place:]]
    assert all(len(v) == 1 for v in [*entity.values(), *made.values()]) and len(entity) > 50
