import hashlib
import random
import re
import time

import pytest

from riskspark.llm.personal_data import KINDS, find_spans, identifiers, luhn, mask, personal_data

DDL = "doc_id long, text string, spans string, n_ip string"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute(text):
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15],
    }


def test_base_spans_match_plain_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        t = "".join(rng.choice("aZ09.@-+ ()1234567890._%é\n٣") for _ in range(rng.randint(0, 45)))
        assert identifiers(t) == brute(t), repr(t)


# (text, kind, what the added span covers)
DISGUISED = [
    ("mail bob [at] example (dot) com now", "email", "bob [at] example (dot) com"),
    ("bob at example dot com", "email", "bob at example dot com"),
    ("to Bob AT mail.example DOT com.", "email", "Bob AT mail.example DOT com"),
    ("bob＠example．com", "email", "bob＠example．com"),
    ("раul@ехample.com", "email", "раul@ехample.com"),
    ("jo​e@example.com", "email", "jo​e@example.com"),
    ("write ana [arroba] example [punto] es", "email", "ana [arroba] example [punto] es"),
    ("call plus four nine one five five five one two three four five", "phone",
     "plus four nine one five five five one two three four five"),
    ("+４９ 1555 123456", "phone", "+４９ 1555 123456"),
    ("four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one"),
    ("4111 1111 1111 １１１１", "card", "4111 1111 1111 １１１１"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("mail user[@]host[.]com or", "email", "user[@]host[.]com"),
    ("user (@) mail{.}host <.> org", "email", "user (@) mail{.}host <.> org"),
    ("up 192[.]168[.]0[.]1 down", "ip", "192[.]168[.]0[.]1"),
    ("ip 10(.)0 (dot) 0 [.] 7", "ip", "10(.)0 (dot) 0 [.] 7"),
    ("write john_at_example_dot_com now", "email", "john_at_example_dot_com"),
    ("j.doe-at-mail-dot-example-dot-com", "email", "j.doe-at-mail-dot-example-dot-com"),
    ("host 10 dot 0 dot 0 dot 7 up", "ip", "10 dot 0 dot 0 dot 7"),
]


@pytest.mark.parametrize(("text", "kind", "span"), DISGUISED)
def test_disguises_map_back_to_the_source(text, kind, span):
    for prefix in ("", "É ß İ ", "x " * 50):
        base, added = find_spans(prefix + text)
        assert base == brute(prefix + text)
        assert [(prefix + text)[a:b] for a, b in added[kind]] == [span]


@pytest.mark.parametrize("text", [
    "look at example.com", "1 dot 2", "one two three four five six seven eight nine", "meet at noon, dot the i",
    "E. é ö ﬁ m² ½", "un dos tres", "he was at the dot com party", "null acht neun", "a (at) b", "f(.) and g[.]x", "a[@] b", "look_at_me", "meet-at-noon", "_at_x_dot_y", "a_at_b-dot-c", "a_at_b_dot_c_d", "Версия 1.2.3",
])
def test_clean_text_gains_nothing(text):
    assert not any(find_spans(text)[1].values())


@pytest.mark.parametrize("text", ["a+" * 50_000, "1" * 100_000, "1." * 50_000, "@" * 50_000, "a@" * 50_000, "+1" * 50_000,
                                  "one " * 20_000, "x dot " * 20_000, "​" * 50_000, "[at" * 30_000, "a_at_" * 30_000,
                                  "a_at_b" + "_dot_b" * 20_000 + "_", "a-at-b" * 20_000, "[.]" * 40_000, " " * 100_000 + "(at", "a (at)" + "\t" * 100_000, "a" * 100_000 + " at b"])
def test_long_runs_stay_fast(text):
    start = time.process_time()
    find_spans(text)
    assert time.process_time() - start < 10


def test_report_and_mask(spark):
    rows = [(1, "a@b.co and x [at] y [dot] org"), (2, None), (3, ""), (None, "+1 555 123 4567"), (1, "a@b.co and x [at] y [dot] org")]
    df = spark.createDataFrame([(i, t, "s", "n") for i, t in rows], DDL)
    got = {(r.doc_id, r.spans): r for r in personal_data(df).collect()}
    r = got[(1, "email:0:6,email:11:29")]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_added) == (1, 0, 0, 0, 1)
    assert r.base_sha256 == hashlib.sha256(b"email:0:6").hexdigest()
    assert got[(2, "")].base_sha256 == got[(3, "")].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[(None, "phone:0:15")].n_phone == 1
    assert personal_data(df).count() == 5
    masked = {r.doc_id: r.text for r in mask(df).collect()}
    assert masked == {1: "<email> and <email>", 2: "", 3: "", None: "<phone>"}
    assert personal_data(spark.createDataFrame([], DDL)).count() == 0
    assert KINDS == ("email", "ip", "card", "phone")
