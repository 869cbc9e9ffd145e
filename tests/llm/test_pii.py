import hashlib
import random
import re
import time

import pytest

from riskframe.llm import pii as P


def brute_base(text):
    """The four patterns by plain matching, with their checks."""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())]
        total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted((m.start(), P.KINDS.index(k), m.end()) for k, m in out)


def test_base_spans_are_the_patterns():
    rng = random.Random(0)
    found = 0
    for alphabet, n in (("a.@-1 é", 40000), ("12. -+()", 40000), ("0123456789.- ", 20000), ("+0123456789 ()-", 20000)):
        for _ in range(n // 20):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60)))
            want = brute_base(text)
            found += len(want)
            assert P.base_spans(text) == want, text
    assert found > 500
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


PLANTED = [     # text before, disguised identifier, kind
    ("mail ", "john.doe [at] example [dot] com", "email"), ("mail ", "john.doe(at)example(dot)com", "email"), ("", "jane_roe {at} mail.example.org", "email"),
    ("write to ", "john dot doe at mail dot example dot com", "email"), ("write ", "ab.12 at example.com", "email"), ("bei ", "max punkt muster at beispiel punkt de", "email"),
    ("a ", "ana arroba correo punto es", "email"), ("a ", "jоhn@exаmple.com", "email"), ("a ", "user＠mail．example．com", "email"), ("a ", "us​er@mail.example.com", "email"),
    ("call ", "plus one two one two five five five seven seven one three", "phone"), ("call ", "+1 (212) 555-7713", "phone"),
    ("call ", "＋１ (２１２) ５５５-７７１３", "phone"), ("call ", "plus four four double five six one two three four triple nine", "phone"),
    ("card ", "four one" + " one" * 14, "card"), ("card ", "４１１１ １１１１ １１１１ １１１１", "card"), ("card ", "4111–1111–1111–1111", "card"), ("card ", "cuatro uno" + ", uno" * 14, "card"),
    ("host ", "192[.]168[.]1[.]17", "ip"), ("host ", "10 dot 0 dot 0 dot 7", "ip"), ("host ", "one nine two dot one six eight dot zero dot one", "ip"), ("host ", "１０．２０．３０．４０", "ip"),
]


@pytest.mark.parametrize("before,hidden,kind", PLANTED)
def test_disguises_are_found_at_their_place(before, hidden, kind):
    text = f"{before}{hidden}, thanks. Real: x.y@z.org"
    base = P.base_spans(text)
    got = P.all_spans(text, base)
    assert (len(before), P.KINDS.index(kind), len(before) + len(hidden)) in got
    assert set(base) <= set(got) and len(got) <= len(base) + 1


def test_plain_prose_has_no_spans():
    for text in ("meet me at noon. look at example.com", "dot at the end. one two or three of them", "uno dos tres", "почта и адрес", "(a) first (at) last", "five four plus",
                 "chapter 1.2.3 at 10 dot", "x at y", "versions 1 dot 2"):
        assert P.all_spans(text, P.base_spans(text)) == P.base_spans(text) == [], text


def test_a_base_span_stays_and_nothing_inside_it_is_added():
    text = "hidden jоhn.doe@mail.example.com and 10.0.0.1 dot x"
    base = P.base_spans(text)
    got = P.all_spans(text, base)
    assert set(base) < set(got) and [text[a:b] for a, k, b in sorted(set(got) - set(base))] == ["jоhn.doe@mail.example.com"]


def test_whole_texts_in_linear_time():
    start = time.time()
    n = 300_000
    for unit in ("a", "1", "1.", "1 ", "+1", "a@", "@a.", "(", "one ", "one two ", "a at ", "a dot ", "dot ", "а", "1 dot "):
        text = unit * (n // len(unit))
        P.all_spans(text, P.base_spans(text))
    assert time.time() - start < 60
    text = "word " * 200_000 + "me.too [at] site [dot] net"
    assert [text[a:b] for a, _, b in P.all_spans(text, P.base_spans(text))] == ["me.too [at] site [dot] net"]


def test_query_rows(make_docs):
    rows = [None, "", "mail a@b.cd or 1.2.3.4", "see bob [at] site [dot] net and a@b.cd", "long " * 3000 + "+1 (212) 555-7713", "a@b.cd"]
    docs = make_docs([*enumerate(rows), (5, "a@b.cd"), (None, "c@d.ef")]).selectExpr("*", "1 AS spans", "2 AS base", "3 AS n_email")
    found = {r.doc_id: r for r in P.digest_columns(P.find(docs)).collect()}
    assert sorted(found) == [0, 1, 2, 3, 4, 5]
    for i, t in enumerate(rows):
        base = brute_base(t or "")
        assert [found[i][f"n_{k}"] for k in P.KINDS] == [sum(s[1] == n for s in base) for n in range(4)]
        assert found[i].base_sha256 == hashlib.sha256(P.written(base).encode()).hexdigest()
        assert found[i].spans == P.written(P.all_spans(t or "", base))
    assert found[3].spans == "email:4:27,email:32:38" and (found[3].n_email, found[3].n_all_email) == (1, 2)
    assert P.digest_columns(P.find(docs)).count() == 7
    assert P.find(docs.where("false")).count() == 0
    values = {r.doc_id: r["values"] for r in P.find(docs).collect()}
    assert values[3] == ["bob [at] site [dot] net", "a@b.cd"]
