"""Strict spans against the plain expressions; what weak supervision adds."""

import hashlib
import random
import re

import numpy as np

from basketflow.llm import pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    only = lambda x: re.sub("[^0-9]", "", x)
    found = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in re.finditer(CARD, text) if 13 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    return found + [("phone", m.start(), m.end()) for m in re.finditer(PHONE, text) if 9 <= len(only(m[0])) <= 15]


PARTS = ["a@b.c", "@", ".", "x_y@z-.q", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "5", " ", "-", "+1 (555) 010-9999", "+", "(", "é", "🎉", "\n", "_", "12345678901234567890", "+49", "tel ", "b.c_d@e.f"]


def test_strict_spans_equal_the_plain_expressions(documents, odd_texts):
    rng = random.Random(4)
    rows = [*odd_texts, *((100 + i, "".join(rng.choices(PARTS, k=rng.randrange(1, 14)))) for i in range(1500))]
    got = {}
    for r in pii.digests(pii.find(documents(rows))).collect():
        got.setdefault(r["doc_id"], r)
    for i, text in rows:
        wanted = plain_spans(text or "")
        joined = ",".join(":".join(map(str, s)) for s in wanted)
        counts = [sum(s[0] == k for s in wanted) for k in pii.BASE]
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (text, joined, got[i]["spans"])
        assert [got[i][f"n_{k}"] for k in pii.BASE] == counts
        assert set(filter(None, joined.split(","))) <= set(got[i]["spans"].split(","))


def test_adds_what_several_labelers_support(documents):
    rows = [(i, f"please mail to user{i}@mail.example.com or call +1 (555) 010-99{i:02d} soon") for i in range(60)]
    rows += [(100, "phone: (555) 010-4477 thanks"), (101, "see order 555-010-4477 there"), (102, "plain text of words only")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(documents(rows)).collect()}
    assert [(s["kind"], s["begin"], s["base"]) for s in found[100]] == [("local", 7, False)]
    assert found[101] == [] and found[102] == []


def test_reliability_is_learned():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.5
    right = np.array([0.95, 0.9, 0.8, 0.6, 0.9, 0.7])
    votes = np.where(rng.random((4000, 6)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((4000, 6)) < 0.2] = -1
    found, rates = pii._maximised(np.zeros(4000, dtype=int), votes, np.ones(4000), 40)
    assert ((found > 0.5) == truth).mean() > 0.95
    assert rates["v_format"][1][0] > rates["v_context"][1][0] and rates["v_format"][1][1] < rates["v_context"][1][1]


def test_long_runs_take_linear_time(documents):
    rows = [(1, "a" * 100_000 + " b@c"), (2, "a@" + "b." * 40_000 + "c"), (3, "1 " * 50_000), (4, "+1" + "(" * 50_000), (5, "1." * 40_000)]
    got = {r["doc_id"]: r for r in pii.digests(pii.find(documents(rows))).collect()}
    assert got[2]["n_email"] == 1 and got[5]["n_ip"] == len(plain_spans("1." * 40_000))


def test_main_path_has_no_python(documents):
    plan = pii.candidates(documents([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)


def test_empty_table(documents):
    assert pii.digests(pii.find(documents([]))).count() == 0
