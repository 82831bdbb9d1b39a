"""Personal data by weak supervision, in DataFrame functions only.

Regular expressions propose candidate spans. Labelers vote yes, no or nothing on each: the strict format, its
plausibility, a gazetteer, words before it that speak for or against it, and what touches its ends. Candidates are
counted by kind and votes, a table whose size does not depend on the data; from it expectation-maximisation
estimates how reliable each labeler is, and a logistic classifier of spans is trained on the resulting
probabilities. Spans in the strict format always stay; the classifier adds others that it is sure of.

All repetitions in the patterns are possessive or of single characters, so matching takes linear time and no
recursion, and an expression starts only where a match could.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import id_and_text
from basketflow.shared import as_table

# The base patterns, written so that they match the same spans without backtracking.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further candidates: telephone numbers without a plus, spelled-out addresses, people after a title.
LOCAL = r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9.-]?[0-9])"
SPELLED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z]{2,}+"
PERSON = r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?+"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local", "spelled", "person")
VOTES = ("v_format", "v_plausible", "v_gazetteer", "v_context", "v_against", "v_ends")
#: Candidates outside the strict formats need this probability, two votes for them and none against.
SURE = 0.9

# Gazetteers and context words.
DOMAINS = r"\.(com|net|org|edu|gov|info|io|co|eu|de|fr|es|it|uk|us|ch|at|nl|example|test)$"
CALLING_CODES = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
GIVEN_NAMES = r"\b(Anna|Maria|John|James|Mary|Robert|Linda|Peter|Paul|Hans|Claudia|Pierre|Marie|Jean|Juan|Carmen|Jose|Luis|Sophie|Thomas)\b"
FOR = {
    "email": r"(?i)\b(e-?mail|mail|contact|kontakt|correo|courriel|write|from|to)\b[^\p{L}]*$",
    "ip": r"(?i)\b(ip|host|server|address|adresse|login|from)\b[^\p{L}]*$",
    "card": r"(?i)\b(card|visa|mastercard|amex|karte|carte|tarjeta|credit|payment)\b[^\p{L}]*$",
    "phone": r"(?i)\b(tel|phone|call|fax|mobile|telefon|handy|móvil)\b[^\p{L}]*$",
    "person": r"(?i)\b(by|from|dear|von|par|por|signed)\b[^\p{L}]*$",
}
AGAINST = r"(?i)(\bversion|\bv|\bchapter|\bsection|\bisbn|\bissn|\border|\binvoice|\bno|\bpage|[#$€/=])[\x20.:]*$"


@dataclass(frozen=True)
class _Kind:
    name: str
    pattern: str
    guard: str  # only texts with this are searched


_CANDIDATES = (
    _Kind("email", EMAIL, "contains(text, '@')"),
    _Kind("ip", IP, "text rlike '[0-9][.][0-9]'"),
    _Kind("card", CARD, "text rlike '[0-9]'"),
    _Kind("phone", PHONE, "contains(text, '+')"),
    _Kind("local", LOCAL, "text rlike '[0-9]{4}'"),
    _Kind("spelled", SPELLED, "contains(text, '(at)') or contains(text, '[at]')"),
    _Kind("person", PERSON, "text rlike '(Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)[. ]'"),
)

_MATCH = "struct<begin:int,text:string,before:string,after:string>"


def _located(matches: Column, pieces: Column) -> Column:
    """Begin, text, and up to 40 characters before and one after each match, from the pieces between matches."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_MATCH}>").alias("out"))

    def add(state: Column, i: Column) -> Column:
        match, before = F.element_at(matches, i), F.element_at(pieces, i)
        begin = state["at"] + F.length(before)
        span = F.struct(
            begin.alias("begin"), match.alias("text"), F.right(before, F.lit(40)).alias("before"), F.left(F.element_at(pieces, i + 1), F.lit(1)).alias("after")
        )
        return F.struct((begin + F.length(match)).alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    found = F.aggregate(F.sequence(F.lit(1), F.size(matches)), start, add, lambda state: state["out"])
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(f"array<{_MATCH}>"))


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((n - i) % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _small_parts(ip: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(ip, r"\."), small)


def _vote(yes: Column, no: Column) -> Column:
    """1, 0, or -1 for no opinion."""
    return F.when(yes, F.lit(1)).when(no, F.lit(0)).otherwise(F.lit(-1))


def _labelled(kind: str, match: Column) -> Column:
    """The candidate with what the labelers say."""
    text = match["text"]
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    never = F.lit(False)
    same = digits.rlike(r"^(.)\1*$")
    strict = {
        "email": F.lit(True),
        "ip": _small_parts(text),
        "card": n.between(13, 19) & _luhn(digits),
        "phone": n.between(9, 15),
    }.get(kind, never)
    plausible = {
        "email": _vote(text.rlike(r"\.[A-Za-z]{2,}$"), text.rlike(r"\.[0-9-]*$")),
        "ip": _vote(~text.rlike(r"^0|\.0[0-9]"), text.rlike(r"^0\.|\.0[0-9]")),
        "card": _vote(n.between(15, 16) & ~same, same | ~n.between(13, 19)),
        "phone": _vote(n.between(10, 13) & ~same, same | ~n.between(9, 15)),
        "local": _vote(n.between(10, 11) & ~same, same | ~n.between(9, 12)),
        "spelled": _vote(text.rlike(r"(?i)[\[(]dot[\])]"), never),
        "person": _vote(text.rlike(r"\x20\p{Lu}\p{Ll}+\x20"), never),
    }[kind]
    listed = {
        "email": text.rlike(DOMAINS),
        "card": digits.rlike(ISSUERS),
        "phone": text.rlike(CALLING_CODES),
        "spelled": text.rlike(DOMAINS),
        "person": text.rlike(GIVEN_NAMES),
    }.get(kind, never)
    context = match["before"].rlike(FOR[{"local": "phone", "spelled": "email"}.get(kind, kind)])
    touched = match["before"].rlike(r"[\p{L}\p{N}]$") | match["after"].rlike(r"^[\p{L}\p{N}]")
    return F.struct(
        F.lit(kind).alias("kind"),
        match["begin"].alias("begin"),
        (match["begin"] + F.length(text)).alias("end"),
        strict.alias("base"),
        _vote(strict, F.lit(kind in BASE)).alias("v_format"),
        plausible.alias("v_plausible"),
        _vote(listed, never).alias("v_gazetteer"),
        _vote(context, never).alias("v_context"),
        _vote(never, match["before"].rlike(AGAINST)).alias("v_against"),
        _vote(~touched, touched).alias("v_ends"),
    )


def _worth_it(kind: str, match: Column) -> Column:
    """Digit runs are candidates for cards only from 12 to 20 digits; this keeps the table small and no span out."""
    if kind != "card":
        return F.lit(True)
    return F.length(F.regexp_replace(match["text"], "[^0-9]", "")).between(12, 20)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and all candidate spans with votes, of every row; one pass, no shuffle."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    empty = F.array().cast("array<string>")
    found = rows.select(
        "doc_id",
        *(
            F.when(F.expr(k.guard), cut).otherwise(empty).alias(f"{name}_{k.name}")
            for k in _CANDIDATES
            for name, cut in (("m", F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))), ("p", F.split("text", k.pattern, -1)))
        ),
    )
    located = found.select("doc_id", *(_located(F.col(f"m_{k.name}"), F.col(f"p_{k.name}")).alias(k.name) for k in _CANDIDATES))
    return located.select("doc_id", F.concat(*(_all_labelled(k.name) for k in _CANDIDATES)).alias("spans"))


def _all_labelled(kind: str) -> Column:
    worthy = F.filter(F.col(kind), lambda match: _worth_it(kind, match))
    return F.transform(worthy, lambda match: _labelled(kind, match))


@dataclass
class SpanModel:
    """Reliability of labelers and the span classifier that was trained on what they imply."""

    reliability: dict[str, dict[int, tuple[float, float]]]
    bias: dict[str, float]
    weights: dict[str, dict[int, float]]

    def probability(self, span: Column) -> Column:
        total = F.lit(0.0)
        for kind, x in self.bias.items():
            total = total + F.when(span["kind"] == kind, F.lit(x)).otherwise(F.lit(0.0))
        for vote, by in self.weights.items():
            for value, x in by.items():
                total = total + F.when(span[vote] == value, F.lit(x)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(found: DataFrame, rounds: int = 40) -> SpanModel:
    """Estimate on the counts of all candidates by kind and votes: at most kinds x 3^labelers rows come back."""
    counts = found.select(F.explode("spans").alias("s")).groupBy("s.kind", *(f"s.{v}" for v in VOTES)).count().collect()
    kinds = np.array([KINDS.index(r["kind"]) for r in counts], dtype=int)
    votes = np.array([[r[v] for v in VOTES] for r in counts], dtype=int).reshape(-1, len(VOTES))
    weight = np.array([r["count"] for r in counts], dtype=float)
    truth = _maximised(kinds, votes, weight, rounds)
    x = np.concatenate([np.eye(len(KINDS))[kinds], *((votes == value).astype(float) for value in (1, 0))], axis=1)
    theta = np.zeros(x.shape[1])
    scale = max(weight.sum(), 1.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (truth[0] - p)) / scale - 1e-3 * theta
        curve = (x * (weight * p * (1 - p) / scale)[:, None]).T @ x + 1e-3 * np.eye(len(theta))
        theta += np.linalg.solve(curve, slope)
    k, n = len(KINDS), len(VOTES)
    return SpanModel(
        truth[1],
        {kind: float(theta[i]) for i, kind in enumerate(KINDS)},
        {v: {1: float(theta[k + i]), 0: float(theta[k + n + i])} for i, v in enumerate(VOTES)},
    )


def _maximised(kinds: np.ndarray, votes: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, dict]:
    """Expectation-maximisation over a hidden truth of each candidate: its probability, and each labeler's rates.

    It begins with the share of votes in favour, and counts a few imaginary candidates on which labelers are mostly
    right, so that labelers that seldom or never vote keep a sensible rate.
    """
    yes, no = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
    truth = (yes + 0.5) / (yes + no + 1)
    rates: dict[str, dict[int, tuple[float, float]]] = {}
    for _ in range(rounds):
        logs = np.zeros(len(weight))
        for k in range(len(KINDS)):
            own = kinds == k
            share = (float((weight * truth)[own].sum()) + 2) / (float(weight[own].sum()) + 4)
            logs[own] = np.log(share / (1 - share))
        for j, name in enumerate(VOTES):
            rates[name] = {}
            for value, right, wrong in ((1, 8.0, 2.0), (0, 2.0, 8.0), (-1, 10.0, 10.0)):
                has = votes[:, j] == value
                if_true = (float((weight * truth)[has].sum()) + right) / (float((weight * truth).sum()) + 20)
                if_false = (float((weight * (1 - truth))[has].sum()) + wrong) / (float((weight * (1 - truth)).sum()) + 20)
                rates[name][value] = (if_true, if_false)
                if value >= 0:
                    logs[has] += np.log(if_true / if_false)
        truth = 1 / (1 + np.exp(-np.clip(logs, -30, 30)))
    return truth, rates


def find(docs: DataFrame, sure: float = SURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, begin, end in characters, base, probability) of every row, by kind and begin.

    Null texts count as empty and have no spans. Rows that repeat give repeated results; a null id stays null.
    A span that the classifier adds has at least two votes for it, none against, and touches no span of a strict format.
    """
    found = as_table(candidates(docs, id_col, text_col), "candidates")
    model = fit(found)
    scored = F.transform(
        "spans",
        lambda s: F.struct(
            s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["base"].alias("base"),
            model.probability(s).alias("probability"), *(sum((F.when(s[v] == value, 1).otherwise(0) for v in VOTES), F.lit(0)).alias(name) for name, value in (("votes_for", 1), ("votes_against", 0))),
        ),
    )
    base = F.filter("scored", lambda s: s["base"])
    added = F.filter(
        "scored",
        lambda s: ~s["base"] & (s["probability"] >= sure) & (s["votes_for"] >= 2) & (s["votes_against"] == 0) & ~F.exists("strict", lambda b: (b["begin"] < s["end"]) & (s["begin"] < b["end"])),
    )
    rows = found.withColumn("scored", scored).withColumn("strict", base).withColumn("more", added)
    order = F.create_map(*(F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)))
    sorted_spans = F.array_sort(
        F.transform(F.concat("strict", "more"), lambda s: F.struct(order[s["kind"]].alias("o"), s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"), s["probability"].alias("probability")))
    )
    return rows.select("doc_id", F.transform(sorted_spans, lambda s: s.dropFields("o")).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts of strict spans by kind, and the joined spans."""
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
    strict = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(joined(strict).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
