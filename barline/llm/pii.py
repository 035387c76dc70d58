"""Personal data by weak supervision (DataFrame functions only).

Base kinds are found by their patterns and checks, leftmost and non-overlapping per
kind; they always stay.  Beside them, looser patterns give candidate spans: obfuscated
addresses, telephone numbers without a country sign, card-like numbers and secrets.
Three sorts of labelers vote on every candidate, 1 for, -1 against, 0 no opinion:

* regex: a stricter pattern or check digit of the kind, and a pattern of look-alikes;
* gazetteer: known mail hosts, country and area codes, issuer prefixes, key names;
* context: words near the span that go with the kind, or against it.

Votes are counted by pattern over all documents (one aggregation; the number of
patterns is bounded by 3^labelers per kind).  Expectation-maximisation estimates the
labelers' reliabilities on these counts, and a logistic span classifier is fitted to the
posteriors.  Its linear form is a column expression; candidates that reach
``threshold`` and touch no base span are added.

Defined cases: null and empty texts hold nothing; repeated rows give repeated results;
a null id stays null; extra columns are ignored; without candidates nothing is added.
Spans are code points, end exclusive.  Texts are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import last_before, lower_ascii, sums_before, text_rows

# Fixed values of the base kinds.  Possessive forms: nothing after them could match by giving back.
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

SPAN = "struct<start:int,ord:int,kind:string,end:int>"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, gate: str, keep: str, build: str) -> str:
    """SQL for every match of ``pattern`` in column ``text`` where ``gate`` holds:
    matches ``x`` with ``s`` (start) and ``e`` (end) for which ``keep`` holds, as ``build``."""
    p = _text(pattern)
    return f"""
    CASE WHEN {gate} THEN
      transform(filter(
        flatten(transform(
          array(zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1), (m, g) -> named_struct('m', m, 'g', g))),
          z -> flatten(transform(array(transform(z, x -> length(x.g) + coalesce(length(x.m), 0))), t -> flatten(transform(array({sums_before('t')}), s ->
            transform(z, (x, i) -> named_struct('m', x.m, 's', s[i] + length(x.g), 'e', s[i] + length(x.g) + length(x.m))))))))),
        x -> x.m IS NOT NULL AND {keep}), x -> {build})
    END"""


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """Whether a digit string passes Luhn: from the right, every second digit doubled."""
    d = f"CAST(substr({digits}, -i, 1) AS bigint)"
    return (f"aggregate(sequence(1, length({digits})), 0L, (t, i) -> t + "
            f"CASE WHEN i % 2 = 1 THEN {d} ELSE (2L * {d}) DIV 10L + (2L * {d}) % 10L END) % 10L = 0")


def _span(kind: str) -> str:
    return f"named_struct('start', x.s, 'ord', {BASE_KINDS.index(kind)}, 'kind', '{kind}', 'end', x.e)"


def base_spans() -> dict[str, str]:
    card = _digits("x.m")
    return {
        "email": matches("text", EMAIL, "contains(text, '@')", "true", _span("email")),
        "ip": matches("text", IP, "text RLIKE '[0-9][.][0-9]+[.][0-9]'",
                      f"x.m RLIKE {_text(f'^{_BYTE}(?:[.]{_BYTE}){{3}}$')}", _span("ip")),
        "card": matches("text", CARD, "text RLIKE '[0-9](?:[ -]?[0-9]){13}'",
                        f"length({card}) BETWEEN 14 AND 19 AND CASE WHEN length({card}) BETWEEN 14 AND 19 THEN {luhn(card)} END",
                        _span("card")),
        "phone": matches("text", PHONE, "contains(text, '+')", f"length({_digits('x.m')}) BETWEEN 10 AND 15", _span("phone")),
    }


@dataclass(frozen=True)
class Candidate:
    """A looser kind: pattern over the text, and its labelers: a condition on the span
    ``x.m`` (``strict``), regular expressions over the span (``lookalike``, ``listed``) and
    over the lower-cased surroundings (``near``, ``against``).  A vote is 1 or -1 where it
    holds.  The part of ``kind`` before the dot names the added spans."""

    kind: str
    ord: int
    pattern: str
    gate: str
    strict: str
    lookalike: str
    listed: str
    near: str
    against: str
    strict_fails: int = 0  # the vote where ``strict`` does not hold


# Gazetteers (fixed values).
MAIL_HOSTS = "gmail|googlemail|yahoo|hotmail|outlook|live|icloud|aol|gmx|web|proton|protonmail|mail|yandex|example"
CALL_CODES = "2[0-9]|3[0-9]|4[0-9]|5[0-9]|6[0-9]|7[2-9]|8[0-689]|9[0-9]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|62"
_TLD = r"(?:dot|\.)[\])]?\x20?(?:com|org|net|edu|de|fr|es|uk|io)$"
KEY_NAMES = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|AKIA"

CANDIDATES = (
    Candidate("email.text", 0, r"[A-Za-z0-9._%+-]{2,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{2,63}(?:\x20?(?:[\[(]\x20?dot\x20?[\])]|\.)\x20?[A-Za-z]{2,20})++",
              "text RLIKE '[\\\\[(] ?at ?[\\\\])]'", rf"x.m RLIKE {_text(_TLD)}",
              r"[\[(]at[\])]\x20(?:the|a|an|our|this)\b", rf"(?i)\b(?:{MAIL_HOSTS})\b", r"mail|contact|write|reach|@", r"\bmeet|look"),
    Candidate("phone.local", 3, r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
              "text RLIKE '[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}'",
              rf"x.m RLIKE {_text('^[+]|^[(][0-9]{3}[)]|^[0-9]{3}-[0-9]{3}-[0-9]{4}$')}",
              r"^(?:000|666|[01][0-9]{2})", rf"^(?:\+|\(?(?:{CALL_CODES}))", r"phone|call|tel|fax|mobile|dial|contact",
              r"isbn|order|item|part|version|id "),
    Candidate("card.like", 2, r"(?<![0-9A-Za-z.+-])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}(?![0-9A-Za-z])",
              "text RLIKE '[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{2}'", luhn(_digits("x.m")),
              r"^(?:0000|1234|9999)|(?:19|20)[0-9]{2}[\x20-](?:19|20)[0-9]{2}", rf"^(?:{ISSUERS})",
              r"card|visa|credit|debit|payment|amex|cvv", r"isbn|serial|order|tracking|phone", -1),
    Candidate("secret", 4, r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?i:password|passwd|pwd|secret|token|api[_-]?key)\x20?[=:]\x20?\"?[^\s\"]{8,}+\"?",
              "text RLIKE '(?i)AKIA|password|passwd|pwd|secret|token|api[_-]?key'", rf"x.m RLIKE {_text('AKIA[0-9A-Z]{16}|[0-9a-f]{16,}')}",
              r"(?i)[=:]\x20?\"?(?:changeme|example|xxx+|your|placeholder|none|null|true|false)", rf"(?i)^(?:{KEY_NAMES})", r"login|auth|key|credential|config", r"forgot|reset|strong"),
)
#: Characters looked at on either side of a span.
CONTEXT_CHARS = 40
LABELERS = ("strict", "lookalike", "listed", "near", "against")


def candidate_spans(c: Candidate) -> str:
    """SQL for the candidates of one kind with their votes and length class."""
    around = (f"concat(substr(low, greatest(1, x.s + 1 - {CONTEXT_CHARS}), least(x.s, {CONTEXT_CHARS})), ' ', "
              f"substr(low, x.e + 1, {CONTEXT_CHARS}))")

    def vote(pattern: str, what: str, value: int) -> str:
        return f"CAST(IF({what} RLIKE {_text(pattern)}, {value}, 0) AS int)"

    build = (f"named_struct('start', x.s, 'ord', {c.ord}, 'kind', '{c.kind}', 'end', x.e, "
             f"'strict', CAST(IF({c.strict}, 1, {c.strict_fails}) AS int), 'lookalike', {vote(c.lookalike, 'x.m', -1)}, "
             f"'listed', {vote(c.listed, 'x.m', 1)}, 'near', {vote(c.near, around, 1)}, "
             f"'against', {vote(c.against, around, -1)})")
    return matches("text", c.pattern, c.gate, "true", build)


CANDIDATE = ("array<struct<start:int,ord:int,kind:string,end:int," + ",".join(f"{v}:int" for v in LABELERS) + ">>")


def with_candidates(docs: DataFrame, candidates: tuple[Candidate, ...] = CANDIDATES) -> DataFrame:
    """Adds ``text``-level columns: base spans per kind (``_email`` ...) and ``_cands``
    (candidates that touch no base span)."""
    df = docs.withColumn("low", lower_ascii(F.col("text")))
    df = df.withColumns({f"_{k}": F.expr(f"coalesce({sql}, CAST(array() AS array<{SPAN}>))") for k, sql in base_spans().items()})
    df = df.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in BASE_KINDS]))
    parts = ", ".join(f"coalesce({candidate_spans(c)}, CAST(array() AS {CANDIDATE}))" for c in candidates)
    df = df.withColumn("_all", F.expr(f"concat({parts})"))
    return df.withColumn("_cands", F.expr(
        # the base spans of a kind are disjoint and in order: only the last that starts before a candidate's end can touch it
        "filter(_all, c -> " + " AND ".join(f"NOT coalesce({last_before(f'_{k}', 'y.start < c.end')}.end > c.start, false)" for k in BASE_KINDS) + ")")
        ).drop("low", "_all")


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier per kind: bias and one weight per labeler."""

    weights: dict[str, list[float]] = field(default_factory=dict)
    reliabilities: dict[str, list[float]] = field(default_factory=dict)
    threshold: float = 0.5

    def keeps(self, c: str) -> str:
        """SQL condition on candidate struct ``c``."""
        cases = " ".join(f"WHEN '{k}' THEN {w[0]!r}D" + "".join(f" + {x!r}D * {c}.{v}" for v, x in zip(LABELERS, w[1:]))
                         for k, w in sorted(self.weights.items()))
        cut = math.log(self.threshold / (1 - self.threshold))
        return f"(CASE {c}.kind {cases} ELSE -1000.0D END) >= {cut!r}D" if cases else "false"


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 100) -> tuple[dict, list[float]]:
    """Posterior of each vote pattern, and each labeler's reliability (probability that
    a vote it casts is right).  A vote's chance given the class follows the labeler's
    reliability; silence says nothing.  Start: every labeler is right in 0.8 of its
    votes.  Two pseudo-votes keep reliabilities inside (0, 1), and they stay at 0.5 or
    above, so that the classes cannot change places."""
    n = len(next(iter(counts)))
    right, prior = [0.8] * n, 0.5
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes in counts:
            odds = math.log(prior / (1 - prior)) + sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right))
            post[votes] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        total = sum(counts.values())
        prior = min(0.95, max(0.05, (sum(p * counts[v] for v, p in post.items()) + 1) / (total + 2)))
        for k in range(n):
            cast = sum(c for v, c in counts.items() if v[k])
            ok = sum(c * (post[v] if v[k] > 0 else 1 - post[v]) for v, c in counts.items() if v[k])
            right[k] = min(0.99, max(0.5, (ok + 1.6) / (cast + 2)))
    return post, right


def logistic(post: dict[tuple[int, ...], float], counts: dict[tuple[int, ...], int], rounds: int = 300) -> list[float]:
    """Logistic regression of the posteriors on the votes, by gradient descent over the
    weighted patterns with a small ridge."""
    n = len(next(iter(counts)))
    w, total = [0.0] * (n + 1), sum(counts.values())
    for _ in range(rounds):
        grad = [1e-4 * x for x in w]
        for votes, c in counts.items():
            z = w[0] + sum(a * b for a, b in zip(w[1:], votes))
            g = c / total * (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - post[votes])
            grad[0] += g
            for k, v in enumerate(votes):
                grad[k + 1] += g * v
        w = [a - 2.0 * b for a, b in zip(w, grad)]
    return [round(x, 9) for x in w]


def fit_span_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                   candidates: tuple[Candidate, ...] = CANDIDATES) -> SpanModel:
    """Learns from the votes on all candidates of all documents.  Only the counts of the
    vote patterns come to the driver."""
    df = with_candidates(_rows(docs, id_col, text_col), candidates)
    rows = (df.select(F.explode("_cands").alias("c")).groupBy("c.kind", *[f"c.{v}" for v in LABELERS])
            .count().collect())
    by_kind: dict[str, dict[tuple[int, ...], int]] = {}
    for r in sorted(rows):
        by_kind.setdefault(r[0], {})[tuple(r[1:-1])] = r[-1]
    weights, right = {}, {}
    for kind, counts in by_kind.items():
        post, right[kind] = expectation_maximisation(counts)
        weights[kind] = logistic(post, counts)
    return SpanModel(weights, right, threshold)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return text_rows(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _listing(spans: str) -> Column:
    return F.expr(f"array_join(transform(array_sort({spans}), s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def _all_spans(model: SpanModel) -> Column:
    return F.expr(f"concat(_base, transform(filter(_cands, c -> {model.keeps('c')}), "
                  "c -> named_struct('start', c.start, 'ord', c.ord, 'kind', split_part(c.kind, '.', 1), 'end', c.end)))")


def find_pii(docs: DataFrame, model: SpanModel, *, id_col: str = "doc_id", text_col: str = "text",
             candidates: tuple[Candidate, ...] = CANDIDATES) -> DataFrame:
    """Per document: counts and digest of the base kinds, and all spans as text."""
    df = with_candidates(_rows(docs, id_col, text_col), candidates).withColumn("_spans", _all_spans(model))
    return df.select("doc_id", *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
                     F.sha2(_listing("_base").cast("binary"), 256).alias("base_sha256"), _listing("_spans").alias("spans"))


_MASK = """
aggregate(array_sort(_spans), named_struct('at', 0, 'out', CAST(array() AS array<string>)),
  (a, s) -> named_struct('at', greatest(a.at, s.end),
    'out', IF(s.start >= a.at, concat(a.out, array(substr({text}, a.at + 1, s.start - a.at), concat('<', upper(s.kind), '>'))), a.out)),
  a -> array_join(concat(a.out, array(substr({text}, a.at + 1))), ''))
"""


def mask_pii(docs: DataFrame, model: SpanModel, *, text_col: str = "text",
             candidates: tuple[Candidate, ...] = CANDIDATES) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping
    spans by the first one's kind.  All columns stay; a null text stays null."""
    names = docs.columns
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = with_candidates(df, candidates).withColumn("_spans", _all_spans(model))
    masked = F.when(F.col(f"_row.`{text_col}`").isNotNull(),
                    F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.expr(_MASK.format(text="text"))))
    return df.select(*[masked.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in names])
