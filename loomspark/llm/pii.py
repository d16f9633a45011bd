"""Personal data by weak supervision.

Fixed patterns give the base spans, which always stay.  Looser patterns propose further candidates.  Five labelers (the
strict form, a gazetteer, words that speak for the kind nearby, words that speak against it, the shape around) vote on
every candidate.  Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for each
kind, drawn towards what it is for all of them, and how likely each pattern means personal data; with those
probabilities as soft labels a logistic regression over features of the span is trained, and it decides which candidates become spans.  Votes and features are small codes, so both
models are fitted on counts over the whole corpus, of a size that does not depend on it.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Collection

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import map_rows
from loomspark.plans.bounds import collect_bounded
from loomspark.plans.scratch import written

BASE = ("email", "ip", "card", "phone")
PROPOSED = ("mail_words", "phone_local", "ssn", "iban", "person")
KINDS = BASE + PROPOSED

# Fixed patterns of the base scan.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_BLANKS = re.compile(r"[^\x00-\x20\x7f]+")

LOOSE = {
    "mail_words": re.compile(r"(?<![\w.])[A-Za-z0-9][\w.+-]{0,63}+[\x20]?(?:\(at\)|\[at\]|\{at\})[\x20]?[A-Za-z0-9-]{1,63}(?:[\x20]?(?:\(dot\)|\[dot\]|\{dot\}|\.)[\x20]?[A-Za-z0-9-]{1,63}){1,5}", re.A),
    "phone_local": re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-])", re.A),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", re.A),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?!\w)", re.A),
    "person": re.compile(r"(?<!\w)(?:(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?[\x20])?[A-Z][a-z]{1,30}[\x20](?:[A-Z]\.[\x20])?[A-Z][a-z]{1,30}(?!\w)"),
}
# A cheap test that has to hold before a loose pattern is looked for at all.
NEEDS = {
    "mail_words": lambda t: "(at)" in t or "[at]" in t or "{at}" in t,
    "phone_local": re.compile(r"[0-9][\x20.-][0-9]{4}(?![0-9])").search,
    "ssn": re.compile(r"-[0-9]{2}-").search,
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}").search,
    "person": re.compile(r"[A-Z][a-z]+[\x20](?:[A-Z]\.[\x20])?[A-Z][a-z]").search,
}
#: Given names that are known without a list of one's own.
GIVEN = frozenset("james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah charles karen anna maria peter paul hans klaus marie pierre jean louis carlos juan jose luis ana carmen laura sofia emma oliver lucas noah alice".split())
HONORIFIC = re.compile(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b")
CUES = {
    "email": "mail contact write reach address", "mail_words": "mail contact write reach address", "ip": "ip host server address login client",
    "card": "card visa credit payment debit mastercard", "phone": "phone tel call mobile fax cell contact", "phone_local": "phone tel call mobile fax cell contact",
    "ssn": "ssn social security", "iban": "iban account bank transfer bic", "person": "name signed mr mrs dear contact patient born customer",
}
CUES = {k: re.compile(r"\b(?:" + "|".join(v.split()) + r")", re.I | re.A) for k, v in CUES.items()}
AGAINST = re.compile(r"\b(?:isbn|issn|doi|version|ver|build|order|invoice|section|chapter|figure|page|part|model|serial|example)\b", re.I | re.A)
NEAR = 40
MAX_NAMES = 1_000_000

VOTES = 5
PATTERNS = 3**VOTES
FEATURES = (4, 4, 4, 3, 3)  # values of each feature: length, share of digits, character before, character after, words nearby
CODES = int(np.prod(FEATURES))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in order, kinds as places in KINDS."""
    out = []
    if "@" in text:
        for run in NO_BLANKS.finditer(text):  # no address reaches over a blank
            if "@" in run[0]:
                out += [(m.start() + run.start(), 0, m.end() + run.start()) for m in _emails(run[0])]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() < 38 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


def _emails(run: str):
    """Matches of EMAIL; each name before an ``@`` is looked at once, from its first character."""
    at, done = run.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (run[start - 1] in "._%+-" or run[start - 1].isascii() and run[start - 1].isalnum()):
            start -= 1
        m = EMAIL.match(run, start) if start < at else None
        if m:
            yield m
            done = m.end()
        else:
            done = at + 1
        at = run.find("@", done)


def _strict(kind: str, s: str) -> int:
    d = digits_of(s)
    if kind in BASE:
        return 1
    if kind == "phone_local":
        return 1 if d[0] > "1" and d[3] > "1" else -1
    if kind == "ssn":
        return 1 if d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000" else -1
    if kind == "iban":
        flat = s.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1 else -1
    if kind == "person":
        return 1 if HONORIFIC.match(s) else 0
    return 1


def _gazetteer(kind: str, s: str, given: Collection[str]) -> int:
    if kind == "person":
        return 1 if any(w.lower() in given for w in s.split()) else -1
    if kind in ("email", "mail_words"):
        return 1 if re.search(r"(?:com|org|net|edu|gov|de|fr|es|uk|io|info)$", s) else 0
    return 0


def _shape(kind: str, s: str, before: str, after: str) -> int:
    d = digits_of(s)
    if len(d) > 5 and len(set(d)) <= 2:
        return -1
    return -1 if before in "#$=/" and before or after in "%$/" and after else 0


def candidate(kind: str, text: str, start: int, end: int, given: Collection[str] = GIVEN) -> tuple[int, int]:
    """(code of the votes, code of the features) of a span."""
    s = text[start:end]
    left, right = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    before, after = left[-1:], right[:1]
    cue = 2 if CUES[kind].search(left) else 1 if CUES[kind].search(right) else 0
    against = bool(AGAINST.search(left))
    votes = (_strict(kind, s), _gazetteer(kind, s, given), 1 if cue else 0, -1 if against else 0, _shape(kind, s, before, after))
    share = len(digits_of(s)) / len(s)
    side = lambda c: 0 if not c or c.isspace() else 1 if c in "\"'(<:,;" else 2 if c.isalnum() else 3
    values = (min(3, len(s) // 8), min(3, int(share * 4)), side(before), min(2, side(after)), 2 if against else 1 if cue else 0)
    code = 0
    for v, n in zip(values, FEATURES):
        code = code * n + v
    pattern = 0
    for v in votes:
        pattern = pattern * 3 + v + 1
    return pattern, code


def examine(text: str | None, given: Collection[str] = GIVEN) -> tuple[list, list]:
    """Base spans, and all candidates as (start, kind, end, votes, features); base spans are candidates too."""
    text = text or ""
    base = base_spans(text)
    spans = list(base)
    for kind, pattern in LOOSE.items():
        if NEEDS[kind](text):
            k = KINDS.index(kind)
            spans += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    out, reach = [], -1
    for start, k, end in sorted(spans):
        if k < len(BASE):
            reach = max(reach, end)
        elif start < reach:
            continue
        out.append((start, k, end, *candidate(KINDS[k], text, start, end, given)))
    return base, out


def _examiner(given):
    def start():
        names = given.value

        def row(doc_id, text):
            found = examine(text, names)[1]
            return doc_id, [dict(zip(("start", "kind", "end", "votes", "features"), x)) for x in found]

        return row

    return start


#: What all kinds say about a labeler counts as so many votes of each kind.
POOLED = 20.0


def reliabilities(counts: dict[tuple[int, int], int], rounds: int = 60) -> dict[tuple[int, int], float]:
    """Probability of personal data for each (kind, vote pattern), by expectation-maximisation.

    Each labeler has, given the truth, its own chances of voting against, not at all, and for: those of a kind are
    smoothed by those of all kinds, and these by a vote of each sort and one more of the right one; each kind has its own share
    of true candidates.  Spans of the fixed patterns are true by definition and say nothing about the labelers of others.
    """
    out = {k: 1.0 for k in counts if k[0] < len(BASE)}
    keys = sorted(k for k in counts if k not in out)
    if not keys:
        return out
    n = np.array([counts[k] for k in keys], float)
    kind = np.array([k for k, _ in keys])
    kinds = np.unique(kind)
    votes = np.array([[p // 3 ** (VOTES - 1 - j) % 3 for j in range(VOTES)] for _, p in keys])
    cast = np.eye(3)[votes]  # pattern, labeler, vote
    prior = np.ones((2, VOTES, 3))
    prior[0, :, 0] += 1.0
    prior[1, :, 2] += 1.0
    q = 1 / (1 + np.exp(-(votes - 1).sum(1) * 2.0 + 0.5))
    for _ in range(rounds):
        weights = np.stack([n * (1 - q), n * q])
        pooled = np.einsum("yp,pjv->yjv", weights, cast) + prior
        pooled /= pooled.sum(2, keepdims=True)
        score = np.zeros(len(keys))
        for k in kinds:
            own = kind == k
            chance = np.einsum("yp,pjv->yjv", weights[:, own], cast[own]) + POOLED * pooled
            chance /= chance.sum(2, keepdims=True)
            share = (weights[1, own].sum() + 1) / (n[own].sum() + 2)
            lift = np.log(chance[1]) - np.log(chance[0])
            score[own] = np.log(share / (1 - share)) + np.einsum("pjv,jv->p", cast[own], lift)
        q = 1 / (1 + np.exp(-score))
    return out | {k: float(p) for k, p in zip(keys, q)}


def train(rows: list[tuple[int, int, float, float]], rounds: int = 300) -> np.ndarray:
    """Logistic regression on (kind, feature code, sum of soft labels, count); returns P for each kind and code."""
    space = [(k, *values) for k in range(len(KINDS)) for values in itertools.product(*map(range, FEATURES))]
    sizes = (len(KINDS), *FEATURES)
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    design = np.zeros((len(space), sum(sizes)))
    design[np.arange(len(space))[:, None], np.array(space) + offsets] = 1.0
    hits, total = np.zeros(len(space)), np.zeros(len(space))
    for kind, code, soft, count in rows:
        hits[kind * CODES + code], total[kind * CODES + code] = soft, count
    seen = total > 0
    x, w = design[seen], np.zeros(design.shape[1])
    if seen.any():
        for _ in range(rounds):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-x @ w))
            curve = x.T @ (x * (total[seen] * p * (1 - p))[:, None]) + np.eye(len(w))
            step = np.linalg.solve(curve, x.T @ (hits[seen] - total[seen] * p) - w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
    return (1 / (1 + np.exp(-design @ w))).reshape(len(KINDS), CODES)


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.5, names: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id and its spans (start, kind, end) in order, code points, end exclusive.

    ``names`` is a table of given names (its first column) that are known beside the built-in ones, ``MAX_NAMES`` at most.

    Texts are read once; what was found in them is written to the shared folder, and both models are fitted on counts of it
    over all rows (at most kinds x vote patterns, and kinds x feature codes).  A null text is an empty one; null
    ids stay; repeated rows give the same row again; an empty table gives an empty table; other columns are not read.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, found array<struct<start:long,kind:int,end:long,votes:int,features:int>>"
    known = collect_bounded(names.select(F.lower(F.col(names.columns[0]))).distinct(), MAX_NAMES, "given names") if names is not None else []
    given = docs.sparkSession.sparkContext.broadcast(GIVEN | {r[0] for r in known if r[0]})
    seen = written(map_rows(narrow, _examiner(given), schema), "pii")
    each = seen.select(F.explode("found").alias("x")).select("x.kind", "x.votes", "x.features")
    counts = each.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n"))
    # The three codes are bounded: kinds x 3^labelers x feature codes, of which a corpus has few; sums of them stay below both bounds.
    patterns = {(r.kind, r.votes): r.n for r in counts.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()}
    truth = reliabilities(patterns)
    soft = docs.sparkSession.createDataFrame([(*k, p) for k, p in truth.items()], "kind int, votes int, p double")
    labelled = counts.join(F.broadcast(soft), ["kind", "votes"]).groupBy("kind", "features")
    rows = labelled.agg(F.sum(F.col("n") * F.col("p")).alias("soft"), F.sum("n").alias("n")).orderBy("kind", "features").collect()
    decide = train([(r.kind, r.features, r.soft, r.n) for r in rows]) >= threshold
    yes = [k * CODES + c for k in range(len(BASE), len(KINDS)) for c in range(CODES) if decide[k, c]]
    stays = lambda x: (x["kind"] < len(BASE)) | (x["kind"] * CODES + x["features"]).isin(yes)
    kept = F.transform(F.filter("found", stays), lambda x: F.struct(x["start"], x["kind"], x["end"]))
    return seen.select("doc_id", kept.alias("spans"))
