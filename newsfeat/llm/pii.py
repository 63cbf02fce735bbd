"""Personal data by weak supervision.

Candidates are the base spans (fixed patterns, always kept) and looser forms:
e-mail addresses with written-out signs, telephone numbers without a country
code, cards of 13 to 15 digits or with other separators, IPv6 addresses, and
matches of the base patterns that failed their check.  Three labelers vote on
each candidate, for, against or not at all: a regex labeler (shape and check
digits), a gazetteer labeler (top-level domains, card ranges, country and area
codes, reserved networks) and a context labeler (cue words on the left).

Expectation-maximisation over the counts of all vote patterns in the corpus
estimates how often each labeler gives each vote for true and for false
candidates of a kind, and with it the probability that a candidate is true.
A logistic span classifier is trained on these probabilities, with the votes
and the span's shape as features and weights of its own for each kind, so that
no kind's verdict depends on how many candidates another has; it decides on the
loose candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# ------------------------------------------------------------- base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at the start of a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their ``@``: the longest run
    of local signs before it, back to the match before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def base_matches(text: str) -> Iterator[tuple[Span, bool]]:
    """All matches of the base patterns, and whether they pass their check."""
    if "@" in text:
        for start, end in _emails(text):
            yield Span(0, start, end), True
    if not _DIGITS.search(text):
        return
    for m in _IP.finditer(text):
        yield Span(1, *m.span()), all(int(x[-9:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        yield Span(2, *m.span()), 16 <= len(d) <= 19 and luhn(d)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield Span(3, *m.span()), 8 <= len(_digits(m[0])) <= 15


# ---------------------------------------------------------- loose candidates

_LOOSE = (
    (0, "at", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++"
                         r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)+")),
    (1, ":", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    (2, "", re.compile(r"(?<![0-9A-Za-z+._/-])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9A-Za-z])")),
    (3, "", re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")),
)


def candidates(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans of ``text``, and its loose candidates that overlap none
    of them, each in the order of kind and start.  A number whose check digit
    fails is a candidate for a card only with a word of ``CUES`` among the
    ``CONTEXT`` characters before it."""
    base, failed = [], []
    for span, good in base_matches(text):
        (base if good else failed).append(span)
    # of failed matches those that are nearly of their kind
    loose = [s for s in failed if _near(s, text[s.start:s.end])]
    for kind, sign, pattern in _LOOSE:
        if sign in text:
            loose += [Span(kind, *m.span()) for m in pattern.finditer(text)]
    # a failed check digit speaks against a card: only a word beside it makes it one to vote on
    loose = [s for s in loose if s.kind != 2 or luhn(_digits(text[s.start:s.end]))
             or CUES[2].search(text, max(0, s.start - CONTEXT), s.start)]
    if loose and base:
        taken = sorted((s.start, s.end) for s in base)
        starts = np.array([t[0] for t in taken])
        ends = np.maximum.accumulate([t[1] for t in taken])
        free = []
        for s in loose:
            k = int(np.searchsorted(starts, s.end))  # base spans that begin before its end
            if not k or ends[k - 1] <= s.start:
                free.append(s)
        loose = free
    return sorted(base), sorted(set(loose))


def _near(span: Span, text: str) -> bool:
    n = len(_digits(text))
    return span.kind == 1 or span.kind == 2 and 13 <= n <= 19 or span.kind == 3 and 7 <= n <= 16


# ------------------------------------------------------------------ labelers

#: Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov int info biz eu de fr es it uk us nl be at ch pl pt se no dk fi ie cz ru "
                        "cn jp kr in br mx ar ca au nz io co me tv".split())
COUNTRY_CODES = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 "
                      "81 82 84 86 90 91 92 351 352 353 358 420 421".split())
CARD_RANGES = ("4", "51", "52", "53", "54", "55", "2221", "23", "24", "25", "26", "270", "34", "37", "6011", "65", "35", "36")
RESERVED_NETWORKS = ("0.", "127.", "255.")
CUES = (
    re.compile(r"mail|contact|write|kontakt|contacter|correo|courriel", re.I),
    re.compile(r"\bip\b|address|host|server|login|client|adresse", re.I),
    re.compile(r"card|visa|master|credit|payment|karte|carte|tarjeta", re.I),
    re.compile(r"tel|phone|call|fax|mobil|ring|anruf|appel|llam", re.I),
)
COUNTER_CUES = re.compile(r"version|release|isbn|issn|order|serial|token|figure|section|chapter|build|\bno\b|\bid\b", re.I)
#: Characters on the left that the context labeler reads.
CONTEXT = 40


def votes(text: str, span: Span, strict: bool) -> tuple[int, int, int]:
    """Votes of the regex, gazetteer and context labelers: 1, -1 or 0."""
    own = text[span.start:span.end]
    d = _digits(own)
    left = text[max(0, span.start - CONTEXT):span.start]
    if span.kind == 0:
        shape = 1 if strict else 0
        gaze = 1 if re.split(r"[.)\]} ]+", own.lower())[-1] in TOP_DOMAINS else -1
    elif span.kind == 1:
        shape = 1 if strict or ":" in own else -1
        gaze = -1 if own.startswith(RESERVED_NETWORKS) else 0 if strict else -1 if ":" not in own else 1
    elif span.kind == 2:
        shape = 1 if strict or 13 <= len(d) <= 19 and luhn(d) else -1
        gaze = 1 if d.startswith(CARD_RANGES) and len(d) >= 15 else -1
    else:
        shape = 1 if strict else 0 if 10 <= len(d) <= 15 else -1
        first = d[:1] if own.startswith("+") else "1"
        gaze = (1 if d.startswith(COUNTRY_CODES) else -1) if own.startswith("+") else (1 if first and d[:1] not in "01" else -1)
    cue = 1 if CUES[span.kind].search(left) else -1 if COUNTER_CUES.search(left) else 0
    return shape, gaze, cue


def pattern_of(text: str, span: Span, strict: bool) -> int:
    """Kind, votes and shape of a candidate as one small number."""
    shape, gaze, cue = votes(text, span, strict)
    own = text[span.start:span.end]
    code = span.kind
    for v in (shape + 1, gaze + 1, cue + 1):
        code = code * 3 + v
    parted = bool(re.search(r"[^0-9A-Za-z]", own))
    alone = (span.start == 0 or text[span.start - 1].isspace()) and (span.end == len(text) or not text[span.end].isalnum())
    return code * 4 + 2 * parted + alone


def _unpacked(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, votes (0, 1, 2) and shape flags of patterns."""
    alone, parted, rest = code % 2, code // 2 % 2, code // 4
    cue, gaze, shape, kind = rest % 3, rest // 3 % 3, rest // 9 % 3, rest // 27
    return kind, np.stack([shape, gaze, cue], axis=1), np.stack([parted, alone], axis=1)


# ------------------------------------------------------- EM and classifier

def reliabilities(kind: np.ndarray, vote: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: ``(share[kind], table[kind, true/false, labeler,
    vote])``.  Starts from the majority of the votes and smooths with one
    candidate per cell that votes as its labeler should."""
    total = (vote - 1).sum(axis=1)
    truth = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    prior = np.array([[[2.0, 1.0, 4.0]] * 3, [[4.0, 1.0, 2.0]] * 3])  # [true, false][labeler][against, none, for]
    share, table = np.full(len(KINDS), 0.5), np.ones((len(KINDS), 2, 3, 3)) / 3
    for _ in range(rounds):
        for k in range(len(KINDS)):
            own = kind == k
            for side, weight in enumerate((truth, 1 - truth)):
                for labeler in range(3):
                    n = prior[side, labeler] + np.bincount(vote[own, labeler], weights=(count * weight)[own], minlength=3)
                    table[k, side, labeler] = n / n.sum()
            share[k] = ((count * truth)[own].sum() + 1) / (count[own].sum() + 2)
        truth = posterior(kind, vote, share, table)
    return share, table


def posterior(kind: np.ndarray, vote: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The probability that a candidate with these votes is true."""
    p = [np.prod([table[kind, side, j, vote[:, j]] for j in range(3)], axis=0) for side in (0, 1)]
    a, b = p[0] * share[kind], p[1] * (1 - share[kind])
    return a / (a + b)


def _inputs(code: np.ndarray) -> np.ndarray:
    """Features of the span classifier: for each kind a constant, each vote for
    and against, and the shape; those of other kinds are 0."""
    kind, vote, shape = _unpacked(code)
    own = np.concatenate([np.ones((len(code), 1)), vote == 2, vote == 0, shape], axis=1).astype(float)
    return (np.eye(len(KINDS))[kind][:, :, None] * own[:, None, :]).reshape(len(code), -1)


@dataclass
class SpanModel:
    weight: np.ndarray
    share: np.ndarray = field(default_factory=lambda: np.full(len(KINDS), 0.5))
    table: np.ndarray = field(default_factory=lambda: np.ones((len(KINDS), 2, 3, 3)) / 3)

    def probability(self, code: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_inputs(code) @ self.weight))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """The base spans of a text, and all its spans."""
        base, loose = candidates(text)
        if loose:
            p = self.probability(np.array([pattern_of(text, s, False) for s in loose]))
            added, end = [], -1
            for s, q in sorted(zip(loose, p), key=lambda x: (x[0].start, -x[0].end, x[0].kind)):
                if q >= 0.5 and s.start >= end:
                    added.append(s)
                    end = s.end
            return base, sorted(base + added)
        return base, base


def train(code: np.ndarray, count: np.ndarray, steps: int = 100) -> SpanModel:
    """The classifier from the counts of all candidate patterns, as they are.
    Without candidates it takes a loose one for true if two labelers agree on
    it."""
    model = SpanModel(np.array(([-1.0] + [1.0] * 3 + [-1.0] * 3 + [0.0] * 2) * len(KINDS)))
    if not len(code):
        return model
    kind, vote, _ = _unpacked(code)
    model.share, model.table = reliabilities(kind, vote, count)
    truth = posterior(kind, vote, model.share, model.table)
    x, start = _inputs(code), model.weight
    width = x.shape[1] // len(KINDS)
    model.weight = start.copy()
    for k in range(len(KINDS)):  # each kind by itself: also its steps do not depend on the others
        own, at = kind == k, slice(k * width, (k + 1) * width)
        if own.any():
            model.weight[at] = _regression(x[own, at], truth[own], count[own], start[at], steps)
    return model


def _regression(x: np.ndarray, truth: np.ndarray, count: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    """Logistic regression by Newton's method, pulled towards ``start``; steps
    that do not lower the loss are halved."""
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((count * (np.logaddexp(0, z) - truth * z)).sum() + ((w - start) ** 2).sum() / 2)

    w = start.copy()
    now = loss(w)
    for _ in range(steps):
        p = 0.5 + 0.5 * np.tanh(x @ w / 2)
        slope = x.T @ (count * (truth - p)) - (w - start)
        curve = (x * (count * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        new = loss(w + step)
        while new >= now and np.abs(step).max() > 1e-9:
            step /= 2
            new = loss(w + step)
        if new >= now:
            break
        w, now = w + step, new
    return w


# ------------------------------------------------------------------ operator

def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            base, loose = candidates(text)
            for spans, strict in ((base, True), (loose, False)):
                for s in spans:
                    code = pattern_of(text, s, strict)
                    counts[code] = counts.get(code, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                     names=["code", "n"])


def fit(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Votes on all candidates of ``docs``; the driver gets one count for each
    pattern, of which there are at most 432."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_patterns, "code long, n long") \
        .groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    return train(counts["code"].to_numpy(np.int64), counts["n"].to_numpy(float))


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def _found(batches: Iterator[pa.RecordBatch], model: SpanModel) -> Iterator[pa.RecordBatch]:
    names = ["doc", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for doc, text in zip(batch.column("_doc").to_pylist(), batch.column("text").to_pylist()):
            base, every = model.spans(text or "")
            n = [0] * len(KINDS)
            for s in base:
                n[s.kind] += 1
            row = (doc, *n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(every), len(every))
            for c, v in zip(columns, row):
                c.append(v)
        types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def found_spans(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans,
    n_spans)``, a row for each row of ``docs``, without a shuffle: counts and
    digest of the base spans, and all spans as ``kind:start:end`` in the order
    of kind and start.  Defined results: a null text counts as empty (no spans,
    the digest of the empty string); base spans of different kinds may overlap,
    added ones overlap none; ids, null or repeated, are passed through; an
    empty table gives no rows; other columns are not read."""
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    schema = "doc long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_spans long"
    return one.mapInArrow(lambda it: _found(it, model), schema).withColumnRenamed("doc", id_col)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; of spans that
    overlap, the joint range gets the kind of the first."""
    out, end = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= end:
            out += [text[end:s.start], f"[{KINDS[s.kind].upper()}]"]
        end = max(end, s.end)
    return "".join(out) + text[end:]


def masked_documents(docs: DataFrame, model: SpanModel, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with masked texts; a null text stays null.  The character
    count, if there is such a column, is that of the new text (null stays)."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else masked(t, model.spans(t)[1]) for t in batch.column(text_col).to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[text_col] = pa.array(texts, batch.schema.field(text_col).type)
            if chars_col in columns:
                old = columns[chars_col].to_pylist()
                n = [o if o is None or t is None else len(t) for o, t in zip(old, texts)]
                columns[chars_col] = pa.array(n, batch.schema.field(chars_col).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(mask, docs.schema)
