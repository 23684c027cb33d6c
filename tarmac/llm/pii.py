"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The field's nodes are a document's tokens that hold a digit or an ``@``; other tokens
can carry no label. Neighbouring tokens share chain potentials; a token also shares a
potential with the next token that repeats it or ends in the same digits, however far
away. Tokens inside a pattern's match are observed, and loopy sum-product message
passing carries their labels to the rest. Observed tokens are linked to every such token
of their document, so a number that is plain once and garbled elsewhere gets one label
throughout, however many repeats lie between. Messages pass until they settle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import digest

KINDS = ("email", "ip", "card", "phone")
_LABELS = 1 + len(KINDS)  # 0: none

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Digits are taken from the start of their run: no other start can give another match, and long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_EDGES = ".,;:!?\"'()[]{}<>|"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            end = domain.end()
        else:
            end = at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """The patterns' matches, leftmost and not overlapping for each kind; matches that fail their check are dropped."""
    out = list(_emails(text))
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of tokens with a digit or an ``@``, without punctuation at their ends."""
    out = []
    for m in _TOKEN.finditer(text):
        whole = m.group()
        inner = whole.strip(_EDGES)
        if inner:
            start = m.start() + whole.index(inner)
            out.append((start, start + len(inner), inner))
    return out


_FEATURES = 18


def _features(token: str) -> list[int]:
    """Numbers of the features that hold."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    n, has_at = len(digits), "@" in token
    parts = token.split(".")
    on = [0]
    on.append(1 + (0 if n == 0 else 1 if n <= 3 else 2 if n <= 6 else 3 if n <= 8 else 4 if n <= 12 else 5 if n <= 19 else 6))
    if has_at:
        on.append(8 if _DOMAIN.match(token, token.index("@") + 1) else 9)
    if token.startswith("+"):
        on.append(10)
    if n == len(token):
        on.append(11)
    elif not has_at and any(c.isalpha() for c in token):
        on.append(12)
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        on.append(13 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else 14)
    if 13 <= n <= 19:
        on.append(15 if luhn(digits) else 16)
    if "-" in token:
        on.append(17)
    return on


def _key(token: str) -> str | None:
    """What repeated or similar tokens share: their last seven digits, or their letters and digits."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    if "@" not in token and len(digits) >= 7:
        return digits[-7:]
    plain = "".join(c for c in token.lower() if c.isalnum())
    return plain if len(plain) >= 5 else None


class Graph(NamedTuple):
    """Tokens of some documents: feature rows, observed labels (-1: open), chain and skip links as index pairs.

    ``far`` links go from observed tokens, one for each label under a key, to the open ones
    under it that have no skip link with a token of that label. They carry skip potentials.
    """

    spots: list[tuple[int, int, int]]  # document, start, end
    features: np.ndarray
    seen: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    far: np.ndarray = np.zeros((0, 2), np.int64)


def graph(texts: list[str], bases: list[list[Span]]) -> Graph:
    spots, features, seen, chain, skip, far = [], [], [], [], [], []
    for doc, (text, base) in enumerate(zip(texts, bases, strict=True)):
        under: dict[str, list[int]] = {}
        before = None
        spans = sorted((s, e, k) for k, s, e in base)
        nearest = 0
        for start, end, token in _tokens(text):
            at = len(spots)
            while nearest < len(spans) and spans[nearest][1] <= start:
                nearest += 1
            inside = next((k for s, e, k in spans[nearest:nearest + 4] if s < end and start < e), -1)
            spots.append((doc, start, end))
            row = np.zeros(_FEATURES)
            row[_features(token)] = 1
            features.append(row)
            seen.append(inside + 1 if inside >= 0 else -1)
            if before is not None and start - before <= 3:
                chain.append((at - 1, at))
            before = end
            key = _key(token)
            if key is not None:
                under.setdefault(key, []).append(at)
        for held in under.values():
            skip += zip(held, held[1:], strict=False)
            labels = [seen[k] for k in held]
            for label in sorted(set(labels) - {-1}):
                beside = [label in labels[max(0, k - 1):k + 2] for k in range(len(held))]
                far += [(held[labels.index(label)], at) for at, mine, near in zip(held, labels, beside, strict=True) if mine < 0 and not near]
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(spots, np.array(features).reshape(-1, _FEATURES), np.array(seen, np.int64), pairs(chain), pairs(skip), pairs(far))


class Model(NamedTuple):
    """Log potentials: features x labels, chain (label, next label), skip (label, label; symmetric)."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(texts: list[str], rounds: int = 300, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Pseudo-likelihood on the patterns' own labels: each token given its neighbours' labels, by Adam steps.

    Without any token all potentials are zero but for the skip links', which favour equal labels.
    """
    g = graph(texts, [base_spans(t) for t in texts])
    y = np.maximum(g.seen, 0)
    eye = np.eye(_LABELS)
    params = [np.zeros((_FEATURES, _LABELS)), np.zeros((_LABELS, _LABELS)), 2.0 * eye]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = len(y)
    for step in range(1, rounds + 1 if n else 1):
        score = g.features @ params[0]
        for links, at, tie in ((g.chain, 1, False), (g.skip, 2, True)):
            left, right = links.T
            np.add.at(score, right, params[at][y[left]])
            np.add.at(score, left, params[at][:, y[right]].T)
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        miss = p - eye[y]
        grads = [g.features.T @ miss / n + decay * params[0]]
        for links, at, tie in ((g.chain, 1, False), (g.skip, 2, True)):
            left, right = links.T
            grad = np.zeros((_LABELS, _LABELS))
            np.add.at(grad, y[left], miss[right])
            np.add.at(grad.T, y[right], miss[left])
            grad = (grad + grad.T) / 2 if tie else grad
            grads.append(grad / n + decay * (params[at] - (2.0 * eye if tie else 0)))
        for k, grad in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad ** 2
            params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(*params)


def beliefs(g: Graph, model: Model, rounds: int | None = None, settled: float = 1e-6) -> np.ndarray:
    """Label probabilities of all tokens after loopy sum-product, all documents at once.

    Without ``rounds`` messages pass until those of a document change by less than
    ``settled``, for at most 64 rounds and four more for each token of the longest document:
    damped by half, a message needs about two for each link. Messages that have not settled by then count as they are.
    """
    unary = g.features @ model.node
    fixed = g.seen >= 0
    unary[fixed] = -1e3
    unary[fixed, g.seen[fixed]] = 0
    doc = np.array([s[0] for s in g.spots], np.int64)
    if len(g.far):  # what an observed token sends depends on its label only
        np.add.at(unary, g.far[:, 1], model.skip[g.seen[g.far[:, 0]]])
    # a message for each direction of each link: (from, to, potential with the sender's label first)
    source = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
    target = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
    tables = np.stack([model.chain, model.chain.T, model.skip, model.skip.T])
    which = np.repeat(np.arange(4), [len(g.chain), len(g.chain), len(g.skip), len(g.skip)])
    back = np.concatenate([np.arange(len(g.chain)) + len(g.chain), np.arange(len(g.chain)), 2 * len(g.chain) + len(g.skip) + np.arange(len(g.skip)), 2 * len(g.chain) + np.arange(len(g.skip))])
    sent = np.zeros((len(source), _LABELS))
    most = 64 + 4 * int(np.bincount(doc).max()) if rounds is None and len(doc) else rounds or 0
    live, total, answer = np.arange(len(source)), unary.copy(), back
    for _ in range(most):
        if not len(live):
            break
        into, out_of = target[live], source[live]
        total[into] = unary[into]
        np.add.at(total, into, sent[live])
        out = (total[out_of] - sent[answer])[:, :, None] + tables[which[live]]
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        moving = np.abs(new - sent[live]).max(axis=1) >= settled
        sent[live] = 0.5 * sent[live] + 0.5 * new
        # links stay within a document: the settled ones are left as they are
        going = np.isin(doc[out_of], doc[out_of[moving]])
        if not going.all():
            live = live[going]
            answer = back[live]
    np.add.at(unary, target, sent)
    unary -= unary.max(axis=1, keepdims=True)
    p = np.exp(unary)
    return p / p.sum(axis=1, keepdims=True)


def added_spans(texts: list[str], bases: list[list[Span]], model: Model, sure: float = 0.9) -> list[list[Span]]:
    """For each text, spans of tokens outside the patterns' matches whose label has probability ``sure`` or more; neighbours of one kind join."""
    out: list[list[Span]] = [[] for _ in texts]
    g = graph(texts, bases)
    if not len(g.spots):
        return out
    p = beliefs(g, model)
    best = p.argmax(axis=1)
    linked = {int(b) for _, b in g.chain}
    joined = -2
    for k in np.flatnonzero((best > 0) & (p.max(axis=1) >= sure) & (g.seen < 0)).tolist():
        doc, start, end = g.spots[k]
        kind = int(best[k]) - 1
        spans = out[doc]
        if joined == k - 1 and k in linked and spans and spans[-1][0] == kind:
            spans[-1] = (kind, spans[-1][1], end)
        else:
            spans.append((kind, start, end))
        joined = k
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at, until = [], 0, -1
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= until:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = until = end
        else:
            at = until = max(until, end)
    return "".join([*out, text[at:]])


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def train(docs: DataFrame, rows: int = 4000, max_bytes: int = 65_536) -> Model:
    """Fits on at most ``rows`` texts of at most ``max_bytes`` bytes that hold a digit or an ``@``, the same ones on each run."""
    texts = docs.where((F.octet_length("text") <= max_bytes) & F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), F.length("text").alias("n"), "doc_id", "text")
    chosen = texts.select("h", "n", "doc_id").distinct().orderBy("h", "n", "doc_id").limit(rows).select("h", "n").distinct()
    # at most `rows` texts, however many rows share an id or a text
    found = texts.join(F.broadcast(chosen), ["h", "n"]).select("text").distinct().orderBy(F.xxhash64("text"), "text").limit(rows).collect()
    return fit(sorted(r.text for r in found))


def _all_spans(texts: list[str], model: Model) -> tuple[list[list[Span]], list[list[Span]]]:
    bases = [base_spans(t) for t in texts]
    return bases, [b + more for b, more in zip(bases, added_spans(texts, bases, model), strict=True)]


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with counts of the patterns' matches, the digest of these, and all spans.

    Null and empty texts have no spans. Columns of ``docs`` with the names of the result
    are replaced; rows stay, repeated ones too.
    """
    names = [c.split()[0] for c in _FOUND.split(", ")]

    @F.pandas_udf(_FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for base, spans in zip(*_all_spans(list(batch), model), strict=True):
                counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                rows.append((*counts, digest(written(base).encode()), written(spans)))
            yield pd.DataFrame(rows, columns=names)

    held = docs.withColumn("_found", found(F.coalesce("text", F.lit(""))))
    return held.select(*[c for c in docs.columns if c not in names], *[F.col(f"_found.{n}").alias(n) for n in names])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; a null text stays null."""
    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = list(batch)
            yield pd.Series([redacted(t, s) for t, s in zip(texts, _all_spans(texts, model)[1], strict=True)], dtype="object")

    return docs.withColumn("text", F.when(F.col("text").isNotNull(), clean(F.coalesce("text", F.lit("")))))
