"""Personal data: base patterns, and a skip-chain conditional random field for what they miss.

Base spans are the leftmost non-overlapping matches of one pattern for each kind, checked (Luhn,
octets, numbers of digits); a match that fails its check is dropped without another try.

The field labels tokens that hold a digit, an at sign or a bracketed "at" or "dot", and the
neighbours of such a mark that stands alone; other tokens can only be outside (a hard constraint of the
model, which keeps it linear in such tokens).  Factors are

* one for each token, from its shape and neighbours,
* one for each two neighbouring tokens,
* one for each token and the next similar one anywhere in the document, and for each token and the
  first similar one inside a base span (skip edges): tokens or runs of them with the same digits, the
  same last seven digits, the same four octets, the same letters and digits around an at sign, or the
  same long mixture of letters and digits.

Tokens inside base spans are clamped to their kind.  Loopy belief propagation with damping carries
labels along skip edges until messages settle, so a number found once is found in every other notation
that the base pattern misses, and a bare number is personal data where the document says elsewhere what
it is.  Tokens outside base spans whose marginal for a kind reaches ``CERTAIN`` are added, with their
neighbours that are of the kind more likely than not as one span, if the whole fits its kind.  A fifth kind, secrets, has added spans only.

The factors maximise the pseudo-likelihood of documents whose labels the base patterns do not give.
They are made from a bounded sample, at most ``SAMPLE`` of about ``DRAWN`` documents with a digit or an at
sign, chosen by the hashes of their rows: their base spans, and strings assigned to names of secrets, are rewritten in other
notations, mentioned again elsewhere, and mixed with dates, amounts and other numbers.

Results for special rows: a null text is an empty one without spans; rows are independent, so
repeated rows change nothing; an empty table gives an empty result; further columns are not read.
Whole texts are searched whatever their length, in time linear in it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
OUTSIDE = len(KINDS)
BASE_KINDS = KINDS[:SECRET]
SPACE = " \t\n\x0b\x0c\r"
#: Documents whose spans the factors are estimated from, at most, and documents drawn to find them.
SAMPLE, DRAWN = 1000, 1200
#: An added span has a token of this marginal, and neighbours that are more likely of its kind than not.
CERTAIN, LIKELY = 0.9, 0.5
#: Rounds of message passing at most, the change below which messages have settled, and damping.
ROUNDS, SETTLED, DAMPING = 60, 1e-3, 0.3
#: Gradient steps, step length and the weight of the squared norm of the factors.
STEPS, RATE, RIDGE = 600, 0.3, 3e-5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = r"[\[({](?:at|dot|\.)[\])}]"
_SIGN = re.compile(rf"[0-9@]|{_MARK}", re.IGNORECASE)
_LONE_MARK = re.compile(rf"(?:{_MARK}|@)", re.IGNORECASE)
_AT_MARK = re.compile(r"[\[({]at[\])}]", re.IGNORECASE)
_DOT_MARK = re.compile(r"[\[({](?:dot|\.)[\])}]", re.IGNORECASE)
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LONG_MIX = re.compile(r"(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{16,}")
_HEX = re.compile(r"[0-9A-Fa-f]+")
_EVERYDAY = re.compile(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?|[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+\.[0-9]+")
#: A string assigned to the name of a secret: its label in the sample.
_ASSIGNED = re.compile(r"(?i)\b(?:token|secret|api[_-]?key|key|password|passwd|pwd)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_-]{16,})")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign, in time linear in the text."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in the order of kinds, then of starts."""
    if not _SIGN.search(text):
        return []
    out: list[Span] = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


class Nodes(NamedTuple):
    """The tokens of a text that the field labels."""

    bounds: list[tuple[int, int]]
    #: Index of the kind of the base span that covers a token, else -1.
    clamped: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


#: Shapes of neighbours that count: pieces of numbers written in several tokens.
NUMBER_SHAPES = ((3,), (4,), (3, 4), (3, 3, 4))


def _shape(token: str) -> tuple[int, ...]:
    """The lengths of a token's groups of digits; empty if it holds a letter."""
    return () if any(c.isalpha() for c in token) else tuple(map(len, _NOT_DIGIT.sub(" ", token).split()))


def _feature_row(token: str, before: str, after: str) -> list[float]:
    """The shape of a token; ``before`` and ``after`` are the tokens beside it, empty beyond a line of the field."""
    core = token.strip(".,;:!?\"'*#$%&|<>")
    digits = _NOT_DIGIT.sub("", token)
    n, dots = len(digits), token.count(".")
    letters = sum(c.isalpha() for c in token)
    parts = _NOT_DIGIT.sub(" ", core).split()
    long = 16 <= n <= 19
    mixed = _LONG_MIX.fullmatch(core) is not None
    return [
        1.0,
        long,
        long and luhn(digits),
        "@" in token,
        "@" in token and dots > 0,
        token.startswith("+"),
        core.startswith("("),
        "-" in core,
        "/" in core or "_" in core,
        dots == 3,
        dots >= 4,
        letters == 0,
        letters > n,
        n == 0,
        1 <= n <= 2,
        n == 3,
        n == 4,
        5 <= n <= 6,
        n == 7,
        8 <= n <= 9,
        n == 10,
        11 <= n <= 12,
        13 <= n <= 15,
        n > 19,
        len(parts) == 4 and all(len(x) == 4 for x in parts),
        len(parts) == 3 and list(map(len, parts)) == [3, 3, 4],
        len(parts) == 2 and list(map(len, parts)) == [3, 4],
        len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts),
        _EVERYDAY.fullmatch(core) is not None,
        _AT_MARK.search(token) is not None,
        _DOT_MARK.search(token) is not None,
        _LONE_MARK.fullmatch(token) is not None,
        _LONE_MARK.fullmatch(before) is not None,
        _LONE_MARK.fullmatch(after) is not None,
        mixed,
        mixed and _HEX.fullmatch(core) is not None,
        token[:1] in "\"'",
        before[-1:] in ("=", ":"),
        before == "",
        after == "",
        *(x for other in (before, after) for x in (other.startswith("+"), other.startswith("("), *(_shape(other) == shape for shape in NUMBER_SHAPES))),
    ]


FEATURES = len(_feature_row("0", "", ""))
#: Columns of the features that say "as many digits as a card" and "passes the Luhn check".
LONG, VALID = 1, 2


def _plain_address(text: str) -> str:
    """An address without its dots, marks read as what they stand for."""
    return "".join(c for c in _AT_MARK.sub("@", _DOT_MARK.sub("", text)).lower() if c.isalnum() or c == "@")


def _similar(text: str) -> list[str]:
    """What a token or a run of tokens is recognised by."""
    digits = _NOT_DIGIT.sub("", text)
    keys = []
    if 7 <= len(digits) <= 19:
        keys += ["d" + digits, "t" + digits[-7:]]
    parts = _NOT_DIGIT.sub(" ", text).split()
    if len(parts) == 4 and all(len(x) <= 3 for x in parts):
        keys.append("i" + ".".join(map(str, map(int, parts))))
    if "@" in text or _AT_MARK.search(text):
        keys.append("@" + _plain_address(text))
    core = "".join(c for c in text.lower() if c.isalnum())
    if len(core) >= 16 and len(digits) < len(core):
        keys.append("s" + core)
    return keys


def _tokens(text: str) -> list[tuple[int, int]]:
    """Bounds of the tokens that the field labels."""
    found: list[tuple[int, int]] = []
    end, size = 0, len(text)
    for m in _SIGN.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] not in SPACE:
            start -= 1
        end = m.end()
        while end < size and text[end] not in SPACE:
            end += 1
        found.append((start, end))
    out: list[tuple[int, int]] = []
    last = 0
    for k, (start, end) in enumerate(found):
        lone = _LONE_MARK.fullmatch(text, start, end) is not None
        if lone:  # the word before a mark
            b = start
            while b > last and text[b - 1] in " \t":
                b -= 1
            a = b
            while a > last and text[a - 1] not in SPACE:
                a -= 1
            if a < b:
                out.append((a, b))
        out.append((start, end))
        last = end
        if lone:  # the word after it, unless it is a token by itself
            a, stop = end, found[k + 1][0] if k + 1 < len(found) else size
            while a < stop and text[a] in " \t":
                a += 1
            b = a
            while b < stop and text[b] not in SPACE:
                b += 1
            if a < b:
                out.append((a, b))
                last = b
    return out


def nodes_of(text: str, base: list[Span]) -> Nodes | None:
    """The tokens of a text that the field labels; None if there are none."""
    bounds = _tokens(text)
    if not bounds:
        return None
    clamped = np.full(len(bounds), -1)
    # A base span of several tokens is compared as a whole, at its first token.
    whole: dict[int, str] = {}
    starts = np.array([a for a, _ in bounds])
    ends = np.array([b for _, b in bounds])
    for kind, a, b in base:
        low, high = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        clamped[low:high] = kind
        whole[low] = text[a:b]
    near = [not text[ends[k] : starts[k + 1]].strip(" \t") for k in range(len(bounds) - 1)]
    tokens = [text[a:b] for a, b in bounds]
    beside = lambda k, other: tokens[other] if 0 <= other < len(tokens) and near[min(k, other)] else _word_beside(text, bounds[k], other - k)
    features = np.array([_feature_row(t, beside(k, k - 1), beside(k, k + 1)) for k, t in enumerate(tokens)], float)
    chain = np.array([(k, k + 1) for k, x in enumerate(near) if x], int).reshape(-1, 2)
    runs = _runs(text, tokens, bounds, near)
    last: dict[str, int] = {}
    hub: dict[str, int] = {}
    skip = set()
    keys = [{*_similar(token), *_similar(whole.get(k, "")), *_similar(runs.get(k, ""))} for k, token in enumerate(tokens)]
    for k, own in enumerate(keys):
        for key in own:
            if clamped[k] >= 0:
                hub.setdefault(key, k)
            if key in last:
                skip.add((last[key], k))
            last[key] = k
    for k, own in enumerate(keys):
        skip |= {(min(k, hub[key]), max(k, hub[key])) for key in own if hub.get(key, k) != k}
    return Nodes(bounds, clamped, features, chain, np.array(sorted(skip), int).reshape(-1, 2))


def _word_beside(text: str, bounds: tuple[int, int], step: int) -> str:
    """The word before or after a token, at most 20 characters of it, none across a line's end."""
    if step < 0:
        head = text[max(0, bounds[0] - 24) : bounds[0]].rpartition("\n")[2].split()
        return head[-1] if head else ""
    tail = text[bounds[1] : bounds[1] + 24].partition("\n")[0].split()
    return tail[0] if tail else ""


def _runs(text: str, tokens: list[str], bounds: list[tuple[int, int]], near: list[bool]) -> dict[int, str]:
    """Texts of runs of numbers, and of words joined by marks, by the first token of each."""
    marks = [_LONE_MARK.fullmatch(t) is not None for t in tokens]
    number = [not any(c.isalpha() for c in t) and not m for t, m in zip(tokens, marks, strict=True)]
    out: dict[int, str] = {}
    first = 0
    for k in range(len(tokens)):
        joined = k + 1 < len(tokens) and near[k] and (marks[k] or marks[k + 1] or number[k] and number[k + 1])
        if not joined:
            if k > first:
                out[first] = text[bounds[first][0] : bounds[k][1]]
            first = k + 1
    return out


class Field(NamedTuple):
    """Log factors: of tokens by feature, of neighbours, of similar tokens."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _address_forms(s: str) -> list[str]:
    name, _, host = s.partition("@")
    dotted = host.split(".")
    return [
        f"{name} [at] {' [dot] '.join(dotted)}",
        f"{name}(at){'(dot)'.join(dotted)}",
        f"{name}[at]{host}",
        f"{name} @ {'[.]'.join(dotted)}",
        f"{name}@{'[.]'.join(dotted)}",
        f"{name} (at) {host}",
    ]


def _octet_forms(s: str) -> list[str]:
    return [mark.join(s.split(".")) for mark in ("[.]", "(.)", "[dot]", "(dot)")]


def _card_forms(s: str) -> list[str]:
    d = _NOT_DIGIT.sub("", s)
    fours = [d[k : k + 4] for k in range(0, len(d), 4)]
    return [mark.join(fours) for mark in (".", "/", "_", "  ")]


def _phone_forms(s: str) -> list[str]:
    d = _NOT_DIGIT.sub("", s)
    head, a, b, c = d[:-10] or "1", d[-10:-7], d[-7:-4], d[-4:]
    forms = [f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"{a}-{b}-{c}", f"00{head} {a} {b} {c}", f"+{head}/{a}/{b}/{c}", f"({a}){b}-{c}", f"{a}{b}{c}", f"{b}-{c}"]
    return forms if len(d) >= 10 else [d]


def _secret_forms(s: str) -> list[str]:
    return [s, f"({s})", f'"{s}"', f"token: {s}"]


FORMS: tuple[Callable[[str], list[str]], ...] = (_address_forms, _octet_forms, _card_forms, _phone_forms, _secret_forms)


def _distractor(rng: np.random.Generator) -> str:
    """A date, an amount or another number or string that is nobody's."""
    n = lambda low, high: int(rng.integers(low, high))
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    forms = (
        lambda: f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}",
        lambda: f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}",
        lambda: f"{n(0, 24):02d}:{n(0, 60):02d}",
        lambda: f"{n(0, 1000)}.{n(0, 100)}",
        lambda: f"{n(1, 1000)},{n(0, 1000):03d}",
        lambda: f"{n(1, 10)}.{n(0, 20)}.{n(0, 20)}",
        lambda: str(n(0, 3000)),
        lambda: digits(n(5, 16)),
        lambda: digits(10),
        lambda: digits(n(16, 20)),
        lambda: f"{digits(3)}-{digits(4)}",
        lambda: f"({n(1, 2100)})",
        lambda: f"{n(1, 100)}%",
        lambda: f"+{n(1, 100)}",
        lambda: f"{n(1, 400)}-{n(1, 400)}",
        lambda: "".join(rng.choice(list("0123456789abcdef"), int(rng.choice([16, 32, 40, 64])))),
    )
    return forms[n(0, len(forms))]()


def rewritten(text: str, rng: np.random.Generator) -> tuple[str, list[Span]]:
    """``text`` with its spans in other notations, mentioned again, and mixed with distractors; and where all spans are now."""
    base = base_spans(text)
    free = lambda a, b: all(b <= x or y <= a for _, x, y in base)
    spans = base + [(SECRET, m.start(1), m.end(1)) for m in _ASSIGNED.finditer(text) if free(m.start(1), m.end(1))]
    spans = sorted(spans, key=lambda s: s[1])
    spans = [s for k, s in enumerate(spans) if k == 0 or s[1] >= spans[k - 1][2]]
    inserts: list[tuple[int, int, str, int]] = []
    gaps = [m.start() for m in re.finditer(" ", text) if all(m.start() < a or m.start() >= b for _, a, b in spans)]
    for kind, a, b in spans:
        forms = FORMS[kind](text[a:b])
        form = text[a:b] if kind == SECRET or rng.random() < 0.5 else forms[int(rng.integers(len(forms)))]
        inserts.append((a, b, form, kind))
        if gaps and rng.random() < 0.6:
            at = gaps[int(rng.integers(len(gaps)))]
            inserts.append((at, at, " " + forms[int(rng.integers(len(forms)))], kind))
        if kind != SECRET and rng.random() < 0.3:  # right behind another one, where base patterns run over
            at = spans[int(rng.integers(len(spans)))][2]
            inserts.append((at, at, " " + text[a:b], kind))
    if gaps:
        for _ in range(6):
            at = gaps[int(rng.integers(len(gaps)))]
            inserts.append((at, at, " " + _distractor(rng), OUTSIDE))
    out, truth, at, length = [], [], 0, 0
    for a, b, form, kind in sorted(inserts, key=lambda x: x[:2]):
        out += [text[at:a], form]
        length += a - at
        if kind != OUTSIDE:
            truth.append((kind, length + len(form) - len(form.lstrip()), length + len(form)))
        length += len(form)
        at = b
    return "".join([*out, text[at:]]), truth


def train(texts: list[str]) -> Field:
    """Factors that maximise the pseudo-likelihood of rewritten texts: each label given its neighbours'."""
    rng = np.random.default_rng(8)
    k = OUTSIDE + 1
    rows, labels, left, right, similar = [], [], [], [], []
    for text in texts:
        new, truth = rewritten(text, rng)
        base = base_spans(new)
        # A match that joins several mentions is no label to learn from, but it is what the field will meet.
        nodes = nodes_of(new, base)
        if nodes is None:
            continue
        label = np.full(len(nodes.bounds), OUTSIDE)
        starts, ends = np.array(nodes.bounds).T
        for kind, a, b in truth:
            label[int(np.searchsorted(ends, a, "right")) : int(np.searchsorted(starts, b, "left"))] = kind
        sides = [np.zeros((len(label), k)) for _ in range(3)]
        (a, b), (c, d) = nodes.chain.T, nodes.skip.T
        np.add.at(sides[0], (b, label[a]), 1)
        np.add.at(sides[1], (a, label[b]), 1)
        np.add.at(sides[2], (c, label[d]), 1)
        np.add.at(sides[2], (d, label[c]), 1)
        for found, values in zip((rows, labels, left, right, similar), (nodes.features, label, *sides), strict=True):
            found.append(values)
    unary, chain, skip = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros((k, k))
    unary[0, OUTSIDE] = 5.0
    if not rows:
        return Field(unary, chain, skip)
    x, y, before, after, far = map(np.concatenate, (rows, labels, left, right, similar))
    target, n = np.eye(k)[y], len(y)
    factors = (unary, chain, skip)
    squares = [np.full_like(f, 1e-8) for f in factors]
    for _ in range(STEPS):
        score = x @ unary + before @ chain + after @ chain.T + far @ skip
        p = np.exp(score - score.max(1, keepdims=True))
        error = (target - p / p.sum(1, keepdims=True)) / n
        pull = far.T @ error
        slopes = (x.T @ error, before.T @ error + error.T @ after, pull + pull.T)
        for factor, slope, square in zip(factors, slopes, squares, strict=True):
            slope = slope - RIDGE * factor
            square += slope**2
            factor += RATE * slope / np.sqrt(square)
    return Field(*factors)


def marginals(nodes: Nodes, field: Field) -> np.ndarray:
    """The label distribution of each token after loopy belief propagation."""
    k = OUTSIDE + 1
    unary = nodes.features @ field.unary
    known = nodes.clamped >= 0
    unary[known] = -50.0
    unary[known, nodes.clamped[known]] = 0.0
    # A number as long as a card's that fails the check is no card by its own shape or its neighbours'.
    unary[nodes.features[:, LONG].astype(bool) & ~nodes.features[:, VALID].astype(bool) & ~known, CARD] = -50.0
    unary -= unary.max(1, keepdims=True)
    edges = np.concatenate([nodes.chain, nodes.skip])
    belief = unary
    if len(edges):
        factors = np.concatenate([np.repeat(field.chain[None], len(nodes.chain), 0), np.repeat(field.skip[None], len(nodes.skip), 0)])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        factor = np.exp(np.concatenate([factors, factors.transpose(0, 2, 1)]))
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), k))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            out = np.exp(out - out.max(1, keepdims=True))
            new = np.log(np.maximum(np.einsum("ei,eij->ej", out, factor), 1e-300))
            new -= new.max(1, keepdims=True)
            moved = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if moved < SETTLED:
                break
        belief = unary.copy()
        np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _fits(kind: int, found: str) -> bool:
    """Whether a whole added span can be of its kind."""
    digits = _NOT_DIGIT.sub("", found)
    if kind == EMAIL:
        name, _, host = _plain_address(found).partition("@")
        return bool(name and host)
    if kind == IP:
        parts = _NOT_DIGIT.sub(" ", found).split()
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts)
    if kind == CARD:
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == PHONE:
        return 7 <= len(digits) <= 15
    return _LONG_MIX.search(found) is not None


#: Digits of an added span at most; a further token of the same kind starts another one.
MOST_DIGITS = {IP: 12, CARD: 19, PHONE: 15, SECRET: 0}


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans outside base spans that the field is certain of; neighbours of a kind are one as far as its digits go."""
    nodes = nodes_of(text, base)
    if nodes is None or not (nodes.clamped < 0).any():
        return []
    p = marginals(nodes, field)
    best = p[:, :OUTSIDE].max(1)
    kind = np.where((nodes.clamped < 0) & (best >= LIKELY), p[:, :OUTSIDE].argmax(1), -1)
    joined = {a for a, _ in nodes.chain.tolist()}
    groups: list[list[float]] = []  # kind, start, end, highest marginal
    before = -2
    for k in np.flatnonzero(kind >= 0).tolist():
        start, end = nodes.bounds[k]
        follows = before == k - 1 and before in joined and kind[before] == kind[k] and text[start] != "+"
        if follows and len(_NOT_DIGIT.sub("", text[groups[-1][1] : end])) <= MOST_DIGITS.get(int(kind[k]), 10**9):
            groups[-1][2:] = [end, max(groups[-1][3], best[k])]
        else:
            groups.append([int(kind[k]), start, end, best[k]])
        before = k
    out: list[Span] = []
    for which, start, end, surest in groups:
        if surest < CERTAIN:
            continue
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        if end > start and text[start] == "(" and ")" not in text[start:end]:
            start += 1
        if end > start and text[end - 1] == ")" and "(" not in text[start:end]:
            end -= 1
        if end > start and _fits(which, text[start:end]):
            out.append((which, start, end))
    return out


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and base with added spans, both by kind and start."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, field))


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans by the first's."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Field:
    """The field for ``docs``, from a sample of at most SAMPLE of its texts.

    A threshold on the hash of id and text leaves about DRAWN of the texts that hold a digit or an at
    sign, whatever the size of the table; equal rows count once, and the SAMPLE least hashes are used.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(1 << 31)).alias("h"))
    useful = rows.filter(F.col("text").rlike("[0-9@]"))
    share = min(1.0, DRAWN / max(1, useful.count()))
    drawn = useful.filter(F.col("h") < int(share * (1 << 31))).groupBy("h").agg(F.min("text").alias("text"))
    texts = sorted((r["h"], r["text"]) for r in drawn.collect())
    return train([t for _, t in texts[:SAMPLE]])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the numbers of base spans by kind, base_sha256, all spans and their number."""
    ship(docs.sparkSession)
    field = fit(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, spans = all_spans(value.as_py() or "", field)
                counts = [sum(k == kind for k, _, _ in base) for kind in range(len(BASE_KINDS))]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            types = [pa.int64()] * len(BASE_KINDS) + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def redact_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text, and ``n_chars`` set to the new length; null texts stay."""
    ship(docs.sparkSession)
    field = fit(docs, doc_id, text)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [None if t is None else redact(t, all_spans(t, field)[1]) for t in texts]
            batch = batch.set_column(at, text, pa.array(new, pa.string()))
            yield batch

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(n_chars, F.coalesce(F.length(text).cast("long"), F.col(n_chars))) if n_chars in docs.columns else out
