"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    w = words(text)
    n = len(w)
    places = defaultdict(list)
    for i in range(n - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Shares by weight, the excess over three times a source's size shared again until none is above."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: 1 + k % 3 for k, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in full]
        rest = total - sum(3 * sizes[n] for n in full)
        whole = sum(weight[n] for n in free)
        share = {n: 3 * sizes[n] if n in full else rest * weight[n] / whole for n in names}
        above = {n for n in free if share[n] > 3 * sizes[n]}
        if not above:
            return share
        full |= above


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def links(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> tuple[list[int], list[int]]:
    """For each row its group's least id and its number of links."""
    sets = [shingles(t) for _, t in rows]
    n, count, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def top(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                count[i] += 1
                count[j] += 1
                root[top(i)] = top(j)
    least = {}
    for k in range(n):
        least[top(k)] = min(least.get(top(k), rows[k][0]), rows[k][0])
    return [least[top(k)] for k in range(n)], count


def removed(rows: list[tuple[int | None, str | None]], size: int = 13) -> list[tuple]:
    first: dict[tuple, int] = {}
    split = [(d, words(t)) for d, t in rows]
    for d, w in split:
        for p in range(len(w) - size + 1 if d is not None else 0):
            key = tuple(w[p : p + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        keep = [True] * len(w)
        for p in range(len(w) - size + 1 if d is not None else 0):
            if first[tuple(w[p : p + size])] < d:
                keep[p : p + size] = [False] * size
        left = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((d, len(w), len(w) - sum(keep), hashlib.sha256(left.encode()).hexdigest()))
    return out


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            checks = (lambda: True, lambda: all(int(p) <= 255 for p in m[0].split(".")), lambda: 16 <= len(digits) <= 19 and luhn(digits), lambda: 8 <= len(digits) <= 15)  # noqa: B023
            if checks[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def top_products(vectors: list[tuple[int, list[float]]], k: int = 20, every: int = 20) -> list[tuple[int, int, int, int]]:
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors]
    out = []
    for q, a in {i: min(v for j, v in whole if j == i) for i, _ in whole}.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def counted(values: list) -> Counter:
    return Counter(values)


def best_cut(values: list[float]) -> float:
    """Between the two clusters of least squares, by trying every cut."""
    v = sorted(values)
    if v[-1] - v[0] < 1e-9:
        return v[0] / 2 if v[0] > 0 else math.inf
    spread = lambda part: sum((x - sum(part) / len(part)) ** 2 for x in part)
    k = min(range(1, len(v)), key=lambda k: spread(v[:k]) + spread(v[k:]))
    return (v[k - 1] + v[k]) / 2


def main_text(html: str) -> str:
    """The text of the best region of a well-formed page, from its tokens and by weighing each container by itself."""
    blocks = "article aside body div footer h1 html li main nav p section ul table tr td br".split()
    tokens = re.findall(r"<[^>]+>|[^<]+", re.sub(r"<head>.*?</head>|<(script|style)>.*?</\1>", lambda m: "<x>" * (m[0].count("<")), html, flags=re.S))
    lines, path, text, links, before, ids = [], [(0, "html", False)], "", 0, 0, 0
    before = 0

    def end():
        nonlocal text, links, before
        if " ".join(text.split()):
            lines.append([" ".join(text.split()), before, list(path), min(links, len(" ".join(text.split())))])
            before = links = 0
        text = ""

    for token in tokens:
        name = re.match(r"</?(\w+)", token)
        if not name:
            text += entities.unescape(token)
            links += len(entities.unescape(token).strip()) if any(t == "a" for _, t, _ in path) else 0
            continue
        tag = name[1]
        if tag in blocks:
            end()
        before += 1
        if token.startswith("</"):
            while path.pop()[1] != tag:
                pass
        elif tag not in ("br", "x"):
            ids += 1
            words = set(re.findall(r"class=\"?([\w -]+)", token)[0].split()) if "class=" in token else set()
            path.append((ids, tag, tag in ("nav", "aside", "footer", "form", "header") or bool(words & {"ad", "menu", "sidebar", "footer", "comments"})))
    end()
    if not lines:
        return ""
    after = [n for _, n, _, _ in lines[1:]] + [before]
    furniture = [any(f for *_, f in p) for _, _, p, _ in lines]
    ratio = [(len(t) - k) / (1 + n + m) * (0.25 if f else 1) for (t, n, _, k), m, f in zip(lines, after, furniture, strict=True)]
    level = []
    for i in range(len(lines)):
        near = [(math.exp(-((i - j) ** 2) / 18), math.log(1 + ratio[j])) for j in range(len(lines)) if abs(i - j) <= 10]
        level.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    cut = best_cut(level)
    start = max(range(len(lines)), key=lambda i: (not furniture[i], ratio[i], -i))
    holders = [e for e in lines[start][2] if e[1] in ("article", "body", "div", "html", "main", "section", "table", "td")]
    weight = lambda e: sum((x - cut) * (0.25 if f and x > cut else 1) for (_, _, p, _), x, f in zip(lines, level, furniture, strict=True) if e in p)
    best = max(holders, key=lambda e: (round(weight(e), 6), e[0]))
    return " ".join(t for (t, _, p, _), r, f in zip(lines, ratio, furniture, strict=True) if best in p and (math.log(1 + r) >= cut or not f))


def article_text(html: str) -> str:
    """The text of the only article of a page of the test tables, by its tags."""
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", html, re.S)[1]
    parts = [re.sub("</?b>", "", x) for x in re.split(r"<(?!/?b>)[^>]*>", body)]
    return " ".join(filter(None, (" ".join(entities.unescape(x).split()) for x in parts)))


def label_marginals(nodes, field, op):
    """The label distribution of each token, by summing over all labellings."""
    import itertools

    import numpy as np

    unary = nodes.features @ field.unary
    for i, kind in enumerate(nodes.clamped):
        if kind >= 0:
            unary[i], unary[i, kind] = -50.0, 0.0
        elif nodes.features[i][op.LONG] and not nodes.features[i][op.VALID]:
            unary[i, op.CARD] = -50.0
    out = np.zeros_like(unary)
    top = unary.max(1).sum() + 10 * (len(nodes.chain) + len(nodes.skip))
    for labels in itertools.product(range(unary.shape[1]), repeat=len(unary)):
        score = sum(unary[i, y] for i, y in enumerate(labels))
        score += sum(field.chain[labels[a], labels[b]] for a, b in nodes.chain) + sum(field.skip[labels[a], labels[b]] for a, b in nodes.skip)
        for i, y in enumerate(labels):
            out[i, y] += math.exp(score - top)
    return out / out.sum(1, keepdims=True)


def license_digest(text: str | None) -> str | None:
    """The digest of a text's canonical form, line by line and word by word."""
    openings = [
        "permission is hereby granted", "permission to use", "redistribution and use", "this software is provided", "permission is granted", "licensed under",
        "this is free and unencumbered", "all rights reserved",
    ]
    any_opening = "|".join(openings)
    lines = (text or "").lower().split("\n")
    marks = r"(copyright|\(c\)|©)"
    lines = [re.sub(rf"{marks}[^a-z]*(\(c\)|©|\d{{4}}).{{0,200}}?[^a-z0-9]({any_opening})", r" \3", x, flags=re.ASCII) for x in lines]
    lines = [re.sub(rf"all rights reserved[^a-z0-9]*({any_opening})", r" \1", x) for x in lines]
    lines = ["" if re.match(rf"[^a-z0-9]*{marks}[^a-z]*(\(c\)|©|[0-9]{{4}}|by[^a-z0-9])", x) or re.fullmatch("[^a-z0-9]*all rights reserved[^a-z0-9]*", x) else x for x in lines]
    form = "".join(c if c.isalpha() or c.isnumeric() else " " for c in "\n".join(lines))
    form = " ".join(form.split())
    for a, b in (
        ("licenc", "licens"), ("copyright owner", "copyright holder"), ("copyright holders", "copyright holder"), ("isation", "ization"), ("authoris", "authoriz"),
        ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"), ("realis", "realiz"), ("favour", "favor"), ("labour", "labor"), ("colour", "color"),
        ("honour", "honor"), ("fulfill", "fulfil"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("non commercial", "noncommercial"),
        ("merchantibility", "merchantability"), ("whilst", "while"), ("https ", "http "),
    ):
        form = form.replace(a, b)
    return hashlib.sha256(form.encode()).hexdigest() if form else None


def mcd(vectors, floors: list[float], unit: int, share: float, steps: int, width: int):
    """The reweighted MCD estimate (location, scatter) of one group by plain matrices, with the operator's starts and bins."""
    import numpy as np

    from corpusloom.llm.op01_quality import BINS, STEPS, _consistency, chi2_quantile

    x = np.array(vectors, float)
    n, p = x.shape
    floor = np.array(floors) * unit

    def fit(part, factor):
        m = part.mean(0)
        return m, factor * ((part - m).T @ (part - m) / len(part)) + np.diag(floor**2)

    def distance(m, c):
        return np.einsum("ij,ij->i", x - m, np.linalg.solve(c, (x - m).T).T)

    def at(column, q):
        cells = np.sort(np.floor(column / width))
        return (cells[np.flatnonzero(np.arange(1, n + 1) >= q * n)[0]] + 0.5) * width

    middle = np.array([at(x[:, j], 0.5) for j in range(p)])
    spread = np.maximum([(at(x[:, j], 0.75) - at(x[:, j], 0.25)) / 1.349 for j in range(p)], floor)
    m, c = fit(x, 1.0)
    found = []
    for m, c in ((middle, np.diag(spread**2)), (m, np.diag(np.diag(np.linalg.cholesky(c)) ** 2))):
        for _ in range(steps):
            bins = np.minimum(BINS, np.floor(np.log2(1 + distance(m, c)) * STEPS))
            before = np.array([(bins < b).sum() for b in bins])
            m, c = fit(x[before < share * n], _consistency(share, p))
        found.append((np.linalg.slogdet(c)[1], len(found), m, c))
    _, _, m, c = min(found, key=lambda f: f[:2])
    return fit(x[distance(m, c) <= chi2_quantile(0.975, p)], _consistency(0.975, p))
