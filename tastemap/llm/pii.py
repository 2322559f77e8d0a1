"""Personal data by base rules and a skip-chain conditional random field.

Base spans are exact: emails, IPv4 addresses, card numbers and phone numbers by
the rules below, each found in time linear in the text.  They stay as they are.

The field's nodes are the base spans, each one node that is held to its kind,
and the other tokens (runs without white space) that hold a digit or an ``@``,
which it labels with one of ``KINDS`` or none.  Unary potentials come from a
token's shape, neighbours in the text are joined by chain potentials, and skip
edges join mentions of one content, however far apart: the digits of a whole
span or token, or an address up to its domain's first label.  Contents agree
when they are equal, or when the digits of one end in those of the other (a
number without its country or area code; not for IP addresses, which have no
such short form).  Each node is joined to the last one of equal digits, of the
next shorter and of any next longer ones.  Loopy sum-product message passing
then lets distant mentions agree, and a token becomes a span when the marginal
of a kind reaches ``SURE`` and its content agrees with that of a base span of
the text (agreeing doubtful tokens alone don't make each other sure).

Potentials are fitted piecewise on a sample of at most about ``SAMPLE_DOCS``
texts that the base rules label (but for tokens that agree with a base span,
which are left open): a softmax regression for the shapes, and smoothed
label-pair ratios for the chain and skip edges.

Edge cases: null and empty texts hold nothing; the same token repeated any
number of times costs one edge a repetition; repeated rows get equal results;
with no base span in the sample nothing is added.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.text import drawn, fields_and, map_arrow, n_texts, slices, text_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 2000
SURE = 0.9
ROUNDS = 12             # of message passing
BATCH_DOCS = 512

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S++")
_HINT = re.compile(r"[0-9@]").search
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def emails(text: str):
    at, free = text.find("@"), 0             # free: end of the last match
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else max(free, start)
        if domain:
            yield start, free
        # Without a match the same run could only fail again before this sign.
        at = text.find("@", max(at + 1, free))
        if not domain:
            free = max(free, start)


def ips(text: str):
    for chain in _DOTTED.finditer(text):
        groups, at = chain.group().split("."), chain.start()
        for i in range(0, len(groups) - 3, 4):
            four = groups[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g[-4:]) <= 255 for g in four):
                yield at, at + size
            at += size + 1


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), sorted; offsets in code points."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(a, 1, b) for a, b in ips(text)] if "." in text else []
        out += [(a, 2, b) for a, b in cards(text)]
        out += [(a, 3, b) for a, b in phones(text)] if "+" in text else []
    return sorted(out)


class Tokens(NamedTuple):
    """Tokens of some texts that hold a digit or an @, and the field's nodes:
    base spans, and tokens that meet none."""

    shape: np.ndarray       # a token's features
    label: np.ndarray       # kind of the base span a token meets, from 1; 0 for none
    doc: np.ndarray         # of a node, as all that follow
    first: np.ndarray       # number of its first token among all tokens of the text
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray         # its token's row in shape; -1 for a base span
    held: np.ndarray        # kind of the base span it is, from 1; 0 for none
    agrees: np.ndarray      # whether its content agrees with that of a base span
    skip: np.ndarray        # pairs of nodes joined by a skip edge


def _shape(token: str) -> list[float]:
    digits = len(_NOT_DIGIT.sub("", token))
    return [1.0, "@" in token, "." in token, "+" in token, "-" in token, "(" in token or ")" in token,
            any(c.isalpha() for c in token), digits >= 1, digits >= 4, digits >= 7, digits >= 9, digits >= 12,
            digits >= 16, digits > 19, digits >= 12 and _luhn(_NOT_DIGIT.sub("", token)), token.count(".") == 3]


SHAPE_WIDTH = len(_shape("0"))


def _bare(text: str, a: int, b: int) -> tuple[int, int]:
    """The stretch without what is neither letter nor digit at its ends."""
    while a < b and not text[a].isalnum():
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _content(mention: str) -> str:
    """What equal or similar mentions share; '' for those too slight to tell."""
    if "@" in mention:
        a, b = _bare(mention, 0, len(mention))
        local, _, domain = mention[a:b].lower().partition("@")
        return f"{local}@{domain.split('.')[0]}" if local and domain else ""
    digits = _NOT_DIGIT.sub("", mention)
    return digits if len(digits) >= 5 else ""


def _endings(numbers: set[str]) -> dict[str, str]:
    """number -> the longest other one that it ends in, shorter ones first."""
    out, open_ones = {}, []
    for n in sorted(x[::-1] for x in numbers):
        while open_ones and not n.startswith(open_ones[-1]):
            open_ones.pop()
        out[n[::-1]] = open_ones[-1][::-1] if open_ones else ""
        open_ones.append(n)
    return out


def _mentions(contents: list[str], held: list[int]) -> tuple[list[tuple[int, int]], list[bool]]:
    """Skip edges of a text's nodes, and which agree with a base span."""
    ip = 1 + KINDS.index("ip")
    number = [c != "" and "@" not in c and h != ip for c, h in zip(contents, held)]
    shorter = _endings({c for c, n in zip(contents, number) if n})
    edges, equal, numbers, longer = [], {}, {}, {}       # content -> the last node of it, or of one that ends in it
    for i, (c, n) in enumerate(zip(contents, number)):
        if not c:
            continue
        if c in equal:
            edges.append((equal[c], i))
        equal[c] = i
        if n:
            edges += [(x[k], i) for x, k in ((numbers, shorter[c]), (longer, c)) if k in x]
            numbers[c] = i
            if shorter[c]:
                longer[shorter[c]] = i
    base = {c for c, h in zip(contents, held) if h and c}
    below = {c for c, h, n in zip(contents, held, number) if h and n}       # a base span's, or ends in one
    above = set(below)                                                      # a base span's, or one ends in it
    for c, short in shorter.items():
        if short in below:
            below.add(c)
    for c, short in reversed(shorter.items()):
        if c in above and short:
            above.add(short)
    return edges, [c in base or n and (c in below or c in above) for c, n in zip(contents, number)]


def find_tokens(texts: list[str], base: list[list]) -> Tokens:
    shape, label, nodes, agrees, skip = [], [], [], [], []
    for d, text in enumerate(texts):
        if not _HINT(text):
            continue
        found = [m.span() for m in _TOKEN.finditer(text)]
        starts, ends = [a for a, _ in found], [b for _, b in found]
        own, met = [], {}                       # token's number -> kind of the first base span it meets
        for a, kind, b in base[d]:
            first, last = bisect_right(ends, a), bisect_left(starts, b) - 1
            own.append((a, b, first, last, -1, 1 + kind))
            for k in range(first, last + 1):
                met.setdefault(k, 1 + kind)
        for k, (a, b) in enumerate(found):
            token = text[a:b]
            if not _HINT(token):
                continue
            if k not in met:
                own.append((a, b, k, k, len(shape), 0))
            shape.append(_shape(token))
            label.append(met.get(k, 0))
        own.sort()
        edges, agree = _mentions([_content(text[n[0]:n[1]]) for n in own], [n[5] for n in own])
        skip += [(len(nodes) + i, len(nodes) + j) for i, j in edges]
        agrees += agree
        nodes += [(d, first, last, a, b, row, kind) for a, b, first, last, row, kind in own]
    return Tokens(np.array(shape, float).reshape(len(shape), SHAPE_WIDTH), np.array(label, np.int64),
                  *np.array(nodes, np.int64).reshape(-1, 7).T, np.array(agrees, bool),
                  np.array(skip, np.int64).reshape(-1, 2))


def chain_edges(t: Tokens) -> np.ndarray:
    """Pairs of nodes that follow each other in a text."""
    i = np.flatnonzero((t.doc[1:] == t.doc[:-1]) & (t.first[1:] == t.last[:-1] + 1))
    return np.stack([i, i + 1], axis=1)


class Model(NamedTuple):
    weights: np.ndarray     # shape features x labels
    chain: np.ndarray       # log potentials of neighbours
    skip: np.ndarray        # log potentials along skip edges


def fit_potentials(x: np.ndarray, y: np.ndarray, times: np.ndarray, nodes: np.ndarray, chain: np.ndarray,
                   skip: np.ndarray) -> Model:
    """Piecewise: shapes and labels of tokens, how often each pair occurs, how
    many nodes have each label, and ``chain`` and ``skip``, label pairs of nodes seen on such edges."""
    n = len(KINDS) + 1
    w, target = np.zeros((x.shape[1], n)), np.eye(n)[y]
    weighted = (x * (times / times.sum())[:, None]).T
    for _ in range(300):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w += 1.0 * (weighted @ (target - p) - 1e-4 * w)
    share = (nodes + 1) / (nodes.sum() + n)

    def ratio(pairs, prior):
        seen = np.zeros((n, n))
        np.add.at(seen, (pairs[:, 0], pairs[:, 1]), 1)
        seen = seen + seen.T + prior
        return np.log(seen / seen.sum() / (share[:, None] * share[None, :]))

    # Ratios are damped, since chain and unary evidence overlap.
    return Model(w, 0.5 * ratio(chain, np.full((n, n), 0.5)), ratio(skip, 0.05 + 2.0 * np.eye(n)))


def _messages(unary: np.ndarray, edges: np.ndarray, potential: np.ndarray, rounds: int) -> np.ndarray:
    """Marginals by loopy sum-product; each edge has a potential per direction."""
    n, k = unary.shape
    to = np.concatenate([edges[:, 1], edges[:, 0]])
    frm = np.concatenate([edges[:, 0], edges[:, 1]])
    pot = np.exp(np.concatenate([potential, potential.transpose(0, 2, 1)]))
    m, back = np.zeros((len(to), k)), np.roll(np.arange(len(to)), len(edges))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, to, m)
        sent = belief[frm] - m[back]                       # without what came along this edge
        sent = np.exp(sent - sent.max(axis=1, keepdims=True))
        new = np.log(np.maximum(np.einsum("ei,eij->ej", sent, pot), 1e-300))
        m = 0.5 * m + 0.5 * (new - new.max(axis=1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, to, m)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def added_spans(texts: list[str], base: list[list], model: Model) -> list[list[tuple[int, int, int]]]:
    """Spans of the field besides the base spans."""
    out: list = [[] for _ in texts]
    t = find_tokens(texts, base)
    if not len(t.skip):
        return out
    known = t.held > 0
    unary = np.full((len(t.doc), model.weights.shape[1]), -50.0)
    unary[~known] = t.shape[t.row[~known]] @ model.weights
    unary[known, t.held[known]] = 0.0
    chain = chain_edges(t)
    edges = np.concatenate([chain, t.skip])
    potential = np.concatenate([np.broadcast_to(model.chain, (len(chain), *model.chain.shape)),
                                np.broadcast_to(model.skip, (len(t.skip), *model.skip.shape))])
    p = _messages(unary, edges, potential, ROUNDS)
    label = p.argmax(axis=1)
    for i in np.flatnonzero(t.agrees & ~known & (label > 0) & (p.max(axis=1) >= SURE)).tolist():
        a, b = _bare(texts[t.doc[i]], int(t.start[i]), int(t.end[i]))
        if a < b:
            out[t.doc[i]].append((a, int(label[i]) - 1, b))
    return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Potentials from a sample of about ``sample_docs`` different texts that
    hold a digit or an @."""
    rows = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    n = rows.agg(n_texts()).first()[0]
    # Drawn by the text: the same sample whatever the ids and however often a row repeats.
    sample = rows.filter(drawn("pii") < min(1.0, sample_docs / max(1, n))).dropDuplicates(["text"])

    def run(batches):
        for batch in batches:
            texts = [text_of(t) for t in batch.column("text").to_pylist()]
            for s in slices(len(texts), BATCH_DOCS):
                t = find_tokens(texts[s], [base_spans(x) for x in texts[s]])
                if not len(t.doc):
                    continue
                # Equal (shape, label) pairs and label pairs are summed here, so little is sent.
                # A token that agrees with a base span has no label yet: the field is to give it one.
                open_ones = t.agrees & (t.held == 0)
                told = np.ones(len(t.label), bool)
                told[t.row[open_ones]] = False
                chain, skip = (e[~open_ones[e].any(axis=1)] for e in (chain_edges(t), t.skip))
                seen, times = np.unique(np.column_stack([t.shape, t.label])[told], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes()], pa.binary()) for v in
                     (np.column_stack([seen, times]), np.bincount(t.held[~open_ones], minlength=len(KINDS) + 1),
                                                             t.held[chain], t.held[skip])], ["shapes", "nodes", "chain", "skip"])

    rows = map_arrow(sample, run, "shapes binary, nodes binary, chain binary, skip binary").toArrow()
    if not rows.num_rows:
        return None
    width = SHAPE_WIDTH + 2
    x = np.concatenate([np.frombuffer(v, float).reshape(-1, width) for v in rows["shapes"].to_pylist()])
    # Summed over the whole sample, in an order of their own: no matter how its rows are dealt out.
    pairs, which = np.unique(x[:, :-1], axis=0, return_inverse=True)
    times = np.bincount(which.ravel(), weights=x[:, -1])
    x, y = pairs[:, :-1], pairs[:, -1].astype(int)
    if not y.any():
        return None
    chain, skip = (np.concatenate([np.frombuffer(v, np.int64).reshape(-1, 2) for v in rows[c].to_pylist()])
                   for c in ("chain", "skip"))
    nodes = sum(np.frombuffer(v, np.int64) for v in rows["nodes"].to_pylist())
    return fit_potentials(x, y, times, nodes, chain, skip)


def find(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with base and added spans (arrays of start, kind,
    end in code points) of every row's text, and the redacted text (null for
    a null text)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def rows(spans):
        return pa.array([[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in s] for s in spans], kind)

    def run(batches):
        for batch in batches:
            texts = [text_of(t) for t in batch.column("_text").to_pylist()]
            for s in slices(len(texts), BATCH_DOCS):
                base = [base_spans(t) for t in texts[s]]
                more = added_spans(texts[s], base, model) if model else [[] for _ in base]
                kept = [batch.column(i)[s] for i in range(len(keep))]
                clean = [t and redact(text_of(t), [(a, KINDS[k], e) for a, k, e in b + m])
                         for t, b, m in zip(batch.column("_text")[s].to_pylist(), base, more)]
                yield pa.RecordBatch.from_arrays([*kept, rows(base), rows(more), pa.array(clean, pa.string())],
                                                 [*keep, "base", "added", "redacted"])

    spans = "array<struct<start: long, kind: string, end: long>>"
    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")), run,
                     fields_and(docs, keep, f"base {spans}, added {spans}, redacted string"))


def redact(text: str, spans) -> str:
    """The text with each span (start, kind, end) replaced by its kind in
    brackets; of overlapping spans the united stretch, under the first's kind."""
    if not spans:
        return text
    out, at = [], 0
    merged: list = []
    for a, kind, b in sorted(spans):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([a, kind, b])
    for a, kind, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, their digest, and all spans."""
    found = find(docs.select("doc_id", "text"), fit(docs), ["doc_id"])
    order = F.array(*map(F.lit, KINDS))

    def listed(spans):
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"),
                                                      s["end"].alias("b")))
        return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
            ":", F.element_at(order, s["k"].cast("int")), s["a"], s["b"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.concat("base", "added")).alias("spans"))
