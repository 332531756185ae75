"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

The field's nodes are the words of a text that hold a digit, ``@`` or ``+``; all others are observed as "outside".
Neighbouring nodes share a chain potential. Nodes of one text that are equal, or alike once digits and letters are
replaced by classes, share a skip potential however far apart (each with the next one like it, so the edges grow with
the nodes and not with their square). Words within a pattern's match have its label; loopy message passing carries the
labels over both kinds of edges, so that one entity gets one label throughout a document.

The weights are trained here, by pseudo-likelihood, on at most ``TRAIN_TEXTS`` texts of at most ``TRAIN_CHARS``
characters that have such words; the patterns give their labels.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.sketch import Shared
from quarry.llm.textbatch import chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
TRAIN_TEXTS, TRAIN_CHARS = 2_000, 20_000
FEATURES = 4096
ROUNDS, DAMPING = 8, 0.5
LEAST_POSTERIOR = 0.9
_OBSERVED = 30.0

_TRIGGER = np.zeros(256, bool)
_TRIGGER[list(b"0123456789@+")] = True
_SCALAR = (np.arange(256) & 0xC0) != 0x80

#: Fixed patterns. Possessive where the greedy run cannot end elsewhere, so that they are linear.
_MAIL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")
_MAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches: a local part starts after the last match or @ in its run of address characters."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _MAIL:
            start -= 1
        end = _MAIL_RUN.match(text, at).end()
        while 0 <= at < end:
            domain = _DOMAIN.match(text, at + 1) if at > start else None
            if domain:
                yield start, domain.end()
                start = domain.end()
            else:
                start = at + 1
            at = text.find("@", start, end)
        done = end
        at = text.find("@", end)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in characters, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


@dataclass
class Nodes:
    """The nodes of one text: word numbers, character spans, words and the words beside them."""

    number: list[int]
    span: list[tuple[int, int]]
    word: list[str]
    beside: list[tuple[str, str]]


def _nodes(batch_column: pa.Array) -> Iterator[tuple[int, str, Nodes]]:
    """Row, text and nodes of every text that has nodes."""
    for c in chunks(batch_column):
        start, end, first = c.words()
        triggers = np.concatenate(([0], np.cumsum(_TRIGGER[c.data])))
        active = np.flatnonzero(triggers[end] > triggers[start])
        if not len(active):
            continue
        scalars = np.concatenate(([0], np.cumsum(_SCALAR[c.data])))
        raw = c.data.tobytes()
        of = np.searchsorted(first, active, "right") - 1
        for text in np.unique(of):
            own = active[np.searchsorted(of, text) : np.searchsorted(of, text, "right")]
            lo, hi = first[text], first[text + 1]
            zero = scalars[c.offsets[text]]

            def word(k: int) -> str:
                return raw[start[k] : end[k]].decode() if lo <= k < hi else ""

            yield (
                int(text) + c.first,
                raw[c.offsets[text] : c.offsets[text + 1]].decode(),
                Nodes((own - lo).tolist(), [(int(scalars[start[k]] - zero), int(scalars[end[k]] - zero)) for k in own], [word(k) for k in own], [(word(k - 1), word(k + 1)) for k in own]),
            )


def _shape(word: str) -> str:
    return re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", word)))


def _trimmed(word: str) -> str:
    return word.strip(".,;:!?\"'()[]|%&$*#")


def _features(word: str, beside: tuple[str, str]) -> list[int]:
    core = _trimmed(word)
    shape = _shape(core)
    short = re.sub(r"(.)\1+", r"\1+", shape)
    digits = len(_digits(core))
    names = [
        "bias", f"shape {shape[:24]}", f"short {short[:24]}", f"digits {min(digits, 20)}", f"first {word[:1]}", f"dots {min(core.count('.'), 4)}", f"at {'@' in core}",
        f"plus {word.startswith('+')}", f"share {4 * digits // max(1, len(core))}", f"before {_shape(_trimmed(beside[0]))[:8]}", f"after {_shape(_trimmed(beside[1]))[:8]}",
        f"cue {_trimmed(beside[0]).lower()[-12:]}",
    ]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _edges(nodes: Nodes) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges and skip edges between node numbers."""
    chain = [(i, i + 1) for i in range(len(nodes.number) - 1) if nodes.number[i + 1] == nodes.number[i] + 1]
    skip, last = [], {}
    for i, word in enumerate(nodes.word):
        core = _trimmed(word)
        for key in {("same", core), ("like", _shape(core))}:
            if key in last and last[key] + 1 < i:
                skip.append((last[key], i))
            last[key] = i
    return chain, sorted(set(skip))


def _labels(nodes: Nodes, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each node that a pattern's match overlaps, else 0 (outside)."""
    out = np.zeros(len(nodes.span), np.int64)
    if spans:
        starts = np.array([s for s, _ in nodes.span])
        ends = np.array([e for _, e in nodes.span])
        for kind, a, b in spans:
            lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b)
            out[lo:hi] = kind + 1
    return out


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label x next label
    skip: np.ndarray  # symmetric


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[str], steps: int = 150, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Weights that maximise the pseudo-likelihood of the patterns' labels (Adam over all nodes)."""
    k = len(LABELS)
    feats, labels, chain, skip, alone = [], [], [], [], []
    for _, text, nodes in _nodes(pa.array(texts, pa.string())):
        base = len(feats)
        own_chain, own_skip = _edges(nodes)
        feats += [_features(w, b) for w, b in zip(nodes.word, nodes.beside)]
        labels += _labels(nodes, base_spans(text)).tolist()
        chain += [(a + base, b + base) for a, b in own_chain]
        skip += [(a + base, b + base) for a, b in own_skip]
        alone += [base + i for i in range(len(nodes.word))]
    field = Field(np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
    if not feats:
        return field
    x, y = np.array(feats), np.array(labels)
    one = np.eye(k)
    c, s = np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)
    before, after, alike = np.zeros((len(y), k)), np.zeros((len(y), k)), np.zeros((len(y), k))
    before[:, 0] = after[:, 0] = 1  # a neighbour that isn't a node is outside
    before[c[:, 1]] = one[y[c[:, 0]]]
    after[c[:, 0]] = one[y[c[:, 1]]]
    np.add.at(alike, s[:, 0], one[y[s[:, 1]]])
    np.add.at(alike, s[:, 1], one[y[s[:, 0]]])
    weights = [field.unary, field.chain, field.skip]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, steps + 1):
        score = field.unary[x].sum(1) + before @ field.chain + after @ field.chain.T + alike @ field.skip
        error = (one[y] - _softmax(score)) / len(y)
        unary = np.zeros_like(field.unary)
        np.add.at(unary, x.ravel(), np.repeat(error, x.shape[1], axis=0))
        skip_step = alike.T @ error
        steps_ = [unary, before.T @ error + (after.T @ error).T, skip_step + skip_step.T]
        for i, (w, g) in enumerate(zip(weights, steps_)):
            g = g - decay / len(y) * w
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w += rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return field


def posterior(field: Field, nodes: Nodes, observed: np.ndarray) -> np.ndarray:
    """Label probabilities of the nodes by loopy sum-product; a label in ``observed`` other than 0 is given."""
    k = len(LABELS)
    n = len(nodes.word)
    unary = field.unary[np.array([_features(w, b) for w, b in zip(nodes.word, nodes.beside)])].sum(1)
    chain, skip = _edges(nodes)
    has_before, has_after = np.zeros(n, bool), np.zeros(n, bool)
    for a, b in chain:
        has_after[a], has_before[b] = True, True
    unary[~has_before] += field.chain[0]
    unary[~has_after] += field.chain[:, 0]
    given = np.flatnonzero(observed)
    unary[given, observed[given]] += _OBSERVED
    edges = np.array(chain + skip, np.int64).reshape(-1, 2)
    if not len(edges):
        return _softmax(unary)
    pair = np.concatenate([np.repeat(field.chain[None], len(chain), 0), np.repeat(field.skip[None], len(skip), 0)])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), k))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, message)
        out = (belief[source] - message[back])[:, :, None] + pair
        top = out.max(1)
        out = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        out -= out.max(1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * out
    belief = unary.copy()
    np.add.at(belief, target, message)
    return _softmax(belief)


def added_spans(field: Field, nodes: Nodes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the runs of nodes that the field labels surely and no pattern's match overlaps."""
    observed = _labels(nodes, base)
    p = posterior(field, nodes, observed)
    label = p.argmax(1)
    sure = (p.max(1) >= LEAST_POSTERIOR) & (label > 0) & (observed == 0)
    out, i = [], 0
    while i < len(label):
        j = i + 1
        if sure[i]:
            while j < len(label) and sure[j] and label[j] == label[i] and nodes.number[j] == nodes.number[j - 1] + 1:
                j += 1
            first, last = nodes.word[i], nodes.word[j - 1]
            lead = len(first) - len(first.lstrip(".,;:!?\"'[]|%&$*#"))
            tail = len(last) - len(last.rstrip(".,;:!?\"'[]|%&$*#"))
            start, end = nodes.span[i][0] + lead, nodes.span[j - 1][1] - tail
            if start < end:
                out.append((int(label[i]) - 1, start, end))
        i = j
    return out


def train(docs: DataFrame, text_col: str = "text", texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> Field:
    """The field, from the ``texts`` distinct texts with the smallest hashes among those with nodes and at most ``chars`` characters."""
    text = F.col(text_col)
    pool = docs.select(text.alias("text")).filter((F.length(text) <= chars) & text.rlike("[0-9@+]")).withColumn("h", F.xxhash64("text"))
    smallest = [r["h"] for r in pool.select("h").distinct().orderBy("h").limit(texts).collect()]
    if not smallest:
        return fit([])
    sample = pool.filter(F.col("h") <= smallest[-1]).groupBy("h").agg(F.min("text").alias("text"))
    return fit([r["text"] for r in sample.orderBy("h").collect()])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256, n_added, spans.

    The counts and the hash are of the patterns' matches; ``spans`` are those and the ones that the field adds, all as
    kind:start:end in characters, by kind and start. Null and empty texts have no span. Repeated rows are each searched
    and null ids kept. Other columns are ignored. An empty table gives an empty result.
    """
    shared = Shared(docs.sparkSession, field or train(docs, text_col))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((len(KINDS) + 1, n), np.int64)
            sha, spans = [empty] * n, [""] * n
            for row, text, nodes in _nodes(batch.column(1)):
                base = base_spans(text)
                more = added_spans(shared.value, nodes, base)
                for kind, _, _ in base:
                    counts[kind, row] += 1
                counts[-1, row] = len(more)
                sha[row] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[row] = _joined(base + more)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in counts[:-1]), pa.array(sha), pa.array(counts[-1]), pa.array(spans)], schema.names)

    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("n_added", T.LongType()), T.StructField("spans", T.StringType())]
    )
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary")).mapInArrow(search, schema).withColumnRenamed("id", id_col)
