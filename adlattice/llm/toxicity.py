"""Toxicity by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

Every word enters as two vectors: an embedding of the word itself (words that the training texts hold often enough, any
other is unknown) and the mean of embeddings of its character trigrams. Texts are read in windows of ``WINDOW`` words, each
overlapping the next by half. Two gated recurrent networks read a window from both ends, attention weighs the states of
its words, and the weighted mean gives the window's logit. A document's logit is its largest window's; a logistic curve
fitted to the training documents turns it into a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import blocks, span_hashes, text_buffers, word_bounds

WINDOW, STRIDE = 48, 24
WORD_DIMS, CHAR_DIMS, HIDDEN, ATTENTION = 12, 8, 8, 8
TRIGRAMS = 1 << 12
#: Bounds of the training sample: labelled rows per class, characters of a text that may be chosen, known words.
TRAIN_ROWS, TRAIN_CHARS, TRAIN_WORDS = 1200, 20_000, 20_000
#: Bytes of texts that are taken apart at once.
TRAIN_BLOCK, SCORE_BLOCK = 1 << 17, 1 << 18
#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
DECAY = 1e-3
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.exp(-x)
        out += 1
        return np.reciprocal(out, out=out)


@dataclass
class Words:
    """The words of some texts: distinct hashes with their trigrams, each word's place among them, first word by text."""

    distinct: np.ndarray
    trigrams: np.ndarray
    trigram_starts: np.ndarray
    place: np.ndarray
    first: np.ndarray


def read_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
    begin, stop, first = word_bounds(data, starts, ends, _BREAK)
    distinct, sample, place = np.unique(span_hashes(data, begin, stop, lower=True), return_index=True, return_inverse=True)
    begin, size = begin[sample], (stop - begin)[sample]
    at = np.concatenate(([0], np.cumsum(size)))
    inner = np.arange(at[-1]) - np.repeat(at[:-1], size)
    here = np.repeat(begin, size) + inner
    letters = _LOWER[data]
    before = np.where(inner > 0, letters[np.maximum(here - 1, 0)], 0)
    after = np.where(inner < np.repeat(size, size) - 1, letters[np.minimum(here + 1, max(len(data) - 1, 0))], 0)
    trigrams = (before * 961 + letters[here] * 31 + after) * 40503 % 65537 % TRIGRAMS
    return Words(distinct, trigrams, at, place, first)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end word of all windows, and where each text's windows begin. A text without words has none."""
    counts = np.diff(first)
    made = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
    bounds = np.concatenate(([0], np.cumsum(made)))
    text = np.repeat(np.arange(len(counts)), made)
    begin = first[:-1][text] + (np.arange(bounds[-1]) - bounds[:-1][text]) * STRIDE
    return begin, np.minimum(begin + WINDOW, first[1:][text]), bounds


class Network:
    """Weights, forward pass and gradients. ``vocabulary`` holds the sorted hashes of the known words."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)

        def matrix(*shape):
            return (draw.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])).astype(np.float32)

        self.vocabulary = vocabulary
        self.w = {
            "word": 0.1 * draw.standard_normal((len(vocabulary) + 1, WORD_DIMS)).astype(np.float32),
            "char": 0.1 * draw.standard_normal((TRIGRAMS, CHAR_DIMS)).astype(np.float32),
            "in": matrix(WORD_DIMS + CHAR_DIMS, 6 * HIDDEN), "in_b": np.zeros(6 * HIDDEN, np.float32),
            "state0": matrix(HIDDEN, 3 * HIDDEN), "state1": matrix(HIDDEN, 3 * HIDDEN),
            "att": matrix(2 * HIDDEN, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": matrix(ATTENTION),
            "out": matrix(2 * HIDDEN), "out_b": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0

    def rows(self, words: Words) -> np.ndarray:
        """Row of the word table for each distinct word; 0 stands for unknown."""
        if not len(self.vocabulary):
            return np.zeros(len(words.distinct), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words.distinct), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words.distinct, at + 1, 0)

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Table rows, input vectors and gate inputs of both directions, for each distinct word."""
        rows = self.rows(words)
        if not len(rows):
            return rows, np.zeros((0, WORD_DIMS + CHAR_DIMS), np.float32), np.zeros((0, 6 * HIDDEN), np.float32)
        chars = np.add.reduceat(self.w["char"][words.trigrams], words.trigram_starts[:-1])
        chars /= np.diff(words.trigram_starts)[:, None].astype(np.float32)
        x = np.concatenate((self.w["word"][rows], chars), axis=1)
        return rows, x, x @ self.w["in"] + self.w["in_b"]

    def forward(self, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``ids`` and ``mask`` are (windows, WINDOW). ``keep`` also returns what gradients need."""
        w, (n, steps) = self.w, ids.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        trail: list[list[tuple]] = [[], []]
        whole, at = mask.all(axis=0), np.ascontiguousarray(ids.T)
        for way in (0, 1):
            h = np.zeros((n, HIDDEN), np.float32)
            table = np.ascontiguousarray(gates[:, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN])
            u = w[f"state{way}"]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                g, hu = table[at[t]], h @ u
                zr = sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                if keep:
                    trail[way].append((t, h, z, r, c, hu[:, 2 * HIDDEN :]))
                step = (1 - z) * (c - h)
                h = h + (step if whole[t] else step * mask[:, t, None])
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = h
        att = np.tanh(states @ w["att"] + w["att_b"])
        weight = np.where(mask.T, att @ w["att_v"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        context = np.einsum("tn,tnk->nk", weight, states)
        logits = context @ w["out"] + w["out_b"][0]
        return (logits, (states, trail, att, weight, context)) if keep else logits

    def gradients(self, words: Words, ids: np.ndarray, mask: np.ndarray, slope) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Logits, and the gradient of a loss whose slope by the logits ``slope`` computes."""
        w = self.w
        rows, x, gates = self.inputs(words)
        logits, (states, trail, att, weight, context) = self.forward(gates, ids, mask, keep=True)
        d = slope(logits).astype(np.float32)
        grad = {"out": d @ context, "out_b": d.sum(keepdims=True)}
        d_context = d[:, None] * w["out"]
        d_states = weight[:, :, None] * d_context
        d_weight = np.einsum("nk,tnk->tn", d_context, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["att_v"] = np.einsum("tn,tna->a", d_score, att)
        d_att = d_score[:, :, None] * w["att_v"] * (1 - att * att)
        grad["att"] = np.einsum("tnk,tna->ka", states, d_att)
        grad["att_b"] = d_att.sum(axis=(0, 1))
        d_states += d_att @ w["att"].T
        d_gates = np.zeros((*ids.shape, 6 * HIDDEN), np.float32)
        for way in (0, 1):
            u, du = w[f"state{way}"], np.zeros_like(w[f"state{way}"])
            dh = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, c, hc in reversed(trail[way]):
                m = mask[:, t, None]
                dh = dh + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                dn = dh * m
                dz = dn * (h - c) * z * (1 - z)
                dc = dn * (1 - z) * (1 - c * c)
                dr = dc * hc * r * (1 - r)
                d_gates[:, t, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN] = np.concatenate((dz, dr, dc), axis=1)
                d_hu = np.concatenate((dz, dr, dc * r), axis=1)
                du += h.T @ d_hu
                dh = dh - dn * (1 - z) + d_hu @ u.T
            grad[f"state{way}"] = du
        used = ids.ravel()
        order = np.argsort(used, kind="stable")
        some, starts = np.unique(used[order], return_index=True)
        d_table = np.zeros_like(gates)
        d_table[some] = np.add.reduceat(d_gates.reshape(-1, 6 * HIDDEN)[order], starts)
        grad["in"], grad["in_b"] = x.T @ d_table, d_table.sum(axis=0)
        d_x = d_table @ w["in"].T
        grad["word"] = np.zeros_like(w["word"])
        np.add.at(grad["word"], rows, d_x[:, :WORD_DIMS])
        size = np.diff(words.trigram_starts)
        spread = np.repeat(d_x[:, WORD_DIMS:] / size[:, None].astype(np.float32), size, axis=0)
        grad["char"] = np.zeros_like(w["char"])
        np.add.at(grad["char"], words.trigrams, spread)
        return logits, grad

    def logits(self, words: Words, chunk: int = 1024) -> np.ndarray:
        """Largest window logit of each text; a text without words has the logit of an empty context."""
        begin, end, bounds = windows(words.first)
        out = np.full(len(bounds) - 1, self.w["out_b"][0], np.float32)
        if not len(begin):
            return out
        gates = self.inputs(words)[2]
        found = np.concatenate([
            self.forward(gates, *window_ids(words, begin[i : i + chunk], end[i : i + chunk])) for i in range(0, len(begin), chunk)
        ])
        full = np.flatnonzero(np.diff(bounds))
        out[full] = np.maximum.reduceat(found, bounds[:-1][full])
        return out

    def scores(self, words: Words) -> np.ndarray:
        return sigmoid(self.scale * self.logits(words).astype(np.float64) + self.shift)


def window_ids(words: Words, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = begin[:, None] + np.arange(WINDOW)
    mask = at < end[:, None]
    return words.place[np.where(mask, at, begin[:, None])], mask


def segments(values: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen segments of ``values`` one after the other, and where each starts."""
    size = np.diff(starts)[chosen]
    at = np.concatenate(([0], np.cumsum(size)))
    return values[np.repeat(starts[chosen], size) + np.arange(at[-1]) - np.repeat(at[:-1], size)], at


def words_of(texts: list[str]) -> Words:
    """All words of some texts, read block by block and brought together."""
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    parts = [
        read_words(data[offsets[a] : offsets[b]], offsets[a:b] - offsets[a], offsets[a + 1 : b + 1] - offsets[a])
        for a, b in blocks(offsets, TRAIN_BLOCK)
    ]
    distinct, sample, inverse = np.unique(
        np.concatenate([p.distinct for p in parts]), return_index=True, return_inverse=True)
    known = np.cumsum([0] + [len(p.distinct) for p in parts])
    place = np.concatenate([inverse[k + p.place] for k, p in zip(known, parts)])
    counts = np.concatenate([np.diff(p.first) for p in parts])
    sizes = np.concatenate([np.diff(p.trigram_starts) for p in parts])
    trigrams, starts = segments(
        np.concatenate([p.trigrams for p in parts]), np.concatenate(([0], np.cumsum(sizes))), sample)
    return Words(distinct, trigrams, starts, place, np.concatenate(([0], np.cumsum(counts))))


def train(texts: list[str], toxic: np.ndarray, toxic_share: float, epochs: int = 8, batch: int = 256) -> Network:
    """Fit a network. A toxic text teaches by its most suspect window, a clean one by that and a random window.

    Which window is most suspect is first told by the evidence of its words, and after half of the epochs by the network.
    ``toxic_share`` is the share of toxic among all labelled documents, to which the final curve is fitted.
    """
    if not texts:
        net = Network(np.zeros(0, np.uint64))
        net.scale, net.shift = 0.0, -30.0
        return net
    words = words_of(texts)
    toxic = np.asarray(toxic, bool)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    word, text = np.divmod(np.unique(words.place * len(texts) + owner), len(texts))
    holds = np.bincount(word, minlength=len(words.distinct))
    bad = np.bincount(word, toxic[text], len(words.distinct))
    # How far a word's texts are off the share of toxic ones, as a signed root of the likelihood ratio, less what chance
    # brings about among thousands of words.
    rate, share = bad / holds, min(max(toxic.mean(), 1e-6), 1 - 1e-6)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.nan_to_num(bad * np.log(rate / share)) + np.nan_to_num((holds - bad) * np.log((1 - rate) / (1 - share)))
    evidence = np.sign(rate - share) * np.clip(np.sqrt(2 * np.maximum(ratio, 0)) - 3, 0, 4)
    often = np.flatnonzero(holds >= max(3, 0.002 * len(texts)))
    often = np.sort(often[np.argsort(-holds[often], kind="stable")[:TRAIN_WORDS]])
    net = Network(words.distinct[often])
    evidence = np.where(np.isin(np.arange(len(evidence)), often), evidence, 0)
    # A start from the evidence: the first dimension of a known word is how far it tells the classes apart.
    net.w["word"][1:, 0] = evidence[often]

    begin, end, bounds = windows(words.first)
    full = np.flatnonzero(np.diff(bounds))
    if not toxic.any() or toxic.all() or not full.size:
        net.scale, net.shift = 0.0, -30.0 if not toxic.any() else 30.0
        return net
    draw = np.random.default_rng(3)
    peak = np.concatenate(([0], np.cumsum(np.maximum(evidence[words.place], 0))))
    suspicion = peak[end] - peak[begin]
    target_of = toxic[np.repeat(np.arange(len(texts)), np.diff(bounds))]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    origin = {k: net.w[k].copy() for k in ("word", "char")}
    count = 0
    for epoch in range(epochs):
        if epoch == epochs // 2:
            gates = net.inputs(words)[2]
            suspicion = np.concatenate([
                net.forward(gates, *window_ids(words, begin[i : i + 512], end[i : i + 512])) for i in range(0, len(begin), 512)])
        order = np.argsort(-suspicion, kind="stable")
        text = np.repeat(np.arange(len(texts)), np.diff(bounds))[order]
        top = order[np.unique(text, return_index=True)[1]]
        other = bounds[:-1][full] + draw.integers(0, np.diff(bounds)[full])
        chosen = np.unique(np.concatenate((top, other[~toxic[full]])))
        chosen = draw.permutation(chosen)
        share = target_of[chosen].mean()
        for i in range(0, len(chosen), batch):
            part = chosen[i : i + batch]
            target = target_of[part]
            importance = np.where(target, 0.5 / share, 0.5 / (1 - share)) / len(part)
            ids, mask = window_ids(words, begin[part], end[part])
            used, local = np.unique(ids, return_inverse=True)
            some = Words(words.distinct[used], *segments(words.trigrams, words.trigram_starts, used), local, words.first)
            _, grad = net.gradients(some, local.reshape(ids.shape), mask, lambda x: (sigmoid(x) - target) * importance)
            count += 1
            for k, g in grad.items():
                if k in ("word", "char"):
                    g = g + DECAY * (net.w[k] - origin[k])  # rare words stay near where they began
                one, two = moments[k]
                one += 0.1 * (g - one)
                two += 0.01 * (g * g - two)
                net.w[k] -= 0.01 * (one / (1 - 0.9**count)) / (np.sqrt(two / (1 - 0.99**count)) + 1e-7)
    _calibrate(net, net.logits(words, 512).astype(np.float64), toxic, toxic_share)
    return net


def _calibrate(net: Network, x: np.ndarray, toxic: np.ndarray, share: float) -> None:
    """Logistic curve over the logits, with the classes weighted as among all labelled documents."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    importance = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean())) / len(x)
    middle, spread = x.mean(), x.std() or 1.0
    a, b, x = 1.0, 0.0, (x - middle) / spread
    for _ in range(500):
        error = (sigmoid(a * x + b) - toxic) * importance
        curve = sigmoid(a * x + b) * (1 - sigmoid(a * x + b)) * importance
        h = np.array([[(curve * x * x).sum() + 1e-3, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-6]])
        step = np.linalg.solve(h, [(error * x).sum() + 1e-3 * a, error.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    net.scale, net.shift = a / spread, b - a * middle / spread


def training_rows(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, float]:
    """(__id, toxic, text), the bounded sample that the network is fitted to, and the share of toxic among labelled rows.

    Only labelled rows whose crc32(id as text) is not divisible by 5 are read. Of each class the ``TRAIN_ROWS`` ids with
    the smallest hash are chosen from the labels alone; their number bounds what is broadcast to the scan of the texts.
    Texts of more than ``TRAIN_CHARS`` characters are left out, so the sample has a bounded size.
    """
    known = labels.select(F.col(id_col).cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic")).where(
        "__id IS NOT NULL AND toxic IS NOT NULL").where(learnable("__id")).groupBy("__id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = [known.where(F.col("toxic") == mark).orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS) for mark in (0, 1)]
    rows = df.select(F.col(id_col).cast("long").alias("__id"), F.col(text).cast("string").alias("text")).where(
        F.length("text") <= TRAIN_CHARS)
    return rows.join(F.broadcast(chosen[0].union(chosen[1])), "__id").select("__id", "toxic", "text"), share


def learnable(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 != 0


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> Network:
    """The network for the labels of ``df``. It is trained in a task of its own, and only its weights come to the driver."""
    sample, share = training_rows(df, labels, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[1], r[0], r[2]))
        network = train([r[2] for r in rows], np.array([r[1] for r in rows], bool), share)
        parts = (network.vocabulary, network.w, float(network.scale), float(network.shift))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary())], names=["parts"])

    found = sample.repartition(1).mapInArrow(run, "parts binary").collect()  # one row
    if not found:
        return train([], np.zeros(0, bool), share)
    vocabulary, weights, scale, shift = pickle.loads(found[0]["parts"])
    network = Network(vocabulary)
    network.w, network.scale, network.shift = weights, scale, shift
    return network


def score_toxicity(df: DataFrame, network: Network, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text, from all of its windows.

    Null and wordless texts get the score of an empty window. Null ids and repeated rows stay; nothing but the text
    enters a score; other columns are left out. Without labels of one class every score is near the other class.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for at, end in blocks(offsets, SCORE_BLOCK):
                low, high = int(offsets[at]), int(offsets[end])
                words = read_words(data[low:high], offsets[at:end] - low, offsets[at + 1 : end + 1] - low)
                found = network.scores(words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is not predicted toxic, with all their columns."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        data, offsets = text_buffers(texts)
        out = [np.zeros(0)]
        for at, end in blocks(offsets, SCORE_BLOCK):
            low, high = int(offsets[at]), int(offsets[end])
            out.append(network.scores(read_words(data[low:high], offsets[at:end] - low, offsets[at + 1 : end + 1] - low)))
        return pa.array(np.concatenate(out))

    return df.where(score(F.col(text).cast("string")) < 0.5)
