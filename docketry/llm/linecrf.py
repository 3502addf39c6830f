"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is described by shares and counts of its characters and words, cut into steps, together
with those of the lines before and after it. The field labels every line good or bad; it is
trained on documents whose lines all carry the document's label. A document's quality is the mean
of its lines' marginal probabilities of being good, weighted by their length, from the
forward-backward recursion, put through a logistic curve fitted on the training documents.

The model is fitted on a sample of whole labelled documents, at most ``most_docs`` with at most
``most_lines`` lines together; tasks make the lines' features, and only those are gathered. Scores use
whole texts. A long text is scored in blocks of lines, so that its features are never held at once.

Edge cases: a text that is null or has no word has no lines and gets the smoothed share of good
documents among such training texts, 0 without any; labels that are null or not 0 or 1 teach
nothing, and without any usable label all scores are 0.5; repeated rows are scored each and teach
once; equal hashes (ties) are taken for equal rows; an empty table gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8_bytes, written

_LOWER, _UPPER, _DIGIT, _BLANK, _SYMBOL, _BANG, _BAR, _MARK, _OTHER = range(9)
#: Steps of a share, and of the log of a number of words.
_SHARE_STEPS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
_LOG_STEPS = (0.8, 1.5, 2.5, 3.5, 5.0)
_WORD_STEPS = (2.5, 4.0, 6.0, 9.0)


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    for code, chars in ((_DIGIT, b"0123456789"), (_BLANK, b" \t\n\x0b\x0c\r"), (_SYMBOL, b"#*$%&<>@_=+~^\\{}[]"), (_BANG, b"!"), (_BAR, b"|"), (_MARK, b".,;:?'\"()-/")):
        table[list(chars)] = code
    table[ord("a") : ord("z") + 1] = _LOWER
    table[ord("A") : ord("Z") + 1] = _UPPER
    return table


_CLASS = _classes()
_POWER = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at once, and lines whose inputs are held at once.
_RUN, _LINES = 1 << 18, 1 << 14


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the multiplier from the first on, and those of its inverse."""
    return tuple(np.cumprod(np.full(n, np.uint64(x), np.uint64)) for x in (int(_POWER), pow(int(_POWER), -1, 1 << 64)))


def _word_codes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word that is the same wherever it stands; a bounded run of bytes at a time."""
    code = np.zeros(len(begin), np.uint64)
    powers, back = _powers(_RUN)
    i = 0
    while i < len(begin):
        j = int(np.searchsorted(end, begin[i] + _RUN, "right"))
        if j > i:  # words that end within a run of the first one's beginning
            lo = begin[i]
            part = buffer[lo : end[j - 1]].astype(np.uint64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(part * powers[: len(part)])])
            code[i:j] = (sums[end[i:j] - lo] - sums[begin[i:j] - lo]) * back[begin[i:j] - lo]
            i = j
            continue
        shift = back[:1].copy()  # a word longer than a run
        for lo in range(int(begin[i]), int(end[i]), _RUN):
            part = buffer[lo : min(lo + _RUN, int(end[i]))].astype(np.uint64)
            code[i : i + 1] += (part * powers[: len(part)]).sum(dtype=np.uint64) * shift
            shift *= powers[-1:]
        i += 1
    return code


class Lines:
    """The lines with a word of a batch of texts: features, byte lengths, and each line's text.

    ``echoes`` has hashes of lines that are known to occur twice in the (only) text, beyond those
    that the batch itself holds twice; with ``hashes_only`` just ``hashes`` of the lines are made.
    """

    def __init__(self, texts: list[bytes], echoes: np.ndarray | None = None, hashes_only: bool = False):
        buffer = np.frombuffer(b"".join(t + b"\n" for t in texts) or b"\n", np.uint8)
        ends = np.flatnonzero(buffer == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1 if texts else np.empty(0, np.int64)
        kind = _CLASS[buffer]
        filled = np.add.reduceat((kind != _BLANK).view(np.uint8), starts, dtype=np.int32)
        kept = np.flatnonzero(filled > 0)
        self.doc = np.searchsorted(text_ends, ends[kept])
        self.length = filled[kept].astype(np.float64)
        self.hashes, self.features = np.empty(0, np.uint64), np.zeros((0, WIDTH), np.uint8)
        if len(kept):
            self._describe(buffer, kind, starts, kept, echoes, hashes_only)

    def _describe(self, buffer: np.ndarray, kind: np.ndarray, starts: np.ndarray, kept: np.ndarray, echoes: np.ndarray | None, hashes_only: bool) -> None:
        word = kind != _BLANK
        begin = np.flatnonzero(word & np.concatenate([[True], ~word[:-1]]))
        end = np.flatnonzero(word & np.concatenate([~word[1:], [True]])) + 1
        code = _word_codes(buffer, begin, end)
        line_at = np.full(len(starts), -1)
        line_at[kept] = np.arange(len(kept))
        line = line_at[np.searchsorted(starts, begin, "right") - 1]
        n_words = np.bincount(line, minlength=len(kept)).astype(np.float64)
        tops = np.searchsorted(line, np.arange(len(kept)))
        self.hashes = np.add.reduceat(code * (np.arange(len(line)) - tops[line] + 1).astype(np.uint64), tops)
        if hashes_only:
            return
        counts = np.stack([np.add.reduceat((kind == c).view(np.uint8), starts, dtype=np.int32)[kept] for c in range(9)], axis=1).astype(np.float64)
        filled = np.maximum(self.length, 1.0)
        letters = np.maximum(counts[:, _LOWER] + counts[:, _UPPER] + counts[:, _OTHER], 1.0)
        pairs = np.sort((line.astype(np.uint64) << np.uint64(36)) | (code >> np.uint64(28)))
        again = pairs[1:][pairs[1:] == pairs[:-1]] >> np.uint64(36)
        repeats = np.bincount(again.astype(np.int64), minlength=len(kept)) / n_words
        twins = line[1:][(line[1:] == line[:-1]) & (code[1:] == code[:-1])]
        twin = np.bincount(twins, minlength=len(kept)) / n_words
        same = (self.doc.astype(np.uint64) << np.uint64(36)) | (self.hashes >> np.uint64(28))
        echoed = np.isin(same, twice_in(same))
        if echoes is not None:
            echoed |= np.isin(self.hashes >> np.uint64(28), echoes)
        head, tail = kind[begin[tops]], kind[end[np.append(tops[1:], len(line)) - 1] - 1]
        steps = [(counts[:, c] / (letters if c == _UPPER else filled), _SHARE_STEPS) for c in (_UPPER, _DIGIT, _SYMBOL, _BANG, _BAR, _MARK, _OTHER)]
        steps += [(repeats, _SHARE_STEPS), (twin, _SHARE_STEPS), (np.log1p(n_words), _LOG_STEPS), (filled / n_words, _WORD_STEPS)]
        flags = [echoed, head == _UPPER, head == _LOWER, (tail == _MARK), (tail == _BANG)]
        self.features = np.stack([(values > s).view(np.uint8) for values, of in steps for s in of] + [f.view(np.uint8) for f in flags], axis=1)


def twice_in(values: np.ndarray) -> np.ndarray:
    """The values that occur twice or more."""
    ordered = np.sort(values)
    return np.unique(ordered[1:][ordered[1:] == ordered[:-1]])


def line_blocks(text: bytes, size: int) -> Iterator[bytes]:
    """``text`` cut at line ends into blocks of about ``size`` bytes; a longer line is a block of its own."""
    at = 0
    while at < len(text):
        cut = text.rfind(b"\n", at, at + size)
        cut = cut if cut > at else text.find(b"\n", at + 1)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut]
        at = cut + 1


WIDTH = 9 * len(_SHARE_STEPS) + len(_LOG_STEPS) + len(_WORD_STEPS) + 5


def with_neighbours(features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and the one after in its document, and three flags."""
    n = len(features)
    before, after = np.zeros_like(features), np.zeros_like(features)
    inner = doc[1:] == doc[:-1] if n else np.empty(0, bool)
    before[1:][inner] = features[:-1][inner]
    after[:-1][inner] = features[1:][inner]
    top = np.ones(n, np.uint8)
    top[1:] = ~inner
    bottom = np.ones(n, np.uint8)
    bottom[:-1] = ~inner
    return np.hstack([features, before, after, top[:, None], bottom[:, None], np.ones((n, 1), np.uint8)])


def _grid(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first line, number of lines) of each document that has any, longest first, and its number."""
    ids, first, length = np.unique(doc, return_index=True, return_counts=True)
    order = np.argsort(-length, kind="stable")
    return first[order], length[order], ids[order]


def marginals(emission: np.ndarray, doc: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over all documents at once: line marginals, expected transitions, log partition.

    ``emission`` has a score for each line and label; documents are runs of ``doc``.
    """
    first, length, _ = _grid(doc)
    peak = emission.max(axis=1, keepdims=True) if len(emission) else np.zeros((0, 1))
    local, step = np.exp(emission - peak), np.exp(transition)
    forward, backward, scale = np.empty_like(local), np.ones_like(local), np.ones(len(local))
    most = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(most), "left")  # documents longer than the position
    for t in range(most):
        at = first[: active[t]] + t
        now = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        scale[at] = now.sum(axis=1)
        forward[at] = now / scale[at][:, None]
    for t in range(most - 2, -1, -1):
        at = first[: active[t + 1]] + t
        backward[at] = (local[at + 1] * backward[at + 1]) @ step.T / scale[at + 1][:, None]
    gamma = forward * backward
    gamma /= np.maximum(gamma.sum(axis=1, keepdims=True), 1e-300)
    inner = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.empty(0, np.int64)
    nxt = local[inner + 1] * backward[inner + 1] / scale[inner + 1][:, None]
    pairs = (forward[inner].T @ nxt) * step
    return gamma, pairs, float(np.log(scale).sum() + peak.sum())


def long_marginals(emission: np.ndarray, transition: np.ndarray, block: int = 2048) -> np.ndarray:
    """The line marginals of one long document: all blocks of its lines advance together, then are joined.

    The recursion is a product of two-by-two matrices, so each block's product is made first, the
    blocks are chained, and the lines of all blocks are filled in from both sides.
    """
    n = len(emission)
    blocks = -(-n // block)
    local = np.ones((blocks * block, 2))
    local[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    local = local.reshape(blocks, block, 2)
    step = np.exp(transition)
    steps = np.broadcast_to(step, (blocks, 2, 2)).copy()
    at = np.arange(blocks) * block
    product = np.broadcast_to(np.eye(2), (blocks, 2, 2)).copy()

    def matrix(t: int) -> np.ndarray:
        """What line ``t`` of each block multiplies by; lines beyond the document change nothing."""
        inside = at + t < n
        out = steps * local[:, t, None, :]
        out[~inside] = np.eye(2)
        if t == 0:
            out[0] = np.diag(local[0, 0])
        return out

    for t in range(block):
        product = product @ matrix(t)
        product /= product.sum(axis=(1, 2), keepdims=True)
    before, after = np.empty((blocks, 2)), np.empty((blocks, 2))
    now = np.ones(2)
    for k in range(blocks):
        before[k] = now
        now = now @ product[k]
        now = now / now.sum()
    now = np.ones(2)
    for k in range(blocks - 1, -1, -1):
        after[k] = now
        now = product[k] @ now
        now = now / now.sum()
    forward = np.empty((blocks, block, 2))
    now = before
    for t in range(block):
        now = (now[:, None, :] @ matrix(t))[:, 0]
        now = now / now.sum(axis=1, keepdims=True)
        forward[:, t] = now
    now = after
    for t in range(block - 1, -1, -1):
        forward[:, t] *= now
        now = (matrix(t) @ now[:, :, None])[:, :, 0]
        now = now / now.sum(axis=1, keepdims=True)
    gamma = forward.reshape(-1, 2)[:n]
    return gamma / gamma.sum(axis=1, keepdims=True)


class LineField:
    """Weights of the field and of the logistic curve on top."""

    def __init__(self, weights: np.ndarray, transition: np.ndarray, slope: float, offset: float, empty: float):
        self.weights, self.transition, self.slope, self.offset, self.empty = weights, transition, slope, offset, empty

    def _emission(self, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
        parts = [np.zeros((0, 2))]
        for lo in range(0, len(doc), _LINES):  # with the neighbours of the first and last line of a run
            at, end = max(lo - 1, 0), min(lo + _LINES + 1, len(doc))
            found = with_neighbours(features[at:end], doc[at:end]).astype(np.float64) @ self.weights
            parts.append(found[lo - at : lo - at + _LINES])
        return np.concatenate(parts)

    def raw(self, lines: Lines, n: int) -> np.ndarray:
        """Length-weighted mean marginals by document; NaN where a document has no lines."""
        gamma, _, _ = marginals(self._emission(lines.features, lines.doc), lines.doc, self.transition)
        weight = np.bincount(lines.doc, lines.length, n)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.bincount(lines.doc, lines.length * gamma[:, 1], n) / weight

    def raw_long(self, text: bytes, block_bytes: int = 1 << 20, block_lines: int = 2048) -> float:
        """The same for one long text, whose features are made and used a block of lines at a time."""
        hashes = np.concatenate([np.empty(0, np.uint64), *(Lines([b], hashes_only=True).hashes for b in line_blocks(text, block_bytes))])
        echoes = twice_in(hashes >> np.uint64(28))
        del hashes
        emission, length = [np.zeros((0, 2))], [np.empty(0)]
        held = np.zeros((0, WIDTH), np.uint8)  # the last two lines before: one still waits for its neighbour

        def send(features: np.ndarray, first: int, last: int) -> None:
            for lo in range(first, last, _LINES):
                at, end = max(lo - 1, 0), min(min(lo + _LINES, last) + 1, len(features))
                found = with_neighbours(features[at:end], np.zeros(end - at, np.int64)).astype(np.float64) @ self.weights
                emission.append(found[lo - at : min(lo + _LINES, last) - at])

        done = 0
        for part in line_blocks(text, block_bytes):
            lines = Lines([part], echoes)
            length.append(lines.length)
            features = np.concatenate([held, lines.features])
            send(features, done, len(features) - 1)
            held = features[-2:]
            done = max(len(held) - 1, 0)
        send(held, done, len(held))
        weight = np.concatenate(length)
        if not len(weight):
            return float("nan")
        gamma = long_marginals(np.concatenate(emission), self.transition, block_lines)
        return float((weight * gamma[:, 1]).sum() / weight.sum())

    def score(self, texts: list[bytes], long_bytes: int = 1 << 20) -> np.ndarray:
        """Quality of each text; texts beyond ``long_bytes`` are scored in blocks of lines."""
        mean = self.raw(Lines([t if len(t) <= long_bytes else b"" for t in texts]), len(texts))
        for i, text in enumerate(texts):
            if len(text) > long_bytes:
                mean[i] = self.raw_long(text)
        curve = 1.0 / (1.0 + np.exp(-np.clip(self.slope * _logit(mean) + self.offset, -30, 30)))
        return np.where(np.isnan(mean), self.empty, curve)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _ascend(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam on a concave function whose gradient is given."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def train(features: np.ndarray, doc: np.ndarray, length: np.ndarray, labels: np.ndarray, steps: int = 150, ridge: float = 2e-3) -> LineField:
    """Fit the field and its curve on labelled documents: their lines' features, document and length."""
    empty = np.bincount(doc, minlength=len(labels)) == 0
    blank = float(labels[empty].sum() / (empty.sum() + 1)) if empty.any() else 0.0
    if len(set(labels[~empty].tolist())) < 2:
        return LineField(np.zeros((3 * WIDTH + 3, 2)), np.zeros((2, 2)), 0.0, 0.0, blank if len(labels) else 0.5)
    inputs = with_neighbours(features, doc)
    truth = np.eye(2, dtype=np.float32)[labels[doc].astype(int)]
    inner = doc[1:] == doc[:-1]
    seen = truth[:-1][inner].T @ truth[1:][inner]
    n, split = len(doc), inputs.shape[1] * 2
    runs = [slice(lo, lo + _LINES) for lo in range(0, n, _LINES)]

    def emissions(x: np.ndarray) -> np.ndarray:
        weights = x[:split].reshape(-1, 2).astype(np.float32)
        return np.concatenate([(inputs[r].astype(np.float32) @ weights).astype(np.float64) for r in runs])

    def gradient(x: np.ndarray) -> np.ndarray:
        gamma, pairs, _ = marginals(emissions(x), doc, x[split:].reshape(2, 2))
        rest = truth - gamma.astype(np.float32)
        up = sum((inputs[r].astype(np.float32).T @ rest[r]).astype(np.float64) for r in runs) / n
        return np.concatenate([up.ravel(), ((seen - pairs) / n).ravel()]) - ridge * x

    found = _ascend(gradient, np.zeros(split + 4), steps, 0.05)
    transition = found[split:].reshape(2, 2)
    gamma, _, _ = marginals(emissions(found), doc, transition)
    mean = np.bincount(doc, length * gamma[:, 1], len(labels))[~empty] / np.bincount(doc, length, len(labels))[~empty]
    x, y = _logit(mean), labels[~empty].astype(float)

    def slope(p: np.ndarray) -> np.ndarray:
        rest = y - 1.0 / (1.0 + np.exp(-np.clip(p[0] * x + p[1], -30, 30)))
        return np.array([(rest * x).mean(), rest.mean()]) - 1e-3 * p

    a, b = (float(v) for v in _ascend(slope, np.array([1.0, 0.0]), 400, 0.05))
    return LineField(found[:split].reshape(-1, 2), transition, a, b, blank)


def described(text: bytes, block_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Features, packed to bits, and lengths of all lines of a text."""
    if len(text) <= block_bytes:
        lines = Lines([text])
        return np.packbits(lines.features, axis=1), lines.length
    hashes = np.concatenate([np.empty(0, np.uint64), *(Lines([b], hashes_only=True).hashes for b in line_blocks(text, block_bytes))])
    echoes, rows, lengths = twice_in(hashes >> np.uint64(28)), [], [np.empty(0)]
    for part in line_blocks(text, block_bytes):
        lines = Lines([part], echoes)
        rows.append(np.packbits(lines.features, axis=1))
        lengths.append(lines.length)
    return np.concatenate([np.zeros((0, -(-WIDTH // 8)), np.uint8), *rows]), np.concatenate(lengths)


def _line_table(rows: DataFrame) -> DataFrame:
    """(h, label, n, features, lengths) of (h, label, text): what the fit needs of whole texts, some 14 bytes a line."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(utf8_bytes(batch.column("text"))):
                features, lengths = described(text or b"")
                values = [pa.array([len(lengths)], pa.int64()), pa.array([features.tobytes()], pa.binary()), pa.array([lengths.astype("<u4").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("h").slice(i, 1), batch.column("label").slice(i, 1), *values], ["h", "label", "n", "features", "lengths"])

    return rows.select("h", F.col("label").cast("int").alias("label"), "text").mapInArrow(scan, "h long, label int, n long, features binary, lengths binary")


def fit(labelled: DataFrame, most_docs: int = 4000, most_lines: int = 200_000, seed: int = 3, texts: DataFrame | None = None) -> LineField:
    """Fit on (id, text, label) rows: a bounded sample of whole documents, gathered by the driver.

    Where the texts are a table of their own, ``texts`` (id, text), ``labelled`` has (id, label): a row's
    hashes with either label meet the labels, and the texts of the sample are found where they are.

    The sample has the rows with the smallest seeded hashes, ``most_docs`` at most; of these, in that
    order, those are taken that together have at most ``most_lines`` lines: a document with more than
    are left is passed over. Rows equal in id, text and label count once.
    """
    usable = labelled.where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    hashed = lambda label: F.xxhash64(F.lit(seed), F.col("id"), F.col("text"), label)
    if texts is None:
        usable = ranked = usable.withColumn("h", hashed(F.col("label")))
    else:
        kind = labelled.schema["label"].dataType
        digests = texts.select("id", *[hashed(F.lit(of).cast(kind)).alias(f"h{of}") for of in (0, 1)])
        usable = usable.join(digests, "id").select("id", "label", F.when(F.col("label") == 1, F.col("h1")).otherwise(F.col("h0")).alias("h"))
        ranked = written(usable.distinct().orderBy("h", "id", "label").limit(most_docs), "sample")
        usable = texts.join(F.broadcast(ranked), "id").where(hashed(F.col("label")) == F.col("h"))
    edge = ranked.select("h").distinct().orderBy("h").limit(most_docs).agg(F.max("h")).first()[0]
    if edge is None:
        return train(np.zeros((0, WIDTH), np.uint8), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    table = written(_line_table(usable.where(F.col("h") <= F.lit(edge))), "lines")
    left, chosen = most_lines, []
    for r in table.groupBy("h").agg(F.first("n").alias("n")).orderBy("h").collect():
        if r["n"] <= left:
            chosen.append((r["h"],))
            left -= r["n"]
    picked = table.join(F.broadcast(labelled.sparkSession.createDataFrame(chosen, "h long")), "h").groupBy("h").agg(*[F.first(c).alias(c) for c in ("label", "features", "lengths")])
    rows = picked.toPandas().sort_values("h", kind="stable")
    lengths = [np.frombuffer(x, "<u4") for x in rows["lengths"]]
    packed = np.frombuffer(b"".join(rows["features"]), np.uint8).reshape(-1, -(-WIDTH // 8))
    features = np.unpackbits(packed, axis=1, count=WIDTH)
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in lengths])
    return train(features, doc, np.concatenate([np.empty(0), *lengths]), rows["label"].to_numpy(np.int64))


def score(docs: DataFrame, field: LineField, text_col: str = "text", batch_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` without the text, with ``score``."""
    others = [c for c in docs.columns if c not in (text_col, "score")]
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = [t or b"" for t in utf8_bytes(batch.column(text_col))]
            found, lo, size = [], 0, 0
            for i, text in enumerate(texts):
                size += len(text) + 1
                if size >= batch_bytes or i + 1 == len(texts):
                    found.append(known.score(texts[lo : i + 1]))
                    lo, size = i + 1, 0
            scores = np.concatenate(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(scores, pa.float64())], [*others, "score"])

    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField("score", T.DoubleType())])
    return docs.select(*others, text_col).mapInArrow(scan, schema)
