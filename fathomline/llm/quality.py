"""Quality rules: counts on words and lines, and a linear-chain CRF that labels lines content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import BLANKS, filtered, small_batches

CONTENT, BOILERPLATE = 0, 1
SYMBOLS = "#*$%&|<>"
FEATURES = ("bias", "symbols>2%", "symbols>8%", "upper>30%", "upper>70%", "bangs>3%", "digits>20%", "few letters", "under 4 words", "over 12 words", "repeated line", "pipe or tab")
_COUNTED = [(c, ord(c)) for c in SYMBOLS]


@dataclass(frozen=True)
class Fit:
    """Bounds of what the CRF is fitted on.

    fit_docs labelled documents at most, those of smallest xxhash64(doc_id); of them, only documents of fit_lines
    lines or fewer.  Labels are of documents, so the lines' are learned too: at first all lines of a document have its
    label, then, turns times, the labels that the CRF gives them, where these agree with the document's (see labelled).
    """

    fit_docs: int = 1500
    fit_lines: int = 200
    rounds: int = 120
    turns: int = 2
    l2: float = 1.0


def line_features(lines: list[str]) -> np.ndarray:
    """One row of FEATURES (0/1) for each line; depends on these lines only."""
    out = np.zeros((len(lines), len(FEATURES)), np.float32)
    out[:, 0] = 1
    seen: set[str] = set()
    for i, line in enumerate(lines):
        n = len(line)
        b = line.encode()
        few = len(b.translate(None, b"#*$%&|<>"))
        symbols = len(b) - few
        upper = len(b) - len(b.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        lower = len(b) - len(b.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
        digits = len(b) - len(b.translate(None, b"0123456789"))
        words = len(b.split())
        letters = upper + lower
        row = out[i]
        row[1], row[2] = symbols > 0.02 * n, symbols > 0.08 * n
        row[3], row[4] = upper > 0.3 * letters, upper > 0.7 * letters
        row[5], row[6] = line.count("!") > 0.03 * n, digits > 0.2 * n
        row[7] = letters < 0.5 * n
        row[8], row[9] = words < 4, words > 12
        row[10] = line in seen
        row[11] = "|" in line or "\t" in line
        seen.add(line)
    return out


@dataclass(frozen=True)
class Crf:
    """Weights of a two-label linear-chain CRF: emit (features, 2), move (2, 2)."""

    emit: np.ndarray
    move: np.ndarray

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest label sequence; equal scores go to content."""
        e = (features @ self.emit).tolist()
        if not e:
            return np.zeros(0, np.int8)
        (aa, ab), (ba, bb) = self.move.tolist()
        a, b = e[0]
        back = []
        for x, y in e[1:]:
            from_a, from_b = a + aa >= b + ba, a + ab >= b + bb
            a, b = (a + aa if from_a else b + ba) + x, (a + ab if from_b else b + bb) + y
            back.append((from_a, from_b))
        label = CONTENT if a >= b else BOILERPLATE
        out = [label]
        for from_a, from_b in reversed(back):
            label = CONTENT if (from_a, from_b)[label] else BOILERPLATE
            out.append(label)
        return np.array(out[::-1], np.int8)


#: What holds where no labelled document exists: symbols, shouting, tables and repeats speak for boilerplate.
UNFITTED = Crf(np.array([[1, 0, 0, 0, 0, 0, 0, 0, 0, 0.5, 0, 0], [0, 1, 1, 0, 1, 1, 0.5, 0.5, 0.2, 0, 0.6, 0.6]], np.float64).T, np.array([[0.5, 0.0], [0.0, 0.5]]))


def fitted(samples: list[tuple[np.ndarray, int | np.ndarray]], rounds: int, l2: float) -> Crf:
    """Maximum likelihood of the label sequences, by gradient ascent with forward-backward (all chains in one pass).

    samples: a document's line features, and the labels of its lines, or one that all of them have.  Chains lie side by
    side, longest first, so that the lines of one number are neighbours and short chains cost nothing beyond their end.
    """
    samples = sorted(((f, np.broadcast_to(np.asarray(y, np.int64), len(f))) for f, y in samples if len(f)), key=lambda s: -len(s[0]))
    if not samples or len({int(x) for _, y in samples for x in y}) < 2:
        return UNFITTED
    k, n = len(FEATURES), len(samples)
    length = np.array([len(f) for f, _ in samples])
    active = np.array([int((length > t).sum()) for t in range(length[0])])
    first = np.concatenate([[0], np.cumsum(active)])
    place = [first[: len(f)] + i for i, (f, _) in enumerate(samples)]
    x, y, weight = np.zeros((first[-1], k)), np.zeros(first[-1], np.int64), np.zeros(first[-1])
    for at, (f, own) in zip(place, samples):
        x[at], y[at] = f, own
        weight[at] = 1 / np.sqrt(len(f))  # a long document has more to say, but not in proportion
    steps = [(slice(first[t - 1], first[t - 1] + active[t]), slice(first[t], first[t + 1])) for t in range(1, length[0])]
    before = np.concatenate([np.arange(s.start, s.stop) for s, _ in steps] or [[]]).astype(int)
    after = np.concatenate([np.arange(s.start, s.stop) for _, s in steps] or [[]]).astype(int)
    end, chain = np.array([at[-1] for at in place]), np.zeros(first[-1], np.int64)
    for i, at in enumerate(place):
        chain[at] = i
    truth_emit = np.stack([weight[y == label] @ x[y == label] for label in (0, 1)], axis=1)
    truth_move = np.zeros((2, 2))
    np.add.at(truth_move, (y[before], y[after]), weight[after])
    theta = np.zeros(k * 2 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = weight.sum()
    for step in range(1, rounds + 1):
        emit, move = theta[: 2 * k].reshape(k, 2), theta[2 * k :].reshape(2, 2)
        e = x @ emit
        alpha, beta = e.copy(), np.zeros_like(e)
        for was, now in steps:
            alpha[now] += np.logaddexp(alpha[was, 0, None] + move[0], alpha[was, 1, None] + move[1])
        for was, now in reversed(steps):
            s = beta[now] + e[now]
            beta[was] = np.logaddexp(s[:, 0, None] + move[:, 0], s[:, 1, None] + move[:, 1])
        z = np.logaddexp(alpha[end, 0], alpha[end, 1])[chain]
        p = np.exp(alpha + beta - z[:, None]) * weight[:, None]
        pair = np.exp(alpha[before, :, None] + move + (e[after] + beta[after])[:, None, :] - z[after, None, None]) * weight[after, None, None]
        grad = np.concatenate([(truth_emit - x.T @ p).ravel(), (truth_move - pair.sum(0)).ravel()]) / total - l2 * theta / total
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(theta[: 2 * k].reshape(k, 2).copy(), theta[2 * k :].reshape(2, 2).copy())


def labelled(samples: list[tuple[np.ndarray, int, np.ndarray]], crf: Crf, content_share: float) -> list[tuple[np.ndarray, int | np.ndarray]]:
    """The samples (line features, document's label, characters of the lines) with labels of lines: the CRF's, where the
    share of content that they give speaks for the document's label, and else the document's for all of them."""
    out = []
    for features, label, size in samples:
        lines = crf.viterbi(features)
        content = size[lines == CONTENT].sum() >= content_share * size.sum()
        out.append((features, lines if content == (label == CONTENT) else label))
    return out


def learned(samples: list[tuple[np.ndarray, int, np.ndarray]], fit: Fit, content_share: float) -> Crf:
    """From documents' labels to a CRF of lines: fits, labels the lines, and fits anew, fit.turns times."""
    crf = fitted([(f, label) for f, label, _ in samples], fit.rounds, fit.l2)
    for _ in range(fit.turns):
        if crf is not UNFITTED:
            crf = fitted(labelled(samples, crf, content_share), fit.rounds, fit.l2)
    return crf


def word_lines(text: str) -> list[str]:
    """The \\n-split lines that hold a word."""
    return [x for x in text.split("\n") if x.strip(BLANKS)]


def fit_crf(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, content_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> Crf:
    """Fits on at most fit.fit_docs documents; only features and lengths of their lines reach the driver."""
    sample = labels.select(id_col, "quality").dropna().groupBy(id_col).agg(F.max("quality").alias("quality"))
    sample = sample.orderBy(F.xxhash64(id_col), id_col).limit(fit.fit_docs).collect()
    label = {r[0]: 1 - int(r[1] > 0) for r in sample}
    if not label:
        return UNFITTED
    most = fit.fit_lines

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, sizes = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = word_lines(text or "")
                if 0 < len(lines) <= most:
                    ids.append(i)
                    rows.append(np.packbits(line_features(lines).astype(bool), axis=1).tobytes())
                    sizes.append(np.fromiter(map(len, lines), np.int32, len(lines)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema[0].type), pa.array(rows, pa.binary()), pa.array(sizes, pa.binary())], names=["id", "f", "n"])

    df = small_batches(docs).select(id_col, text_col).filter(F.col(id_col).isin([*label]))
    # a sampled id may stand on many rows; of its texts one is enough
    found = df.mapInArrow(features, f"id {df.schema[0].dataType.simpleString()}, f binary, n binary").groupBy("id").agg(F.min(F.struct("f", "n")).alias("x")).collect()
    width = (len(FEATURES) + 7) // 8
    unpack = lambda f: np.unpackbits(np.frombuffer(f, np.uint8).reshape(-1, width), axis=1)[:, : len(FEATURES)]
    samples = sorted(((r.id, bytes(r.x.f), bytes(r.x.n)) for r in found))
    return learned([(unpack(f), label[i], np.frombuffer(n, np.int32)) for i, f, n in samples], fit, content_share)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    pairs = ids[:-1] * base + ids[1:]
    if base < 2_000_000:  # three numbers fit 63 bits
        keys = pairs[:-1] * base + ids[2:]
    else:
        keys = np.unique(pairs, return_inverse=True)[1].reshape(-1)[:-1] * base + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode().split()
    blanks = sum(map(text.count, BLANKS))
    lines = word_lines(text)
    return len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def judged(text: str | None, crf: Crf, content_share: float, min_words: int, repeat_percent: int) -> tuple:
    """The counts of a text, base_failed, kept and content_share."""
    text = text or ""
    n_words, word_chars, symbols, dup_lines, repeats = counts(text)
    lines = word_lines(text)
    share = 0.0
    if lines:
        size = np.fromiter(map(len, lines), np.int64, len(lines))
        share = float(size[crf.viterbi(line_features(lines)) == CONTENT].sum() / size.sum())
    failed = n_words < min_words or 100 * repeats > repeat_percent * n_words
    return n_words, word_chars, symbols, dup_lines, repeats, failed, not failed and share >= content_share, share


def kept_documents(docs: DataFrame, labels: DataFrame, *, fit: Fit = Fit(), content_share: float = 0.5, min_words: int = 50, repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that quality() keeps, all columns as they are."""
    crf = fit_crf(docs, labels, fit, content_share=content_share, id_col=id_col, text_col=text_col)
    return filtered(docs, text_col, lambda: lambda text: judged(text, crf, content_share, min_words, repeat_percent)[6])


def quality(docs: DataFrame, labels: DataFrame, *, fit: Fit = Fit(), content_share: float = 0.5, min_words: int = 50, repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: counts, base_failed, content_share and kept.

    kept is false where base_failed (under min_words words, or over repeat_percent % of the words in repeated
    3-word windows); otherwise it says whether lines that the CRF labels content hold at least content_share of the
    characters of all lines with a word.  A null or empty text has no words: base_failed, content_share 0.  Repeated
    rows give repeated rows; an empty table gives an empty one; without usable labels UNFITTED weights hold.
    Other columns aren't read.  No shuffle.
    """
    crf = fit_crf(docs, labels, fit, content_share=content_share, id_col=id_col, text_col=text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [judged(t.as_py(), crf, content_share, min_words, repeat_percent) for t in batch.column(1)]
            columns = [*zip(*out)] or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"])

    df = small_batches(docs).select(id_col, text_col)
    return df.mapInArrow(rows, f"`{id_col}` {df.schema[0].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, content_share double")
