"""Language identification: scripts narrow the candidates, Viterbi over word scores labels spans of mixed texts."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.llm.common import bitmap, dropped, fresh, perhaps, small_batches, written

UNKNOWN = "und"
#: Runs of letters and of numbers that aren't decimal digits, such as fractions and Roman numerals; words() cuts at the latter.
_RUN = re.compile(r"[^\W\d_]+")
_CACHE = 250_000


@dataclass(frozen=True)
class Fit:
    """Bounds of what word scores are learned from and of the model, which is sent to all workers.

    docs documents at most, divided evenly among the languages (but least of each one in any case), those of smallest
    xxhash64(doc_id); of each, the counts of grams n-grams of its most frequent kinds.  The model has kept n-grams at
    most: each language's most frequent ones in turn, so that a language with few documents has as many as others.  It
    takes 4 * kept * languages bytes for the scores, and some 100 * kept for the n-grams: 4 MB with four languages.
    """

    docs: int = 3000
    least: int = 20
    grams: int = 4000
    order: tuple[int, ...] = (3,)
    kept: int = 30_000


def words(text: str) -> list[str]:
    """The words of a text: its runs of letters."""
    found = _RUN.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ("".join(c if c.isalpha() else " " for c in run).split() if not run.isalpha() else (run,))]


def places(text: str) -> list[tuple[int, int]]:
    """Where the words of a text begin and end."""
    out = []
    for m in _RUN.finditer(text):
        if m.group().isalpha():
            out.append(m.span())
            continue
        at = m.start()
        for letter, own in groupby(m.group(), str.isalpha):
            n = sum(1 for _ in own)
            if letter:
                out.append((at, at + n))
            at += n
    return out


def script(char: str) -> str:
    """The script of a letter: the first word of its Unicode name (LATIN, CYRILLIC, GREEK, CJK, ...)."""
    return "LATIN" if char < "ɐ" else unicodedata.name(char, "UNKNOWN").split(" ")[0].split("-")[0]


def grams(word: str, order: tuple[int, ...]) -> Iterator[str]:
    """n-grams of a lower-cased word between blanks."""
    w = f" {word} "
    for n in order:
        for i in range(len(w) - n + 1):
            yield w[i : i + n]


@dataclass
class Model:
    """Log-probabilities of n-grams for each language, and the languages seen with each script."""

    languages: list[str]
    row_of: dict[str, int]
    log_p: np.ndarray
    scripts: dict[str, np.ndarray]
    order: tuple[int, ...]
    penalty: float
    _cache: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def __post_init__(self):
        #: script -> the languages that it rules out, for scripts that rule out some but not all
        self._excluded = {s: ~allowed for s, allowed in self.scripts.items() if allowed.any() and not allowed.all()}

    def scores(self, words: list[str]) -> np.ndarray:
        """For each word and language: the mean log-probability of its grams times the square root of its length;
        languages that the word's script rules out lose 60.  log_p's last row is for unseen grams."""
        get, unseen, excluded = self.row_of.get, len(self.log_p) - 1, self._excluded
        index, at, size, ruled = [], [], [], []
        for i, word in enumerate(words):
            low = word.lower()
            at.append(len(index))
            w = f" {low} "
            for n in self.order:
                index += [get(w[j : j + n], unseen) for j in range(len(w) - n + 1)]
            size.append(len(low) ** 0.5 / (len(index) - at[-1]))
            no = excluded.get("LATIN" if low[0] < "ɐ" else script(low[0]))
            if no is not None:
                ruled.append((i, no))
        out = np.add.reduceat(self.log_p[index], at, axis=0) * np.array(size)[:, None]
        for i, no in ruled:
            out[i, no] -= 60
        return out

    def rows(self, words: list[str]) -> np.ndarray:
        cache = self._cache
        new = [w for w in dict.fromkeys(words) if w not in cache]
        if len(new) > _CACHE // 2:
            return self.scores(words)
        if self._rows is None or len(cache) + len(new) > _CACHE:
            cache.clear()
            self._rows = np.empty((_CACHE, len(self.languages)), np.float32)
            new = [*dict.fromkeys(words)]
        if new:
            first = len(cache)
            self._rows[first : first + len(new)] = self.scores(new)
            cache.update(zip(new, range(first, first + len(new))))
        return self._rows[list(map(cache.__getitem__, words))]

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The best label of each word, where each change of language costs the penalty.

        One language throughout is the best path if no stretch of words gains more than the penalty by leaving it
        (the largest sum over a stretch of the best other language's lead); then no table is filled.
        """
        whole = int(scores.sum(axis=0).argmax())
        n, k = scores.shape
        if k == 1:
            return np.zeros(n, np.int64)
        lead = np.delete(scores, whole, axis=1).max(axis=1) - scores[:, whole]
        total = np.concatenate([[0.0], np.cumsum(lead)])
        if (total - np.minimum.accumulate(total)).max() <= self.penalty:
            return np.full(n, whole)
        return self.viterbi(scores)

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        n, k = scores.shape
        back = np.empty((n, k), np.int32)
        best = scores[0].copy()
        own = np.arange(k)
        for t in range(1, n):
            top = int(best.argmax())
            jump = best[top] - self.penalty
            stay = best >= jump
            back[t] = np.where(stay, own, top)
            best = np.where(stay, best, jump) + scores[t]
        out = np.empty(n, np.int64)
        out[-1] = best.argmax()
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, language) of the stretches of a text, code points."""
        found = places(text)
        if not found or not self.languages:
            return []
        path = self.path(self.rows([text[a:b] for a, b in found]))
        cut = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(found)]
        return [(found[a][0], found[b - 1][1], self.languages[path[a]]) for a, b in zip(cut, cut[1:])]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with most letters along the best path, and its share of the letters."""
        found = words(text or "")
        if not found or not self.languages:
            return UNKNOWN, 0.0
        path = self.path(self.rows(found))
        size = np.bincount(path, np.fromiter(map(len, found), np.float64, len(found)), len(self.languages))
        return self.languages[int(size.argmax())], float(size.max() / size.sum())


def learnable(docs: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """Rows that may be learned from: a language, and crc32(id as text) mod 3 other than 1."""
    return docs.filter(F.col(lang_col).isNotNull() & (held_out(id_col) == F.lit(False)))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, fit: Fit = Fit(), *, penalty: float = 6.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from a bounded sample; only n-gram counts of the sample reach the driver.

    Every language that has a document to learn from with a letter in it is learned.
    """
    order, most = fit.order, fit.grams
    own = learnable(docs, id_col=id_col, lang_col=lang_col).filter(F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(id_col, lang_col)
    n_languages = own.select(lang_col).distinct().count()
    each = max(fit.least, fit.docs // max(1, n_languages))
    # Spark keeps the first rows of each language in every task before they meet
    drawn = own.withColumn("place", F.row_number().over(Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col))).filter(F.col("place") <= each)
    sample = written(drawn.select(F.col(id_col).alias("id")).distinct(), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c, scripts = Counter(), Counter()
                for w, n in Counter(words(text or "")).items():
                    low = w.lower()
                    scripts[script(low[0])] += n
                    for g in grams(low, order):
                        c[g] += n
                out += [(lang, g, n) for g, n in c.most_common(most)] + [(lang, f"\0{s}", n) for s, n in scripts.items()]
            columns = [*zip(*out)] or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["lang", "gram", "n"])

    lines = written(bitmap(sample, "id"), "bitmap")
    mark = fresh(docs, "_perhaps")[0]
    texts = perhaps(small_batches(docs), id_col, lines, mark).filter(F.col(mark) & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    texts = texts.join(sample, "id", "left_semi").select("text", "lang")
    counted = texts.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    is_script = F.col("gram").startswith("\0")
    ranked = counted.withColumn("place", F.row_number().over(Window.partitionBy("lang", is_script).orderBy(F.desc("n"), "gram"))).filter(F.col("place") <= fit.kept)
    by: dict[str, Counter] = defaultdict(Counter)
    best: dict[str, int] = {}
    for lang, gram, n, place in ranked.collect():
        by[lang][gram] = n
        best[gram] = min(place, best.get(gram, place))
    dropped(sample, lines)
    languages = sorted(by)
    seen = sorted((g for g in best if g[0] != "\0"), key=lambda g: (best[g], g))[: fit.kept]
    totals = np.array([sum(n for g, n in by[x].items() if g[0] != "\0") for x in languages], float)
    smooth = 0.5
    counts = np.array([[by[x][g] for x in languages] for g in seen] + [[0] * len(languages)], float).reshape(len(seen) + 1, len(languages))
    log_p = np.log((counts + smooth) / (totals + smooth * (len(seen) + 1))).astype(np.float32)
    names = {g[1:] for c in by.values() for g in c if g[0] == "\0"}
    scripts = {s: np.array([by[x][f"\0{s}"] > 0.001 * sum(n for g, n in by[x].items() if g[0] == "\0") for x in languages]) for s in names}
    return Model(languages, {g: i for i, g in enumerate(seen)}, log_p, scripts, order, penalty)


def language(docs: DataFrame, *, sample: Fit = Fit(), penalty: float = 6.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each document: held_out, lang_pred, score (the share of letters in spans of lang_pred).

    lang_pred is `und` with score 0 for a null text, one without letters, and everywhere if nothing can be learned.
    Neither the language nor the id is an input of a prediction.  Repeated rows give repeated rows, an empty table an
    empty one.  A prediction depends on its own text only: no shuffle of texts.
    """
    model = fit(docs, sample, penalty=penalty, id_col=id_col, text_col=text_col, lang_col=lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most Fit.kept grams

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=[id_col, "held_out", "lang_pred", "score"])

    df = small_batches(docs).select(id_col, held_out(id_col).alias("held_out"), text_col)
    return df.mapInArrow(rows, f"`{id_col}` {df.schema[0].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) with the language spans of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            spans = [[dict(zip(("start", "end", "lang"), s)) for s in shared.value.spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[id_col, "spans"])

    df = small_batches(docs).select(id_col, text_col)
    return df.mapInArrow(rows, f"`{id_col}` {df.schema[0].dataType.simpleString()}, spans array<struct<start:bigint,end:bigint,lang:string>>")
