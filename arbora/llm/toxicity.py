"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Token labels come from document labels: a word of a toxic training document is labelled toxic if the word, or its
first four or five letters, marks toxic documents (found in several, and hardly in others).  The field has two states
and features of the word, its prefixes and suffix, and of its neighbours.  A text of any length is one chain: the
messages are ratios of two potentials, so that a step is a Moebius map; the maps of runs of STEPS words are multiplied
for all runs at once, which gives what enters each run, and then all runs advance together.  Forward-backward gives each
word's marginal; their maximum and sum, fed to a logistic calibration on the training documents, give the document's
score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import fold
from arbora.llm.tokens import WORD, encode, fit_logistic, hashed, logistic, slices

FOLDS, HELD_OUT = 5, 0
#: Bounds of the training sample: toxic and other documents, each read whole.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1_000, 1_400
SIZE = 1 << 18
#: A cue must be found in so many toxic documents that the log of the chance of none of them being clean is below this.
LUCK = -6.0
STEPS = 128
PAIRS = 1 << 18
ROUNDS = 24


def word_features(word: str) -> list[int]:
    return [hashed("w", word, SIZE), hashed("3", word[:3], SIZE), hashed("4", word[:4], SIZE), hashed("5", word[:5], SIZE), hashed("s", word[-3:], SIZE)]


def cues(lists: list[list[str]], toxic: np.ndarray, least: int = 3) -> set[str]:
    """Words ("w..."), and prefixes ("4...", "5..."), found often in toxic documents and hardly in others."""
    there, other = Counter(), Counter()
    for words, y in zip(lists, toxic, strict=True):
        seen = {f"w{w}" for w in set(words)} | {f"{k}{w[:k]}" for w in set(words) for k in (4, 5) if len(w) >= k}
        (there if y else other).update(seen)
    n_there, n_other = max(1, int(toxic.sum())), max(1, int(len(toxic) - toxic.sum()))
    chance = np.log(n_there / (n_there + n_other))
    return {c for c, n in there.items() if n >= least and n / n_there >= 20 * (other[c] + 0.3) / n_other and n * chance <= LUCK}


def is_cue(word: str, marks: set[str]) -> bool:
    return f"w{word}" in marks or (len(word) >= 4 and f"4{word[:4]}" in marks) or (len(word) >= 5 and f"5{word[:5]}" in marks)


def _entering(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, first: float) -> np.ndarray:
    """What enters each column if x becomes (a x + b) / (c x + d) at each of its places (rows), and columns follow each other."""
    p, q, r, s = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for i in range(1, len(a)):
        p, q, r, s = a[i] * p + b[i] * r, a[i] * q + b[i] * s, c[i] * p + d[i] * r, c[i] * q + d[i] * s
        if i % 4 == 3:
            scale = p + q + r + s
            p, q, r, s = p / scale, q / scale, r / scale, s / scale
    out, x = np.empty(len(p)), first
    for k, (w, y, u, v) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        out[k] = x
        x = (w * x + y) / (u * x + v)
    return out


def messages(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x after each place of a sequence of maps x -> (a x + b) / (c x + d), the first of which has no use for x."""
    n = len(a)
    runs = -(-n // STEPS)

    def grid(v: np.ndarray, fill: float) -> np.ndarray:  # a column a run
        out = np.full((runs, STEPS), fill)
        out.ravel()[:n] = v
        return np.ascontiguousarray(out.T)

    a, b, c, d = grid(a, 1.0), grid(b, 0.0), grid(c, 0.0), grid(d, 1.0)
    x = _entering(a, b, c, d, 1.0)
    for i in range(STEPS):
        x = (a[i] * x + b[i]) / (c[i] * x + d[i])
        a[i] = x  # no longer needed as a factor
    return a.T.ravel()[:n]


def forward_backward(e: np.ndarray, first: np.ndarray, start: float, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of the toxic state at each word, and the forward and backward messages (log odds) they come from.

    ``e``: log odds of the words by themselves; ``first``: whether a word starts a text; t[i, j]: log potential from
    state i to j.
    """
    if not len(e):
        return e, e, e
    here, to = np.exp(np.clip(e, -30, 30)), np.exp(np.clip(t, -12, 12))
    go = ~first
    f = messages(here * to[1, 1] * go, here * np.where(first, np.exp(np.clip(start, -30, 30)), to[0, 1]), to[1, 0] * go, np.where(first, 1.0, to[0, 0]))
    go, after = np.append(go[1:], False), np.append(here[1:], 1.0)  # whether another word of the text follows
    b = messages(*(v[::-1] for v in (after * to[1, 1] * go, np.where(go, to[1, 0], 1.0), after * to[0, 1] * go, np.where(go, to[0, 0], 1.0))))[::-1]
    f, b = np.log(f), np.log(b)
    return f + b, f, b


class Field:
    """Weights: three per feature (this word, the word before, the word after), start and transition potentials."""

    def __init__(self):
        self.w = np.zeros((3, SIZE), dtype=np.float32)
        self.start, self.t = 0.0, np.zeros((2, 2))
        self.bias = -4.0
        self.doc = np.array([1.0, 1.0, 0.0])

    def emissions(self, codes: np.ndarray, starts: np.ndarray, features: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        of = self.w[:, features].sum(2)
        e = of[0][codes] + self.bias
        inner = np.ones(len(codes), dtype=bool)
        inner[starts[:-1][np.diff(starts) > 0]] = False  # a text's first word has none before it
        e[inner] += of[1][codes[np.flatnonzero(inner) - 1]]
        before = np.flatnonzero(inner) - 1
        e[before] += of[2][codes[before + 1]]
        return e

    def marginals(self, codes: np.ndarray, starts: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Log odds of every word's toxic state."""
        return forward_backward(self.emissions(codes, starts, features), firsts(starts), self.start, self.t)[0]

    def fit(self, codes: np.ndarray, starts: np.ndarray, features: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = 0.3, l2: float = 1e-6) -> None:
        """Adagrad on the conditional likelihood of the token labels ``y``."""
        if not len(codes):
            return
        first = firsts(starts)
        here, n = np.flatnonzero(~first), len(features)
        is_t, next_t = y[here - 1], y[here]
        sums = [np.full(self.w.shape, 1e-3, dtype=np.float32), 1e-3, np.full((2, 2), 1e-3), 1e-3]
        scale = 1.0 / max(1.0, y.sum())
        seen = np.array([((1 - is_t) * (1 - next_t)).sum(), ((1 - is_t) * next_t).sum(), (is_t * (1 - next_t)).sum(), (is_t * next_t).sum()]).reshape(2, 2)
        for _ in range(rounds):
            e = self.emissions(codes, starts, features)
            odds, f, b = forward_backward(e, first, self.start, self.t)
            g = logistic(odds) - y
            by_word = [np.bincount(codes, g, n), np.bincount(codes[here - 1], g[here], n), np.bincount(codes[here], g[here - 1], n)]
            gw = np.stack([np.bincount(features.ravel(), np.repeat(x, features.shape[1]), SIZE) for x in by_word]) * scale + l2 * self.w
            expected = np.zeros(4)  # pairs of neighbouring states
            for k in range(0, len(here), PAIRS):
                at = here[k : k + PAIRS]
                x, z = f[at - 1], e[at] + b[at]
                logs = np.stack([np.zeros_like(x) + self.t[0, 0], z + self.t[0, 1], x + self.t[1, 0], x + z + self.t[1, 1]])
                pair = np.exp(logs - logs.max(0))
                expected += (pair / pair.sum(0)).sum(1)
            gt = (expected.reshape(2, 2) - seen) * scale
            gs, gb = g[first].sum() * scale, g.sum() * scale
            for i, grad in enumerate((gw, gs, gt, gb)):
                sums[i] = sums[i] + grad * grad
            self.w -= (rate * gw / np.sqrt(sums[0])).astype(np.float32)
            self.start -= rate * gs / np.sqrt(sums[1])
            self.t = self.t - rate * gt / np.sqrt(sums[2])
            self.bias -= rate * gb / np.sqrt(sums[3])


def firsts(starts: np.ndarray) -> np.ndarray:
    """Whether each word is the first of its text."""
    out = np.zeros(int(starts[-1]), dtype=bool)
    out[starts[:-1][np.diff(starts) > 0]] = True
    return out


def documents_of(odds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row a text: its greatest log odds (-10 without words, at most 10) and the log of its expected toxic words."""
    out = np.full((len(starts) - 1, 2), -10.0)
    some = np.diff(starts) > 0
    if len(odds):
        at = starts[:-1][some]
        out[some, 0] = np.clip(np.maximum.reduceat(odds, at), -10, 10)
        out[some, 1] = np.clip(np.log(np.add.reduceat(logistic(odds), at) + 1e-9), -10, 10)
    return out


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    codes, starts, words = encode([WORD.findall(t.lower()) for t in texts])
    features = np.array([word_features(w) for w in words], dtype=np.int64).reshape(-1, 5)
    return codes, starts, features, words


def train(texts: list[str], toxic: list[int]) -> Field:
    field, y = Field(), np.asarray(toxic, dtype=float)
    if not texts:
        return field
    codes, starts, features, words = coded([t or "" for t in texts])
    lists = [[words[c] for c in codes[a:b]] for a, b in zip(starts, starts[1:])]  # noqa: RUF007
    marks = cues(lists, y > 0)
    cue = np.array([is_cue(w, marks) for w in words], dtype=float)
    owner = np.repeat(y, np.diff(starts))
    field.fit(codes, starts, features, cue[codes] * owner if len(codes) else np.zeros(0))
    field.doc = fit_logistic(documents_of(field.marginals(codes, starts, features), starts), y)
    return field


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Whole texts and labels of a hash sample of labelled documents outside the held-out fold; of repeated labels the highest."""
    known = labels.where((fold("doc_id", FOLDS) != HELD_OUT) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {bool(r["t"]): r["n"] for r in known.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    dice, top = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), 1 << 30
    rate = {t: min(top, int(top * most / max(1, counts.get(t, 0))) + 1) for t, most in ((True, SAMPLE_TOXIC), (False, SAMPLE_CLEAN))}
    few = known.where(dice < F.when(F.col("toxic") > 0, rate[True]).otherwise(rate[False])).orderBy(dice, "doc_id").limit(2 * (SAMPLE_TOXIC + SAMPLE_CLEAN))
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(few), "doc_id")
    got = sorted(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect(), key=lambda r: r["doc_id"])
    return [r["text"] for r in got], [int(r["toxic"] > 0) for r in got]


def scored_spans(field: Field, texts: list[str | None], with_spans: bool) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Scores, and the (start, end, probability) of runs of toxic words, as offsets in code points."""
    scores, spans = np.zeros(len(texts)), [[] for _ in texts]
    for first, run in slices(texts):
        codes, starts, features, _ = coded(run)
        odds = field.marginals(codes, starts, features)
        scores[first : first + len(run)] = logistic(documents_of(odds, starts) @ field.doc[:2] + field.doc[2])
        if with_spans:
            hit = odds > 0
            for i in np.unique(np.repeat(np.arange(len(run)), np.diff(starts))[hit]) if hit.any() else []:
                low = run[i].lower()
                places = [m.span() for m in WORD.finditer(low)] if len(low) == len(run[i]) else [m.span() for m in WORD.finditer("".join(c.lower()[0] for c in run[i]))]
                found, last = [], -2
                for j in np.flatnonzero(hit[starts[i] : starts[i + 1]]):
                    if j >= len(places):  # a letter whose lower case is several characters has shifted the words
                        break
                    p = float(logistic(odds[starts[i] + j]))
                    if j == last + 1:
                        found[-1] = (found[-1][0], places[j][1], max(found[-1][2], p))
                    else:
                        found.append((*places[j], p))
                    last = j
                spans[first + int(i)] = found
    return scores, spans


def with_toxicity(docs: DataFrame, field: Field, text: str = "text", name: str = "_toxicity") -> DataFrame:
    """Adds a struct of score, predicted and spans (start, end, probability) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))  # plain arrays, so that executors need no copy of this module

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Field()
        vars(own).update(shared.value)
        for texts in batches:
            scores, spans = scored_spans(own, texts.tolist(), True)
            cells = [[{"start": a, "end": b, "probability": p} for a, b, p in s] for s in spans]
            yield pd.DataFrame({"score": scores, "predicted": (scores >= 0.5).astype("int32"), "spans": cells})

    udf = F.pandas_udf(judge, "score double, predicted int, spans array<struct<start:int,end:int,probability:double>>")
    return docs.withColumn(name, udf(F.col(text)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, spans.

    Learns from labels (doc_id, toxic) of documents outside the held-out fold; null ids and labels teach nothing, and
    with no label at all the score is that of an even prior.  Null and empty texts have no spans and the score of a
    text without toxic words.  Rows with a null id are scored and not held out; repeated rows are scored alike; other
    columns are not read.  A score of exactly 0.5 predicts 1; words at even odds are no span.  A very long text is one
    chain, as any other.
    """
    field = train(*training_sample(docs, labels))
    judged = with_toxicity(docs.select("doc_id", "text"), field)
    return judged.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "_toxicity.*")
