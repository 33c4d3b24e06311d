"""Quality classifier by co-training of two views.

The content view sees a text's words, the shapes of its tokens and a few densities; the metadata view sees source,
language and lengths.  Both start from the labelled sample.  In each round each view names the unlabelled documents
it is surest of, in the classes' labelled proportions, and the other view learns from these pseudo-labels (a document
that both name differently is dropped).  At the end each view is calibrated on labelled documents that were set aside
from training, a quarter of each class, and a logistic combination of the calibrated views, fitted on the same documents,
scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import fresh, quoted
from arbora.llm.tokens import encode, fit_logistic, hashed, logistic, slices

#: Bounds of the training sample: labelled documents of each class, and unlabelled ones, each read whole.
SAMPLE_CLASS = 1_000
SAMPLE_UNLABELLED = 1_500
SIZE = 1 << 16
META_SIZE = 1 << 10
ROUNDS = 4
GROWTH = 0.1
#: Documents whose probability of good quality is below this are rejected.
LEAST = 0.25
_SHAPE = [(re.compile(p), r) for p, r in ((r"[^\W\d_]", "a"), (r"\d", "0"), (r"(.)\1+", r"\1+"))]
DENSE = 6


def shape(token: str) -> str:
    """Letters to a (A where the token is all capitals), digits to 0, runs to one character and a plus."""
    capital = token.isupper() and len(token) > 1
    for pattern, by in _SHAPE:
        token = pattern.sub(by, token)
    return ("A" if capital else "a") + token[-6:]


class Content:
    """Averaged hashed words and shapes, and densities, of texts."""

    @staticmethod
    def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes, starts, the two feature ids of each distinct token, and a row of densities a text."""
        codes, starts, tokens = encode([t.split() for t in texts])
        ids = np.array([(hashed("w", t.lower(), SIZE), hashed("s", shape(t), SIZE)) for t in tokens], dtype=np.int64).reshape(-1, 2)
        n = np.maximum(1, np.diff(starts))
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        distinct = np.zeros(len(texts))
        if len(codes):
            pairs = np.unique(owner * (len(tokens) + 1) + codes)
            distinct = np.bincount(pairs // (len(tokens) + 1), minlength=len(texts))
        again = np.zeros(len(texts))
        if len(codes) > 1:
            same = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
            again = np.bincount(owner[1:][same], minlength=len(texts))
        letter = np.array([any(c.isalpha() for c in t) for t in tokens], dtype=float)
        capital = np.array([t.isupper() and len(t) > 1 for t in tokens], dtype=float)
        tail = np.array([not t[-1].isalnum() and t[-1] not in ".,;:?!)\"'" for t in tokens], dtype=float)
        mean = lambda v: np.bincount(owner, v[codes], len(texts)) / n if len(codes) else np.zeros(len(texts))
        dense = np.column_stack([np.log1p(np.diff(starts)) / 8, distinct / n, again / n, mean(letter), mean(capital), mean(tail)])
        return codes, starts, ids, dense

    def __init__(self):
        self.w, self.d, self.b = np.zeros(SIZE, dtype=np.float32), np.zeros(DENSE), 0.0

    def odds(self, made) -> np.ndarray:
        codes, starts, ids, dense = made
        out = dense @ self.d + self.b
        if len(codes):
            each = self.w[ids].sum(1)[codes]
            owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            out = out + np.bincount(owner, each, len(starts) - 1) / np.maximum(1, np.diff(starts))
        return out

    def fit(self, made, rows: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.5) -> None:
        codes, starts, ids, dense = made
        n, owner = np.maximum(1, np.diff(starts)), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.__init__()
        weight = np.zeros(len(starts) - 1)
        weight[rows] = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))  # classes count alike
        target = np.zeros(len(starts) - 1)
        target[rows] = y
        sw, sd, sb = np.full(SIZE, 1e-8), np.full(DENSE, 1e-8), 1e-8
        for _ in range(rounds):
            g = weight * (logistic(self.odds(made)) - target)
            by_token = np.bincount(codes, (g / n)[owner], len(ids)) if len(codes) else np.zeros(len(ids))
            gw = np.bincount(ids.ravel(), np.repeat(by_token, 2), SIZE) + 1e-6 * self.w
            gd, gb = dense.T @ g + 1e-5 * self.d, g.sum()
            sw, sd, sb = sw + gw * gw, sd + gd * gd, sb + gb * gb
            self.w -= (rate * gw / np.sqrt(sw)).astype(np.float32)
            self.d -= rate * gd / np.sqrt(sd)
            self.b -= rate * gb / np.sqrt(sb)


class Metadata:
    """One-hot source, language and their pair, and the page's declared length."""

    @staticmethod
    def features(sources: list, langs: list, n_chars: list) -> np.ndarray:
        rows = []
        for s, x, n in zip(sources, langs, n_chars, strict=True):
            known = n is not None and n == n
            size = int(np.log2(1 + max(0, n)) * 2) if known else -1
            rows.append((hashed("s", str(s), META_SIZE), hashed("l", str(x), META_SIZE), hashed("p", f"{s}|{x}", META_SIZE), hashed("n", str(size), META_SIZE)))
        return np.array(rows, dtype=np.int64).reshape(-1, 4)

    def __init__(self):
        self.w, self.b = np.zeros(META_SIZE), 0.0

    def odds(self, made: np.ndarray) -> np.ndarray:
        return self.w[made].sum(1) + self.b

    def fit(self, made: np.ndarray, rows: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.2) -> None:
        self.__init__()
        x = made[rows]
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
        sw, sb = np.full(META_SIZE, 1e-8), 1e-8
        for _ in range(rounds):
            g = weight * (logistic(self.odds(x)) - y)
            gw = np.bincount(x.ravel(), np.repeat(g, 4), META_SIZE) + 1e-3 * self.w
            sw, sb = sw + gw * gw, sb + g.sum() ** 2
            self.w -= rate * gw / np.sqrt(sw)
            self.b -= rate * g.sum() / np.sqrt(sb)


class Quality:
    def __init__(self):
        self.content, self.metadata = Content(), Metadata()
        self.combine, self.log = np.array([0.5, 0.5, 0.0]), []
        self.scale = np.array([[1.0, 0.0], [1.0, 0.0]])  # of each view's odds: factor and offset

    def state(self) -> dict:
        return {"content": vars(self.content), "metadata": vars(self.metadata), "combine": self.combine, "scale": self.scale}

    @classmethod
    def of(cls, state: dict) -> Quality:
        own = cls()
        vars(own.content).update(state["content"])
        vars(own.metadata).update(state["metadata"])
        own.combine, own.scale = state["combine"], state["scale"]
        return own

    def calibrated(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """The calibrated log odds of both views."""
        return np.clip(np.column_stack([content, metadata]), -8, 8) * self.scale[:, 0] + self.scale[:, 1]

    def views(self, texts: list, sources: list, langs: list, n_chars: list) -> np.ndarray:
        meta = self.metadata.odds(Metadata.features(sources, langs, n_chars))
        text = np.zeros(len(texts))
        for first, run in slices(texts):
            text[first : first + len(run)] = self.content.odds(Content.features(run))
        return self.calibrated(text, meta)

    def __call__(self, *columns) -> tuple[np.ndarray, np.ndarray]:
        v = self.views(*columns)
        return v, logistic(v @ self.combine[:2] + self.combine[2])


def train(rows: pd.DataFrame, rounds: int = ROUNDS, growth: float = GROWTH) -> Quality:
    """``rows``: doc_id, text, source, lang, n_chars, quality (null: unlabelled), in a fixed order."""
    model = Quality()
    y = rows["quality"].to_numpy(dtype=float, na_value=np.nan)
    known = np.flatnonzero(~np.isnan(y))
    if not len(known):
        return model
    y = np.where(y > 0, 1.0, np.where(np.isnan(y), np.nan, 0.0))
    aside = np.concatenate([known[y[known] == v][3::4] for v in (0.0, 1.0)])  # a quarter of each class for the calibration
    first = np.setdiff1d(known, aside)
    text = Content.features([t or "" for t in rows["text"]])
    meta = Metadata.features(rows["source"].tolist(), rows["lang"].tolist(), rows["n_chars"].tolist())
    pseudo: list[dict[int, float]] = [{}, {}]  # what each view has been told by the other
    free = set(np.flatnonzero(np.isnan(y)).tolist())
    share = y[first].mean() if len(first) else 0.5
    for r in range(rounds + 1):
        for view, made, told in ((model.content, text, pseudo[0]), (model.metadata, meta, pseudo[1])):
            extra = np.array(sorted(told), dtype=np.int64)
            view.fit(made, np.concatenate([first, extra]), np.concatenate([y[first], [told[int(i)] for i in extra]]))
        if r == rounds or not free:
            break
        odds, pool = [model.content.odds(text), model.metadata.odds(meta)], np.array(sorted(free))
        named: list[dict[int, float]] = []
        for o in odds:
            ranked = pool[np.argsort(o[pool], kind="stable")]
            n = max(1, int(growth * len(pool)))
            low, high = ranked[: max(1, int(n * (1 - share)))], ranked[len(ranked) - max(1, int(n * share)) :]
            sure = {int(i): 0.0 for i in low if o[i] < -1.0} | {int(i): 1.0 for i in high if o[i] > 1.0}
            named.append(sure)
        clash = {i for i in named[0] if i in named[1] and named[0][i] != named[1][i]}
        pseudo[1].update({i: v for i, v in named[0].items() if i not in clash})
        pseudo[0].update({i: v for i, v in named[1].items() if i not in clash})
        free -= clash | named[0].keys() | named[1].keys()
        model.log.append((len(named[0]), len(named[1]), len(clash)))
    odds = model.content.odds(text), model.metadata.odds(meta)
    if 0 < y[aside].sum() < len(aside):  # with fewer than four of a class the views are averaged as they are
        model.scale = np.stack([fit_logistic(np.clip(o[aside], -8, 8)[:, None], y[aside]) for o in odds])
        model.combine = fit_logistic(model.calibrated(*odds)[aside], y[aside])
    return model


def training_sample(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """A hash sample of labelled and of other documents, by id; of repeated labels the lowest counts."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {bool(r["q"]): r["n"] for r in known.groupBy((F.col("quality") > 0).alias("q")).agg(F.count(F.lit(1)).alias("n")).collect()}
    dice, top = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)), 1 << 30
    rate = {q: min(top, int(top * SAMPLE_CLASS / max(1, counts.get(q, 0))) + 1) for q in (True, False)}
    few = known.where(dice < F.when(F.col("quality") > 0, rate[True]).otherwise(rate[False])).orderBy(dice, "doc_id").limit(3 * SAMPLE_CLASS)
    total = max(1, docs.count())
    columns = ["doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars")]
    base = docs.where("text is not null and doc_id is not null").select(*columns)
    other = base.where(dice >= top - min(top, int(top * SAMPLE_UNLABELLED / total) + 1)).join(known, "doc_id", "left_anti")
    other = other.orderBy(dice.desc(), "doc_id").limit(2 * SAMPLE_UNLABELLED)
    rows = base.join(F.broadcast(few), "doc_id").unionByName(other.withColumn("quality", F.lit(None).cast("int")))
    return rows.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id", ignore_index=True)


def with_quality(docs: DataFrame, model: Quality, name: str = "_quality") -> DataFrame:
    """Adds a struct of score_content, score_metadata, score (probability of good quality) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        own = Quality.of(shared.value)
        for columns in batches:
            views, score = own(*[c.tolist() for c in columns])
            yield pd.DataFrame({"score_content": logistic(views[:, 0]), "score_metadata": logistic(views[:, 1]), "score": score, "rejected": score < LEAST})

    udf = F.pandas_udf(judge, "score_content double, score_metadata double, score double, rejected boolean")
    return docs.withColumn(name, udf(F.col("text"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long")))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, score_content, score_metadata, score, predicted (1 good, at 0.5), rejected.

    Learns from labels (doc_id, quality); null ids and labels teach nothing, and with no label every score is that of
    an even prior.  Null and empty texts are judged as texts without tokens, null metadata as values of their own.
    Repeated rows are scored alike; other columns are not read.  Very long texts are read whole; a score of exactly 0.5
    predicts 1, one of exactly LEAST is not rejected.
    """
    model = train(training_sample(docs, labels))
    judged = with_quality(docs.select("doc_id", "text", "source", "lang", "n_chars"), model)
    return judged.select("doc_id", "_quality.*").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    model, name = train(training_sample(docs, labels)), fresh(docs, "_quality")
    return with_quality(docs, model, name).where(f"not {name}.rejected").select(*quoted(docs.columns))
