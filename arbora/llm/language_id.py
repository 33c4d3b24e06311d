"""Language identification by compression.

Each language has zstandard raw-content dictionaries made of whole training texts, as many as they hold.  A text
(lower-cased, runs of other than letters made one space) is encoded whole, in blocks that each start from the dictionary
alone so that a long text does not become its own dictionary, with every language's dictionaries; the smallest total
wins.  The margin is the saving over the runner-up; where it is narrow the text is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm.shared import fold, fresh, quoted

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Bounds of the training sample: documents of each language, and bytes of a dictionary.
SAMPLE_DOCS = 400
DICTIONARY = 110_000
MOST_BROADCAST = 1_000_000
SHARDS = 2
MIN_MARGIN = 0.01
BLOCK = 4_096
_OTHER = re.compile(r"[\W\d_]+")


def normalize(text: str | None) -> str:
    """Lower case, anything but letters made one space; empty if there is no letter (marks and fractions alone are none)."""
    clean = _OTHER.sub(" ", text.lower()).strip() if text else ""
    return clean if any(c.isalpha() for c in clean) else ""


def training_sample(docs: DataFrame) -> dict[str, list[str]]:
    """Whole texts by language, the commonest first: a hash sample of at most SAMPLE_DOCS documents of every language."""
    known = docs.where((fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").collect()}
    if not counts:
        return {}
    # ids are chosen without their texts; the few chosen are then read
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    few = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE_DOCS)
    few = few.groupBy("lang", "doc_id").agg(F.min("k").alias("k"))
    if len(counts) * SAMPLE_DOCS <= MOST_BROADCAST:
        few = F.broadcast(few)
    rows = known.join(few, ["lang", "doc_id"]).select("lang", "k", "text").distinct().collect()
    out: dict[str, list[str]] = {lang: [] for lang in counts}
    for r in sorted(rows, key=lambda r: (r["k"], r["text"])):
        out[r["lang"]].append(r["text"])
    return out


def dictionaries(sample: dict[str, list[str]]) -> dict[str, list[bytes]]:
    """Dictionary contents by language: its texts dealt in turn to SHARDS dictionaries, each filled to DICTIONARY bytes.

    Shorter texts come first, so that a dictionary holds many; the last text of one is cut between two characters.
    """
    made = {}
    for lang, texts in sample.items():
        clean, shards = sorted((t for t in map(normalize, texts) if t), key=lambda t: (len(t), t)), []
        for s in range(SHARDS):
            data = " ".join(clean[s::SHARDS]).encode("utf-8", "replace")[:DICTIONARY]
            shards.append(data.decode("utf-8", "ignore").encode())
        if any(len(s) >= 8 for s in shards):
            made[lang] = [s for s in shards if len(s) >= 8]
    return made


class Classifier:
    def __init__(self, contents: dict[str, list[bytes]]):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            strategy=z.STRATEGY_GREEDY, min_match=4, search_log=3, window_log=19, hash_log=17, chain_log=16, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self.coders = {}
        for lang, shards in contents.items():
            self.coders[lang] = []
            for shard in shards:
                d = z.ZstdCompressionDict(shard, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                self.coders[lang].append(z.ZstdCompressor(compression_params=params, dict_data=d))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and margin in [0, 1); (UNKNOWN, 0) if there is no letter or nothing was learnt."""
        clean = normalize(text)
        if not clean or not self.coders:
            return UNKNOWN, 0.0
        data = clean.encode("utf-8", "replace")
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for c in coders for b in blocks) / len(coders), k, lang) for k, (lang, coders) in enumerate(self.coders.items()))
        if len(sizes) == 1:
            return sizes[0][2], 1.0 - 1e-9
        return sizes[0][2], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def with_language(docs: DataFrame, contents: dict[str, list[bytes]], text: str = "text", name: str = "_language", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Adds a struct of lang_pred, score, margin and rejected, judged from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = Classifier(shared.value)
        for texts in batches:
            found = [classify(t) for t in texts]
            margin = pd.Series([m for _, m in found], dtype=float)
            lang = pd.Series([x for x, _ in found], dtype=object)
            yield pd.DataFrame({"lang_pred": lang, "score": margin / (margin + 0.02), "margin": margin, "rejected": (margin < min_margin) | (lang == UNKNOWN)})

    udf = F.pandas_udf(judge, "lang_pred string, score double, margin double, rejected boolean")
    return docs.withColumn(name, udf(F.col(text)))


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, margin, rejected.

    Learns from ``train`` (``docs`` if None): rows with a text, a language and an id outside the held-out fold.
    Null, empty and letterless texts get "und", score 0 and are rejected, as does every text where nothing could be
    learnt.  Equal sizes go to the language with most training rows, with margin 0.  Rows with a null id are judged, not
    held out.  Repeated rows are judged alike; other columns are not read.  A very long text is encoded whole, block by
    block.
    """
    contents = dictionaries(training_sample(docs if train is None else train))
    judged = with_language(docs.select("doc_id", "text"), contents)
    return judged.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "_language.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told by a margin that is not narrow."""
    name = fresh(docs, "_language")
    judged = with_language(docs, dictionaries(training_sample(docs)), name=name)
    return judged.where(f"not {name}.rejected").select(*quoted(docs.columns))
