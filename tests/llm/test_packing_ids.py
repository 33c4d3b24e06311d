import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from arbora.llm import packing as P
from arbora.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("text", ["end <|endoftext|> x", "<|endoftext|><|endoftext|>", "<|endoftext| >", "a" + " " * 1_100_000 + "b", "\n" * 1_000_001, "日本語の文章。" * 3_000])
def test_ids_of_added_tokens_and_long_runs(text):
    assert P.Encoder(PATH, added=True)([text])[0].tolist() == ids_of(text)


def test_query_and_stage_use_added_tokens(spark, tmp_path):
    import corpus_pipeline

    text = "end <|endoftext|> x " * 700
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = ids_of(text)
    for got in (queries.op4_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, "")):
        rows = sorted(got.collect(), key=lambda r: r.piece)
        assert len(rows) == math.ceil(len(want) / 1024)
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(np.array(want[r.start : r.start + r.length], dtype="<u4").tobytes())


def test_files_of_other_rules_go_to_the_library(tmp_path):
    import json

    data = json.loads(open(PATH, encoding="utf-8").read())
    data["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(data))
    from tokenizers import Tokenizer

    e = P.Encoder(str(tmp_path / "other.json"), added=True)
    assert not e.alike and P.Encoder(PATH).alike
    assert e(["word and word"])[0].tolist() == [*Tokenizer.from_file(str(tmp_path / "other.json")).encode("word and word", add_special_tokens=False).ids, 2]
