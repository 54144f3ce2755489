import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinicpulse.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counted(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r[1] for r in df.select("id", tokens.token_counts(df, PATH)(F.col("text"))).orderBy("id").collect()]


def test_agrees_with_the_library(spark, library):
    rng = random.Random(5)
    signs = ["a", "B", "é", "ß", "中", "🙂", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "!", "...", " ", " ", "\x1c", "\x85",
             "ing", "the ", "<|endoftext|>", "<|im_start|>", "́", "٣", "ñ", "\r\n", "_", "A" * 9]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["aaaa" * 50, "ab" * 500, " " * 100, "<|endoftext|>" * 3, "x<|endoftext|> y", "", "\n" * 77]
    wanted = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counted(spark, texts) == wanted


def test_real_texts_nulls_and_repeats(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    wanted = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counted(spark, [*texts, None, texts[0]]) == [*wanted, 0, wanted[0]]


def test_long_texts_and_long_pretokens(spark, library):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefghij", k=20_000)), "word " * 300_000, "=" * 50_000]
    assert counted(spark, texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_empty_table(spark):
    assert counted(spark, []) == []


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(tokens, "_REMEMBERED", 50)
    counter = tokens.Counter(tokens.Vocabulary.load(PATH))
    texts = [f"word{i} other{i % 7} again" for i in range(400)]
    assert counter.count(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(counter.known) <= 2000
