"""Best-fit packing: against the vocabulary's own library, a plain packer and the least number of sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinicpulse.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string"
TEXTS = [
    None, "", " ", "one two", "a<|endoftext|>b <|endoftext|>", "<|endoftext|", "don't 'sabc I'M", " \x1c\x85  x  \xa0 y\n\n z\n ", "12½ ²x 漢字　仮名 🙂",
    "word " * 1023, "word " * 1024, "word " * 2047, "ab\n\ncd " * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def plain_pieces(library, rows, limit=1024):
    out = []
    for doc_id, text in rows:
        ids = ids_of(library, text)
        first = len(ids) if len(ids) <= limit else len(ids) % limit or limit
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc_id, piece, a, b - a, np.array(ids[a:b], dtype="<u4").tobytes()))
    return sorted(out, key=str)


def check_places(rows, limit=1024):
    """No gap, no overlap, nothing above the limit; the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_ids_pieces_and_places(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "one two"), (3, "one two"), (4, "other text")]
    found = packing.packed(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    keys = [(r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in found]
    assert sorted(keys, key=str) == plain_pieces(library, rows)
    check_places(found)


def test_long_texts_are_encoded_alike_in_slices(spark, library, monkeypatch):
    rng = random.Random(5)
    signs = [" ", "  ", "\n", "\t\n", "\xa0", " \xa0", "　 ", "it's", "'ll", "héllo", "12", "!?", "漢", "\x1c", "<|endoftext|>", "x" * 40]
    encoder = packing.Encoder(spark, PATH)
    monkeypatch.setattr(packing, "_SLICE", 7)
    for _ in range(400):
        text = "".join(rng.choices(signs, k=rng.randint(0, 60)))
        assert [*encoder.encode(text).tolist(), 2] == ids_of(library, text)


def test_a_very_long_text_without_spaces(spark):
    rows = packing.packed(spark.createDataFrame([(1, "a" * 3_000_000), (2, " " * 3_000_000), (3, "^" * 1_500_000)], SCHEMA), PATH).collect()
    check_places(rows)
    assert {r["doc_id"] for r in rows} == {1, 2, 3}


def plain_best_fit(lengths, limit, open_bins):
    """Places by looking at every open bin; equal ones by the latest touched."""
    bins, n, out = [], 0, []
    for length in lengths:
        fits = [b for b in bins if b[1] >= length]
        if fits:
            least = min(b[1] for b in fits)
            chosen = [b for b in fits if b[1] == least][-1]
            bins.remove(chosen)
        else:
            if len(bins) == open_bins:
                least = min(b[1] for b in bins)
                bins.remove([b for b in bins if b[1] == least][-1])
            chosen, n = (n, limit), n + 1
        out.append((chosen[0], limit - chosen[1]))
        if chosen[1] > length:
            bins.append((chosen[0], chosen[1] - length))
    return out


@pytest.mark.parametrize("open_bins", [1, 2, 5, 1000])
def test_the_packer_is_best_fit_with_bounded_space(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.choice([rng.randint(1, 32), 32, rng.randint(1, 8)]) for _ in range(600)]
    packer = packing.Packer(32, open_bins)
    assert [packer.place(n) for n in lengths] == plain_best_fit(lengths, 32, open_bins)
    assert packer.opened <= open_bins


def test_few_sequences_on_the_documents(spark, library):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op12_best_fit_packing"](spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    wanted = [(*p[:4], zlib.crc32(p[4])) for p in plain_pieces(library, docs)]
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=str) == sorted(wanted, key=str)
    total = sum(r["length"] for r in rows)
    assert check_places(rows) <= 1.01 * total / 1024 + 1


def test_windows_over_several_tasks_stay_full(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), (F.col("id") * 37 % 900).cast("int")).alias("text"))
    rows = packing.packed(docs, PATH, settings=packing.Settings(window=2048, open_bins=1024)).select("sequence_id", "offset", "length").collect()
    assert len({r["sequence_id"] // packing._SEQUENCES_PER_PART for r in rows}) == 5
    assert check_places(rows) <= 1.02 * sum(r["length"] for r in rows) / 1024


def test_sequences_hold_their_pieces(spark):
    docs = spark.createDataFrame([(i, "some words " * (i * 7 % 300)) for i in range(60)], SCHEMA)
    placed = packing.packed(docs, PATH).cache()
    whole = {r["sequence_id"]: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        sequence = whole[r["sequence_id"]]
        assert bytes(sequence["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
        assert r["offset"] in sequence["starts"]
    assert all(len(s["ids"]) <= 4096 for s in whole.values())


def test_no_rows_and_clashing_columns(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    schema = "key string, `my.text` string, piece string, ids int, part int, window int, sequence_id int"
    rows = packing.packed(spark.createDataFrame([("k", "a b", "p", 1, 2, 3, 4)], schema), PATH, "key", "my.text").collect()
    assert [(r["doc_id"], r["piece"], r["length"], r["offset"]) for r in rows] == [("k", 0, 3, 0)]
