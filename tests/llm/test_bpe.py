import array
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodework.llm import bpe
from lodework.llm.pieces import pieces
from tests.llm import data

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = list("abc dé́̀  \n\t 　'sSΣσ1 23!?#\x1c\x85İß漢字😀\r") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'re "]


def texts(n=400):
    r = random.Random(1)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("cut_bits", [0, 2, 8])
def test_chunks_agree_with_the_library(path, cut_bits):
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts(), add_special_tokens=False)]
    assert bpe.encode_array(pa.array(texts()), path, cut_bits).to_pylist() == expected


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_and_decoding_agree_with_the_library(path):
    library, own = Tokenizer.from_file(path), pieces(path)
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        for found in (own.encode(t.encode()), own.text_ids(t)):
            assert array.array("I", found).tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_shared_passages_give_shared_chunks():
    passage = data.text(1, 400).encode()
    encoder = bpe.ChunkEncoder(pieces(WORD), 6)
    encoder.encode(b"x " + passage, np.array([0, len(passage) + 2]))
    known = len(encoder._chunks)
    encoder.encode(b"another begin " + passage, np.array([0, len(passage) + 14]))
    assert known > 20 and len(encoder._chunks) - known <= 2


def test_chunks_that_are_met_again_are_not_forgotten():
    encoder = bpe.ChunkEncoder(pieces(WORD), remembered=4)
    met = encoder._chunk(b"often met again")
    for i in range(20):
        encoder._chunk(b"met once %d" % i)
        assert encoder._chunk(b"often met again") is met
        assert len(encoder._chunks) + len(encoder._older) <= 4


def test_awkward_rows(spark):
    docs = data.documents(spark, data.awkward())
    library = Tokenizer.from_file(WORD)
    found = docs.select("text", bpe.round_trip(F.col("text"), WORD).alias("r")).collect()
    assert len(found) == len(data.awkward())
    for row in found:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["r"]["ids"] == ids and row["r"]["decoded"] == library.decode(ids, skip_special_tokens=False)
    both = docs.select("text", bpe.encode(F.col("text"), WORD).alias("ids"))
    assert both.select(bpe.decode(F.col("ids"), WORD).alias("t")).count() == len(data.awkward())
    assert data.empty(spark, data.DOCUMENTS).select(bpe.encode(F.col("text"), WORD)).count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_200_000, "a\t" + " \t\n" * 500_000 + " b", "x" + " " * 10_001 + "y z\n" * 20, "q" * 300_000])
def test_very_long_white_space_and_words(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    assert np.frombuffer(pieces(path).text_ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
