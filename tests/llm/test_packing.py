import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest_llm import clashing, documents, ODD
from strikepath.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "a  b   c\n \n d ", "tail ", "\n   x", "<|endoftext|>", "a<|endoftext|> b", "I'll don't\t x", "é́ 　y", "x" * 3000, "\0 a\0b  c"]


def wanted_ids(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [np.array([*e.ids, 0], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_the_library():
    got = packing.Encoder(VOCABULARY).encode(TRICKY)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x[:-1].tolist() for x in wanted_ids(TRICKY)]


def check(out, rows, window=packing.WINDOW):
    ids = {}
    for (i, _), x in zip(rows, wanted_ids([t for _, t in rows]), strict=True):
        ids.setdefault((i, len(x)), x)
    total = 0
    for r in out:
        x = ids[r["doc_id"], r["doc_tokens"]]
        assert zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        total += r["length"]
    assert total == sum(len(ids[i, n]) for i, n in [(i, len(x)) for (i, _), x in zip(rows, wanted_ids([t for _, t in rows]), strict=True)])
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return [sum(n for _, n in parts) for parts in sequences.values()]


def test_round_trip_with_at_most_one_padded_window(spark):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + i, "word " * (13 * i)) for i in range(60)] + [(500 + i, "same " * 700) for i in range(50)] + ODD
    lengths = check(packing.pack(documents(spark, rows), VOCABULARY).collect(), rows)
    assert sum(n < packing.WINDOW for n in lengths) <= 1


def test_one_hot_length_is_cut(spark):
    rows = [(i, "same " * 700) for i in range(40)]
    lengths = check(packing.pack(documents(spark, rows), VOCABULARY).collect(), rows)
    assert sum(n < packing.WINDOW for n in lengths) <= 1


def test_least_squares_fits_a_histogram_that_combinations_can_make():
    histogram = np.zeros(17)
    histogram[[4, 12, 8, 16]] = [30, 30, 20, 5]
    combos = packing.combinations(np.array([4, 8, 12, 16]), 16)
    x = packing.least_squares(combos, histogram)
    made = np.zeros(17)
    for row, n in zip(combos, x, strict=True):
        for length in row[row > 0]:
            made[length] += n
    assert (x >= 0).all() and np.abs(made - histogram).max() < 0.5


def test_odd_rows(spark):
    assert len(packing.pack(clashing(spark, ODD[:6]), VOCABULARY).collect()) == 6
    assert packing.pack(documents(spark, []), VOCABULARY).count() == 0
