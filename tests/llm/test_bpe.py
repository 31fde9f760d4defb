import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest_llm import clashing, documents, ODD
from strikepath.llm import bpe

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
MINE = bpe.WordBpe(VOCABULARY)
PARTS = st.sampled_from(["the", " ", "ing", "aaaa", "É", "é", "ΑΣ", "ß", "İ", "<|endoftext|>", "</w>", "12", "²", "漢字", "😀", "'s", "\n", "\x1c", "　", "_!", "\U0003f0b1", "꟢"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=6)), max_size=12).map("".join))
def test_encode_and_decode_equal_the_library(text):
    ids, decoded = MINE.encode([text])[0]
    wanted = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == wanted
    assert decoded.decode() == LIBRARY.decode(wanted, skip_special_tokens=False) == MINE.decode(wanted)


def test_compatibility_agrees_with_exact_merging():
    words = ["".join(MINE.bytes[b] for b in w.encode()) for w in ("internationalisation", "aaaaaaa", "thththe", "éèêë", "unhappiness", "x")]
    for word in words:
        proposal = MINE.propose(word)
        stands = MINE.compatible(np.array(proposal[:-1]), np.array(proposal[1:])).all()
        assert stands == (proposal == MINE.merge(word))
    assert MINE.encode_words(words) == [MINE.merge(w) for w in words]


def test_query_and_general_form_agree(spark):
    rows = ODD + [(50, "Hello WORLD's <|startoftext|> café"), (51, "a  b\n c")]
    digests = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(clashing(spark, rows), VOCABULARY).collect()}
    encoded = bpe.encode(documents(spark, rows), VOCABULARY)
    pairs = zip(sorted(encoded.collect(), key=str), sorted(bpe.decode(encoded, VOCABULARY).collect(), key=lambda r: str(r["doc_id"])), strict=True)
    assert encoded.count() == len(rows) and all(e is not None for e in pairs)
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()) in digests
    assert bpe.round_trip(documents(spark, []), VOCABULARY).count() == 0
