import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mediamart.llm import packing
from mediamart.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
@settings(max_examples=60, deadline=None)
def test_patterns_place_every_piece_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    placed = Counter()
    for n, lengths in patterns:
        assert n > 0 and sum(lengths) <= 64
        for size in lengths:
            placed[size] += n
    assert placed == Counter(histogram)


def test_slots_are_ranks_in_a_row():
    histogram = {40: 5, 30: 7, 20: 9, 4: 33}
    patterns = packing.shortest_pack_first(histogram, 64)
    used = defaultdict(set)
    for size, rows in packing.slots(patterns).items():
        ends = [*rows[1:, 0], histogram[size]]
        assert rows[0, 0] == 0
        for (rank, sequence, offset), end in zip(rows, ends):
            for k in range(end - rank):
                spots = {(sequence + k, offset + j) for j in range(size)}
                assert not spots & used[sequence + k]
                used[sequence + k] |= spots


TEXTS = [
    "Plain words, and more.\nLines\ttoo", "", None, "It's we'll I'D '' x'S", "naïve Straße ÀÉ × ÷ ½ ² µ", "日本語 текст ok",
    "é ẛ̣", "<|endoftext|> a<|startoftext|>b", "\x1c\x85  sep arated", "123 4a5 a_b __ %%%", "İstanbul ǅ ΑΣ",
    "x" * 50_000, "😀 👍🏽 mixed😀",
]


def test_encoder_gives_the_tokenizers_ids():
    encoder, tokenizer = Encoder(PATH, most=5), Tokenizer.from_file(PATH)
    assert encoder.by_word
    for text in TEXTS * 2:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text or ""), "<u4").tolist() == ids


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_encoder_on_any_text(text):
    assert np.frombuffer(_ENCODER.encode(text), "<u4").tolist() == _TOKENIZER.encode(text, add_special_tokens=False).ids


_ENCODER, _TOKENIZER = Encoder(PATH), Tokenizer.from_file(PATH)


def test_other_vocabularies_take_the_whole_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Encoder(path)
    assert not encoder.by_word
    assert np.frombuffer(encoder.encode("a  b c"), "<u4").tolist() == Tokenizer.from_file(path).encode("a  b c").ids


@pytest.mark.parametrize("length", [64, 2048])
def test_round_trip(documents, words, length):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again"), (5, "again")]
    rows += [(100 + k, " ".join(words(3 * k % 211, k))) for k in range(300)]
    packed = packing.pack(documents(rows), PATH, length=length, keep_ids=True)
    got = packed.toPandas()
    # pieces: every id of every document once
    for i, text in rows:
        if i in (None, 5):
            continue
        ids = np.array([*_TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = got[got.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        for r in mine.itertuples():
            piece = ids[r.start : r.start + r.length].tobytes()
            assert r.ids_crc32 == zlib.crc32(piece) and bytes(r.ids) == piece
    assert len(got[got.doc_id == 5]) >= 3 and got.doc_id.isna().sum() == 1
    # sequences: no gap, no overlap, nothing over the length
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= length and set(fill.index) == set(range(len(fill)))
    assert fill.sum() / (length * len(fill)) > 0.97
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert all(len(made[s]) == 4 * n for s, n in fill.items())


def test_empty(documents):
    assert packing.pack(documents([]), PATH).count() == 0


def test_words_that_come_again_are_kept_when_the_memory_is_full():
    encoder, tokenizer = Encoder(PATH, most=50), Tokenizer.from_file(PATH)
    texts = [f"The word and w{k}x again, and THE {k} " + "long" * 30 for k in range(400)]
    for text, ids in zip(texts, encoder.encode_all(texts[:200]) + [encoder.encode(t) for t in texts[200:]]):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert "and" in encoder.words and len(encoder.words) <= 60 and len(encoder.before) <= 700
