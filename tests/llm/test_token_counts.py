import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from mediamart.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def stream(spark, files, block, width=2):
    """Blocks of flat files given as lists of ids."""
    rows = []
    for name, ids in files.items():
        raw = np.array(ids, f"<u{width}").tobytes()
        rows += [(name, k, bytearray(raw[at : at + block])) for k, at in enumerate(range(0, len(raw), block))]
    return spark.createDataFrame(rows, "file string, block int, bytes binary").repartition(3)


def brute(files, end):
    out = []
    for name, ids in files.items():
        start, n = 0, 0
        for k, i in enumerate(ids):
            if i == end:
                out.append((name, n, start, k - start, True))
                start, n = k + 1, n + 1
        if start < len(ids):
            out.append((name, n, start, len(ids) - start, False))
    return sorted(out)


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(token_counts, "RUN", 4)
    rng = np.random.default_rng(block)
    files = {
        "mixed": np.where(rng.random(300) < 0.1, 9, 5).tolist(),
        "ends": [9] * 17,
        "none": [5] * 100,
        "long": [5] * 150 + [9] + [5] * 90 + [9],
        "one": [9],
        "open": [9, 5],
    }
    got = token_counts.counts(stream(spark, files, block), 9, 2).collect()
    assert sorted(tuple(r) for r in got) == brute(files, 9)


def test_four_bytes(spark):
    files = {"a": [70_000, 2, 131_074, 2, 2]}
    got = token_counts.counts(stream(spark, files, 8, 4), 2, 4).collect()
    assert sorted(tuple(r) for r in got) == brute(files, 2)


def test_files_hold_the_documents_in_order(spark, documents):
    texts = ["first text", "", None, "</s> <s> \x02\x00 in text", "日本語 \U0001f600", "long " * 30_000, "same", "same"]
    folder = token_counts.write_flat(documents(list(enumerate(texts))).coalesce(1).sortWithinPartitions("doc_id"), PATH)
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = token_counts.counts(token_counts.blocks(spark, folder, 2, 4_096), 2, 2).orderBy("document").collect()
    assert [r.tokens for r in got] == [len(processor.encode(t or "")) for t in texts]
    assert all(r.ended for r in got)


def test_empty(spark, documents):
    folder = token_counts.write_flat(documents([]), PATH)
    assert token_counts.counts(token_counts.blocks(spark, folder, 2), 2, 2).count() == 0
    with pytest.raises(ValueError):
        token_counts.blocks(spark, folder, 2, 3)


def test_files_longer_than_one_cell_may_be(spark, tmp_path):
    ids = np.where(np.arange(5_000) % 7 == 3, 9, 5)
    ids.astype("<u2").tofile(tmp_path / "part-0")
    (tmp_path / "part-1").touch()
    name = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")  # as a file over 2 GiB is to the real one
    try:
        parts = token_counts.blocks(spark, str(tmp_path), 2, 64)
        got = token_counts.counts(parts, 9, 2).drop("file").collect()
        assert max(len(r.bytes) for r in parts.collect()) == 64
    finally:
        spark.conf.set(name, before)
    assert sorted(tuple(r) for r in got) == [r[1:] for r in brute({"a": ids.tolist()}, 9)]
