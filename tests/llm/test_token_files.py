import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import encode, packing, shared, token_files
from tests_llm_helpers import corpus, docs, folder, no_docs  # noqa: F401


def plain(name, texts, end):
    """Ids by the tokenizer alone, text by text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(encode.tokenizer_path(name))
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for t in texts]


@pytest.mark.parametrize("name,blank", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_encoder_equals_the_tokenizer(corpus, name, blank):
    texts = [t or "" for _, t, *_ in corpus] + ["a  b", "  x", " a", "a ", "\n\nA b\n c \n", "İ Σς ΑΣ", "é x"]
    made = encode.encoder(encode.tokenizer_path(name), blank).encode(texts)
    for got, want in zip(made, plain(name, texts, 0)):
        assert np.frombuffer(got, "<u4").tolist() == want[:-1].tolist()


@pytest.mark.parametrize("name,blank", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_long_texts_small_slices_and_forgetting(corpus, name, blank, monkeypatch):
    monkeypatch.setattr(encode, "LONG", 40)
    monkeypatch.setattr(encode, "KNOWN_PARTS", 50)
    texts = [t for _, t, *_ in corpus if t is None or len(t) < 20_000] + ["b  " * 90, "<|startoftext|>a<|endoftext|> b " * 9, "x" * 100 + " y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    one = encode.Encoder(encode.tokenizer_path(name), blank)
    got, rows = [], 0
    for some in encode.slices(batch, "text", 500):
        ids, ends = encode.closed(*one.column(some.column("text")), 7)
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
        rows += some.num_rows
    assert rows == len(texts) and got == [x.tolist() for x in plain(name, texts, 7)]


def test_read_back_is_spread_over_tasks(spark, docs, folder, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 2000)
    monkeypatch.setattr(token_files, "TASK_IDS", 20_000)
    files = shared.staged(token_files.write(docs, folder, "word_bpe_49k.json", 2), folder, "manifest")
    back = token_files.read(files)
    assert files.count() > 4 and back.rdd.getNumPartitions() > 4 and back.count() == docs.count()


@pytest.mark.parametrize("n,top", [(0, 1), (1, 5), (4096, 1), (4097, 50_000), (9000, 2**32 - 1)])
def test_blocks_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    ids[::97] = top - 1
    blob = token_files.encode_file([1], [n], ids)
    assert blob.startswith(token_files.MAGIC) and blob.endswith(token_files.MAGIC)
    blocks = token_files.encode_blocks(ids)
    if n:
        assert (token_files.decode_blocks(blocks)[:n] == ids).all()


def test_ranges_and_broken_files(tmp_path):
    ids = np.arange(20_000, dtype="<u4") * 7
    uri = f"file://{tmp_path}/x.pfor"
    shared.put(uri, token_files.encode_file([1, 2], [5000, 15_000], ids))
    file = token_files.TokenFile(uri)
    for start, length in ((0, 0), (0, 20_000), (4095, 2), (4096, 4096), (19_999, 1)):
        assert file.ids(start, length).tolist() == ids[start : start + length].tolist()
    (tmp_path / "y.pfor").write_bytes(b"no such file format at all, but long enough to be read as one")
    with pytest.raises(ValueError):
        token_files.TokenFile(f"file://{tmp_path}/y.pfor")


def test_documents_round_trip(docs, corpus, folder):
    files = shared.staged(token_files.write(docs, folder, "word_bpe_49k.json", 2), folder, "manifest")
    got = [tuple(r) for r in token_files.read(files).collect()]
    order = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for row, ids in zip(order, plain("word_bpe_49k.json", [r[1] for r in order], 2)):
        want.append((row[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=key) == want


def test_empty_table(no_docs, folder):
    files = shared.staged(token_files.write(no_docs, folder, "word_bpe_49k.json", 2), folder, "manifest")
    assert token_files.read(files).collect() == []
    assert packing.packed_documents(no_docs, folder, "byte_bpe_50k.json", 1).collect() == []


def test_best_fit_equals_a_plain_search():
    draw = np.random.default_rng(3)
    for window, n in ((10, 60), (64, 300), (2048, 500)):
        lengths = draw.integers(1, window + 1, n)
        place, offset, windows = packing.best_fit(lengths, window)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in room if r[0] >= lengths[i]]
            best = min(fits, key=lambda r: r[0])[0] if fits else None
            if best is None:
                room.append([window])
                best = window
            slot = next(r for r in room if r[0] == best)
            want[i] = best
            slot[0] -= lengths[i]
        assert windows == len(room)
        assert {i: window - offset[i] for i in range(n)} == want  # the room each piece found
        used = np.zeros((windows, window), int)
        for p, o, length in zip(place, offset, lengths):
            used[p, o : o + length] += 1
        assert used.max() == 1


def test_packing_keeps_every_id(docs, corpus, folder):
    cut = shared.staged(packing.pieces(docs, "byte_bpe_50k.json", 1, with_ids=True), folder, "pieces")
    got = packing.pack(cut, folder, group_pieces=10).drop("row")
    rows = got.collect()
    ids = plain("byte_bpe_50k.json", [r[1] for r in corpus], 1)
    assert sum(r.length for r in rows) == sum(map(len, ids))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    for row, want in zip(corpus[:-2], ids):
        parts = sorted(by_doc[row[0]], key=lambda r: r.start)
        if row[0] != corpus[-2][0]:  # the repeated row
            assert b"".join(bytes(p.ids) for p in parts) == want.tobytes()
            assert {p.doc_tokens for p in parts} == {len(want)}
    spots = {}
    for r in rows:
        spots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(spots) == list(range(len(spots)))
    for pieces in spots.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    padded = packing.sequences(got).collect()
    assert len(padded) == len(spots) and all(len(r.input_ids) == 2048 for r in padded)
