"""SentencePiece encoding and token records."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import pieces, queries, records
from loadgrain.session import scratch_path

MODEL = queries.tokenizer_path("piece_bpe_32k.model")
BPE = queries.tokenizer_path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "  ", "a", " a  b ", "line\n\nend\t.", "Überaus schön, naïve café", "日本語のテキスト ﬁ",
    "emoji 🙂🙂 and ▁ mark", "x" * 3000, "aaaa " * 400, "'s it's we'll 123 45!!??", "nul \x00 \x1f end",
    "<|endoftext|> as text", "</s><s>", "\r\n mixed   spaces  ",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = "abcdethe  \n.,ñéß日𝔘"
    return ["".join(rng.choices(alphabet, k=rng.randrange(0, 60))) for _ in range(n)]


def plain_viterbi(own, text):
    """All substrings at all places, over the whole text at once."""
    if not text:
        return []
    marked = "▁" + text.replace(" ", "▁")
    longest = max(map(len, own.scores))
    best, back = [0.0] + [None] * len(marked), [None] * (len(marked) + 1)
    for end in range(1, len(marked) + 1):
        for size in range(min(longest, end), 0, -1):
            known = own.scores.get(marked[end - size : end])
            if known and best[end - size] is not None:
                total = best[end - size] + known[0]
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, (size, [known[1]])
        if back[end] is None or marked[end - 1] not in own.scores:
            spelt = [own.byte_ids[b] for b in marked[end - 1].encode()]
            best[end], back[end] = best[end - 1], (1, spelt)
    ids, at = [], len(marked)
    while at:
        size, these = back[at]
        ids = these + ids
        at -= size
    return ids


def test_viterbi_against_brute_force():
    own = pieces.Pieces(MODEL)
    for text in [t for t in TEXTS if t is not None and len(t) < 200] + random_texts(300, 1):
        ids = own.encode(text).tolist()
        total = lambda x: sum(own.scores.get(own.text[i], (0.0,))[0] for i in x)
        plain = plain_viterbi(own, text)
        assert total(ids) == total(plain) and ids == plain, text
        assert own.decode(np.array(ids, dtype=int)) == text.replace("▁", " ")


def test_decoding_agrees_with_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = pieces.Pieces(MODEL)
    for text in random_texts(100, 2):
        ids = library.encode(text)
        assert own.decode(np.array(ids, dtype=int)) == library.decode(ids) == text


def test_memory_of_words_may_be_lost(monkeypatch):
    own = pieces.Pieces(MODEL)
    texts = random_texts(60, 3)
    first = [own.encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    assert [own.encode(t).tolist() for t in texts] == first


def test_documents_round_trip(docs_of):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (4, "a"), (4, "b")]
    docs = docs_of(rows, more=[("ids", "int"), ("n_tokens", "int")])
    got = pieces.encode_documents(docs, MODEL)
    encoded = got.collect()
    assert len(encoded) == len(rows)
    for r in encoded:
        assert r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        assert r.round_trip == (r.doc_id != 9)
    back = {r.doc_id: r.text for r in pieces.decode_documents(got, MODEL).collect() if r.doc_id != 4}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in rows if i != 4)
    assert pieces.encode_documents(docs_of([]), MODEL).collect() == []


def library_ids(text):
    library = records.encoder(BPE).library
    return library.encode(text or "", add_special_tokens=False).ids + [records.END_ID]


def test_records_against_the_library(spark, docs_of, monkeypatch):
    monkeypatch.setattr(records, "SHARD_TEXT_BYTES", 700)
    rows = list(enumerate(TEXTS + random_texts(80, 4)))
    rows += [(None, "no id"), (-5, "below"), (10**15, "above"), (4, "a"), (4, "b")]
    random.Random(5).shuffle(rows)
    folder = scratch_path(spark, "records")
    records.write_records(docs_of(rows, more=[("value", "int"), ("frame", "int")]), BPE, folder)
    index = records.build_index(spark, folder)
    got = sorted(index.collect(), key=lambda r: (r.shard, r.offset))
    assert len({r.shard for r in got}) > 3
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (d, t) in zip(got, order, strict=True):
        ids = library_ids(t)
        assert (r.doc_id, r.n_tokens, r.start) == (d, len(ids), start)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    some = records.read_records(spark, folder, index.where("n_tokens % 2 = 0")).collect()
    expected = [(d, library_ids(t)) for d, t in rows if len(library_ids(t)) % 2 == 0]
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in some))) == sorted(map(repr, expected))


def test_damage_is_noticed():
    shard = b"".join(records.frame(p) + b"\n" for p in (b"one", b"\n\ntwo", b""))
    assert [bytes(p) for _, p in records.frames(shard)] == [b"one", b"\n\ntwo", b""]
    for at in range(len(shard)):
        broken = bytearray(shard)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            list(records.frames(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.frames(shard[:-1]))


def test_no_records(spark, docs_of):
    folder = scratch_path(spark, "records")
    records.write_records(docs_of([]), BPE, folder)
    assert records.build_index(spark, folder).collect() == []


def test_encoder_forgets_safely(monkeypatch):
    monkeypatch.setattr(records, "REMEMBERED", 2)
    own = records.Encoder(BPE)
    for text in [t or "" for t in TEXTS] + random_texts(50, 6):
        ids = np.frombuffer(own.encode(text), dtype=own.kind).tolist()
        assert ids + [records.END_ID] == library_ids(text)


def test_query_of_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert queries.op8_token_records(spark, sf_dir).count() == docs.count()
    got = queries.op4_sentencepiece(spark, sf_dir)
    assert got.where(~F.col("round_trip")).count() == 0 and got.count() == docs.count()


def test_long_words_are_not_remembered():
    own = pieces.Pieces(MODEL)
    text = "short " + "x" * 5000 + " 日本語" * 40 + " short " + "x" * 5000
    assert own.decode(own.encode(text)) == text
    assert own.young and max(map(len, own.young)) <= pieces.LONGEST
    other = records.Encoder(BPE)
    assert other.encode("a" * 900 + " b " + "a" * 900) == other._whole("a" * 900 + " b " + "a" * 900)
    assert max(map(len, other.young)) <= records.LONGEST
