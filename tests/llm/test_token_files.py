"""Shards of wavelet matrices: round trips against the tokenizer, look-ups against the plain ids."""

import random
import zlib

import numpy as np
import pytest

from kestrel.llm import token_files as tf, wavelet

from llm_rows import docs, frame, shipped  # noqa: F401 (fixtures)

PIECES = ["don't", "'s", "'tis", " 'll", "we're", "''s", "'", "re", "l'été", "  ", "\n", "\n\n", " \n", "\t x", "12", "3a", "!!", " ?", "<", ">", "a|b", "é", "ß", "×",
          "÷", "hello", "World", " the", "'D", "'d", "I'm", " 've x", "x'vex", "x'r", "'l", "1's", "_", "-'t"]
EDGES = ["", "<|endoftext|>x", "日本語 text", "a b", "x\x1cy\x00", "﻿q", "a" * 5000, "'", "x'", " ", "\n"]


def plain_ids(text):
    return tf.tokenizer_at(tf.TOKENIZER).encode(text or "", add_special_tokens=False).ids + [tf.END]


def test_pieces_give_the_tokenizers_ids():
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(600)] + EDGES
    encoder = tf.Encoder(tf.TOKENIZER)
    raw = [t.encode() for t in texts]
    ids, edges = encoder(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for d, text in enumerate(texts):
        assert ids[edges[d]:edges[d + 1]].tolist() == plain_ids(text), text


def test_a_piece_with_anothers_hash_is_encoded_by_itself(monkeypatch):
    monkeypatch.setattr(tf, "piece_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["some words here", "more text", "other worlds lie here"]
    encoder = tf.Encoder(tf.TOKENIZER)
    ids, edges = encoder(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [plain_ids(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 7, wavelet.BLOCK_BITS, 70_001])
def test_a_shards_file_answers_like_the_plain_ids(n):
    rng = random.Random(n)
    tokens = np.array([rng.choice([0, 2, 50256, 65535, rng.randrange(65536), rng.randrange(300)]) for _ in range(n)], dtype=np.uint16)
    documents = np.array([(i, i % 5 == 0, 1) for i in range(n)], dtype=wavelet.DOCUMENT)
    shard = wavelet.Shard(wavelet.encode(tokens, documents))
    assert (shard.tokens() == tokens).all() and (shard.documents == documents).all()
    for i in [rng.randrange(n) for _ in range(40 if n else 0)]:
        token = int(tokens[i])
        places = np.flatnonzero(tokens == token)
        assert shard.access(i) == token
        assert shard.count(token) == len(places) and shard.rank(token, i) == (places < i).sum()
        assert (shard.occurrences(token) == places).all()
        k = rng.randrange(len(places))
        assert shard.select(token, k) == places[k]
    assert shard.count(65534) == (tokens == 65534).sum() and shard.count(1 << 20) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(7777, int((tokens == 7777).sum()))


def test_the_file_is_compressed():
    tokens = np.array([random.Random(1).choice([5, 6, 7, 1000]) for _ in range(1 << 17)], dtype=np.uint16)
    assert len(wavelet.encode(tokens, np.array([(1, False, len(tokens))], wavelet.DOCUMENT))) < tokens.nbytes / 2


def written(spark, rows, tmp_path, **more):
    path = str(tmp_path / "shards")
    tf.write(frame(spark, rows), path, **more)
    return tf.shards(spark, path)


def test_documents_come_back_in_id_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60)))) for i in rng.sample(range(10_000), 200)]
    rows += [(-5, None), (20_000, ""), (20_001, "x " * 30_000)] + [(20_002 + i, t) for i, t in enumerate(EDGES)]
    files = written(spark, rows, tmp_path, shard_tokens=500)
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = plain_ids(text)
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in tf.documents(files).collect()) == want
    assert files.count() > 20 and files.agg({"n_tokens": "max"}).first()[0] >= 30_000

    corpus = np.concatenate([plain_ids(t) for _, t in sorted(rows, key=lambda r: r[0])])
    asked = [int(t) for t in corpus[[0, 50, 99]]] + [2, 49_999]
    assert {r.token: r.n for r in tf.counts(files, asked).collect()} == {t: int((corpus == t).sum()) for t in asked}
    got = sorted((r.token, r.place, r.doc_id, r.offset) for r in tf.occurrences(files, asked[:3]).collect())
    starts = {w[0]: w[1] for w in want}
    assert [(t, p) for t, p, *_ in got] == sorted((t, int(p)) for t in set(asked[:3]) for p in np.flatnonzero(corpus == t))
    assert all(starts[d] + o == p for _, p, d, o in got)
    places = spark.createDataFrame([(int(p),) for p in [0, 17, 17, len(corpus) - 1, len(corpus), -1]], "place bigint")
    assert sorted(tuple(r) for r in tf.access(files, places).collect()) == [(p, int(corpus[p])) for p in (0, 17, len(corpus) - 1)]


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "one two"), (None, None), (None, "one two"), (3, "b"), (3, "a"), (3, "a"), (1, "x")]
    got = sorted(tf.documents(written(spark, rows, tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, None, 1, 3, 3, 3]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(np.array(plain_ids(t), "<u4").tobytes()) for _, t in rows)


def test_an_empty_table(spark, tmp_path):
    files = written(spark, [], tmp_path)
    assert tf.documents(files).collect() == [] and tf.counts(files, [1]).collect() == []
