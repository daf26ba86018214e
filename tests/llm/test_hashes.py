"""Words that a polynomial modulo 2**64 can't tell apart: a Thue-Morse word and its complement."""

import random
import re
import zlib

import numpy as np
import pytest

from kestrel.llm import curve_packing, decontam, llr_quality, minhash, repeats, rlz_dedup, textscan as ts

from llm_rows import frame, shipped  # noqa: F401 (fixtures)


def thue_morse(n):
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def hashes(*words, base=0):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    edges = np.cumsum([0, *map(len, words)])
    return ts.range_hashes(ts.byte_values(data), edges[:-1], edges[1:], base)


def test_products_modulo_the_prime():
    rng = random.Random(1)
    a, b = ([rng.choice([0, 1, ts.PRIME - 1, rng.randrange(ts.PRIME)]) for _ in range(4000)] for _ in range(2))
    got = ts.times(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    assert got.tolist() == [x * y % ts.PRIME for x, y in zip(a, b)]


@pytest.mark.parametrize("base", [0, 1])
@pytest.mark.parametrize("n", [64, 128, 256, 512, 4096, 1 << 16])
def test_range_hashes_tell_thue_morse_words_apart(n, base):
    one, two = hashes(*thue_morse(n), base=base)
    assert one != two
    again = hashes("x", thue_morse(n)[0], thue_morse(n)[0], base=base)
    assert again[1] == again[2] == one  # wherever it stands


PAIRS = [thue_morse(256), thue_morse(512)]


def test_repeated_passages_need_equal_words(spark):
    """op10: no window of the second document occurs in the first."""
    rng = random.Random(3)
    rows = []
    for k, (one, two) in enumerate(PAIRS):
        words = [rng.choice("abcdefgh") * 3 for _ in range(20)]
        rows += [(10 * k + 1, " ".join([*words[:10], one, *words[10:]])), (10 * k + 2, " ".join([*words[:10], two, *words[10:]])),
                 (10 * k + 3, " ".join([*words[:10], one, *words[10:]]))]
    got = {r.id: r.n_removed for r in rlz_dedup.parse(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 21, 11: 0, 12: 0, 13: 21}


def test_links_need_equal_shingles(spark):
    """op9: two documents of similarity 12 / 22 are no near copies."""
    rng = random.Random(4)
    for one, two in PAIRS:
        words = ["".join(rng.choice("cdefgh") for _ in range(5)) for _ in range(20)]
        a, b = (" ".join([*words[:10], w, *words[10:]]) for w in (one, two))
        got = {r.id: r.component_id for r in minhash.groups(frame(spark, [(1, a), (2, b), (3, a)])).collect()}
        assert got == {1: 1, 2: 2, 3: 1}


def test_pieces_keep_their_own_ids(spark):
    """op7: both words in one text, whose ids are the tokenizer's; also where hashes do collide."""
    tokenizer = curve_packing.tokenizer_at(curve_packing.TOKENIZER)
    rows = [(k, " ".join(["one", a, "two", b, a])) for k, (a, b) in enumerate(PAIRS)]
    for r in curve_packing.pack(frame(spark, rows)).groupBy("doc_id").agg({"ids": "collect_list"}).collect():
        ids = tokenizer.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [curve_packing.END]
        assert b"".join(r[1]) == np.array(ids, "<u2").tobytes()


def test_a_colliding_piece_is_encoded_by_itself(monkeypatch):
    monkeypatch.setattr(ts, "range_hashes", lambda values, starts, ends, base=0: (ends - starts).astype(np.uint64))
    encoder = curve_packing.Encoder(curve_packing.TOKENIZER)
    texts = ["some words here", "more text", "many other worlds lie here", "a bc def"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, edges, _ = encoder(data, np.cumsum([0, *map(len, texts)]))
    for d, text in enumerate(texts):
        assert ids[edges[d]:edges[d + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [curve_packing.END]


def test_repeated_lines_and_leaks_need_equal_words(spark):
    """op4: two different lines are no repeats; op3: other tokens don't cover an item."""
    for one, two in PAIRS:
        data = np.frombuffer(f"{one}\n{two}\n{one}".encode(), np.uint8)
        assert llr_quality.line_repeats(data, np.array([0, len(data)])).tolist() == [1]
        item = " ".join(f"{one} {w}" for w in "abcdefghijkl")
        other = " ".join(f"{two} {w}" for w in "abcdefghijkl")
        bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
        assert [r.id for r in decontam.leaks(frame(spark, [(1, other), (2, item)]), bench).collect()] == [2]
