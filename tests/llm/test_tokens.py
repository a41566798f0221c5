"""Packing, token counts and token files against the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import packing, tokencounts, tokenfiles, wordtokens
from quire.session import staging_path

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def ids_of(path, text):
    return tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_pieces_and_places(odd):
    got = packing.pack_documents(odd, WORD, 64).collect()
    want = Counter()
    for r in odd.collect():
        ids = np.array([*ids_of(WORD, r.text), 0], "<u4")
        want.update((r.doc_id, k, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for k, s in enumerate(range(0, len(ids), 64)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 64


def test_packed_sequences_hold_the_ids(odd):
    texts = {r.doc_id: r.text for r in odd.collect()}
    got = packing.pack_documents(odd, WORD, 64).collect()
    for r in got:
        assert r.ids == [*ids_of(WORD, texts[r.doc_id]), 0][r.start : r.start + 64] and len(r.ids) == r.length
    assert sum(len(r.ids) for r in got) == sum(len(ids_of(WORD, r.text)) + 1 for r in odd.collect())


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=25))
@settings(max_examples=150, deadline=None)
def test_plan_is_best_fit_decreasing(histogram):
    bins = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = min((b for b in range(len(bins)) if bins[b] >= length), key=lambda b: bins[b], default=None)
            if fit is None:
                bins.append(40)
                fit = len(bins) - 1
            bins[fit] -= length
    used = Counter()
    for length, a, b, seq, per, at in packing.plan(histogram, 40):
        for rank in range(a, b):
            used[seq + (rank - a) // per] += length
            assert at + ((rank - a) % per + 1) * length <= 40
    assert sum(used.values()) == sum(k * v for k, v in histogram.items())
    assert sorted(40 - x for x in used.values()) == sorted(bins)


def test_token_counts(odd, empty):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in tokencounts.count_tokens(odd, BYTE).collect())
    assert got == Counter((r.doc_id, len((r.text or "").encode()), len(ids_of(BYTE, r.text))) for r in odd.collect())
    assert tokencounts.count_tokens(empty, BYTE).count() == 0


def test_odd_white_space(spark):
    texts = [" ", "\n\n a", "a\n\nb  c\t\td \n", "x  <|endoftext|> y", "   b　 \x1c z", "'S 's're", "á \x00b \x85 c", "\r\n\r\n x \t", "²½ Ⅷ ª µ x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in tokencounts.count_tokens(df, BYTE).collect():
        assert r.n_tokens == len(ids_of(BYTE, texts[r.doc_id]))
    for r in packing.token_pieces(df, WORD, 1000, with_ids=True).collect():
        assert r.ids == [*ids_of(WORD, texts[r.doc_id]), 0]


def test_word_of_very_many_tokens():
    n = (1 << 24) + 5  # more than 24 bits count; a digit is a token
    texts = ["ab " + "7" * n + " cd", "ef " + "7" * n, "gh"]
    enc = wordtokens.WordEncoder(WORD)
    ids, off = enc.encode(pa.array(texts))
    seven, *short = (ids_of(WORD, t) for t in ("7", "ab", "cd", "ef", "gh"))
    assert len(seven) == 1
    parts = [ids[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
    ab, cd, ef, gh = short
    assert [len(p) for p in parts] == [len(ab) + n + len(cd), len(ef) + n, len(gh)]
    assert parts[0][: len(ab)].tolist() == ab and parts[0][len(ab) + n :].tolist() == cd
    assert parts[1][: len(ef)].tolist() == ef and parts[2].tolist() == gh
    assert (parts[0][len(ab) : len(ab) + n] == seven[0]).all() and (parts[1][len(ef) :] == seven[0]).all()
    # Words met later, and met again from the cache, keep their places.
    again, to = enc.encode(pa.array(["cd new", "gh"]))
    assert again[: to[1]].tolist() == [*cd, *ids_of(WORD, "new")] and again[to[1] :].tolist() == gh


def test_plain_words_are_encoded_piece_by_piece():
    """Words that share letters cost no more model calls: a worker remembers pieces, not words."""
    stems = ["deneinen", "oieuxon", "Éenêen", "ß", "x"]
    words = [up(s) + tail for s in stems for up in (str.lower, str.capitalize, str.upper) for tail in ["", ",", "!!", "$$$", "7", "42.", "é×"]]
    words += ["don't", "a<|endoftext|>b", "a<b", "漢字", "é", "x" * 5000 + "7,", "\x1cx"]
    enc = wordtokens.WordEncoder(WORD)
    texts = [" ".join(words), None, "".join(words), *words]
    ids, off = enc.encode(pa.array(texts))
    for t, a, b in zip(texts, off[:-1], off[1:], strict=True):
        assert ids[a:b].tolist() == ids_of(WORD, t)
    enc = wordtokens.WordEncoder(WORD)
    enc.encode(pa.array([s + tail for s in ("one", "Two", "THREE") for tail in ("", ",", ".", "!", ";", ":")]))
    assert len(enc.words) == 3 + 5


def test_token_files_round_trip(spark, odd):
    path = staging_path(spark, "test-shards")
    tokenfiles.write_shards(odd, WORD, path, shard_bytes=4000)
    want = Counter()
    for r in odd.collect():
        ids = np.array([*ids_of(WORD, r.text), 1], "<u4")
        want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfiles.read_shards(spark, path).collect()) == want
    # A key opens its own shard alone; the starts of documents run on over the shards.
    every = spark.read.parquet(f"{path}-keys").count()
    assert every >= 3 and len(tokenfiles.shards_of(spark, path, [6])) == 1 and tokenfiles.shards_of(spark, path, [999]) == []
    found = {r.doc_id: r.ids for r in tokenfiles.fetch(spark, path, [6, 8, 999]).collect()}
    assert sorted(found) == [6, 8] and found[6] == [*ids_of(WORD, odd.where("doc_id = 6").first().text), 1]


def test_perfect_hash():
    h = tokenfiles.key_hashes(np.arange(20_000), np.zeros(20_000, bool), np.zeros(20_000, int))
    slots = tokenfiles.PerfectHash.build(h).slots(h)
    assert sorted(slots.tolist()) == list(range(20_000))


@pytest.mark.parametrize("op", ["pack", "files"])
def test_empty_table(spark, empty, op):
    if op == "pack":
        assert packing.pack_documents(empty, WORD).count() == 0
    else:
        path = staging_path(spark, "test-empty")
        tokenfiles.write_shards(empty, WORD, path)
        assert tokenfiles.read_shards(spark, path).count() == 0
