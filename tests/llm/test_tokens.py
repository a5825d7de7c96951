import glob
import random

import brute
import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from samples import docs, empty, rows  # noqa: F401
from larder.llm import byte_bpe, segments, token_counts, token_orc

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_segments_give_the_librarys_ids(path, rows):
    memo = segments.Memo(path, room=60)  # so small that generations change all the time
    tricky = ["a  <|endoftext|> b, c.", "  x\n\n y <|ENDOFTEXT|>. ", "don't, it's.  ", "ΑΣ Σ. é, 12, 3.4.",
              "A, B.", "e\u0301 É É,", "\u00a0a \u2003 b", " \u0301x", "x\x1cy z", "Ÿ ÿ, İ.", "a\r\n b"]
    for text in [t for _, t in rows if t is not None] + tricky:
        want = memo.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.ids(text), "<u4").tolist() == want, text[:60]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAeé '’s.,!12\n\t \u00a0\x1c<|>endoftxß中"), max_size=40))
def test_segments_of_any_text(text):
    for path in (WORDS, BYTES):
        memo = segments.memo(path)
        want = memo.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.ids(text), "<u4").tolist() == want


def test_orc_files_hold_all_ids_in_order(spark, docs, rows, tmp_path):
    path = str(tmp_path / "ids")
    twice = docs.unionByName(docs.filter("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    token_orc.write(token_orc.encoded(twice, WORDS), path)
    got = {r["doc_id"]: r for r in token_orc.read(spark, path).withColumn(
        "crc", token_orc.crc32("ids")).collect()}
    lead = len(got[None]["ids"])
    want = brute.orc_tokens(rows)
    for doc, (start, n, crc) in want.items():
        r = got[doc]
        assert (r["start"], len(r["ids"]), r["crc"]) == (start + lead, n, crc)
    assert got[6]["ids"] == [2] == got[7]["ids"] and got[None]["start"] == 0
    assert {r["doc_id"] for r in token_orc.lookup(spark, path, [3, 17]).collect()} == {3, 17}
    order = [i for f in sorted(glob.glob(path + "/part-*.orc")) for i in
             orc.ORCFile(f).read(["doc_id"])["doc_id"].to_pylist()]
    assert order == [None, *range(40)]


def test_orc_of_an_empty_table(spark, empty, tmp_path):
    path = str(tmp_path / "none")
    token_orc.write(token_orc.encoded(empty, WORDS), path)
    assert token_orc.read(spark, path).count() == 0


def test_byte_bpe_round_trip(docs, rows):
    out = docs.select("doc_id", byte_bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN)
                      .alias("i"))
    out = out.withColumn("b", byte_bpe.decode(F.col("i"), RANKS, public_tokenizers.PATTERN))
    want = dict(zip([d for d, _ in rows], brute.byte_bpe([t for _, t in rows])))
    text = dict(rows)
    for r in out.collect():
        assert r["i"] == want[r["doc_id"]]
        assert bytes(r["b"]).decode() == (text[r["doc_id"]] or "")


def test_byte_bpe_of_an_empty_table(empty):
    assert empty.select(byte_bpe.encode(F.col("text"), RANKS, "x")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab", max_size=80),
                 st.text(alphabet="theinganoi é\n 's!", max_size=80)))
def test_byte_bpe_of_any_text(text):
    known = segments.memo((RANKS, public_tokenizers.PATTERN), byte_bpe.Pieces)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=known.codec.ranks)
    assert np.frombuffer(known.ids(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_byte_bpe_time_is_linear_in_a_piece():
    known = segments.memo((RANKS, public_tokenizers.PATTERN), byte_bpe.Pieces)
    assert len(known.ids("ab" * 200_000)) > 0


def test_neighbours_fit_as_plain_merging_says(rows):
    known = segments.memo((RANKS, public_tokenizers.PATTERN), byte_bpe.Pieces).codec
    near = [i for i in known.shorter if len(known.bytes[i]) < 7]
    pick = random.Random(4)
    pairs = [(pick.choice(near), pick.choice(near)) for _ in range(30_000)]
    words = [w.encode() for _, t in rows for w in (t or "")[:20_000].split()]
    pairs += [(x, y) for w in words for n in range(1, len(w)) if (x := known.ranks.get(w[:n]))
              in known.shorter and (y := known.ranks.get(w[n:])) in known.shorter]
    wrong = [(x, y) for x, y in pairs if known.apart(x, y) != (
        byte_bpe.merged(known.ranks, known.bytes[x] + known.bytes[y]) == [x, y])]
    assert not wrong and len({known.apart(*p) for p in pairs}) == 2


def test_backtracking_is_used():
    known = segments.memo((RANKS, public_tokenizers.PATTERN), byte_bpe.Pieces).codec
    for word in ("anthropologistically", "untheinganoi", "hhhhhtttttp", "ionsionionsio"):
        assert known.piece(word.encode()) == byte_bpe.merged(known.ranks, word.encode()) \
            or word in known.letters


@pytest.mark.parametrize("chunk, overlap", [(32_768, 1_024), (1_000, 200), (300, 150)])
def test_token_counts_splice_chunks(docs, rows, chunk, overlap):
    want = dict(zip([d for d, _ in rows], brute.library_ids([t for _, t in rows], "byte_bpe_50k.json")))
    text = dict(rows)
    got = token_counts.counts(docs, BYTES, chunk=chunk, overlap=overlap).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_tokens"] == len(want[r["doc_id"]]), r
        assert r["n_bytes"] == len((text[r["doc_id"]] or "").encode())


def test_token_counts_widen_when_nothing_aligns(spark):
    # one run of letters without any boundary, and special strings across the cuts
    rows = [(1, "ab" * 5_000), (2, "<|endoftext|>" * 700), (None, "x" * 999 + " <|endoftext|>" * 300),
            (1, "ab" * 5_000), (3, " " * 4_000 + "x"), (4, "a\u00a0 b " * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_counts.counts(docs, BYTES, chunk=1_000, overlap=200).collect()
    want = brute.library_ids([t for _, t in rows], "byte_bpe_50k.json")
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=key) == \
        sorted(((d, len(i)) for (d, _), i in zip(rows, want)), key=key)


def test_token_counts_of_an_empty_table(empty):
    assert token_counts.counts(empty, BYTES).count() == 0


MIXED = ["ab$$$ cd76xyz9, ef.### Ünï!! a12b'sc 'tis <|endoftext|>x, {a}[1] AB$$ \x00 a\x00b", None, "", "x" * 90 + "1!",
         "中文 字符，ab мир!! 12३ éa$ ß€µ×÷", "<|startoftext|> a<|b c|>d", "don't, it's.\n\n  X.y,z;w"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_new_segments_are_encoded_together(path, rows):
    texts = [t for _, t in rows] + MIXED
    small, known = segments.Memo(path, room=60), segments.Memo(path)
    want = [known.library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for memo in (small, known, known):  # the last time all is known
        assert [np.frombuffer(x, "<u4").tolist() for x in memo.many(texts)] == want
    assert small.many([]) == []


def test_short_pieces_are_merged_side_by_side(monkeypatch):
    known = byte_bpe.Codec(RANKS)
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    draw = random.Random(3)
    pieces = [bytes(draw.choice(b"aetn \xc3\xa9s") for _ in range(draw.randrange(1, 70))) for _ in range(600)]
    pieces += [b"a" * n for n in range(1, 80)] + ["中文字符мир".encode(), b"", b"\x00\xff"]
    monkeypatch.setattr(known.merges, "ROWS", 50, raising=False)
    for piece, ids in zip(pieces, known.pieces(pieces)):
        plain = [known.ranks[piece]] if piece in known.ranks else byte_bpe.merged(known.ranks, piece)
        assert np.frombuffer(ids, "<u4").tolist() == plain == known.piece(piece) if piece else ids == b""
    assert "trie" not in byte_bpe.Codec(RANKS).__dict__  # only long pieces need it
    memo = byte_bpe.Pieces((RANKS, public_tokenizers.PATTERN), room=60)
    for text, ids in zip(MIXED, memo.many(MIXED)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", disallowed_special=())


def test_a_byte_without_a_token_is_an_error(tmp_path):
    (tmp_path / "few").write_bytes(b"YQ== 0\nYg== 1\nYWI= 2\n")
    known = byte_bpe.Codec(str(tmp_path / "few"))
    assert known.pieces([b"abb", b"ab"]) == [b"\2\0\0\0\1\0\0\0", b"\2\0\0\0"]
    with pytest.raises(ValueError):
        known.pieces([b"abc"])


def test_rows_of_no_ids_decode_to_nothing(spark):
    known = byte_bpe.Codec(RANKS)
    ids = known.piece("mír a".encode())
    ranks, pattern = RANKS, public_tokenizers.PATTERN
    some = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, ids[:1])], "n int, ids array<int>").coalesce(1)
    got = {r["n"]: bytes(r["b"]) for r in some.select("n", byte_bpe.decode("ids", ranks, pattern).alias("b")).collect()}
    assert got == {1: "mír a".encode(), 2: b"", 3: b"", 4: known.bytes[ids[0]]}
    none = some.filter("n = 2 or n = 3").select(byte_bpe.decode("ids", ranks, pattern).alias("b")).collect()
    assert [bytes(r["b"]) for r in none] == [b"", b""]
