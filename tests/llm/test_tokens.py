"""Token ids: whole-text parity with the libraries, round trips, files and edge cases."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import AddedToken, Tokenizer

from newsloom.llm import sentence_pieces, token_files
from newsloom.llm.bpe_words import WordEncoder, word_encoder
from newsloom.llm.words import span_hashes

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "a b", " a", "a ", "  a  b  ", "a\nb", "a \n b", "a\n\nb", "it's we'll 'quoted' x'",
    "word.\nNext, one!", "naïve café Été", "a b  c", "　wide space", "x y", "12 345abc6 7.5%",
    "漢字 かな", "\U0001f600 \U0001f600\U0001f3fd", "tab\tand\r\nreturn", "<|endoftext|> <s> </s> <unk>", "▁ ▁x x▁ y",
    "a" * 5000, "ab " * 5000, "\x00\x01 \x7f", "café. ×÷ é'è", "á é", "﻿bom",
]


def random_texts():
    r = random.Random(3)
    alphabet = ["the", "of", "re", "é", "ß", " ", " ", " ", "\n", ".", ",", "'s", "'", " ", "1", "%%%", "\t", "Zz", "▁", "漢", " "]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(1, 200))) for _ in range(400)]


@pytest.fixture(scope="module")
def texts():
    return TEXTS + random_texts()


def test_stretches_give_the_ids_of_whole_texts(texts):
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    coder = word_encoder(BPE)
    for _ in range(2):  # learnt, then remembered
        got = []
        for _, ids, lengths in coder.encode(pa.array(texts, pa.string())):
            got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
        assert got == want
    coder.forget()


SPECIAL_TEXTS = [
    "a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b", "<|endoftext|><|endoftext|>\nx", "x\n<|endoftext|>\n\n y",
    "a  <|endoftext|>  b", "it'<|endoftext|>s", "<|endof", "text|> and", "<<|endoftext|>>", "a<|endoftext|", "|<|endoftext|>é",
    "漢<|endoftext|> \t<|ENDOFTEXT|>", "many words " * 50_000 + "<|endoftext|> end",
]


def test_special_tokens_in_texts_are_tokens_as_in_the_library(spark, texts, tmp_path):
    library = Tokenizer.from_file(BPE)
    r = random.Random(5)
    mixed = ["".join(r.choice(["<|endoftext|>", t or "", " ", "\n", "x"]) for t in r.sample(texts, 6)) for _ in range(200)]
    for some in (SPECIAL_TEXTS, texts + SPECIAL_TEXTS + mixed):
        want = [library.encode(t or "", add_special_tokens=False).ids for t in some]
        coder = word_encoder(BPE, True)
        for _ in range(2):
            got = []
            for _, ids, lengths in coder.encode(pa.array(some, pa.string())):
                got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
            assert got == want
        coder.forget()
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(SPECIAL_TEXTS)), "doc_id bigint, text string")
    start = 0
    for row in sorted(token_files.token_files(docs, BPE).collect(), key=lambda x: x.start):
        ids = np.array(library.encode(SPECIAL_TEXTS[row.doc_id], add_special_tokens=False).ids + [0], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("kind", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"special": False}])
def test_added_tokens_that_look_around_them(tmp_path, kind):
    library = Tokenizer.from_file(BPE)
    library.add_tokens([AddedToken(t, **({"special": True} | kind)) for t in ("[of the]", "[of]")])
    path = str(tmp_path / "model.json")
    library.save(path)
    some = ["a [of the] b", "x[of the]y", "a  [of the]  b<|endoftext|> c", "[of the]", "[of]", "[of]x", "x[of]", "no such token, but more"]
    got = []
    for _, ids, lengths in WordEncoder(path, True).encode(pa.array(some, pa.string())):
        got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("parity", [True, False])
def test_pieces_have_parity_on_whole_texts(texts, parity):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coder = sentence_pieces.PieceEncoder(PIECES, threads=2, parity=parity)
    got = []
    for _, ids, lengths in coder.encode(pa.array(texts, pa.string())):
        got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert got == [library.encode(t or "") for t in texts]
    assert coder.differing == 0


def test_model_file_is_read_field_by_field():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = sentence_pieces.read_model(PIECES)
    assert model.pieces == [library.id_to_piece(i) for i in range(library.vocab_size())]
    assert model.scores == [library.get_score(i) for i in range(library.vocab_size())]
    assert model.unknown == library.unk_id() and model.byte_fallback and model.kind == sentence_pieces.BPE


def test_unigram_models_are_rebuilt():
    pieces = ["<unk>", "▁a", "▁ab", "b", "▁", "a", "c"]
    kinds = [sentence_pieces.UNKNOWN] + [sentence_pieces.NORMAL] * 6
    model = sentence_pieces.Model(pieces, [0.0, -2.0, -2.5, -3.0, -4.0, -3.0, -3.5], kinds, trims=False)
    rebuilt = sentence_pieces.rebuild(model, prefix=True)
    assert rebuilt.encode("ab a", add_special_tokens=False).tokens == ["▁ab", "▁a"]
    assert rebuilt.decode(rebuilt.encode("ab a").ids) == "ab a"


def _field(number, value):
    """A field of a protocol buffer."""
    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def _unigram_file(path, prefix, trims):
    """A model whose pieces are made by a rule: letters, pairs and triples, with near ties in their scores."""
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñó.,!?\n"
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    pieces += [("▁", -3.0, 1)] + [(c, -6.0 - i / 64, 1) for i, c in enumerate(letters)]
    more = {"".join(r.choice(letters[:26]) for _ in range(n)) for n in (2, 3) for _ in range(400)}
    pieces += [(m if r.random() < 0.7 else f"▁{m}", -4.0 * len(m) + r.randrange(3) / 8, 1) for m in sorted(more)]
    pieces = list({p[0]: p for p in pieces}.values())
    body = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    body += _field(2, _field(3, 1) + _field(35, 1) + _field(40, 0) + _field(41, 1) + _field(42, 2))
    body += _field(3, _field(1, b"identity") + _field(3, int(prefix)) + _field(4, int(trims)) + _field(5, 1))
    path.write_bytes(body)
    return str(path)


@pytest.mark.parametrize("prefix, trims", [(True, False), (False, False), (True, True)])
def test_unigram_ids_are_those_of_the_library(spark, tmp_path, prefix, trims):
    model = _unigram_file(tmp_path / "unigram.model", prefix, trims)
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    own = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for r in sentence_pieces.encode_and_decode(docs.union(own), model).collect():
        assert r.ids == library.encode(r.text or ""), r.doc_id


def test_encode_and_decode(spark):
    rows = [(i, t, "own", 5) for i, t in enumerate(TEXTS)] + [(0, None, "own", 5), (None, "x y", "own", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, ids int")
    got = sentence_pieces.encode_and_decode(docs, PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert got.columns == ["doc_id", "text", "ids", "n_tokens", "decoded", "round_trip", "differing"]
    for r in got.collect():
        assert r.ids == library.encode(r.text or "") and r.n_tokens == len(r.ids) and r.differing == 0
        # The marker itself can't be told from a blank.
        assert r.round_trip or "▁" in r.text
    assert got.count() == len(rows)
    assert sentence_pieces.encode_and_decode(docs.limit(0), PIECES).count() == 0


def test_re_pair_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 5000):
        for top in (2, 9, 60_000):
            lengths = r.integers(1, 30, n)
            ids = r.integers(0, top, int(lengths.sum())).astype(np.uint32)
            block = token_files.Block(token_files.pack(ids, lengths, 60_000))
            assert (block.ids() == ids).all()
            ends = np.cumsum(lengths)
            for k in r.integers(0, n, 5):
                a, b = int(ends[k] - lengths[k]), int(ends[k])
                assert (block.read(a, b) == ids[a:b]).all()
            if top == 2 and n == 5000:
                assert len(block.symbols) < len(ids) / 3
    with pytest.raises(ValueError):
        token_files.Block(b"other bytes and more")


def test_re_pair_goes_on_until_no_pair_is_frequent():
    r = np.random.default_rng(2)
    passage = r.integers(0, 50_000, 700)
    parts = [np.concatenate([r.integers(0, 300, 40), passage, r.integers(0, 300, 40)]) for _ in range(200)]
    parts += [np.full(3000, 7), np.tile([1, 2, 3], 500), np.arange(20_000)] + [np.arange(20_000, 21_000)] * 12
    ids, lengths = np.concatenate(parts).astype(np.uint32), np.array([len(x) for x in parts])
    left, right, seq = token_files.re_pair(ids, lengths, 60_000)
    block = token_files.Block(token_files.pack(ids, lengths, 60_000))
    assert (block.ids() == ids).all()
    # Symbols of one document, then the next: no frequent pair is left inside any.
    ends = np.cumsum(block.lengths())
    inside = ~np.isin(ends[:-1], np.cumsum(lengths))
    pairs = (seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:])[inside]
    assert np.unique(pairs, return_counts=True)[1].max() < token_files.LEAST_USES
    assert token_files.expansion_lengths(left, right, 60_000).max() >= 700


def test_token_files(spark, tmp_path):
    rows = [(100 - i, t, "own") for i, t in enumerate(TEXTS)] + [(7, "same", "own"), (7, "same", "own"), (None, "no id", "own")]
    rows += [(1000 + i, "many words " * 60_000 + str(i), "own") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string").repartition(3)
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, BPE, block_ids=500)
    blocks = spark.read.parquet(path)
    assert blocks.count() > 2
    got = sorted(token_files.read_token_files(blocks).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    start = 0
    for r, (i, t, _) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0])), strict=True):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.token_files(docs.limit(0), BPE).count() == 0


def _thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_texts_made_to_collide_under_a_polynomial_do_not():
    one, other = _thue_morse(1024)
    words = [one, other, one[:512] + other[512:], other[:512] + one[512:], "a\x00", "a", "", "A" * 20, "a" * 20, "b" * 8, "b" * 9]
    # The same pieces at other places, and pieces that add up.
    words += ["abcdefgh" + "ijklmnop", "ijklmnop" + "abcdefgh", "abcdefghabcdefgh", "bbcdefghzbcdefgh"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    assert len(set(span_hashes(data, starts, ends).tolist())) == len(words)
    lowered = span_hashes(data, starts, ends, lower=True)
    assert lowered[7] == lowered[8] and len(set(lowered.tolist())) == len(words) - 1


def test_stretches_with_one_hash_are_told_apart(monkeypatch):
    import newsloom.llm.bpe_words as bpe_words

    path = public_tokenizers.path("byte_bpe_50k.json")
    one, other = _thue_morse(1024)
    texts = [one, other, f"{one} {other}", "plain words here", f"x {other}"]
    tokenizer = Tokenizer.from_file(path)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def ids_of(coder):
        out = []
        for _, ids, lengths in coder.encode(pa.array(texts)):
            out += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
        return out

    assert ids_of(bpe_words.WordEncoder(path, True)) == want
    # Even with a hash that knows nothing but the length.
    monkeypatch.setattr(bpe_words, "hash_eights", lambda values, counts, lengths: lengths.astype(np.uint64))
    coder = bpe_words.WordEncoder(path, True)
    assert ids_of(coder) == want and ids_of(coder) == want
