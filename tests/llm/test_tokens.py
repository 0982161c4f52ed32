"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pytest

from tickvault.llm import sentence_pieces

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return sentence_pieces.Encoder(sentence_pieces.PieceModel(PATH))


def awkward(library):
    rng = random.Random(1)
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    letters = ["abcdefghijklmnopqrstuvwxyz", " ab", " \n\tx", "éñß日本語😀؀a ", "aaaa b", "ngi thnde", "0123456789.",
               "▁ a", "\x00\x01a"]
    texts = ["", None, "a", " ", "  ", "▁", " " * 40, " " * 900, "a" * 5000, "ng" * 250, "ng" * 400, "inging" * 30]
    texts += ["".join(rng.choices(rng.choice(letters), k=rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 12))).replace("▁", rng.choice([" ", ""])) for _ in range(1500)]
    return texts + ["".join(rng.choices("abcdeinogrth", k=k)) for k in (500, 511, 512, 513, 3000)]


def test_ids_and_texts_are_the_librarys(library, encoder):
    texts = awkward(library)
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids.tolist() == want, text
        assert encoder.decode(ids).decode() == library.decode(want), text


def test_rounds_and_queue_agree(library, encoder, monkeypatch):
    texts = awkward(library)
    whole = [x.tolist() for x in encoder.encode(texts)]
    for limit in (0, 10 ** 9):
        monkeypatch.setattr(sentence_pieces, "LONG", limit)
        other = sentence_pieces.Encoder(encoder.m)
        assert [x.tolist() for x in other.encode(texts)] == whole


def test_words_forgotten_in_between(library, encoder, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHED", 3)
    texts = [f"word{k % 7} and {k} more" for k in range(50)]
    for k in range(0, 50, 10):
        assert [x.tolist() for x in encoder.encode(texts[k:k + 10])] == \
            library.encode(texts[k:k + 10], add_bos=True, add_eos=True)


def test_decoding_any_ids(library, encoder):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(library.vocab_size()) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randint(0, 7))]
        assert encoder.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_documents(spark, docs, rows, empty, library):
    def want(r):
        ids = library.encode(r[1] or "", add_bos=True, add_eos=True)
        return (r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    got = sentence_pieces.digests(docs, PATH)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(want, rows), key=repr)
    coded = sentence_pieces.encode(docs, PATH)
    assert sorted(((r[0], r[1]) for r in coded.collect()), key=repr) == \
        sorted(((r[0], library.encode(r[1] or "", add_bos=True, add_eos=True)) for r in rows), key=repr)
    assert sorted(map(tuple, sentence_pieces.decode(coded, PATH).collect()), key=repr) == \
        sorted(((r[0], r[1] or "") for r in rows), key=repr)
    assert sentence_pieces.digests(empty, PATH).count() == sentence_pieces.encode(empty, PATH).count() == 0
