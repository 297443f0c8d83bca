import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pluvio.llm import pieces

PATH = pieces.default_model()
PLAIN = pieces.Encoder(PATH, 0.0)
DROPS = pieces.Encoder(PATH, 0.3)
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "   ", " a", "a ", "a  b", "  a   b  ", "\n\t\r\n", "x▁y", "☃ 😀 é", "z" * 3000, "The quick brown fox", "a" * 41 + " b", " \n x", "  \n"]


def test_without_dropout_as_the_library(documents):
    texts = [r.text for r in documents.limit(150).collect()] + [t for t in ODD if "▁" not in t]
    got = PLAIN.encode(texts, list(range(len(texts))))
    assert [g.tolist() for g in got] == [SP.encode(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80), st.integers(0, 10**9))
def test_lossless(text, doc_id):
    text = text.encode("utf-8", "ignore").decode()
    ids = DROPS.encode([text], [doc_id])[0]
    assert DROPS.pieces.decode(ids) == text


M = (1 << 64) - 1


def _mix(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & M
    x ^= x >> 29
    x = x * 0xA0761D6478BD642F & M
    return x ^ x >> 32


def _plain_words(text):
    """Words with the spaces before them: a word begins at a space that follows something else."""
    out, full = [], " " + text
    for i, c in enumerate(full):
        if i == 0 or (c == " " and full[i - 1] != " "):
            out.append("")
        out[-1] += c
    return out if text else []


def _plain(text, doc_id, rate, seed=pieces.SEED):
    """Merge after merge over a list of symbols, straight from the vocabulary; every candidate draws once, when it comes up."""
    names = {SP.id_to_piece(i).replace("▁", " "): i for i in range(SP.get_piece_size()) if not (SP.is_control(i) or SP.is_unknown(i) or SP.is_byte(i) or SP.is_unused(i))}
    score = {x: SP.get_score(i) for x, i in names.items()}
    symbols = set(names) | {c for x in names for c in x}
    ids = []
    for number, word in enumerate(_plain_words(text)):
        lane = _mix(_mix(_mix(doc_id & M) + seed & M) + number & M)
        at = [(i, i + 1) for i in range(len(word))]
        drawn = {}

        def kept(a, b, c):
            if (a, b, c) not in drawn:
                drawn[a, b, c] = _mix(_mix(a << 42 | b << 21 | c) + lane & M) >> 32 >= int(rate * 2**32)
            return drawn[a, b, c]

        while True:
            found = [(-score[word[a:d]], a, k) for k, ((a, b), (_, d)) in enumerate(zip(at, at[1:])) if word[a:b] in symbols and word[b:d] in symbols and word[a:d] in names and kept(a, b, d)]
            if not found:
                break
            k = min(found)[2]
            at[k : k + 2] = [(at[k][0], at[k + 1][1])]
        for a, b in at:
            piece = word[a:b]
            ids += [names[piece]] if piece in names else [SP.piece_to_id(f"<0x{x:02X}>") for x in piece.encode()]
    return ids


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_against_a_plain_version(documents, rate):
    texts = [r.text[:400] for r in documents.limit(12).collect()] + [t for t in ODD if "▁" not in t and len(t) < 100] + ["x" * 45 + "internationalisation" * 3 + " ☃☃", "日本語 テキスト"]
    e = pieces.Encoder(PATH, rate)
    for i, got in enumerate(e.encode(texts, list(range(100, 100 + len(texts))))):
        assert got.tolist() == _plain(texts[i], 100 + i, rate), texts[i]


def test_every_occurrence_draws_by_itself():
    word = "internationalisation"
    ids = DROPS.encode([" ".join([word] * 300)], [7])[0]
    seen, one = set(), []
    for i in ids.tolist():
        name = DROPS.pieces.bytes_of[i]
        if name.startswith(b" ") and one:
            seen.add(tuple(one))
            one = []
        one.append(i)
    assert len(seen) > 50
    other = DROPS.encode([word, word], [7, 8])
    assert other[0].tobytes() == pieces.Encoder(PATH, 0.3).encode([word], [7])[0].tobytes()
    assert len({DROPS.encode([word], [d])[0].tobytes() for d in range(200)}) > 40
    assert len({pieces.Encoder(PATH, 0.3, seed).encode([word], [7])[0].tobytes() for seed in range(6)}) > 1


def test_neighbours_in_a_batch_change_nothing():
    alone = [DROPS.encode([t], [i])[0].tolist() for i, t in enumerate(ODD)]
    assert [x.tolist() for x in DROPS.encode(ODD, list(range(len(ODD))))] == alone


def test_long_words_as_short_ones(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choice("etaoinshré☃") for _ in range(rnd.randrange(1, 30))) for _ in range(100)) for _ in range(4)]
    a = DROPS.encode(texts, [1, 2, 3, 4])
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    assert [x.tolist() for x in DROPS.encode(texts, [1, 2, 3, 4])] == [x.tolist() for x in a]


def test_too_large_a_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "get_piece_size", lambda self: 70_000)
    with pytest.raises((ValueError, IndexError)):
        pieces.Pieces(PATH)


def test_documents(documents, odd, empty):
    for df in (documents, odd):
        rows = pieces.encode_documents(df).collect()
        assert len(rows) == df.count() and all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
    assert pieces.encode_documents(empty).count() == 0
