"""New pieces that begin with a blank go through the library as one text."""

import random

import numpy as np
import public_tokenizers
import pytest

from recspark.llm import tokens


class Counted:
    """The library, counting the pieces and texts that it is given."""

    def __init__(self, library):
        self.library, self.given = library, 0

    def encode(self, pieces, **how):
        self.given += len(pieces)
        return self.library.encode(pieces, **how)

    def encode_batch_fast(self, texts, **how):
        self.given += len(texts)
        return self.library.encode_batch_fast(texts, **how)


def made(rng, n):
    ends = ["", ".", "'s", "'", "!?", " 12", "3é", "\n", "\n\n  ", "  ", "\t", " '", "<|endoftext|>", " \x0b", "\xa0"]
    word = lambda: "".join(rng.choices("abcdeéñTÖ", k=rng.randint(1, 9)))
    return [" ".join(word() + rng.choice(ends) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("cache", [1 << 20, 50, 3])
def test_ids_are_the_librarys(monkeypatch, cache):
    monkeypatch.setattr(tokens, "CACHE", cache)        # a full cache, and one that is forgotten
    e = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    rng = random.Random(cache)
    for _ in range(6):
        some = made(rng, 40) + ["", "日本 語 abc", " "]
        want = [np.array(x.ids, "<u4").tobytes() for x in e.library.encode_batch(some, add_special_tokens=False)]
        assert e.encode(some) == want
        assert len(e.kept) <= cache


def test_pieces_of_a_blank_and_more_are_one_text():
    e = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    e.library = Counted(e.library)
    e.encode([" ".join(f"qx{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26))])
    assert e.library.given <= 3                        # the text's first piece, and one text of all others


def test_another_split_falls_back_to_piece_by_piece(monkeypatch):
    e = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    want = e.encode([" one two three"])
    other = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    other.length[:] = 2                                # lengths that don't meet the pieces' ends
    assert other.encode([" one two three"]) == want
