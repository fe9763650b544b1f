"""Pieces of Latin words by the tokenizer's model alone."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from lumenvox.llm.tokens import PieceEncoder

LETTERS = "abcdeXYZÀÖØßàöøÿĀŁłıſǅɏéÉÇñ"


@pytest.mark.parametrize(("name", "keeps_space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_latin_words_skip_the_rules(name, keeps_space, monkeypatch):
    encoder = PieceEncoder(public_tokenizers.path(name), keeps_space)
    random.seed(5)
    word = lambda: "".join(random.choices(LETTERS, k=random.randint(1, 12)))
    between = [" ", ", ", ". ", ".\n", "\n", ",\n"]
    texts = ["a " + "".join(word() + random.choice(between) for _ in range(60)) + "end" for _ in range(200)]
    texts += ["a İx X\nİ z\n\ny w.\n v..\nu don't\nI'll e\u0301\ne aª\nº", "a b.\nc.\nd e,\n"]
    expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == expected
    encoder._forget()
    slow = []
    encoded = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda some: slow.extend(some) or encoded(some))
    lines = [f"a {word()}{sign}\n{word()}{sign} {word()}{sign} b" for sign in ("", ",", ".") for _ in range(50)]
    list(encoder.encode(pa.array(lines)))
    assert not set(slow) - {"a"}
