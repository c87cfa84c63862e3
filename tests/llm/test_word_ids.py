"""Ids of words against the tokenizer itself, over all assigned code points."""

import unicodedata

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from genoweave.llm.packing import WordIds

#: What stands around a code point.
FORMS = ["{}.", "{}'s", "a{},", "{}a,", "{}\u0301."]


def test_ids_of_all_code_points():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = WordIds(path, 100_000)
    letters = [chr(c) for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    wrong = []
    for form in FORMS:
        for at in range(0, len(letters), 100_000):
            texts = [form.format(c) for c in letters[at : at + 100_000]]
            for text, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                if np.frombuffer(ids.of(text.encode()), "<u4").tolist() != e.ids:
                    wrong.append(text)
    assert not wrong, (len(wrong), wrong[:20])


def test_ids_of_special_tokens_and_capitals():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, ids = Tokenizer.from_file(path), WordIds(path, 1_000)
    for text in ("<|endoftext|>", "<|ENDOFTEXT|> A", "x<|startoftext|>y. Z", "<|EndOfText|>.", "TATİL. İ, é.", "DON'T stop, I'LL.", "a|>b <|c|>", "", "  \t\n"):
        assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
