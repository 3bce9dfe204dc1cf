"""Ids of words remembered by the encoder, against the tokenizer's own."""

from __future__ import annotations

import numpy as np
import pytest
from vaultsmith.llm import _tokens

TEXTS = ["a\nb", "\n", "\na", "a\n", "a\n\nb", "a \nb", "a\n b", "it's\nIt's (x).\n'tis", " one,\nTwo ... 3.14,\n12!", "ñandú,\n漢字.\nŁódź", "a\r\nb\tc"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_line_ends_and_marks_give_the_tokenizers_ids(name):
    enc = _tokens.ChunkEncoder(_tokens.tokenizer_path(name))
    for text in TEXTS:
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_around_a_line_end_are_remembered_apart():
    enc = _tokens.ChunkEncoder(_tokens.tokenizer_path("byte_bpe_50k.json"))
    names = [a + b for a in "abcdefghij" for b in "klmno"]
    for before in names:
        enc.encode("".join(f"of {before}.\n{after} " for after in names).strip())
    assert len(enc._spaced) <= 4 * len(names)
    assert len(enc._parts) <= 4 * len(names)
