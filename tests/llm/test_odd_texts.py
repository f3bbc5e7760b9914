"""op7: texts that must be encoded one by one are found by substring search."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from slicecheck.llm import packed_ids
from slicecheck.llm.queries import WORDS


def test_odd_texts_are_found_and_encoded_as_the_library_does():
    odd = ["a <|endoftext|> b", "x\x02y", "p\x1cq", "p\x1dq", "p\x1eq", "p\x1fq", "ΣΑΣ σας"]
    plain = ["plain words, here.", "", "café au lait", "< | apart"]
    assert [packed_ids.is_odd(t) for t in odd] == [True] * len(odd)
    assert [packed_ids.is_odd(t) for t in plain] == [False] * len(plain)
    tokenizer = Tokenizer.from_file(WORDS)
    texts = odd + plain + ["Καλημέρα ΣΑΣ", "word"]
    flat, starts = packed_ids.LibraryIds(WORDS).encode(texts)
    for i, text in enumerate(texts):
        assert flat[starts[i] : starts[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.all(np.diff(starts) >= 0)
