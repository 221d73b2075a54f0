import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docrecords.llm import token_counts as tc
from tests.llm.test_token_counts import TEXTS

RNG = random.Random(1)
LONG = {
    "chinese": "。".join("".join(chr(RNG.randrange(0x4E00, 0x9000)) for _ in range(40)) for _ in range(20)),
    "base64": "".join(RNG.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1500)),
    "code": "if(a1<2){b.c('ll');it's=d['e'];}" * 30 + "<|startoftext|>x!<|endoftext|>" + "éa'́s!̸" * 40,
    "letters": "abcde" * 120,
}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tc.VOCABULARY))


@pytest.mark.parametrize("name", LONG)
def test_long_words_are_cut_where_the_library_says(library, name):
    text, counter = LONG[name], tc.WordCounter(public_tokenizers.path(tc.VOCABULARY))
    counts = [len(e.ids) for e in library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]
    table = counter.prefix_table(text.encode())
    for budget in [*range(1, counts[-1] + 1, max(1, counts[-1] // 40)), counts[-1] - 1, counts[-1]]:
        want = max(k for k, n in enumerate(counts) if n <= budget)
        assert counter.longest_prefix(text.encode(), *table, budget) == len(text[:want].encode()), budget


def test_all_texts_have_a_longest_prefix(library):
    counter = tc.WordCounter(public_tokenizers.path(tc.VOCABULARY))
    for text in TEXTS:
        data, n = text.encode(), len(library.encode(text, add_special_tokens=False).ids)
        for budget in {n, n - 1, n - 2} - {0, -1, -2}:
            fit = data[: counter.longest_prefix(data, *counter.prefix_table(data), budget)].decode()
            assert fit and len(library.encode(fit, add_special_tokens=False).ids) <= budget
            more = [text[:k] for k in range(len(fit) + 1, min(len(text), len(fit) + 40) + 1)]
            assert all(not m[len(fit) :].strip() or len(library.encode(m, add_special_tokens=False).ids) > budget for m in more)
