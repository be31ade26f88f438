import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from atende.llm.best_fit_packing import vocabulary
from atende.llm.token_counts import TokenTree, leaves_of, token_counts
from atende.llm.tokens import encoder

SCHEMA = "doc_id long, text string, n_edits string, edits array<struct<at: int, remove: int, insert: string>>"


def test_edits_against_encoding_the_whole_text():
    rnd, encode = random.Random(4), encoder(vocabulary())
    letters = "ab   \n'sé🤦1,."
    some = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    for _ in range(150):
        text = some(rnd.randint(0, 200))
        tree = TokenTree(text, encode, leaf_chars=5)
        for _ in range(12):
            assert (tree.text(), tree.tokens, tree.chars) == (text, len(encode.packed(text)) // 4, len(text))
            at, remove, insert = rnd.randint(0, len(text)), rnd.choice([0, 1, 3, 30, 400]), some(rnd.choice([0, 1, 2, 20]))
            tree.edit(at, remove, insert)
            text = text[:at] + insert + text[at + remove:]


def test_only_touched_leaves_are_encoded_again():
    encode = encoder(vocabulary())
    tree = TokenTree("some words of a long text " * 4000, encode)
    tree.edit(50_000, 3, "new words")
    assert 0 < tree.encoded_chars < 2000
    assert "".join(leaves_of(tree.text())) == tree.text()


def test_counts_of_a_table(spark, documents):
    encode = encoder(vocabulary())
    rows = [(i, t, "x", [(5, 3, "hello there"), (10**6, 7, " end"), None, (None, None, None)]) for i, t in documents]
    rows += [(-1, None, "x", [(0, 0, "abc")]), (-2, "", "x", None), (None, "a b", "x", []), (None, "a b", "x", [])]
    got = token_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = []
    for i, t, _, edits in rows:
        text = t or ""
        for e in edits or []:
            if e and e[0] is not None:
                text = text[: e[0]] + e[2] + text[e[0] + e[1]:]
        expected.append((i, len(encode.packed(t or "")) // 4, len(encode.packed(text)) // 4, len(text)))
    assert sorted(map(repr, [tuple(r)[:4] for r in got])) == sorted(map(repr, expected))
    assert token_counts(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 400_000, "\t" * 400_000, "a" + " " * 60_000 + "b", "x " + " \n" * 40_000 + "\tyes  " + " " * 70_000, ("\u3000" * 60_000 + "z") * 2])
def test_long_white_space_against_the_library(text):
    library = Tokenizer.from_file(vocabulary())
    assert np.frombuffer(encoder(vocabulary())(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
