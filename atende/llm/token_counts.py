"""Edit-aware token counts.

A document is kept as a segment tree over leaves of text. Leaves are cut where a single space stands
between two other characters, which is a pre-token border whatever lies around it, so that the tokens
of a document are those of its leaves. An edit touches the leaves it overlaps, plus a neighbour where
it reaches the border; only these are encoded again, and the sums on their paths are updated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.best_fit_packing import vocabulary
from atende.llm.tokens import Encoder, encoder

LEAF_CHARS = 512


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in pieces of at least ``size`` characters that start with a lone space (but for the first)."""
    out, start, at = [], 0, size
    while (at := text.find(" ", at)) >= 0 and at + 1 < len(text):
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            out.append(text[start:at])
            start, at = at, at + size
        else:
            at += 1
    return [*out, text[start:]]


class TokenTree:
    """Characters and tokens of a document by leaf, summed up in a tree."""

    def __init__(self, text: str, encode: Encoder, leaf_chars: int = LEAF_CHARS):
        self.encode, self.encoded_chars = encode, 0
        self.leaves = leaves_of(text, leaf_chars)
        self.width = 1 << max(0, len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for i, leaf in enumerate(self.leaves):
            self.sums[self.width + i] = len(leaf), self._tokens(leaf)
        level = self.width
        while level > 1:
            self.sums[level // 2: level] = self.sums[level: 2 * level].reshape(-1, 2, 2).sum(1)
            level //= 2
        self.encoded_chars = 0  # counted from the first edit on

    def _tokens(self, leaf: str) -> int:
        self.encoded_chars += len(leaf)
        return len(self.encode(leaf)) // 4

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds the character (the last one for the end) and the characters before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at - before >= self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        return min(node - self.width, len(self.leaves) - 1), before

    def _set(self, i: int, leaf: str) -> None:
        self.leaves[i], node = leaf, self.width + i
        change = np.array([len(leaf), self._tokens(leaf) if leaf else 0]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def _next(self, i: int, step: int) -> int | None:
        i += step
        while 0 <= i < len(self.leaves) and not self.leaves[i]:
            i += step
        return i if 0 <= i < len(self.leaves) else None

    def edit(self, at: int, remove: int, insert: str) -> None:
        """Replace ``remove`` characters from ``at`` on; both are cut to the text."""
        at = min(max(at, 0), self.chars)
        remove = min(max(remove, 0), self.chars - at)
        if not remove and not insert:
            return
        first, before = self._find(min(at, max(self.chars - 1, 0)))
        while not self.leaves[first] and (back := self._next(first, -1)) is not None:
            first, before = back, before - len(self.leaves[back])
        text, last = self.leaves[first], first
        while before + len(text) < at + remove:
            last = self._next(last, 1)
            text += self.leaves[last]
        changed = text[: at - before] + insert + text[at - before + remove:]
        members = [first, last]
        # Boundary context: a leaf must start with a lone space and end with no space.
        while (at - before < 2 or len(changed) < 2 or changed[0] != " " or changed[1].isspace()) and (back := self._next(members[0], -1)) is not None:
            changed, before = self.leaves[back] + changed, before - len(self.leaves[back])
            members[0] = back
        while (not changed or changed[-1].isspace()) and (ahead := self._next(members[1], 1)) is not None:
            changed, members[1] = changed + self.leaves[ahead], ahead
        for i in range(members[0] + 1, members[1] + 1):
            if self.leaves[i]:
                self._set(i, "")
        self._set(members[0], changed)

    def text(self) -> str:
        return "".join(self.leaves)


def token_counts(docs: DataFrame, edits: str = "edits", id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_chars_edited, n_edits, n_chars_encoded) of every row.

    ``edits`` is an array of structs (at, remove, insert) applied one after the other: ``remove`` characters from
    character ``at`` on give way to ``insert``; positions beyond the text are cut to it, null edits and null
    members count as none. n_chars_encoded are the characters encoded again for the edits. A null text is
    empty. Repeated rows are counted alike; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(edits).alias("edits"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path or vocabulary())
        for batch in batches:
            out = []
            for body, changes in zip(batch.column("text"), batch.column("edits")):
                tree = TokenTree(body.as_py(), encode)
                before, done = tree.tokens, [c for c in changes.as_py() or () if c]
                for c in done:
                    tree.edit(c["at"] or 0, c["remove"] or 0, c["insert"] or "")
                out.append((before, tree.tokens, tree.chars, len(done), tree.encoded_chars))
            cols = [pa.array([o[k] for o in out], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=schema.names)

    names = ("n_tokens", "n_tokens_edited", "n_chars_edited", "n_edits", "n_chars_encoded")
    schema = T.StructType([rows.schema["doc_id"]] + [T.StructField(n, T.LongType()) for n in names])
    return rows.mapInArrow(count, schema)
