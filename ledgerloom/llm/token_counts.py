"""Token counts that follow edits without encoding a document anew.

A text is cut into leaves of ``LEAF_PIECES`` pieces, each beginning at a space before a character that is no white space,
where the pre-tokenizer always begins a new pre-token. So the tokens of a text are those of its leaves, and
a tree over the leaves keeps the sums of their characters and tokens. An edit finds its leaves by descending the
sums of characters; only these are encoded again, with the leaf before them if the edit spoilt the place where they
began, and only the sums above them change.

Texts and edits of a document meet in one task, sorted, and stream by: a task holds one document, however
many edits it has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks
from ledgerloom.llm.pieces import ByteLevel
from ledgerloom.llm.token_shards import default_tokenizer, encoder

LEAF_PIECES = 32
#: A leaf that has grown to so many characters is cut up and the tree is built anew.
LEAF_CHARS = 4096


_TIGHT = re.compile(r" (?=\s|\Z)")


def pieces_of(text: str) -> list[str]:
    """The text parted at the spaces that a character other than white space follows."""
    pieces = text.split(" ")
    if not _TIGHT.search(text):
        return pieces
    out = pieces[:1]
    for piece in pieces[1:]:
        if not piece or piece[0].isspace():
            out[-1] += " " + piece
        else:
            out.append(piece)
    return out


class CountTree:
    """The leaves of one text and the sums over them."""

    def __init__(self, codec: ByteLevel, leaves: list[str], counts: list[int]) -> None:
        self.codec = codec
        self.encoded_chars = 0
        self._build(leaves, counts)

    @staticmethod
    def cut(text: str) -> list[str]:
        pieces = pieces_of(text)
        lead = ["", *[" "] * (len(pieces) - 1)]
        return [
            lead[i] + " ".join(pieces[i : i + LEAF_PIECES]) for i in range(0, len(pieces), LEAF_PIECES)
        ]

    @classmethod
    def of(cls, codec: ByteLevel, text: str) -> CountTree:
        leaves = cls.cut(text)
        return cls(codec, leaves, token_counts(codec, leaves))

    def _build(self, leaves: list[str], counts: list[int]) -> None:
        self.leaves = leaves
        self.base = 1
        while self.base < len(leaves):
            self.base *= 2
        pad = [0] * (self.base - len(leaves))
        self.chars = [0] * self.base + [len(x) for x in leaves] + pad
        self.tokens = [0] * self.base + list(counts) + pad
        for node in range(self.base - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_of(self, at: int) -> tuple[int, int]:
        """The leaf whose end is the first at or behind character ``at``, and the place in it."""
        node = 1
        while node < self.base:
            node *= 2
            if at > self.chars[node]:
                at -= self.chars[node]
                node += 1
        return node - self.base, at

    def _put(self, leaf: int, text: str, count: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.base
        self.chars[node], self.tokens[node] = len(text), count
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, at: int, removed: int, added: str) -> None:
        """Replace ``removed`` characters from ``at`` on by ``added``. Places beyond the text are drawn to its end."""
        at = min(max(0, at), self.n_chars)
        removed = min(max(0, removed), self.n_chars - at)
        first, start = self._leaf_of(at)
        last, stop = self._leaf_of(at + removed)
        text = self.leaves[first][:start] + added + self.leaves[last][stop:]
        # Context: the place where the first leaf begins must still be one where a pre-token begins.
        while first > 0 and not (text[:1] == " " and text[1:2] and not text[1].isspace()):
            if not text:
                break
            first -= 1
            text = self.leaves[first] + text
        self.encoded_chars += len(text)
        if len(text) > LEAF_CHARS:
            new = self.cut(text)
            counts = token_counts(self.codec, new)
            n = len(self.leaves)
            self._build(
                self.leaves[:first] + new + self.leaves[last + 1 :],
                self.tokens[self.base : self.base + first] + counts + self.tokens[self.base + last + 1 : self.base + n],
            )
            return
        self._put(first, text, len(self.codec.alone([text])[0]) // self.codec.dtype.itemsize)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._put(leaf, "", 0)


def token_counts(codec: ByteLevel, leaves: list[str]) -> list[int]:
    """Tokens of each leaf. A leaf that is empty has none."""
    return [len(b) // codec.dtype.itemsize for b in codec.encode(leaves)]


def trees(codec: ByteLevel, texts: list[str]) -> Iterator[CountTree]:
    """The tree of each text. The leaves of some texts are encoded together."""
    for part in chunks(texts):
        cut = [CountTree.cut(t) for t in part]
        counts = iter(token_counts(codec, [leaf for leaves in cut for leaf in leaves]))
        for leaves in cut:
            yield CountTree(codec, leaves, [next(counts) for _ in leaves])


def count_with_edits(docs: DataFrame, edits: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_encoded`` for every row of ``docs``.

    ``edits``: ``doc_id, seq, at, removed, added``; those of a document apply in the order of ``seq`` (ties: of ``at``,
    ``removed`` and ``added``), each to the text the earlier ones left; ``at`` counts characters from 0. ``n_encoded``:
    characters encoded again because of edits. A null text is empty; in an edit a null ``at`` or ``removed`` is 0 and a
    null ``added`` empty. Rows that repeat an id are edited each; rows without id have no edits, and edits of
    unknown documents do nothing. An empty table gives an empty table. Other columns are not looked at.
    """
    path = tokenizer or default_tokenizer()
    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"),
        F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("removed"), F.coalesce("text", F.lit("")).alias("text"),
    )
    changes = edits.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("kind"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"),
        F.coalesce(F.col("at").cast("long"), F.lit(0)).alias("at"), F.coalesce(F.col("removed").cast("long"), F.lit(0)).alias("removed"),
        F.coalesce("added", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = encoder(path)
        names = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_encoded"]
        open_id, open_docs, out = None, [], []  # documents of one id: tree, tokens at first

        def close():
            for tree, before, done in open_docs:
                out.append((open_id, before, done[0], tree.n_tokens, tree.n_chars, tree.encoded_chars))
            open_docs.clear()

        for batch in batches:
            fresh = trees(codec, batch["text"][batch["kind"] == 0].tolist())
            for doc_id, kind, at, removed, text in zip(
                batch["doc_id"], batch["kind"], batch["at"], batch["removed"], batch["text"], strict=True
            ):
                doc_id = doc_id if isinstance(doc_id, str) else None
                if doc_id is None or doc_id != open_id:
                    close()
                    open_id = doc_id
                if kind == 0:
                    tree = next(fresh)
                    open_docs.append((tree, tree.n_tokens, [0]))
                    continue
                for tree, _, done in open_docs:
                    tree.edit(int(at), int(removed), text)
                    done[0] += 1
            yield pd.DataFrame(out, columns=names)
            out.clear()
        close()
        yield pd.DataFrame(out, columns=names)

    # Rows without id are spread by their text, so that they do not meet in one task.
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    kind_of_id = docs.schema["doc_id"].dataType
    return (
        texts.unionByName(changes)
        .withColumn("_key", key)
        .repartition("_key")
        .sortWithinPartitions("_key", "doc_id", "kind", "seq", "at", "removed", "text")
        .drop("_key")
        .mapInPandas(run, "doc_id string, n_tokens long, n_edits long, n_tokens_edited long, n_chars_edited long, n_encoded long")
        .withColumn("doc_id", F.col("doc_id").cast(kind_of_id))
    )
