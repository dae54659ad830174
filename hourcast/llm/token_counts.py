"""Token counts: greedy longest-match word pieces by a linear automaton, without building the pieces.

The vocabulary is a trie with two roots, one for pieces that begin a word and one for those that continue it. Each
node has a failure link and the number of pieces that are settled when it is followed, so one pass over a word's
characters adds up the number of pieces (Song et al., Fast WordPiece Tokenization, 2021).
"""
from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourcast.llm.store import table

_WORD = re.compile("[^\x20\x09-\x0d]+")
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
KEPT = 500_000
BEGINS = "▁"


def split_words(text: str) -> list[str]:
    """Maximal runs of characters other than 0x20 and 0x09-0x0D."""
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


class LongestMatch:
    """Number of pieces of a word; a word that cannot be covered counts as one unknown token."""

    def __init__(self, begins: list[str], continues: list[str]):
        self.child: list[dict[str, int]] = [{}, {}]  # node 0 begins words, node 1 continues them
        piece_at = [False, False]
        for root, pieces in ((0, begins), (1, continues)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.child[at]:
                        self.child[at][c] = len(self.child)
                        self.child.append({})
                        piece_at.append(False)
                    at = self.child[at][c]
                piece_at[at] = at != root
        self.fail, self.popped = [-1] * len(self.child), [0] * len(self.child)
        todo = deque([0, 1])
        while todo:
            node = todo.popleft()
            for c, at in self.child[node].items():
                todo.append(at)
                if piece_at[at]:
                    self.fail[at], self.popped[at] = 1, 1
                    continue
                back, pops = self.fail[node], self.popped[node]
                while back >= 0 and c not in self.child[back]:
                    pops += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[at], self.popped[at] = self.child[back][c], pops

    def count(self, word: str) -> int:
        child, fail, popped = self.child, self.fail, self.popped
        node = n = 0
        for c in word:
            while c not in child[node]:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = child[node][c]
        while node > 1:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return n


def piece_vocabulary(model_path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin and that continue words, from a sentencepiece file (unknown, control and byte pieces left out)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    begins, continues = [], []
    for i in range(model.get_piece_size()):
        if model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith(BEGINS):
            begins.append(piece[1:])
        else:
            continues.append(piece)
    return [p for p in begins if p], continues


_counters: dict[tuple[int, int], LongestMatch] = {}


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, one row per row of ``docs`` (only doc_id and text are read).

    Words are the runs of characters other than 0x20 and 0x09-0x0D; n_tokens sums the greedy longest-match pieces of
    all words, an uncoverable word counting one. Null, empty or blank texts have 0 of both.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(piece_vocabulary(model_path))  # one vocabulary, under 1 MB
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, continues = vocabulary.value
        key = (hash(tuple(begins)), hash(tuple(continues)))
        if key not in _counters:
            _counters[key] = LongestMatch(begins, continues)
        match, known = _counters[key].count, {}
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column("text"):
                words, total = split_words(text.as_py() or ""), 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        if len(known) > KEPT:
                            known.clear()
                        n = known[word] = match(word)
                    total += n
                n_words.append(len(words))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), piece_model_path())
