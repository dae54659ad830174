"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a pre-token has exactly one last token in its BPE encoding (see ``prefix_table``). Two tokens are
compatible if undoing their merges, latest first, never meets a merge across their border that would have come earlier.

The normalizer and the pre-tokenizer are those of the tokenizer's file. White space never joins two pre-tokens and is
dropped. A text of Latin-1 characters is cut into its pre-tokens by one pattern, any other one into white-space-free
chunks; each task keeps what it has met of both (two generations of bounded size). The pre-tokens of many texts that are
new to a task are encoded in sorted order.
"""
from __future__ import annotations

import gc
import hashlib
import json
import re
import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourcast.llm.prefix_table import Met, PrefixTable, slices
from hourcast.llm.store import table

WORD_END = "</w>"
_SHIFT = 0x1000
#: In front of special tokens, and of pre-tokens in byte-level characters; neither is a byte-level or a Latin-1 character.
_SPECIAL, _BYTES = "\ufff0", "\ufff1"
_NEVER = 1 << 60
#: The pre-tokenizer's rules for Latin-1 characters in lower case.
_LATIN_PIECES = re.compile("[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")


_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


_OWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER_BYTES = [b for b in range(256) if b not in _OWN_BYTES]
#: The characters that stand for bytes, and what Latin-1 characters become in them.
_BYTE_CHARS = {b: chr(b) for b in _OWN_BYTES} | {b: chr(256 + n) for n, b in enumerate(_OTHER_BYTES)}
_LATIN_BYTES = {c: "".join([_BYTE_CHARS[b] for b in chr(c).encode()]) for c in range(256)}


def is_latin(text: str) -> bool:
    """Whether all characters are in Latin-1, where no two compose and each has one lower-case character."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PrefixEncoder:
    """Exact BPE ids of pre-tokens, from the vocabulary and the merges of a tokenizer with word-end suffixes."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.text = {i: t for t, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            made, pair = vocab[left + right], (vocab[left], vocab[right])
            self.merged.setdefault(pair, rank)
            if made not in self.rank:
                self.rank[made], self.parts[made] = rank, pair
        self.ids = {self.symbols(t): i for t, i in vocab.items()}
        self.table = PrefixTable({symbols: i for symbols, i in self.ids.items() if self.reachable(i)}, self.fits)

    @staticmethod
    def symbols(token: str) -> str:
        """One character per symbol: a word end is part of the symbol before it."""
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            token = token[: -len(WORD_END)]
            return token[:-1] + chr(ord(token[-1]) + _SHIFT)
        return token

    def reachable(self, token: int) -> bool:
        """Whether the token's own symbols are encoded as this one token."""
        todo = [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                if not self.border_holds(*self.parts[t], self.rank[t]):
                    return False
                todo += self.parts[t]
            elif len(self.symbols(self.text[t])) > 1:
                return False
        return True

    def border_holds(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether no merge across the border of a and b comes earlier than ``before`` and the merges that made them."""
        rank, merged, parts = self.rank, self.merged, self.parts
        while True:
            if merged.get((a, b), _NEVER) < before:
                return False
            made_a, made_b = rank.get(a, -1), rank.get(b, -1)
            if made_a > made_b:
                before, a = made_a, parts[a][1]
            elif made_b >= 0:  # of equal merges the left one comes first, so one at the border precedes b's
                before, b = made_b + 1, parts[b][0]
            else:
                return True

    def fits(self, before: int, token: int) -> bool:
        """Whether a token may follow another; those of the table stand alone anyway."""
        return before < 0 or self.border_holds(before, token)

    def encode_all(self, pieces: list[str]) -> Iterator[list[int]]:
        """Ids of sorted pre-tokens in byte-level characters, whose last character ends a word."""
        return self.table.encode_all(piece[:-1] + chr(ord(piece[-1]) + _SHIFT) for piece in pieces)

    def encode(self, piece: str) -> list[int]:
        return next(self.encode_all([piece])) if piece else []


class Coder:
    """Encodes and decodes texts as the tokenizer of the given JSON does, special tokens in the text included."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        made = json.loads(source)
        model = made["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = PrefixEncoder(model["vocab"], merges)
        library = Tokenizer.from_str(source)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        #: Latin-1 texts need no library call if the file has the rules that _LATIN_PIECES states for them.
        self.latin = made["normalizer"] == _NORMALIZER and made["pre_tokenizer"] == _PRE_TOKENIZER
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.tokens = self.bpe.text | {i: t for t, i in self.special.items()}
        self.number, self.spaced = {i: f"{i} " for i in self.tokens}, {i: f"{t} " for i, t in self.tokens.items()}
        self.special_written = {_SPECIAL + t: self.written([i]) for t, i in self.special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces, self.chunks = Met(self.pieces_made), Met(self.chunks_made)

    def written(self, ids: list[int]) -> tuple[str, str]:
        """Ids, each followed by a space, and their tokens likewise."""
        return "".join([self.number[i] for i in ids]), "".join([self.spaced[i] for i in ids])

    def pieces_made(self, pieces: list[str]) -> dict[str, tuple[str, str]]:
        """For each pre-token its ids, each followed by a space, and its tokens likewise."""
        in_bytes = [p if p.isascii() and p.isprintable() else p[1:] if p[0] == _BYTES else p.translate(_LATIN_BYTES) for p in pieces]
        return {p: self.written(ids) for p, ids in zip(pieces, self.bpe.encode_all(in_bytes))}

    def plain(self, text: str) -> bool:
        """Whether _LATIN_PIECES finds the pre-tokens of a text."""
        return self.latin and is_latin(text) and not any(t in text for t in self.special)

    def split_chunk(self, chunk: str) -> list[str]:
        """A chunk's pre-tokens, and marked special tokens between them."""
        if self.plain(chunk):
            return _LATIN_PIECES.findall(chunk.lower())
        out: list[str] = []
        for part in self.special_at.split(chunk) if self.special_at else [chunk]:
            if part in self.special:
                out.append(_SPECIAL + part)
            elif part:
                out += [_BYTES + p for p, _ in self.split(self.normalize(part)) if p]
        return out

    def chunks_made(self, chunks: list[str]) -> dict[str, tuple[str, str]]:
        """For each chunk its ids, each followed by a space, and its tokens likewise."""
        rows = [self.split_chunk(chunk) for chunk in chunks]
        found = self.pieces.of([[p for p in row if not p.startswith(_SPECIAL)] for row in rows])
        found.update(self.special_written)
        return {chunk: found[row[0]] if len(row) == 1 else ("".join([found[p][0] for p in row]), "".join([found[p][1] for p in row]))
                for chunk, row in zip(chunks, rows)}

    def coded(self, texts: list[str]) -> Iterator[list[tuple[str, str]]]:
        """For each text the ids and tokens of its pre-tokens or chunks."""
        plain = [self.plain(text) for text in texts]
        rows = [_LATIN_PIECES.findall(text.lower()) if easy else _SPACES.split(text) if _ODD_SPACE.search(text) else text.split()
                for text, easy in zip(texts, plain)]
        chunks = self.chunks.of([row for row, easy in zip(rows, plain) if not easy])
        pieces = self.pieces.of([row for row, easy in zip(rows, plain) if easy])
        return ([met[c] for c in row] for row, met in zip(rows, (pieces if easy else chunks for easy in plain)))


#: Seconds without a task after which a worker lets its coder go: workers outlive the stage, and later stages need the memory.
IDLE_S = 5.0
_coders: dict[int, Coder] = {}
_resting: list[threading.Timer] = []


def _coder(source: str) -> Coder:
    """The worker's coder, which its tasks share; ``_rest`` ends a task's use of it."""
    while _resting:
        _resting.pop().cancel()
    key = hash(source)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(source)
    return _coders[key]


def _rest() -> None:
    """Lets the coder and all it has met go unless another task asks for it within ``IDLE_S`` seconds."""
    timer = threading.Timer(IDLE_S, _forget)
    timer.daemon = True
    _resting.append(timer)
    timer.start()


def _forget() -> None:
    _coders.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def encode_documents(docs: DataFrame, tokenizer_path: str, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id, n_tokens and the named outputs: ids array<int>, decoded string, ids_sha256, decoded_sha256.

    ids are those of the tokenizers library with add_special_tokens=False; decoded is its decode(ids,
    skip_special_tokens=False). ids_sha256 is that of the decimal ids joined by one space. A null or empty text, or
    one of white space, has no ids. One row per row of ``docs``; columns other than doc_id and text are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary: a few MB at any input size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sha256(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(source.value)
        try:
            for batch in batches:
                for part, texts in slices(batch):
                    out: dict[str, list] = {o: [] for o in ("n_tokens", *outputs)}
                    for row in coder.coded(texts):
                        ids = "".join([c[0] for c in row])
                        out["n_tokens"].append(ids.count(" "))
                        if "ids" in outputs:
                            out["ids"].append(np.array(ids.split(), np.int32))
                        if "ids_sha256" in outputs:
                            out["ids_sha256"].append(sha256(ids[:-1]))
                        if "decoded" in outputs or "decoded_sha256" in outputs:
                            decoded = "".join([c[1] for c in row])[:-1]
                            if "decoded" in outputs:
                                out["decoded"].append(decoded)
                            if "decoded_sha256" in outputs:
                                out["decoded_sha256"].append(sha256(decoded))
                    types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v, types.get(o, pa.string())) for o, v in out.items())], ["doc_id", *out])
        finally:
            del coder
            _rest()

    kinds = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, " + ", ".join(f"{o} {kinds[o]}" for o in outputs))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), word_bpe_path(), ("ids_sha256", "decoded_sha256"))
