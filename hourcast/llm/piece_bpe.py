"""SentencePiece BPE by a table of each prefix's last token.

The merges of a piece model need no list: two neighbours merge if the vocabulary has what they make together, the best
score first and the left one of equals. Every prefix of a text has exactly one last token in its encoding. It is the
token ending there that is compatible with the last token of the rest before it, where two tokens are compatible if
their joined symbols are encoded as these two again (see ``prefix_table``).

White space becomes a visible mark that no piece has behind another character, so a text is a sequence of chunks that
begin with marks, encoded each for itself; a character that the vocabulary lacks ends a chunk as well and is spelled
with byte tokens. The chunks of many texts that are new to a task are encoded in sorted order, so that the table's rows
for what they begin with are made once.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourcast.llm.prefix_table import Met, PrefixTable, slices
from hourcast.llm.store import table
from hourcast.llm.token_counts import piece_model_path

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Merges:
    """What a piece model's merges make, and which tokens they leave side by side."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.pieces = pieces
        self.text = {token: text for text, (token, _) in pieces.items()}

    def merged(self, symbols: str) -> list[str]:
        """The encoding of a short string: of all neighbours that make a piece the best score first, then the left one."""
        row, pieces = list(symbols), self.pieces
        while len(row) > 1:
            best, at = None, -1
            for i in range(len(row) - 1):
                found = pieces.get(row[i] + row[i + 1])
                if found is not None and (best is None or found[1] > best):
                    best, at = found[1], i
            if at < 0:
                break
            row[at:at + 2] = [row[at] + row[at + 1]]
        return row

    def compatible(self, before: int, token: int) -> bool:
        expected = [self.text[token]] if before < 0 else [self.text[before], self.text[token]]
        return self.merged("".join(expected)) == expected


class PieceCoder:
    """Encodes and decodes as the sentencepiece library does with the given BPE model.

    The model must have a piece for every byte, no normalization rules, the white space mark in front of a text, and
    no pieces that a user defined; anything else raises ValueError where the file shows it.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if sp.normalize(" A ́ﬁ  b ") != f"{MARK}{MARK}A ́ﬁ{MARK}{MARK}b{MARK}":
            raise ValueError("the model normalizes texts")
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {i: int(names[i][3:-1], 16) for i in range(n) if sp.is_byte(i)}
        if sorted(self.byte.values()) != list(range(256)):
            raise ValueError("the model has no byte pieces")
        self.byte_id = {b: i for i, b in self.byte.items()}
        plain = [i for i in range(n) if i not in self.byte and not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i))]
        self.merges = Merges({names[i]: (i, sp.get_score(i)) for i in plain})
        self.table = PrefixTable({names[i]: i for i in plain}, self.merges.compatible)
        self.known = {c for i in plain for c in names[i]}
        if not all(c in self.merges.pieces for c in self.known) or any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("pieces of this model cross words or hold characters that are no pieces")
        self.surface = {i: names[i].replace(MARK, " ") for i in plain}
        self.surface |= {i: " ⁇ " for i in range(n) if sp.is_unknown(i)} | {i: "" for i in range(n) if sp.is_control(i)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.written = {i: f"{i}," for i in range(n)}
        self.chunks = Met(self.made)
        #: Line ends that have no piece are cut off their words, which repeat more often then.
        self.line_cut = "\n" not in self.known

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of a string with marks in place of spaces, whatever characters it holds."""
        out, begin = [], 0
        for at, c in enumerate(symbols):
            if c not in self.known:
                out += self.table.encode(symbols[begin:at])
                out += [self.byte_id[b] for b in c.encode("utf-8", "surrogatepass")]
                begin = at + 1
        return out + self.table.encode(symbols[begin:])

    def made(self, chunks: list[str]) -> dict[str, tuple[str, str]]:
        """For each of the sorted chunks its ids, each followed by a comma, and its surface."""
        odd = set().union(*chunks) - self.known
        plain = [c for c in chunks if odd.isdisjoint(c)] if odd else chunks
        written, surfaces, out = self.written, self.surfaces, {}
        for chunk, ids in zip(plain, self.table.encode_all(plain)):
            out[chunk] = ("".join([written[i] for i in ids]), surfaces(ids))
        for chunk in chunks if odd else ():
            if chunk not in out:
                ids = self.encode_symbols(chunk)
                out[chunk] = ("".join([written[i] for i in ids]), surfaces(ids))
        return out

    def surfaces(self, ids: list[int]) -> str:
        if self.byte.keys().isdisjoint(ids):
            return "".join([self.surface[i] for i in ids])
        out, row = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte:
                row.append(self.byte[i])
                continue
            if row:
                out.append(self.spelled(bytes(row)))
                row.clear()
            if i is not None:
                out.append(self.surface[i])
        return "".join(out)

    @staticmethod
    def spelled(data: bytes) -> str:
        """The characters of byte tokens; a byte that is part of none stands for an unknown character each."""
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            pass
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode("utf-8"))
                except UnicodeDecodeError:
                    continue
                at += size
                break
            else:
                out.append("�")
                at += 1
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; the mark in front of it is not part of it."""
        first = next((k for k, i in enumerate(ids) if i not in self.control), None)
        if first is None:
            return ""
        text = self.surfaces(ids[first:])
        return text[1:] if ids[first] in self.merges.text and text.startswith(" ") else text

    def pieces_of(self, text: str) -> list[str]:
        """The text's chunks, with marks."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK + MARK in marked:
            found = _CHUNK.findall(marked)
            if self.line_cut and "\n" in marked:
                return [part for chunk in found for part in re.split("(\n)", chunk) if part]
            return found
        # with single marks every mark begins a chunk: no pattern is needed
        marked = marked.replace(MARK, " " + MARK)
        if self.line_cut and "\n" in marked:
            marked = marked.replace("\n", " \n ")
        return [c for c in marked.split(" ") if c]

    def encode(self, text: str) -> list[int]:
        return [i for c in self.pieces_of(text) for i in self.encode_symbols(c)]


_coders: dict[int, PieceCoder] = {}


def _coder(model: bytes) -> PieceCoder:
    key = hash(model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = PieceCoder(model)
    return _coders[key]


KINDS = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_pieces(docs: DataFrame, model_path: str, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id, n_tokens and the named outputs: ids array<int>, decoded string, ids_sha256, decoded_sha256.

    ids are those of the sentencepiece library without begin or end ids; decoded is its decode(ids). ids_sha256 is that
    of the decimal ids joined by commas. A null or empty text has no ids and decodes to the empty text. One row per row
    of ``docs``, repeated rows included; columns other than doc_id and text are not read.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary: half a MB at any input size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sha256(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in batches:
            for part, texts in slices(batch):
                out: dict[str, list] = {o: [] for o in ("n_tokens", *outputs)}
                rows = [coder.pieces_of(text) for text in texts]
                met = coder.chunks.of(rows)
                for row in rows:
                    found = [met[c] for c in row]
                    ids = "".join([f[0] for f in found])
                    out["n_tokens"].append(ids.count(","))
                    if "ids" in outputs:
                        out["ids"].append(np.array(ids.split(",")[:-1], np.int32))
                    if "ids_sha256" in outputs:
                        out["ids_sha256"].append(sha256(ids[:-1]))
                    if "decoded" in outputs or "decoded_sha256" in outputs:
                        decoded = "".join([f[1] for f in found])[1:]  # every text begins with a mark of its own
                        if "decoded" in outputs:
                            out["decoded"].append(decoded)
                        if "decoded_sha256" in outputs:
                            out["decoded_sha256"].append(sha256(decoded))
                kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v, kinds.get(o, pa.string())) for o, v in out.items())], ["doc_id", *out])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, " + ", ".join(f"{o} {KINDS[o]}" for o in outputs))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), piece_model_path(), ("ids_sha256", "decoded_sha256"))
