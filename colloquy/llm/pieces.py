"""SentencePiece encoding and decoding that keeps source offsets.

The normaliser walks a text by longest prefixes through the model's compiled character map (a
double-array trie) and records, for every byte of the normalised text, the source byte it stems from.
That text is what is segmented, by the library with the model's pieces and without a normaliser; the pieces
tile it, and the alignment projects each to a span of source bytes. Models without a character map take the
same steps in numpy.

* An empty table gives an empty result; ties don't arise.
* Null texts count as empty; an empty text has no id and decodes to an empty text.
* Texts are encoded whole, however long; rows are encoded each on its own, repeated ones too.
* Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from colloquy.llm import textnum as T

MARK = "▁".encode()


def longest_prefix(units: np.ndarray, data: bytes, at: int) -> tuple[int, int]:
    """Of the trie's keys that data has at `at`, the longest: its value and length, or (-1, 0).

    A unit of the double array holds a label (low byte), a leaf flag (bit 8) and an offset.
    """

    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    node, value, length = offset(int(units[0])), -1, 0
    for k in range(at, len(data)):
        node ^= data[k]
        if node >= len(units):
            break
        unit = int(units[node])
        if unit & 0x800000FF != data[k]:
            break
        node ^= offset(unit)
        if unit >> 8 & 1:
            value, length = int(units[node]) & 0x7FFFFFFF, k - at + 1
    return value, length


@dataclass
class Normalizer:
    """What a model says of normalisation; `charsmap` is its compiled character map."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_extra: bool = False
    escape: bool = True

    def __post_init__(self) -> None:
        size = int.from_bytes(self.charsmap[:4], "little") if self.charsmap else 0
        self.units = np.frombuffer(self.charsmap[4 : 4 + size], "<u4")
        self.strings = self.charsmap[4 + size :]

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte it stems from."""
        if not data:
            return b"", np.zeros(1, np.int64)
        return self._mapped(data) if self.charsmap or self.strip_extra else self._plain(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not self.escape:
            head = b" " * self.dummy_prefix
            return head + data, np.concatenate([np.zeros(len(head), np.int64), np.arange(len(data) + 1)])
        source = np.frombuffer(data, np.uint8)
        widths = np.where(source == 0x20, len(MARK), 1)
        align = np.repeat(np.arange(len(source)), widths)
        head = len(MARK) * self.dummy_prefix
        return MARK * self.dummy_prefix + data.replace(b" ", MARK), np.concatenate([np.zeros(head, np.int64), align, [len(source)]])

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        space = MARK if self.escape else b" "
        out, align, at, end = bytearray(), [], 0, len(data)

        def put(piece: bytes, source: int) -> None:
            out.extend(piece)
            align.extend([source] * len(piece))

        def step(at: int) -> tuple[bytes, int]:
            value, length = longest_prefix(self.units, data, at) if len(self.units) else (-1, 0)
            if length:
                return self.strings[value : self.strings.index(b"\0", value)], length
            width = next((w for bits, w in ((0xF0, 4), (0xE0, 3), (0xC0, 2)) if data[at] >= bits), 1)
            return data[at : at + width], min(width, end - at)

        if self.strip_extra:
            while at < end and step(at)[0] in (b" ", b""):
                at += step(at)[1]
            if at == end:
                return b"", np.array([end])
        if self.dummy_prefix:
            put(space, at)
        blank = self.strip_extra
        while at < end:
            piece, length = step(at)
            while blank and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                put(piece.replace(b" ", space), at)
                blank = self.strip_extra and piece.endswith(b" ")
            at += length
        if self.strip_extra:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)


class Encoder:
    """Ids of texts with spans of source bytes, by the model file at `path`.

    The text that is segmented is the normaliser's here: `plain` is the model without its own."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        spec = model.normalizer_spec
        self.normalize = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self.widths = np.array([1 if p.type == p.BYTE else 0 if p.type in (p.CONTROL, p.UNKNOWN) else len(p.piece.encode()) for p in model.pieces])
        self.unknown = self.library.unk_id()
        self.decimal = [str(k) for k in range(len(model.pieces))]
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def encode(self, texts: list[bytes]) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
        """Of each text the ids, and each piece's start and end in the text's bytes."""
        normal = [self.normalize(data) for data in texts]
        ids = self.plain.encode([x.decode() for x, _ in normal], num_threads=1)
        return [(i, *self._spans(x, align, i)) for (x, align), i in zip(normal, ids)]

    def _spans(self, normal: bytes, align: np.ndarray, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        widths = self.widths[np.asarray(ids, np.int64)] if ids else np.zeros(0, np.int64)
        if self.unknown in ids:  # its width shows only in the piece
            widths = np.array([len(p.encode()) for p in self.plain.encode(normal.decode(), out_type=str)])
        cuts = np.concatenate([[0], np.cumsum(widths)])
        if cuts[-1] != len(normal):
            raise ValueError("the pieces don't tile the normalised text")
        return align[cuts[:-1]], align[cuts[1:]]


def _texts(part: T.Slice) -> list[bytes]:
    return [part.buf[a:b].tobytes() for a, b in zip(part.offs[:-1], part.offs[1:])]


ENCODED = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_source_bytes bigint"


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, ids, and the start and end of each piece in source bytes."""

    def make():
        encoder = Encoder(model_path)

        def work(part: T.Slice, _) -> dict:
            ids, starts, ends = zip(*encoder.encode(_texts(part)))
            lists = lambda values, kind: pa.array(values, pa.list_(kind))
            return {"ids": lists(ids, pa.int32()), "starts": lists(starts, pa.int64()), "ends": lists(ends, pa.int64())}

        return work

    return T.map_texts(docs, id_col, text_col, "ids array<int>, starts array<bigint>, ends array<bigint>", make)


def digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id and ENCODED, of the ids, what they decode to, and the source bytes that the spans cover."""

    def make():
        encoder = Encoder(model_path)

        def work(part: T.Slice, _) -> dict:
            found = encoder.encode(_texts(part))
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            return {
                "n_tokens": np.array([len(i) for i, _, _ in found], np.int64),
                "ids_sha256": pa.array([sha(",".join(map(encoder.decimal.__getitem__, i))) for i, _, _ in found], pa.string()),
                "decoded_sha256": pa.array([sha(encoder.library.decode(i)) for i, _, _ in found], pa.string()),
                "n_source_bytes": np.array([int((ends - starts).sum()) for _, starts, ends in found], np.int64),
            }

        return work

    return T.map_texts(docs, id_col, text_col, ENCODED, make)
